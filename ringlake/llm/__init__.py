"""Training-data operators: language, toxicity, licences, duplicates, decontamination, PII, mixing.

Nothing outside this subpackage imports it; ``llm/catalog.py`` registers its queries.
"""
