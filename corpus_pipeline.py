"""Corpus cleaning in stages over ``documents``; each stage works on all rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm import decontaminate, language, mixing, near_dedup, pii
from ringlake.llm.spaces import free_names, staged, table


def identify_languages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trains on the labelled rows of ``docs``; a row stays if its predicted language has at least half of the probability.

    Null, empty and letterless texts go, and all rows where no row has a language to learn from. Texts of any length are judged
    whole; ties take the first name, repeated rows are judged alike, an empty table stays empty, further columns pass through.
    """
    return language.keep_identified(docs, language.fit(docs.select("text", "lang")))


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, stays of every group of exact and near copies (a Jaccard similarity of 0.8 or
    more of the five-word shingles).

    Null and wordless texts are one group, null ids come last, ties of ids go by the text's hash, repeated rows leave one, texts
    are compared whole, an empty table stays empty, further columns pass through.
    """
    return near_dedup.one_of_each(docs)


def drop_benchmark_leaks(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go: 0.6 of its words under common runs of five, in any order.

    Null and empty texts and items match nothing, items under five words only whole texts; repeated rows are judged alike,
    texts are read whole, either table may be empty, further columns pass through.
    """
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_private_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private data becomes surrogates; ``n_chars`` follows the text. The key is ``ringlake.pii.secret``, else the session's own.

    Null texts stay null with a null ``n_chars``, empty ones empty; repeated rows are replaced alike, ties do not arise, texts are
    read whole, an empty table stays empty, further columns pass through.
    """
    found = pii.replaced(docs, pii.session_key(spark), found_col=None)
    return found.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies``, the times each is taken, and ``size``, ``source_size`` and ``target``;
    columns of these names that ``docs`` has give way.

    Null and wordless texts have no words and are never taken; null sources are one source; repeated rows each count; ties in the
    seeded order are between equal rows; texts are counted whole, an empty table stays empty, further columns pass through.
    """
    names = ["size", "source_size", "target", "copies"]
    (row,) = free_names(docs, "row")
    rows = staged(docs.drop(*names).withColumn(row, F.monotonically_increasing_id()), "mix-rows")  # numbered once, so that equal rows stay apart
    found = mixing.mixed_documents(rows, keep=row).where("copies > 0").select(row, *names)
    return rows.join(found, row).drop(row)


STAGES = [
    ("language", identify_languages),
    ("near_copies", drop_near_copies),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("private_data", replace_private_data),
    ("mix", mix_sources),
]

#: No SQL can train the language model or draw the surrogates; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
