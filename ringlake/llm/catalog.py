"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from ringlake.llm.decontaminate import op8_greedy_tiling_decontamination
from ringlake.llm.hard_negatives import op13_threshold_hard_negatives
from ringlake.llm.html_text import op3_tree_model_html_text
from ringlake.llm.imatch import op5_imatch_fingerprints
from ringlake.llm.language import op10_byte_cnn_language
from ringlake.llm.licenses import op1_license_scan
from ringlake.llm.mixing import op6_min_cost_flow_mixing
from ringlake.llm.near_dedup import op7_simhash_near_dedup
from ringlake.llm.pii import op9_keyed_surrogates
from ringlake.llm.substring_dedup import op4_debruijn_substring_dedup
from ringlake.llm.token_files import op12_frame_packed_tokens
from ringlake.llm.toxicity import op2_toxicity_noisy_or
from ringlake.llm.vector_codes import op11_walsh_vector_codes


#: Windows of 35 words grouped and counted; a word goes if one of the last 35 windows that began up to it occurs twice.
REPEATS = """WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w)), twice AS (SELECT h FROM win GROUP BY 1 HAVING count(*) > 1), bad AS (SELECT doc_id, i FROM win WHERE h IN (FROM twice)),
words AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
kept AS (SELECT words.doc_id, words.i, word, max(CASE WHEN bad.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM words LEFT JOIN bad ON bad.doc_id = words.doc_id AND bad.i = words.i),
sums AS (SELECT doc_id, sum(gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS t FROM kept GROUP BY 1)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN sums ON sums.doc_id = w.doc_id"""
EDITED = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), n AS (SELECT *, length(t) AS n, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nxt FROM d)
SELECT doc_id, n AS n_chars, sha256(left(t, n - n // 2) || left(nxt, n // 2)) AS edited_sha256 FROM n"""
#: The level of water over sources: those whose triple size lies under it are full.
TARGETS = """WITH s AS (SELECT doc_id, source, CAST(len(coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), [])) AS BIGINT) AS size FROM documents), g AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM s GROUP BY 1),
w AS (SELECT *, [5.0, 2.0, 1.0][(i - 1) % 3 + 1] AS weight, 3.0 * source_size AS cap FROM g), o AS (SELECT *, cap / weight AS ratio, coalesce(sum(cap) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, sum(source_size) OVER () AS total FROM w),
l AS (SELECT arg_min(level, (ratio, i)) AS level FROM (SELECT (total - before) / open AS level, ratio, i FROM o) WHERE level <= ratio)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(least(cap, weight * coalesce(level, cap)), 6) AS target FROM s JOIN o ON o.source IS NOT DISTINCT FROM s.source CROSS JOIN l"""


def usable_vectors(scale: int) -> str:
    """Rows whose vector is whole, its components as integers."""
    return f"""SELECT vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"""


def vector_rounds(rounds: int = 4) -> str:
    """Lloyd's rounds in long form; the squared distance of whole numbers is exact in doubles below 2**53."""
    far = lambda b: f"SELECT i, c.p, e, list_inner_product(d, d) AS far FROM (SELECT i, c.p, e, [CAST(z[1] - z[2] AS DOUBLE) FOR z IN list_zip(c.w, b.w)] AS d FROM cut c JOIN {b} b ON b.p = c.p) c"
    out = f"""WITH kept AS ({usable_vectors(1024)}), num AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS i FROM kept), cut AS (SELECT i, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS w FROM num, range(4) t(p)),
b0 AS (SELECT p, i - 1 AS e, w FROM cut WHERE i <= 256)"""
    for n in range(rounds + 1):
        out += f""",
a{n} AS MATERIALIZED (SELECT i, p, min(far) AS far, arg_min(e, (far, e)) AS e FROM ({far(f'b{n}')}) GROUP BY ALL)"""
        if n < rounds:
            out += f""",
b{n + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.w, b.w) AS w FROM b{n} b LEFT JOIN (SELECT p, e, list(CAST(floor(CAST(s AS DOUBLE) / n) AS BIGINT) ORDER BY k) AS w FROM (
  SELECT c.p, a.e, k, sum(w[k]) AS s, count(*) AS n FROM cut c JOIN a{n} a ON a.i = c.i AND a.p = c.p, range(1, 17) t(k) GROUP BY ALL) GROUP BY ALL) m ON m.p = b.p AND m.e = b.e)"""
    return out + f""",
coded AS (SELECT i, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256 FROM num JOIN coded ON coded.i = num.i"""


VECTOR_CODES = vector_rounds()
HARD_NEGATIVES = f"""WITH kept AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, CAST(v AS DOUBLE[]) AS v FROM ({usable_vectors(256)}) WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS a, r.vec_id AS i, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS s FROM kept a, kept r WHERE a.vec_id % 50 = 0),
p AS (SELECT a, i, s FROM s WHERE same AND i <> a QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, i) <= 5),
n AS (SELECT p.a, p.i AS p, p.s AS ps, s.i, s.s, row_number() OVER (PARTITION BY p.a, p.i ORDER BY s.s DESC, s.i) AS rank FROM p JOIN s ON s.a = p.a AND NOT same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s)
SELECT a AS anchor_id, p AS positive_id, CAST(rank AS INTEGER) AS rank, i AS negative_id, ps AS positive_score, s AS negative_score FROM n WHERE rank <= 3"""


def edited_texts(spark, sf_dir: str):
    """The part of the I-Match query that SQL expresses."""
    return op5_imatch_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def mix_targets(spark, sf_dir: str):
    """The part of the mixing query that SQL expresses."""
    from pyspark.sql import functions as F

    return op6_min_cost_flow_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"))


def queries() -> dict:
    own = (op1_license_scan, op2_toxicity_noisy_or, op3_tree_model_html_text, op4_debruijn_substring_dedup, op5_imatch_fingerprints, op6_min_cost_flow_mixing, op7_simhash_near_dedup, op8_greedy_tiling_decontamination, op9_keyed_surrogates, op10_byte_cnn_language,
           op11_walsh_vector_codes, op12_frame_packed_tokens, op13_threshold_hard_negatives)
    return {f.__name__: f for f in (*own, edited_texts, mix_targets)}


def oracle_sql() -> dict[str, str]:
    return {"op4_debruijn_substring_dedup": REPEATS, "edited_texts": EDITED, "mix_targets": TARGETS, "op11_walsh_vector_codes": VECTOR_CODES, "op13_threshold_hard_negatives": HARD_NEGATIVES}
