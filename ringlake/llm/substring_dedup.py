"""Exact substring deduplication on a compacted de Bruijn graph of token k-mers (operator 4).

Edges are the ``window``-word k-mers of the corpus; an edge met twice is repeated. Edges are not shuffled one by
one: consecutive edges that share a minimiser (the least hash among their ``seed``-word sub-k-mers) form one path,
and paths meet by minimiser through Spark joins. Every occurrence of an edge lies at the same place of a path with
the same minimiser, so an edge can only repeat among paths of its minimiser. Where all paths of a minimiser are the
same words, the graph does not branch there and the path is repeated as a whole. Where they differ, it branches;
one source coordinate of each distinct path is looked up in its text again, and its edges are settled singly.
Rolling hashes only choose the minimisers. What counts as the same words is verified on the words that stand at the
source coordinates, by 128-bit digests of a whole path or edge. Repeated paths and edges of a document compact into
maximal spans, which are cut from its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm import bytescan as B
from ringlake.llm.spaces import staged, table


def _leftmost_min(a: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost least value in every ``w`` consecutive ones, by doubling."""
    v, p, size = a, np.arange(len(a), dtype=np.int64), 1
    while size < w:
        by = min(size, w - size)
        v0, v1, p0, p1 = v[:-by], v[by:], p[:-by], p[by:]
        take = v0 <= v1
        v, p, size = np.where(take, v0, v1), np.where(take, p0, p1), size + by
    return p


def paths_of(buf: np.ndarray, off: np.ndarray, window: int, seed: int, rolling: B.Rolling):
    """Runs of windows with one minimiser: (minimiser, digest of the words, row, first window in the row, windows)."""
    begin, end, first = B.words(buf, off)
    none = (np.zeros(0, np.uint64), np.zeros((0, 2), np.int64), *(np.zeros(0, np.int64),) * 3)
    if len(begin) < window:
        return none
    row = B.row_of(first)
    n = len(begin) - window + 1
    at = np.flatnonzero(row[:n] == row[window - 1 :])
    if not len(at):
        return none
    grams = rolling.windows(B.hashes(buf, begin, end, 1), seed)
    low = _leftmost_min(grams, window - seed + 1)[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (low[1:] != low[:-1]) | (row[at[1:]] != row[at[:-1]])
    head = np.flatnonzero(fresh)
    count = np.diff(np.append(head, len(at)))
    start = at[head]
    flat, to = B.spaced(buf, begin, end)
    content = B.digests(flat, to[start], to[start + count + window - 1])
    # the minimiser's place belongs to the path: the same words about another place are another path
    content[:, 1] ^= B.mix(low[head].astype(np.uint64) - start.astype(np.uint64), 3).view(np.int64)
    return grams[low[head]], content, row[start], start - first[row[start]], count


def repeated_spans(rows: DataFrame, window: int = 35, seed: int = 12) -> DataFrame:
    """``(doc, mark, spans array<struct<start, n>>)``: runs of repeated windows in ``rows(doc, mark, text)``.

    ``mark`` tells apart rows that share an id; rows equal in both are the same text and both count as sources, but their
    spans are held once.
    """
    schema = pa.schema([("mini", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()), ("n", pa.int16())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = B.Rolling(1)
        for part, buf, off in B.cut(batches):
            mini, content, row, start, n = paths_of(buf, off, window, seed, rolling)
            row = pa.array(row)
            yield B.batch_of(schema, mini=mini.view(np.int64), c1=content[:, 0], c2=content[:, 1], doc=part.column(0).take(row), mark=part.column(1).take(row), start=start.astype(np.int32), n=n.astype(np.int16))

    paths = rows.mapInArrow(scan, "mini long, c1 long, c2 long, doc long, mark long, start int, n smallint")
    # written out, so that the join below stands between two plain exchanges and a minimiser with very many rows can be split
    met = staged(paths.groupBy("mini").agg(F.count("*").alias("k"), *[f(c).alias(f.__name__ + c) for f in (F.min, F.max) for c in ("c1", "c2")]).where("k > 1").selectExpr("mini", "minc1 <> maxc1 or minc2 <> maxc2 as branches"), "minimisers")
    shared = staged(paths.join(met, "mini"), "paths")
    whole = shared.where("not branches").select("doc", "mark", "start", "n")

    forks = shared.where("branches")
    # written out for the same reason, as are the edges met twice
    distinct = staged(forks.groupBy("mini", "c1", "c2").agg(F.count("*").alias("k"), F.min(F.struct("doc", "mark", "start", "n")).alias("at")), "distinct")
    often = forks.join(distinct.where("k > 1").select("mini", "c1", "c2"), ["mini", "c1", "c2"], "left_semi").select("doc", "mark", "start", "n")
    todo = distinct.select("at.*", "k").groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "n", F.least("k", F.lit(2)).cast("int").alias("k"))).alias("todo"))
    edge_schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()), ("k", pa.int32())])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, off in B.cut(batches):
            word, end, first = B.words(buf, off)
            spans = part.column(part.schema.get_field_index("todo"))
            at, todo = np.asarray(spans.offsets), spans.values
            row = np.repeat(np.arange(part.num_rows), np.diff(at))
            begin, n, k = (np.asarray(todo.field(i))[at[0] : at[-1]] for i in range(3))
            w = np.repeat(begin.astype(np.int64), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own = np.repeat(row, n)
            x = w + first[own]
            flat, to = B.spaced(buf, word, end)
            found = B.digests(flat, to[x], to[x + window])
            own = pa.array(own)
            yield B.batch_of(edge_schema, h1=found[:, 0], h2=found[:, 1], doc=part.column(0).take(own), mark=part.column(1).take(own), start=w.astype(np.int32), k=np.repeat(k, n))

    single = staged(rows.join(todo, ["doc", "mark"]).select("doc", "mark", "text", "todo").mapInArrow(edges, "h1 long, h2 long, doc long, mark long, start int, k int"), "edges")
    twice = staged(single.groupBy("h1", "h2").agg(F.sum("k").alias("all")).where("all > 1").select("h1", "h2"), "twice")
    settled = single.where("k = 1").join(twice, ["h1", "h2"], "left_semi").select("doc", "mark", "start", F.lit(1).cast("smallint").alias("n"))
    return whole.union(often).union(settled).groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "n")).alias("spans"))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, with_text: bool = False) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256[, kept_text])`` for every row.

    A word goes if any window of ``window`` words over it also starts elsewhere, in the same row or another. Null,
    empty and short texts lose nothing. Repeated rows are each other's copies; rows that share an id but not a text
    stay apart; null ids are kept. An empty table gives no rows; columns besides id and text are ignored.
    """
    null_id = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(null_id)).alias("doc"), F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).cast("string").alias("text"))
    spans = repeated_spans(rows, window)
    fields = [("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())] + ([("kept_text", pa.string())] if with_text else [])
    schema = pa.schema(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, off in B.cut(batches):
            start, end, first = B.words(buf, off)
            spans = part.column(part.schema.get_field_index("spans"))
            at, values = np.asarray(spans.offsets), spans.values
            begin, n = (np.asarray(values.field(i))[at[0] : at[-1]].astype(np.int64) for i in range(2))
            begin = begin + first[np.repeat(np.arange(part.num_rows), np.diff(at))]
            delta = np.zeros(len(start) + 1, np.int64)
            np.add.at(delta, begin, 1)
            np.add.at(delta, begin + n + window - 1, -1)
            keep = np.cumsum(delta)[:-1] == 0
            # one space after every kept word
            size = np.where(keep, end - start + 1, 0)
            to = np.concatenate([[0], np.cumsum(size)])
            flat = np.full(to[-1], 32, np.uint8)
            letter = np.ones(to[-1], bool)
            letter[to[1:][keep] - 1] = False
            inside = ~B.SPACE[buf]
            flat[letter] = buf[inside][np.repeat(keep, end - start)]
            raw = flat.tobytes()
            edge = to[first]
            kept = np.concatenate([[0], np.cumsum(keep)])[first]
            texts = [raw[a : b - 1] if b > a else b"" for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            words = np.diff(first)
            out = {"doc": part.column(0), "n_words": words, "n_removed": words - np.diff(kept), "kept_sha256": [hashlib.sha256(t).hexdigest() for t in texts]}
            if with_text:
                out["kept_text"] = [t.decode() for t in texts]
            yield B.batch_of(schema, **out)

    joined = rows.join(spans, ["doc", "mark"], "left").select("doc", "mark", "text", "spans")
    made = joined.mapInArrow(cut, "doc long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else ""))
    return made.withColumn("id", F.nullif("doc", F.lit(null_id))).select("id", *[n for n, _ in fields[1:]])


def op4_debruijn_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents"), window=35).withColumnRenamed("id", "doc_id")
