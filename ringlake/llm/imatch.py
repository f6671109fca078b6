"""I-Match document fingerprints (operator 5).

Terms whose document frequency lies in a chosen band form the lexicon. A document keeps its distinct lexicon terms,
sorted, and hashes those that fall into each of several randomised lexicon subsets. Subsets come in levels that keep
a half, a quarter, an eighth ... of the lexicon, so that for texts of any length some level holds about one kept
term a subset; there the share of equal hashes estimates the shared part of both term sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm import bytescan as B
from ringlake.llm.spaces import staged, table, widths

LEVELS, EACH = 10, 8
SUBSETS = LEVELS * EACH


def terms(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct lower-cased letter runs of every row, sorted: 64-bit hashes and their rows."""
    start, end, first = B.runs(B.letters(buf), off)
    h = B.hashes(B.lowered(buf), start, end, 31)
    row = B.row_of(first)
    order = np.argsort(h)
    order = order[np.argsort(row[order], kind="stable")]
    h, row = h[order], row[order]
    if len(h):
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[keep], row[keep]
    return h, row


def document_frequency(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(term, df)`` over all rows; counts are merged inside a task, then summed by term."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged():
            key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return key, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        for _, buf, off in B.cut(batches):
            key, n = np.unique(terms(buf, off)[0], return_counts=True)
            held.append((key, n))
            size += len(key)
            if size > 2_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 1_000_000:
                    yield B.batch_of(schema, term=held[0][0].view(np.int64), n=held[0][1])
                    held, size = [], 0
        if held:
            key, n = merged()
            yield B.batch_of(schema, term=key.view(np.int64), n=n)

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(scan, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))


@dataclass
class Lexicon:
    """Sorted terms of the band."""

    term: np.ndarray


def lexicon(docs: DataFrame, text_col: str = "text", least: float = 0.001, most: float = 0.05, max_terms: int = 4_000_000) -> Lexicon:
    """Terms that between ``least`` and ``most`` of all rows contain.

    Its size has a bound that does not grow with the corpus: every term adds at least ``least * rows`` to the sum of
    all rows' distinct terms, so there are at most (mean distinct terms a row) / ``least``. Raises beyond ``max_terms``.
    """
    rows = docs.count()
    band = document_frequency(docs, text_col).where((F.col("df") >= F.lit(least * rows)) & (F.col("df") <= F.lit(max(2.0, most * rows)))).select("term")
    found = band.limit(max_terms + 1).toPandas()["term"].to_numpy(np.int64)
    if len(found) > max_terms:
        raise ValueError(f"the band holds over {max_terms} terms; raise its lower edge")
    return Lexicon(np.sort(found.view(np.uint64)))


def members(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The randomised subsets of each term: (position of the term, subset)."""
    at, sub = [], []
    for level in range(LEVELS):
        for j in range(EACH):
            hit = np.flatnonzero((B.mix(term, 100 + level * EACH + j) >> np.uint64(63 - level)) == 0)
            at.append(hit)
            sub.append(np.full(len(hit), level * EACH + j))
    return np.concatenate(at), np.concatenate(sub)


class Printer:
    """Fingerprints of rows under a lexicon: (mode, hash of all kept terms, one byte per subset, 0 where it keeps none, the
    same bytes of all the row's terms)."""

    def __init__(self, lex: Lexicon):
        self.term, self.rolling = lex.term, B.Rolling(31)
        self.subsets = self.by_term(lex.term)

    @staticmethod
    def by_term(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subsets in order of their term, and each term's first one."""
        at, sub = members(term)
        order = np.argsort(at, kind="stable")
        return sub[order], np.searchsorted(at[order], np.arange(len(term) + 1))

    @staticmethod
    def cells(subsets: tuple[np.ndarray, np.ndarray], at: np.ndarray, h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """One byte per row and subset from terms ``h``, whose subsets stand at ``at``."""
        sub, head = subsets
        n = head[at + 1] - head[at]
        key = np.repeat(row, n) * SUBSETS + sub[np.repeat(head[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        # sums below 2**53 are exact, and do not depend on the order
        total = np.bincount(key, weights=np.repeat((B.mix(h, 7) >> np.uint64(40)).astype(np.float64), n), minlength=rows * SUBSETS)
        some = np.bincount(key, minlength=rows * SUBSETS) > 0
        return np.where(some, 1 + B.mix(total.astype(np.uint64), 8) % np.uint64(255), np.uint64(0)).astype(np.uint8).reshape(rows, SUBSETS)

    def prints(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        rows = len(off) - 1
        h, row = terms(buf, off)
        at = np.searchsorted(self.term, h)
        inside = np.zeros(len(h), bool)
        if len(self.term):
            inside = self.term[np.minimum(at, len(self.term) - 1)] == h
        plenty = np.bincount(row[inside], minlength=rows) >= 8
        band = inside & plenty[row]
        rest = ~plenty[row]  # rows with few band terms keep all their terms
        own, where = np.unique(h, return_inverse=True)
        every = self.cells(self.by_term(own), where, h, row, rows)
        cell = np.where(plenty[:, None], self.cells(self.subsets, at[band], h[band], row[band], rows), every)
        kept = band | rest
        first = np.searchsorted(row[kept], np.arange(rows + 1))
        sums = self.rolling.sums(h[kept])
        whole = self.rolling.spans(sums, first[:-1], first[1:])
        mode = np.where(plenty, 2, np.where(np.diff(first) > 0, 1, 0)).astype(np.uint8)
        return mode, whole, cell, every


def likeness(a: tuple, b: tuple) -> np.ndarray:
    """0 to 1: twice the shared part of two term sets over both sizes, from equal subset hashes; 1 for equal prints.

    Band terms are compared where both have enough of them, else all terms of both."""
    alike = (a[0] == b[0])[:, None]
    x, y = (np.where(alike, p[2], p[3]).reshape(-1, LEVELS, EACH) for p in (a, b))
    union = ((x > 0) | (y > 0)).sum(2)
    equal = ((x == y) & (x > 0)).sum(2)
    weight = ((x == 0) | (y == 0)).sum(2) / EACH + 1e-6  # crowded levels say little
    j = (weight * equal).sum(1) / np.maximum((weight * union).sum(1), 1e-12)
    same = (a[0] == b[0]) & (a[1] == b[1]) & (a[2] == b[2]).all(1)
    return np.where(same, 1.0, 2 * j / (1 + j))


def shown(p: tuple) -> list[str]:
    """Mode letter (b: band terms, a: all terms, n: no letters), hash of all kept terms, two digits per subset; after
    band terms also two digits per subset of all terms, for comparison with a print of all terms."""
    return ["nab"[m] + f"{w:016x}" + c.tobytes().hex() + (e.tobytes().hex() if m == 2 else "") for m, w, c, e in zip(p[0].tolist(), p[1].tolist(), p[2], p[3], strict=True)]


def fingerprints(docs: DataFrame, lex: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint)`` for every row; null counts as empty, and rows without letters print alike. Repeated rows and null ids
    keep their row, an empty table gives no rows, other columns are ignored."""
    schema = pa.schema([("id", pa.int64()), ("fingerprint", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Printer(lex)
        for part, buf, off in B.cut(batches):
            yield B.batch_of(schema, id=part.column(0), fingerprint=shown(p.prints(buf, off)))

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scan, "id long, fingerprint string")


def in_order_with_next(docs: DataFrame, id_col: str, text_col: str, slice_bytes: int = 128 << 20) -> DataFrame:
    """``(slice, guest, id, mark, text)`` dealt to one partition a slice, in ascending id; each slice ends with a guest, the
    first row of the next slice, so that every row's successor follows it. Rows with one id go by their text's hash.

    Slices are ranges of (id, hash), as many as ``slice_bytes`` asks for, so that they do not grow with the table and null or
    repeated ids spread over them. The driver holds one row a slice.
    """
    least = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    light = staged(rows.select("id", "mark", F.octet_length("text").alias("size")), "order")
    total = light.agg(F.coalesce(F.sum(F.col("size") + 16), F.lit(0))).first()[0]
    n = max(2 * widths(docs.sparkSession), -(-total // slice_bytes))
    dealt = light.select("id", "mark").repartitionByRange(n, "id", "mark").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("id", "mark")).alias("at"))
    heads = sorted((r.at.id, r.at.mark) for r in dealt.collect())
    if not heads:
        return rows.select(F.lit(0).alias("slice"), F.lit(False).alias("guest"), "id", "mark", "text")
    ids, marks = (np.array([h[j] for h in heads], np.int64) for j in range(2))

    def place(i: pd.Series, m: pd.Series) -> pd.DataFrame:
        """The last head at or before each row, and whether it is that row."""
        i, m = i.to_numpy(), m.to_numpy()
        lo, hi = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
        at = lo.copy()
        for x in np.unique(i[lo < hi]):  # ids that heads have: by the hash
            own = np.flatnonzero(i == x)
            a, b = lo[own[0]], hi[own[0]]
            at[own] = a + np.searchsorted(marks[a:b], m[own], "right")
        at -= 1
        return pd.DataFrame({"slice": at.astype(np.int32), "head": (ids[at] == i) & (marks[at] == m)})

    put = F.pandas_udf(place, "struct<slice:int,head:boolean>")("id", "mark")
    spot = lambda s, guest: F.struct(s.alias("slice"), F.lit(guest).alias("guest"))
    own = spot(F.col("put.slice"), False)
    before = spot(F.pmod(F.col("put.slice") - 1, F.lit(len(heads))), True)
    spread = rows.withColumn("put", put).select(F.inline(F.when(F.col("put.head"), F.array(own, before)).otherwise(F.array(own))), "id", "mark", "text")
    return spread.repartitionById(len(heads), F.col("slice")).sortWithinPartitions("slice", "guest", "id", "mark")


def edited_bytes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row but the last: its first half, then as many first code points of the next row as it lost."""
    lead = (buf & 0xC0) != 0x80
    points = np.flatnonzero(lead)  # byte offset of each code point
    count = np.concatenate([[0], np.cumsum(lead)])
    first = count[off]  # number of the row's first code point
    n = np.diff(first)
    points = np.append(points, len(buf))
    half = n[:-1] // 2
    keep_to = points[first[:-2] + n[:-1] - half]
    take_to = points[first[1:-1] + np.minimum(half, n[1:])]
    size = np.stack([keep_to - off[:-2], take_to - off[1:-1]], 1).ravel()
    begin = np.stack([off[:-2], off[1:-1]], 1).ravel()
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return buf[at], np.concatenate([[0], np.cumsum(size.reshape(-1, 2).sum(1))]), n


def with_edited(docs: DataFrame, lex: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row and of its edited text, with their likenesses (see ``op5_imatch_fingerprints``).

    Null counts as empty; an empty text's edited text is empty. Rows sharing an id are ordered by a hash of the text; a null id
    comes first. A table of one row is its own next. An empty table gives no rows; other columns are ignored.
    """
    schema = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, held = Printer(lex), None  # held: the last row seen, whose successor comes in the next chunk
        for part, buf, off in B.cut(batches):
            ids, guest = part.column(2), np.asarray(part.column(1).to_numpy(zero_copy_only=False), bool)
            if held is not None:
                ids = pa.concat_arrays([held[0], ids])
                guest = np.append(held[1], guest)
                buf, off = np.concatenate([held[2], buf]), np.concatenate([[0], off + len(held[2])])
            held = (ids[-1:], guest[-1:], buf[off[-2] :].copy())
            if len(ids) < 2:
                continue
            own = p.prints(buf, off)
            text, at, n = edited_bytes(buf, off)
            new = p.prints(text, at)
            mine = tuple(x[:-1] for x in own)
            raw = text.tobytes()
            out = B.batch_of(schema, id=ids[:-1], n_chars=n[:-1], edited_sha256=[hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)],
                             fingerprint=shown(mine), edited_fingerprint=shown(new), near_edited=likeness(mine, new), near_next=likeness(mine, tuple(x[1:] for x in own)))
            yield out.filter(pa.array(~guest[:-1]))

    made = in_order_with_next(docs, id_col, text_col).mapInArrow(scan, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return made.withColumn("id", F.nullif("id", F.lit(-(1 << 63))))


def op5_imatch_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return with_edited(docs, lexicon(docs)).withColumnRenamed("id", "doc_id")
