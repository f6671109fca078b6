"""Benchmark decontamination by greedy string tiling (operator 8).

Rolling (Karp-Rabin) hashes of ``least`` consecutive tokens join documents to benchmark items. Seeds on one diagonal
grow into maximal matches; the longest match that covers only unmarked tokens becomes a tile and marks them in both
texts, until no match of ``least`` tokens is left. The share of an item's tokens under tiles is its coverage, which
does not depend on their order, so reordered passages count in full.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm import bytescan as B
from ringlake.llm.spaces import free_names, staged, table


def tokens(buf: np.ndarray, off: np.ndarray):
    """Lower-cased runs of letters and digits: hashes, rows' first tokens, starts and ends."""
    low = B.lowered(buf)
    start, end, first = B.runs(B.letters(low) | ((low >= 48) & (low <= 57)), off)
    return B.hashes(low, start, end, 21), first, start, end


def matches(p: np.ndarray, q: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Maximal matches (length, document position, item position) from seed positions on common diagonals."""
    order = np.lexsort((p, p - q))
    p, q = p[order], q[order]
    fresh = np.ones(len(p), bool)
    fresh[1:] = (np.diff(p - q) != 0) | (np.diff(p) != 1)
    head = np.flatnonzero(fresh)
    return list(zip((np.diff(np.append(head, len(p))) + least - 1).tolist(), p[head].tolist(), q[head].tolist(), strict=True))


def tiles(found: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of maximal matches: (length, document position, item position), longest first."""
    heap = [(-n, p, q) for n, p, q in found]
    heapq.heapify(heap)
    mine, theirs, out = set(), set(), []
    while heap:
        n, p, q = heapq.heappop(heap)
        n = -n
        free = [p + i not in mine and q + i not in theirs for i in range(n)]
        if all(free):
            out.append((n, p, q))
            mine.update(range(p, p + n))
            theirs.update(range(q, q + n))
            continue
        i = 0
        while i < n:  # what is left of it between marked tokens
            j = i
            while j < n and free[j]:
                j += 1
            if j - i >= least:
                heapq.heappush(heap, (i - j, p + i, q + i))
            i = j + 1
    return out


class Items:
    """Seeds of a block of benchmark items, for lookup by hash."""

    def __init__(self, ids: list[int], texts: list[str | None], least: int):
        r = B.Rolling(21)
        h, first, _, _ = tokens(*B.text_bytes(pa.array(texts, pa.string())))
        self.ids, self.least, self.size = np.array(ids, np.int64), least, np.diff(first)
        seeds = r.windows(h, least)
        row = B.row_of(first)
        ok = row[: len(seeds)] == row[least - 1 :] if len(seeds) else np.zeros(0, bool)
        at = np.flatnonzero(ok)
        at = at[np.argsort(seeds[at], kind="stable")]
        self.seed, self.item, self.pos = seeds[at], row[at], at - first[row[at]]
        # items too short for a seed match whole texts only
        sums, short = r.sums(h), np.flatnonzero((self.size > 0) & (self.size < least))
        self.short: dict[int, list[int]] = {}
        for x, i in zip(r.spans(sums, first[short], first[short + 1]).tolist(), short.tolist(), strict=True):
            self.short.setdefault(x, []).append(i)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.seed >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (position in ``seeds``, position among the items' seeds) of equal hashes."""
        at = np.flatnonzero(self.maybe[(seeds >> np.uint64(44)).astype(np.int64)])
        lo, hi = (np.searchsorted(self.seed, seeds[at], side) for side in ("left", "right"))
        n = hi - lo
        return np.repeat(at, n), np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def leaks(buf: np.ndarray, off: np.ndarray, items: Items, rolling: B.Rolling, coverage: float):
    """``(row, item, tiles, token starts, token ends)`` of the pairs whose coverage reaches the threshold."""
    least = items.least
    h, first, start, end = tokens(buf, off)
    if items.short:
        some = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < least))
        for i, x in zip(some.tolist(), rolling.spans(rolling.sums(h), first[some], first[some + 1]).tolist(), strict=True):
            for item in items.short.get(x, ()):
                yield i, item, [(int(items.size[item]), int(first[i]), 0)], start, end
    p, s = items.hits(rolling.windows(h, least))
    row = B.row_of(first)
    ok = row[p] == row[p + least - 1] if len(p) else np.zeros(0, bool)
    p, s = p[ok], s[ok]
    if not len(p):
        return
    order = np.lexsort((items.item[s], row[p]))
    p, s = p[order], s[order]
    pair = np.flatnonzero(np.concatenate([[True], (np.diff(row[p]) != 0) | (np.diff(items.item[s]) != 0)]))
    for a, b in zip(pair, np.append(pair[1:], len(p)), strict=True):
        item, size = int(items.item[s[a]]), int(items.size[items.item[s[a]]])
        if len(np.unique((items.pos[s[a:b], None] + np.arange(least)).ravel())) < coverage * size:
            continue  # even all its seeds together do not cover enough
        found = tiles(matches(p[a:b], items.pos[s[a:b]], least), least)
        if sum(n for n, _, _ in found) >= coverage * size:
            yield int(row[p[a]]), item, found, start, end


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> tuple[int, Iterator[list]]:
    """How many blocks of at most about ``block_chars`` characters the benchmark has, and each, collected by itself."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    k = max(1, -(-2 * total // block_chars)) if total > block_chars else 1
    return k, ((items.where(F.pmod(F.xxhash64("i", "t"), F.lit(k)) == b) if k > 1 else items).orderBy("i", "t").collect() for b in range(k))


def _scanned(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, block_chars: int, of, schema) -> list[DataFrame]:
    """``of(seen)`` applied to ``docs`` for each block of the benchmark, broadcast as ``seen``. Of several blocks each is scanned,
    its rows are written and its broadcast is dropped before the next one comes, so that one block is held at a time."""
    count, blocks = _blocks(benchmark, item_id, item_text, block_chars)
    out = []
    for block in blocks:
        seen = docs.sparkSession.sparkContext.broadcast(([r.i for r in block], [r.t for r in block]))
        got = docs.mapInArrow(of(seen), schema)
        if count > 1:
            got = staged(got, "leaks")
            seen.unpersist()
        out.append(got)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 5, coverage: float = 0.6, block_chars: int = 16_000_000) -> DataFrame:
    """``(id, item_id, item_tokens, covered, coverage, tiles, first_start, last_end)`` for each document row and item
    whose coverage reaches the threshold; the offsets are code points of the document.

    Items under ``least`` tokens match a document whose tokens are the item's and no others. Null and empty texts match
    nothing; repeated rows, ties and null ids keep their rows; either table may be empty; further columns of both are ignored.
    The benchmark is broadcast in blocks of at most about ``block_chars`` characters, one scan of the documents each.
    """
    schema = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("item_tokens", pa.int64()), ("covered", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int64()), ("first_start", pa.int64()), ("last_end", pa.int64())])

    def of(seen):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, rolling = Items(*seen.value, least), B.Rolling(21)
            for part, buf, off in B.cut(batches):
                rows: list[tuple] = []
                for r, item, found, start, end in leaks(buf, off, items, rolling, coverage):
                    size, covered = int(items.size[item]), sum(n for n, _, _ in found)
                    x, y = min(q for _, q, _ in found), max(q + n for n, q, _ in found)
                    points = np.cumsum((buf[off[r] : end[y - 1]] & 0xC0) != 0x80)
                    rows.append((part.column(0)[r].as_py(), int(items.ids[item]), size, covered, covered / size, len(found), int(points[start[x] - off[r]]) - 1, int(points[-1])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        return scan

    light = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return reduce(DataFrame.union, _scanned(light, benchmark, item_id, item_text, block_chars, of, "id long, item_id long, item_tokens long, covered long, coverage double, tiles long, first_start long, last_end long"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 5, coverage: float = 0.6, block_chars: int = 16_000_000) -> DataFrame:
    """The rows of ``docs`` that no benchmark item leaks into, all columns as they were.

    Null and empty texts stay, and so do repeated rows; either table may be empty; see ``contaminated``. With several blocks
    of the benchmark the texts with leaks are gathered by their 128-bit marks and then taken out.
    """
    def of(seen, leaky: bool, column: str = text_col):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, rolling = Items(*seen.value, least), B.Rolling(21)
            for part, buf, off in B.cut(batches, column):
                stay = np.ones(part.num_rows, bool)
                stay[[r for r, *_ in leaks(buf, off, items, rolling, coverage)]] = False
                out = part.filter(pa.array(~stay if leaky else stay))
                yield out.select(["a", "b"]) if leaky else out

        return scan

    text = F.col(f"`{text_col}`")
    if _blocks(benchmark, item_id, item_text, block_chars)[0] == 1:
        return _scanned(docs, benchmark, item_id, item_text, block_chars, lambda seen: of(seen, False), docs.schema)[0]
    mark = [F.xxhash64(text), F.xxhash64(text, F.lit(1))]
    light = docs.select(*[m.alias(c) for m, c in zip(mark, "ab", strict=True)], text.cast("string").alias("text"))
    found = reduce(DataFrame.union, _scanned(light, benchmark, item_id, item_text, block_chars, lambda seen: of(seen, True, "text"), "a long, b long")).distinct()
    a, b = free_names(docs, "a", "b")
    return docs.withColumn(a, mark[0]).withColumn(b, mark[1]).join(found.withColumnsRenamed({"a": a, "b": b}), [a, b], "left_anti").select(*[f"`{c}`" for c in docs.columns])


def op8_greedy_tiling_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")
