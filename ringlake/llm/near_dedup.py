"""SimHash near-duplicates through shard BK-trees (operator 7).

Fingerprints that differ in at most ``radius`` bits agree on at least ``blocks - radius`` of ``blocks`` bit
blocks, so every choice of that many blocks is a band and its bits a shard key. Each shard of distinct
fingerprints becomes one BK-tree, built where its rows were dealt: children hang under the integer Hamming
distance to their parent and a search follows only edges within the radius. The trees are dealt by a shuffle,
not broadcast, since their total size grows with the corpus. A shard above ``shard_cap`` fingerprints is dealt
again by blocks of the bits that its key leaves open, until its trees are small.

``one_of_each`` uses the same trees for texts with a given share of equal shingles: shards are bands of shingle
minima, the trees are searched within a radius that such pairs practically always keep, and every hit is confirmed
by the two sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm import bytescan as B
from ringlake.llm.spaces import components, free_names, staged, widths

LANES = np.uint64(0x0101010101010101)


def _majority(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bit set where over half of a row's hashes have it. ``first``: row starts in ``h``, non-empty rows only."""
    n = np.diff(np.append(first, len(h)))
    parts = -(-n // 255)  # eight one-byte lanes hold sums of 255 rows at most
    row = np.repeat(np.arange(len(n)), parts)
    at = first[row] + 255 * (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts))
    out = np.zeros(len(n), np.uint64)
    for j in range(8):
        lanes = np.add.reduceat((h >> np.uint64(j)) & LANES, at).view(np.uint8).reshape(-1, 8).astype(np.int64)
        sums = np.add.reduceat(lanes, np.cumsum(parts) - parts, axis=0)
        for k in range(8):
            out |= (2 * sums[:, k] > n).astype(np.uint64) << np.uint64(8 * k + j)
    return out


def shingle_hashes(buf: np.ndarray, off: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of each row's lower-cased word shingles in text order, and each row's first one."""
    buf = B.LOWER[buf]
    start, end, first = B.words(buf, off)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    # one space after every word
    size = end - start + 1
    to = np.concatenate([[0], np.cumsum(size)])
    flat = np.full(to[-1], 32, np.uint8)
    keep = np.ones(to[-1], bool)
    keep[to[1:] - 1] = False
    flat[keep] = buf[~B.SPACE[buf]]
    count = np.diff(first)
    per = np.where(count >= shingle, count - shingle + 1, (count > 0).astype(np.int64))
    row = np.repeat(np.arange(len(count)), per)
    head = np.cumsum(per) - per
    lead = first[:-1][row] + np.arange(len(row)) - head[row]
    tail = np.minimum(lead + shingle, first[1:][row]) - 1
    text, h = flat.tobytes(), xxhash.xxh64_intdigest
    hashes = np.array([h(text[a:b], 42) for a, b in zip(to[lead].tolist(), (to[tail + 1] - 1).tolist(), strict=True)], np.uint64)
    return hashes, np.append(head, len(hashes))


def fingerprints_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SimHash of each row over its shingle hashes, repeats included; 0 without words."""
    out = np.zeros(len(first) - 1, np.uint64)
    some = np.diff(first) > 0
    if some.any():
        out[some] = _majority(hashes, first[:-1][some])
    return out


def sketches_of(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """``size`` minima of each row's shingle hashes under as many multiplications, 32 bits each."""
    out = np.zeros((len(first) - 1, size), np.uint32)
    some = np.diff(first) > 0
    if some.any():
        at = first[:-1][some]
        for j in range(size):
            m = int(B.mix(np.array([j], np.uint64), 4)[0]) | 1
            out[some, j] = np.minimum.reduceat(hashes * np.uint64(m), at) >> np.uint64(32)
    return out


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """``(id, fp bigint)`` for every row; null and wordless texts have fingerprint 0."""
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, off in B.cut(batches):
            yield B.batch_of(schema, id=part.column(0), fp=fingerprints_of(*shingle_hashes(buf, off, shingle)).view(np.int64))

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scan, "id long, fp long")


class BKTree:
    """Burkhard-Keller tree of 64-bit integers under Hamming distance."""

    def __init__(self):
        self.value: list[int] = []
        self.child: list[dict[int, int]] = []

    def add(self, x: int) -> int:
        """The place of ``x``, which is new unless the tree has it."""
        at = 0
        while self.value and (d := (self.value[at] ^ x).bit_count()):
            to = self.child[at].get(d)
            if to is None:
                self.child[at][d] = len(self.value)
                break
            at = to
        else:
            if self.value:
                return at
        self.value.append(x)
        self.child.append({})
        return len(self.value) - 1

    def within(self, x: int, radius: int) -> Iterator[int]:
        todo = [0] if self.value else []
        while todo:
            at = todo.pop()
            d = (self.value[at] ^ x).bit_count()
            if d <= radius:
                yield at
            todo += [to for e, to in self.child[at].items() if d - radius <= e <= d + radius]


def tree_links(values: list[int], radius: int, confirm=None, joined: list[int] | None = None) -> tuple[list[tuple[int, int]], list[int]]:
    """A spanning forest of the pairs of positions whose values lie within ``radius`` and that ``confirm`` accepts, found by
    searching the shard's BK-tree for each member, and the positions of its roots. Members with one ``joined`` number are
    joined already. The search ends early once it cannot join two components any more."""
    tree, held, root, known = BKTree(), [], [], {}
    out, apart = [], 0

    def top(p: int) -> int:
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    for i, x in enumerate(v & 0xFFFFFFFFFFFFFFFF for v in values):
        root.append(i)
        first = known.setdefault(joined[i], i) if joined else i
        if first != i:
            root[i] = top(first)
        else:
            apart += 1
        for at in tree.within(x, radius) if apart > 1 else ():
            for j in held[at]:
                p, q = top(j), top(i)
                if p != q and (not confirm or confirm(j, i)):
                    root[max(p, q)] = min(p, q)
                    apart -= 1
                    out.append((i, j))
            if apart == 1:
                break
        at = tree.add(x)
        if at == len(held):
            held.append([])
        held[at].append(i)
    return out, [i for i in range(len(root)) if root[i] == i]


def finer(mask: int, radius: int) -> list[int]:
    """The bits of ``mask`` and each of ``radius + 1`` blocks of the others: a pair within the radius agrees on one of them."""
    open_, n = [b for b in range(64) if not mask >> b & 1], radius + 1
    return [mask | sum(1 << b for b in open_[len(open_) * i // n : len(open_) * (i + 1) // n]) for i in range(n)]


def links(prints: DataFrame, radius: int = 2, shard_cap: int = 1024, shard_fill: int = 8) -> DataFrame:
    """``(src, dst)`` fingerprints that connect all of ``prints(fp)``, which are distinct, within ``radius`` bits.

    The block count is the least for which a band's key space is at least ``n / shard_fill``. A shard over ``shard_cap``
    is dealt anew by further bits, which ends at shards of few open bits.
    """
    n = prints.count()
    blocks = radius + 1
    while 2 ** (64 // blocks * (blocks - radius)) < n / shard_fill and blocks < radius + 6:
        blocks += 1
    edge = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in kept) for kept in combinations(range(blocks), blocks - radius)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(group: list[int]):
            pairs = tree_links(group, radius)[0]
            return B.batch_of(schema, src=[group[i] for i, _ in pairs], dst=[group[j] for _, j in pairs])

        now, held = None, []
        for batch in batches:
            for mask, key, fp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (mask, key):
                    if held:
                        yield done(held)
                    now, held = (mask, key), []
                held.append(fp)
        if held:
            yield done(held)

    out, rows = None, prints
    finest = {m: [m] for m in masks}
    rows = prints.withColumn("above", F.explode(F.array(*[F.lit(signed(m)) for m in masks])))
    while True:
        spread = prints.sparkSession.createDataFrame([(signed(m), signed(f)) for m, fs in finest.items() for f in fs], "above long, mask long")
        bands = rows.join(F.broadcast(spread), "above").select("fp", "mask").distinct() if out is not None else rows.select("fp", F.col("above").alias("mask"))
        bands = bands.select("fp", "mask", F.col("mask").bitwiseAND(F.col("fp")).alias("key"))
        # written out, so that the join stands between two plain exchanges and a shard of very many rows can be split
        sizes = staged(bands.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        shards = staged(bands.join(sizes, ["mask", "key"]), "shards")
        large = (F.col("n") > shard_cap) & (F.bit_count(F.col("mask")) < 56)
        small = shards.where(~large).select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(search, "src long, dst long")
        out = small if out is None else out.union(small)
        again = [r.mask & 0xFFFFFFFFFFFFFFFF for r in sizes.where(large).select("mask").distinct().collect()]  # few: bands and blocks of them
        if not again:
            return out
        finest = {m: finer(m, radius) for m in again}
        rows = shards.where(large).select("fp", F.col("mask").alias("above"))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, radius: int = 2, shard_cap: int = 1024) -> DataFrame:
    """``(id, fp, component_id)`` for every input row.

    Equal fingerprints are one component, and fingerprints within ``radius`` bits are linked; ``component_id`` is
    the least id reachable. Null and wordless texts share fingerprint 0. Repeated rows and repeated ids each keep
    their row; null ids never become a component's id, unless all are null. An empty table gives no rows; columns
    besides id and text are ignored.
    """
    rows = staged(simhash(docs, id_col, text_col, shingle), "simhash")
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    linked = components(links(least.select("fp"), radius, shard_cap))
    rooted = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    found = rooted.where("root = fp").select("root", "least").union(rooted.where("root <> fp").select("root", "least")).groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(found, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


SKETCH, ROWS = 48, 3
#: SimHashes of sets that share 0.8 differ in 10 of 64 bits, give or take 3, also of very small sets; those of others in 32.
REACH = 28


def members_of(prints: DataFrame, shard_cap: int) -> DataFrame:
    """``(key, part, parts, fp, id, mark)``: the members of every shard of two or more rows of ``prints(fp, id, mark, sketch, n)``.

    Shards are bands of ``ROWS`` sketch minima: a pair that shares 0.8 of its shingles meets in some shard with a
    probability over 0.9999. A shard above ``shard_cap`` rows, or 1024 shingles (``n``) for each of them, has parts.
    """
    bands = SKETCH // ROWS
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("sketch", b * ROWS * 4 + 1, ROWS * 4)) for b in range(bands)])
    parts = F.ceil(F.greatest(F.count("*") / shard_cap, F.sum("n") / (shard_cap * 1024))).cast("int")
    # written out, so that the join stands between two plain exchanges
    sizes = staged(prints.select("n", F.explode(keys).alias("key")).groupBy("key").agg(F.count("*").alias("rows"), parts.alias("parts")).where("rows > 1").drop("rows"), "sizes")
    return staged(prints.select("fp", "id", "mark", F.explode(keys).alias("key")).join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")), "members")


def compared(tasks: DataFrame, texts: DataFrame, similar: float, shingle: int) -> DataFrame:
    """``(src, dst, key)`` for ``tasks(key, p, q, root, fp, id, mark)``: links that join the members of each (key, p, q) as far as
    their sets are similar, beyond those that share a ``root``, with null keys; and each of its components' leaders with itself."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64()), ("key", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, fps, roots, sets, prints = None, [], [], [], []

        def alike(x: int, y: int) -> bool:
            n, m = len(sets[x]), len(sets[y])
            if min(n, m) < similar * max(n, m) * (1 - 1e-9):
                return False
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            return both / max(n + m - both, 1) >= similar

        def done():
            pairs, leaders = tree_links(prints, REACH, alike, roots)
            return B.batch_of(schema, src=[fps[i] for i, _ in pairs] + [fps[i] for i in leaders], dst=[fps[j] for _, j in pairs] + [fps[i] for i in leaders], key=[None] * len(pairs) + [now[0]] * len(leaders))

        for part, buf, off in B.cut(batches):
            h, first = shingle_hashes(buf, off, shingle)
            own = [np.unique(h[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            print_ = fingerprints_of(np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])).tolist()
            for i, (key, p, q, root, fp) in enumerate(zip(*(part.column(c).to_pylist() for c in range(5)), strict=True)):
                if now != (key, p, q):
                    if fps:
                        yield done()
                    now, fps, roots, sets, prints = (key, p, q), [], [], [], []
                if fps and fps[-1] == fp:  # repeated rows
                    continue
                fps.append(fp)
                roots.append(root)
                sets.append(own[i])
                prints.append(print_[i])
        if fps:
            yield done()

    found = tasks.join(texts, ["id", "mark"]).select("key", "p", "q", "root", "fp", "text")
    # several tasks a shuffle partition, since each holds its texts at once
    return staged(found.repartition(4 * widths(texts.sparkSession), "key", "p", "q").sortWithinPartitions("key", "p", "q", "fp").mapInArrow(search, "src long, dst long, key long").distinct(), "links")


def shared_links(prints: DataFrame, texts: DataFrame, similar: float, shingle: int, shard_cap: int = 2048) -> DataFrame:
    """``(src, dst)`` that connect ``prints(fp, id, mark, sketch, n)`` whose sets of ``shingle``-word shingles have a Jaccard
    similarity of at least ``similar``; ``texts(id, mark, text)`` has their texts.

    The members of a shard's part are linked first, then the leaders of all its parts, which joins a large group of near
    copies in time linear in its size. Of what is left apart then, members outside the shard's largest component meet
    all others of the shard, part by part, so no link is lost.
    """
    one = F.lit(0)
    members = members_of(prints, shard_cap)
    out = compared(members.select("key", F.col("part").alias("p"), one.alias("q"), F.col("fp").alias("root"), "fp", "id", "mark"), texts, similar, shingle)
    hot = members.where("parts > 1")
    if hot.isEmpty():
        return out.where("src <> dst").select("src", "dst")
    leaders = out.where("key is not null").select("key", F.col("src").alias("fp")).join(hot, ["key", "fp"])
    few = staged(leaders.groupBy("key").agg(F.ceil(F.count("*") / shard_cap).cast("int").alias("few")), "few")
    tasks = leaders.join(few, "key").select("key", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("few")).cast("int").alias("p"), one.alias("q"), F.col("fp").alias("root"), "fp", "id", "mark")
    out = out.union(compared(tasks, texts, similar, shingle)).where("src <> dst").select("src", "dst")
    roots = components(out)
    hot = staged(hot.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    sizes = hot.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all")).where("all > most")
    shares = main.select("key", "main", *[F.ceil(F.col(n) / shard_cap).cast("int").alias(c) for n, c in (("most", "of_main"),)], F.ceil((F.col("all") - F.col("most")) / shard_cap).cast("int").alias("of_rest"))
    left = hot.join(staged(shares, "shares"), "key").withColumn("large", F.col("root") == F.col("main"))
    slot = F.pmod(F.xxhash64("fp", F.lit(9)), F.when(F.col("large"), F.col("of_main")).otherwise(F.col("of_rest"))).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    pair = lambda p, q: F.struct(p.cast("int").alias("p"), q.cast("int").alias("q"))
    # pairs of the rest's parts (p <= q), and of each of them with the main component's (-1 - q)
    rest = F.concat(F.transform(upto("of_rest"), lambda x: pair(F.least(F.col("slot"), x), F.greatest(F.col("slot"), x))), F.transform(upto("of_main"), lambda x: pair(F.col("slot"), -1 - x)))
    mine = F.transform(upto("of_rest"), lambda x: pair(x, -1 - F.col("slot")))
    tasks = left.withColumn("slot", slot).select("key", F.inline(F.when(F.col("large"), mine).otherwise(rest)), "root", "fp", "id", "mark")
    return out.union(compared(tasks, texts, similar, shingle).where("src <> dst").select("src", "dst"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similar: float = 0.8) -> DataFrame:
    """The rows of ``docs`` with one, the least id's, of every group of exact and near copies; all columns as they were.

    Near copies are texts whose sets of ``shingle``-word shingles have a Jaccard similarity of at least ``similar``; texts of
    one set are one node. Minima deal the shards, BK-trees of SimHashes find the candidates, and the sets confirm each. The
    SimHashes are those of the sets, since repeats move bits but not the set. Wordless texts are alike, repeated rows leave one row, ties of ids go by the text's
    hash, null ids come last, an empty table stays empty.
    """
    least = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1))
    mark = F.xxhash64(F.col(f"`{text_col}`"))
    schema = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("fp", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, off in B.cut(batches):
            h, first = shingle_hashes(buf, off, shingle)
            sets = [np.unique(h[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            names = np.array([xxhash.xxh64_intdigest(x.tobytes(), 42) for x in sets], np.uint64).view(np.int64)
            yield B.batch_of(schema, id=part.column(0), mark=part.column(1), fp=names, n=[len(x) for x in sets], sketch=[x.tobytes() for x in sketches_of(h, first, SKETCH)])

    texts = docs.select(least.alias("id"), mark.alias("mark"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = staged(texts.mapInArrow(scan, "id long, mark long, fp long, n long, sketch binary"), "sketches")
    prints = staged(rows.groupBy("fp").agg(F.min(F.struct("id", "mark")).alias("least"), F.min("n").alias("n"), F.min("sketch").alias("sketch")).select("fp", "least.id", "least.mark", "n", "sketch"), "prints")
    linked = components(shared_links(prints, texts, similar, shingle))
    groups = prints.select("fp", F.struct("id", "mark").alias("least")).join(linked.withColumnRenamed("node", "fp"), "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("stay"))
    stay = groups.select("stay.*")
    i, m = free_names(docs, "id", "mark")
    kept = docs.withColumn(i, least).withColumn(m, mark).join(stay.select(F.col("id").alias(i), F.col("mark").alias(m)), [i, m], "left_semi")
    again = rows.groupBy("id", "mark").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias(i), F.col("mark").alias(m))
    if not again.isEmpty():  # rows with one id and text: one of them stays
        kept = kept.join(again, [i, m], "left_anti").unionByName(kept.join(again, [i, m], "left_semi").dropDuplicates([i, m]))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    from ringlake.llm.spaces import table

    found = near_components(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
