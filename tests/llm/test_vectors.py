"""Vector codes and hard negatives against plain versions in Python integers."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

from ringlake.llm import catalog, hard_negatives, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = sorted(((i, [math.floor(1024 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts if kept else 0
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    code = lambda v: [min((far(w, e), k) for k, e in enumerate(books[p])) for p, w in enumerate(cut(v))]
    for _ in range(rounds):
        got = defaultdict(list)
        for _, v, _ in kept:
            for p, (_, k) in enumerate(code(v)):
                got[p, k].append(cut(v)[p])
        for (p, k), ws in got.items():
            books[p][k] = [sum(c) // len(ws) for c in zip(*ws)]
    out, sums = [], Counter()
    for i, v, lab in kept:
        c = code(v)
        out.append((i, "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c), lab))
        sums[lab] += out[-1][2]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, c, e, sums[lab], sha) for i, c, e, lab in out)


def plain_negatives(rows):
    kept = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in rows if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for a, la, va in kept:
        if a % 50:
            continue
        score = [(-sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in kept]
        for ps, p, _ in sorted(s for s in score if s[2] == la and s[1] != a)[:5]:
            fit = sorted(s for s in score if s[2] != la and -50 * ps <= -100 * s[0] <= -95 * ps)[:3]
            out.update((a, p, n, i, -ps, -s) for n, (s, i, _) in enumerate(fit, 1))
    return out


def vectors(rng, n, dim, near=True):
    mid = [[rng.gauss(0, 0.1) for _ in range(dim)] for _ in range(6)]
    return [(i, [x + rng.gauss(0, 0.05) for x in rng.choice(mid)] if near else [rng.gauss(0, 0.125) for _ in range(dim)], rng.choice([0, 1, 2, None])) for i in range(n)]


def odd_rows(rng, dim):
    rows = vectors(rng, 330, dim) + vectors(rng, 40, dim, False)
    rows += [(i + 1000, v, lab) for i, v, lab in rows[:30]]  # the same vectors under other ids: ties
    rows += [(2000, None, 1), (2001, [NAN] * dim, 1), (2050, [0.1] * (dim - 1) + [INF], 2), (2003, [None] + [0.1] * (dim - 1), 0), (2100, [0.0] * dim, 1), (2009, [1.5] * dim, 9), (2016, [-1.5] * dim, 9)]
    rng.shuffle(rows)
    return rows


def stored(spark, tmp_path, rows, more=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if more:  # columns that operators use inside
        df = df.withColumn("id", F.lit("x")).withColumn("codes", F.lit(1)).withColumn("error", F.lit(2)).withColumn("_v", F.lit(3)).withColumn("number", F.lit(4)).withColumn("_anchor", F.lit(5))
    df.repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def test_walsh_keeps_distances_and_order():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 5, 16, 24):
        x, e = rng.integers(-3000, 3000, (50, width)), rng.integers(-3000, 3000, (300, width))
        e[40:60] = e[10]
        x[:5] = e[10]
        a, b = vector_codes.walsh(x), vector_codes.walsh(e)
        far = ((x[:, None] - e[None]) ** 2).sum(2)
        code, d = vector_codes.nearest(a, b)
        assert (code == far.argmin(1)).all() and (d == far.min(1) * a.shape[1]).all()
    h = vector_codes.walsh(np.eye(16, dtype=np.int64)).T
    assert [(np.diff(r) != 0).sum() for r in h] == list(range(16))


@pytest.mark.parametrize("seed", [1, 2])
def test_codes(spark, tmp_path, seed):
    rows = odd_rows(random.Random(seed), 8)
    got = catalog.queries()["op11_walsh_vector_codes"](spark, stored(spark, tmp_path, rows, seed == 2)).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == plain_codes(rows)


def test_codes_of_few_repeated_and_short_rows(spark):
    rows = [(1, [0.5] * 7, 1), (1, [0.5] * 7, 1), (None, [0.25] * 7, None), (3, [0.1] * 3, 2), (4, [], 2)]
    coded, books = vector_codes.compressed(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", keep=["label"])
    assert coded.count() == 5 and books.shape == (4, 5, 2)
    exact = {r.id: (vector_codes.decoded(np.array([r.codes]), books)[0].tolist(), r.error) for r in coded.collect()}
    assert exact[1] == ([512] * 7 + [0], 0) and exact[3] == ([102] * 3 + [0] * 5, 0) and exact[4] == ([0] * 8, 0)
    none, books = vector_codes.compressed(spark.createDataFrame([], SCHEMA), "vec_id", "embedding")
    assert none.count() == 0 and books.size == 0
    with pytest.raises(ValueError):
        vector_codes.compressed(spark.createDataFrame([(1, [3e30] * 8, 1)], SCHEMA), "vec_id", "embedding")


def test_many_labels_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "MOST_LABELS", 2)
    rows = spark.createDataFrame([(i, i % 5 or None, 1) for i in range(50)], "id int, label int, error long")
    assert {(r.label, r.s) for r in vector_codes.with_sums(rows, "label", "error", "s").collect()} == {(k or None, 10) for k in range(5)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_negatives(spark, tmp_path, seed, monkeypatch):
    if seed == 3:
        monkeypatch.setattr(hard_negatives, "BLOCK", 12)  # a block for each anchor or two
        monkeypatch.setattr(hard_negatives, "SHARD", 17)
    rows = odd_rows(random.Random(seed), 6)
    got = catalog.queries()["op13_threshold_hard_negatives"](spark, stored(spark, tmp_path, rows, seed == 2)).collect()
    want = plain_negatives(rows)
    assert Counter(map(tuple, got)) == want and len(want) > 50


def test_threshold_stops_early():
    """On clustered rows most of a shard is never scored, and nothing is lost."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-20, 20, (3000, 8)), rng.integers(80, 100, (20, 8))])
    seen = []

    class Counted(hard_negatives.Windows):
        def add(self, scores, ids):
            seen.append(len(scores))
            super().add(scores, ids)

    found = Counted(np.array([0]), np.array([1 << 40]), 5)
    hard_negatives.search(hard_negatives.Lists(x, np.arange(len(x))), np.full(8, 9), np.zeros(len(x), bool), found)
    s = x @ np.full(8, 9)
    assert found.ids[0].tolist() == np.lexsort((np.arange(len(x)), -s))[:5].tolist() and sum(seen) < 400


def test_negatives_of_null_ids_repeats_and_nothing(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (None, [0.9, 0.0], 1), (5, [0.7, 0.0], 2), (5, [0.7, 0.0], 2), (6, [], 3)]
    mined = lambda r: hard_negatives.mined(spark.createDataFrame(r, SCHEMA), "vec_id", "embedding", F.col("label"), F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False))).collect()
    got = mined(rows)
    assert Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id) for r in got) == Counter({(0, None, 1, 5): 2, (0, None, 2, 5): 2})
    assert mined([]) == [] and mined([(1, [1.0], 1)]) == [] and mined([(0, [1.0], 1)]) == []


def test_sql_agrees(spark, tmp_path):
    folder = stored(spark, tmp_path, [r for r in vectors(random.Random(5), 700, 64)])
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet/*.parquet'")
    for name in ("op11_walsh_vector_codes", "op13_threshold_hard_negatives"):
        df = catalog.queries()[name](spark, folder)
        cur = con.execute(catalog.oracle_sql()[name])
        names = [d[0] for d in cur.description]
        assert Counter(tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall()) == Counter(map(tuple, df.collect()))
