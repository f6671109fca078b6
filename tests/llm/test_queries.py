"""The registered queries on a small table, against plain versions of what they return."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from ringlake.llm import catalog, licenses, mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(21)
    syll = {"en": ["ka", "to", "mi", "re"], "de": ["sch", "ung", "ö", "pf"]}
    text = lambda k, n: " ".join("".join(rng.choice(syll[k]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = []
    for i in range(240):
        k = rng.choice(["en", "de"])
        t = ". ".join(text(k, rng.randint(3, 9)) for _ in range(rng.randint(1, 14)))
        if i % 4 == 0:
            t += ". you vile scumbag " + text(k, 2)
        if i % 9 == 0:
            t += "\nReleased under the MIT License.\n" + text(k, 3)
        rows.append((i, t, k, f"s{i % 4}" if i % 11 else None, len(t)))
    rows += [(300 + i, rows[i][1], rows[i][2], "s9", rows[i][4]) for i in range(12)] + [(400, None, "en", "s1", 0), (401, "", None, "s1", 0), (402, " 12 ... ", "de", "s1", 8), (403, "Ü" * 3000 + " x", None, None, 3002)]
    folder = tmp_path_factory.mktemp("llm")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows


def run(spark, table, n):
    q = next(f for k, f in catalog.queries().items() if k.startswith(f"op{n}_"))
    return q(spark, table[0]).collect()


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_licences(spark, table):
    want = Counter((i, v.start, v.end, v.license, v.verdict, t[v.start : v.end]) for i, t, *_ in table[1] for v in licenses.Scanner().scan(t or ""))
    assert Counter((r.doc_id, r.start, r.end, r.license, r.verdict, r.wording) for r in run(spark, table, 1)) == want and len(want) > 20


def test_toxicity(spark, table):
    got = run(spark, table, 2)
    assert len(got) == len(table[1]) and all(r.held_out == (crc(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 240]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.95 and {r.score for r in got if r.doc_id in (400, 401)} == {0.0}


def test_repeats(spark, table):
    words = [WORDS.findall(t or "") for _, t, *_ in table[1]]
    seen = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    want = Counter()
    for (i, *_), w in zip(table[1], words):
        gone = {x for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for x in range(k, k + 35)}
        want[i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in run(spark, table, 4)) == want and any(k[2] for k in want)


def test_fingerprints(spark, table):
    got = {r.doc_id: r for r in run(spark, table, 5)}
    order = sorted((i, t or "") for i, t, *_ in table[1])
    assert len(got) == len(order)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        half, r = len(t) // 2, got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    for i in range(12):
        assert got[i].fingerprint == got[300 + i].fingerprint


def test_mix(spark, table):
    got = run(spark, table, 6)
    size = lambda t: len(WORDS.findall(t or ""))
    own = Counter()
    for _, t, _, s, _ in table[1]:
        own[s] += size(t)
    order = sorted((s for s in own if s), key=lambda s: s.encode("utf-32-be")) + [None]
    goal = mixing.targets({s: own[s] for s in order}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    assert sum(goal.values()) == pytest.approx(sum(own.values())) and all(goal[s] <= 3 * own[s] + 1e-6 for s in order)
    where, taken = {i: s for i, _, _, s, _ in table[1]}, Counter()
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter((i, size(t), own[s]) for i, t, _, s, _ in table[1])
    for r in got:
        assert r.target == pytest.approx(goal[where[r.doc_id]]) and 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[where[r.doc_id]] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 0.01 * goal[s] + 2 for s in order), [(s, taken[s], goal[s], own[s]) for s in order]
    assert sorted(map(str, got)) == sorted(map(str, run(spark, table, 6)))


def test_flow_is_the_cheapest():
    """Against all ways to use three patterns up to three times for two quotas."""
    rng = random.Random(1)
    for _ in range(30):
        patterns = [(("a",), rng.randint(1, 3)), (("a", "b"), rng.randint(1, 4)), (("b",), rng.randint(1, 3))]
        quota = {"a": rng.randint(1, 9), "b": rng.randint(1, 9)}
        sent = mixing.route(patterns, quota, 3)
        cost = lambda used: sum(sum(u * max(0, min(size, x - u * size)) for u in range(3)) for (_, size), x in zip(patterns, used))
        best = None
        for a in range(3 * patterns[0][1] + 1):
            for b in range(3 * patterns[2][1] + 1):
                for m in range(3 * patterns[1][1] + 1):
                    for x in range(m + 1):
                        fa, fb = a + x, b + m - x
                        if fa <= quota["a"] and fb <= quota["b"]:
                            k = (-(fa + fb), cost((a, m, b)))
                            best = k if best is None or k < best else best
        used = [sum(v for (p, _), v in sent.items() if p == i) for i in range(3)]
        assert (-sum(used), cost(used)) == best


def test_near_duplicates(spark, table):
    prints = []
    for i, t, *_ in table[1]:
        w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sh = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
        prints.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    root = {i: i for i, _ in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, f in prints:
        for j, g in prints:
            if j < i and (f ^ g).bit_count() <= 2:
                root[max(top(i), top(j))] = min(top(i), top(j))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in run(spark, table, 7)) == Counter((i, f"{f:016x}", top(i)) for i, f in prints)


def test_language(spark, table):
    got = run(spark, table, 10)
    assert len(got) == len(table[1]) and all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    known = {i: k for i, _, k, *_ in table[1]}
    assert np.mean([r.lang_pred == known[r.doc_id] for r in got if r.held_out and r.doc_id < 240]) > 0.95
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {400, 401, 402} and {r.lang_pred for r in got} == {"en", "de", "und"}


def test_sql_agrees(spark, table):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{table[0]}/documents.parquet/*.parquet'")
    for name, sql in catalog.oracle_sql().items():
        if "embeddings" in sql:
            continue  # those are compared in test_vectors
        df = catalog.queries()[name](spark, table[0])
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        show = lambda v: repr(float(v)) if isinstance(v, float) else repr(v)
        line = lambda r, cols: tuple(show(r[cols.index(c)]) for c in sorted(cols))
        assert sorted(df.columns) == sorted(names) and Counter(line(r, names) for r in cur.fetchall()) == Counter(line(tuple(r), df.columns) for r in df.collect()), name
