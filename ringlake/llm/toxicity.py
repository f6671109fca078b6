"""Toxicity by multiple-instance learning (operator 2).

A document is a bag of sentences. Each sentence scores ``sigmoid(bias + sum of weights)`` over its distinct
hashed words and word stems, and the bag's score is their noisy-or, ``1 - prod(1 - p)``. Only bag labels are known: the gradient
of the bag's log loss through the noisy-or reaches every sentence, so training finds which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm import bytescan as B
from ringlake.llm.linear import Adam, bounded_sample, remainder
from ringlake.llm.spaces import table

#: Bytes that end a sentence.
STOPS = np.zeros(256, bool)
STOPS[[ord(c) for c in ".!?\n"]] = True
#: Bytes of a word's stem, which is a feature beside the word.
STEM = 6


@dataclass
class Scorer:
    bits: int
    weight: np.ndarray
    bias: float


def sentences(buf: np.ndarray, off: np.ndarray, bits: int):
    """Distinct hashed words of every sentence with a letter: sentence starts, ends, rows' first sentences, words, their sentences."""
    start, end, first = B.runs(B.letters(buf), off)
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64), z, z
    low = B.lowered(buf)
    word = (B.hashes(low, start, end, 5) >> np.uint64(64 - bits)).astype(np.int64)
    stem = (B.hashes(low, start, np.minimum(end, start + STEM), 9) >> np.uint64(64 - bits)).astype(np.int64)
    # a sentence ends at stop bytes that a space, a line or the row's end follows
    stop = STOPS[buf]
    nxt = np.ones(len(buf), bool)
    nxt[:-1] = B.SPACE[buf[1:]] | STOPS[buf[1:]]
    breaks = np.cumsum(stop & (nxt | (buf == 10)))[start - 1] * (start > 0)
    row = B.row_of(first)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (breaks[1:] != breaks[:-1]) | (row[1:] != row[:-1])
    sent = np.cumsum(fresh) - 1
    head = np.flatnonzero(fresh)
    key = np.unique(np.concatenate([(sent << bits) | word, (sent << bits) | stem]))
    return start[head], end[np.append(head[1:], len(start)) - 1], np.searchsorted(row[head], np.arange(len(off))), key & ((1 << bits) - 1), key >> bits


def train(texts: list[str], label: np.ndarray, bits: int = 18, rounds: int = 60, rate: float = 0.1, least_docs: int = 3, shrink: float = 0.001) -> Scorer:
    """Fit word weights by full-batch Adam on the noisy-or loss with an L1 pull; words in under ``least_docs`` bags stay 0."""
    label = np.asarray(label, np.float64)
    scorer = Scorer(bits, np.zeros(1 << bits, np.float32), -4.0)
    if len(label) == 0 or label.min() == label.max():
        scorer.bias = 0.0 if len(label) == 0 else (6.0 if label[0] else -6.0)
        return scorer
    bags, words, sents, rows, many = [], [], [], 0, 0
    for part, buf, off in B.cut(iter([pa.record_batch({"text": pa.array(texts, pa.string())})])):
        _, _, first, word, sent = sentences(buf, off, bits)
        bags.append(B.row_of(first) + rows)
        words.append(word.astype(np.int32))
        sents.append((sent + many).astype(np.int32))
        rows, many = rows + part.num_rows, many + len(bags[-1])
    bag, word, sent = np.concatenate(bags), np.concatenate(words), np.concatenate(sents)
    seen = np.unique((bag[sent] << bits) | word)
    docs = np.bincount(seen & ((1 << bits) - 1), minlength=1 << bits)
    # words that lean to the positive bags or away from them
    hot = np.bincount(seen & ((1 << bits) - 1), weights=label[seen >> bits], minlength=1 << bits)
    base = label.mean()
    lean = (hot - docs * base) / np.sqrt(np.maximum(docs, 1) * base * (1 - base))
    use = np.flatnonzero((docs >= least_docs) & (np.abs(lean) > 2.5))
    slot = np.full(1 << bits, -1)
    slot[use] = np.arange(len(use))
    keep = slot[word] >= 0
    w, s = slot[word[keep]], sent[keep]
    weight, bias = np.maximum(lean[use], 0) * 0.15, np.array([-4.0])
    step = Adam([weight, bias], rate)
    balance = np.where(label > 0, 0.5 / base, 0.5 / (1 - base))
    for _ in range(rounds):
        z = bias[0] + np.bincount(s, weights=weight[w], minlength=len(bag))
        p = np.clip(1 / (1 + np.exp(-z)), 1e-9, 1 - 1e-9)
        quiet = np.bincount(bag, weights=np.log1p(-p), minlength=len(label))
        score = np.clip(-np.expm1(quiet), 1e-9, 1 - 1e-9)
        # d loss / d z of a sentence: its share of the noisy-or
        g = balance * np.where(label > 0, -(1 - score) / score, 1.0) / len(label)
        dz = g[bag] * p
        step.step([np.bincount(w, weights=dz[s], minlength=len(use)) + shrink * np.sign(weight) / len(label) * 10, np.array([dz.sum()])])
    scorer.weight[use], scorer.bias = weight, float(bias[0])
    return scorer


def score_rows(buf: np.ndarray, off: np.ndarray, scorer: Scorer):
    """Bag scores, and each row's worst sentence: its score and byte span."""
    start, end, first, word, sent = sentences(buf, off, scorer.bits)
    n = len(off) - 1
    z = scorer.bias + np.bincount(sent, weights=scorer.weight[word], minlength=len(start))
    p = 1 / (1 + np.exp(-z))
    row = B.row_of(first)
    score = -np.expm1(np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n))
    worst = np.full(n, -1)
    if len(p):
        order = np.lexsort((-np.arange(len(p)), p, row))
        worst[row[order]] = order  # the last of each row stays: the highest, the earliest among equals
    return score, p, worst, start, end


def toxicity(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score, worst_score, worst_start, worst_end, worst_sentence)`` for every row, whole texts.

    Offsets are code points. Null, empty and letterless texts have no sentence: score 0, null worst. Repeated rows and null ids
    keep their row, ties take the earliest sentence, an empty table gives no rows, other columns are ignored.
    """
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64()), ("worst_score", pa.float64()), ("worst_start", pa.int64()), ("worst_end", pa.int64()), ("worst_sentence", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, off in B.cut(batches):
            score, p, worst, start, end = score_rows(buf, off, scorer)
            none = worst < 0
            at = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
            a = np.where(none, 0, start[np.maximum(worst, 0)] if len(start) else 0)
            b = np.where(none, 0, end[np.maximum(worst, 0)] if len(end) else 0)
            raw = buf.tobytes()
            yield B.batch_of(schema, id=part.column(0), score=score, worst_score=pa.array(p[worst] if len(p) else np.zeros(len(worst)), mask=none),
                             worst_start=pa.array(at[a] - at[off[:-1]], mask=none), worst_end=pa.array(at[b] - at[off[:-1]], mask=none),
                             worst_sentence=pa.array([None if skip else raw[x:y].decode() for skip, x, y in zip(none, a.tolist(), b.tolist(), strict=True)], pa.string()))

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scan, "id long, score double, worst_score double, worst_start long, worst_end long, worst_sentence string")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", per_class: int = 2000, most_chars: int = 7_000_000) -> Scorer:
    """Train on ``docs(id, text)`` with ``labels(id, toxic)``: at most ``per_class`` rows and ``most_chars`` characters of each label."""
    sample = bounded_sample(docs.select(id_col, "text"), "toxic", per_class, most_chars, labels.where("toxic in (0, 1)"), id_col)
    return train(list(sample["text"]), sample["toxic"].to_numpy())


def op2_toxicity_noisy_or(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    found = toxicity(docs, fit(docs.where(remainder(F.col("doc_id"), 5) != 0), labels))
    return found.select(F.col("id").alias("doc_id"), (remainder(F.col("id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_score", "worst_start", "worst_end", "worst_sentence")
