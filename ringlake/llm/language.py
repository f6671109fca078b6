"""Language identification by a byte convolutional network (operator 10).

Fixed-length windows of UTF-8 bytes pass through filters of several widths, a maximum over positions and a softmax.
The network is trained here, in numpy, on labelled text; every window of every text is classified, and a document's
language has the greatest mean log-probability over its windows, weighted by their letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm import bytescan as B
from ringlake.llm.linear import Adam, bounded_sample, remainder
from ringlake.llm.spaces import table

WINDOW, EMBED, WIDTHS, FILTERS = 128, 4, (2, 3, 4), 16
SPAN = max(WIDTHS)


@dataclass
class Net:
    """``byte``: embedding of each byte. ``conv``: one column per filter over ``SPAN`` bytes, zero beyond its width."""

    names: list[str]
    byte: np.ndarray
    conv: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    mask: np.ndarray = field(repr=False, default=None)


def fresh(names: list[str], seed: int = 3) -> Net:
    rng = np.random.default_rng(seed)
    mask = np.concatenate([np.repeat((np.arange(SPAN * EMBED) < w * EMBED)[:, None], FILTERS, 1) for w in WIDTHS], 1).astype(np.float32)
    k = mask.shape[1]
    conv = rng.normal(0, 0.4, (SPAN * EMBED, k)).astype(np.float32) * mask
    return Net(names, rng.normal(0, 0.6, (256, EMBED)).astype(np.float32), conv, rng.normal(0, 0.2, (k, len(names))).astype(np.float32), np.zeros(len(names), np.float32), mask)


def windows(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts cut into windows of ``WINDOW`` bytes, the last padded with spaces, and each window's row. Case, digits and marks are folded."""
    text = FOLD[B.lowered(buf)]
    n = -(-np.diff(off) // WINDOW)
    row = np.repeat(np.arange(len(n)), n)
    out = np.full(len(row) * WINDOW, 32, np.uint8)
    shift = np.repeat((np.cumsum(n) - n) * WINDOW - off[:-1], np.diff(off))
    out[np.arange(len(text)) + shift] = text
    return out.reshape(-1, WINDOW), row


#: Everything but letters and bytes of multi-byte characters counts as a space.
FOLD = np.full(256, 32, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def _columns(net: Net, w: np.ndarray) -> np.ndarray:
    """Each position's ``SPAN`` embedded bytes side by side: (windows, positions, SPAN * EMBED)."""
    x = net.byte[w].reshape(len(w), WINDOW * EMBED)
    t = WINDOW - SPAN + 1
    return np.lib.stride_tricks.as_strided(x, (len(w), t, SPAN * EMBED), (x.strides[0], EMBED * x.itemsize, x.itemsize))


def hidden(net: Net, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Max-pooled, rectified filter outputs of every window."""
    c = np.ascontiguousarray(_columns(net, w))
    y = (c.reshape(-1, SPAN * EMBED) @ net.conv).reshape(len(w), WINDOW - SPAN + 1, -1)
    return np.maximum(y.max(1), 0), y


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def train(texts: list[str], label: np.ndarray, names: list[str], epochs: int = 6, size: int = 128, rate: float = 0.01, most_windows: int = 24_000, seed: int = 3) -> Net:
    """Minibatch Adam on cross-entropy of single windows; at most ``most_windows`` seeded windows in all, alike per class."""
    net = fresh(names, seed)
    rng = np.random.default_rng(seed)
    w, row = windows(*B.text_bytes(pa.array(texts, pa.string())))
    y = np.asarray(label)[row] if len(row) else np.zeros(0, int)
    pick = [rng.permutation(np.flatnonzero(y == c))[: most_windows // max(1, len(names))] for c in range(len(names))]
    pick = np.concatenate(pick) if pick else np.zeros(0, int)
    params = [net.byte, net.conv, net.out, net.bias]
    step = Adam(params, rate)
    for epoch in range(epochs):
        step.rate = rate * (1 - epoch / epochs)
        order = rng.permutation(pick)
        for at in range(0, len(order), size):
            i = order[at : at + size]
            x = w[i]
            h, conv = hidden(net, x)
            p = np.exp(log_softmax(h @ net.out + net.bias))
            p[np.arange(len(i)), y[i]] -= 1
            p /= len(i)
            g = (p @ net.out.T) * (h > 0)
            best = conv.argmax(1)  # (windows, filters)
            c = _columns(net, x)
            g_conv, g_byte = np.zeros_like(net.conv), np.zeros_like(net.byte)
            rows = np.arange(len(i))
            for k in range(conv.shape[2]):
                g_conv[:, k] = c[rows, best[:, k]].T @ g[:, k]
            for j in range(SPAN):
                part = net.conv[j * EMBED : (j + 1) * EMBED]  # (EMBED, filters)
                ids = x[rows[:, None], best + j]
                for e in range(EMBED):
                    g_byte[:, e] += np.bincount(ids.ravel(), weights=(g * part[e]).ravel(), minlength=256)
            step.step([g_byte, g_conv * net.mask, h.T @ p, p.sum(0)])
    return net


def classify(net: Net, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, its probability, and whether the row has a letter."""
    n, k = len(off) - 1, max(1, len(net.names))
    total, weight = np.zeros((n, k)), np.zeros(n)
    w, row = windows(buf, off)
    for at in range(0, len(w), 256):
        part, r = w[at : at + 256], row[at : at + 256]
        mass = (part != 32).sum(1).astype(np.float64)
        use = mass > 0
        if use.any() and net.names:
            lp = log_softmax(hidden(net, part[use])[0] @ net.out + net.bias)
            np.add.at(total, r[use], lp * mass[use, None])
            np.add.at(weight, r[use], mass[use])
    p = np.exp(log_softmax(total / np.maximum(weight, 1)[:, None]))
    best = p.argmax(1)
    return best, p[np.arange(n), best], weight > 0


def identify(docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` for every row. Null, empty and letterless texts are ``und`` with score 0; so is any
    text when nothing was learned. Repeated rows and null ids keep their row, equal scores take the first name, an empty
    table gives no rows, other columns are ignored."""
    schema = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*net.names, "und"], object)
        for part, buf, off in B.cut(batches):
            best, p, known = classify(net, buf, off)
            known &= lettered(buf, off) & bool(net.names)
            yield B.batch_of(schema, id=part.column(0), lang_pred=pa.array(names[np.where(known, best, len(net.names))], pa.string()), score=np.where(known, p, 0.0))

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scan, "id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, net: Net, text_col: str = "text", at_least: float = 0.5, languages: list[str] | None = None) -> DataFrame:
    """Rows whose predicted language has a probability of ``at_least`` and is one of ``languages`` (None: any), all columns as they were.

    ``und`` rows go: null, empty and letterless texts, and all where nothing was learned. Repeated rows and null ids are judged
    by their text, equal scores take the first name, an empty table stays empty, further columns pass through.
    """
    good = np.array([languages is None or x in languages for x in net.names] or [False])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, off in B.cut(batches, text_col):
            best, p, known = classify(net, buf, off)
            yield part.filter(pa.array(known & good[best] & (p >= at_least) & lettered(buf, off)))

    return docs.mapInArrow(scan, docs.schema)


def lettered(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows with a letter: an ASCII letter, or else a character that Unicode calls one."""
    low = B.LOWER[buf]
    c = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
    out = c[off[1:]] > c[off[:-1]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)):
        out[i] = any(ch.isalpha() for ch in buf[off[i] : off[i + 1]].tobytes().decode())
    return out


def fit(labelled: DataFrame, per_class: int = 400, most_chars: int = 1_000_000) -> Net:
    """Train on ``labelled(text, lang)``: at most ``per_class`` rows and ``most_chars`` characters of each language."""
    sample = bounded_sample(labelled, "lang", per_class, most_chars)
    names = sorted(set(sample["lang"]))
    return train(list(sample["text"]), np.array([names.index(x) for x in sample["lang"]], int), names)


def op10_byte_cnn_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit(docs.where(remainder(F.col("doc_id"), 4) != 2).select("text", "lang"))
    found = identify(docs, net)
    return found.select(F.col("id").alias("doc_id"), (remainder(F.col("id"), 4) == 2).alias("held_out"), "lang_pred", "score")
