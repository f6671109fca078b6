"""Vector codes: each vector's parts are replaced by the nearest entries of small codebooks, in whole numbers throughout.

A part and an entry are padded with zeros to a power of two and taken through the Walsh-Hadamard transform, which keeps
squared distances up to that power as a factor. Differences add up in order of sequency, slow changes first, and an entry
is out once its sum exceeds that of the best one known; nothing is rounded, so codes are the same on every machine.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm.spaces import staged, table
from ringlake.llm.vectors import extent, matrix, pieces, usable

#: Labels whose sums are sent to every executor; more are joined by a shuffle.
MOST_LABELS = 100_000


def sequency(n: int) -> np.ndarray:
    """Rows of the Hadamard matrix of size ``n`` (a power of two) by their number of sign changes."""
    bits = n.bit_length() - 1
    gray = np.arange(n) ^ (np.arange(n) >> 1)
    return sum(((gray >> b) & 1) << (bits - 1 - b) for b in range(bits)) if bits else gray


def walsh(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, padded with zeros to a power of two, in order of sequency."""
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), n), np.int64)
    y[:, : x.shape[1]] = x
    h = 1
    while h < n:
        pair = y.reshape(len(x), n // (2 * h), 2, h)
        y = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return y[:, sequency(n)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of transformed rows: the index of the nearest transformed entry, the lowest among equals, and the squared distance times the
    transform's size."""
    rows, n = np.arange(len(x)), x.shape[1]
    step = min(2, n)
    near = sum((x[:, c, None] - entries[None, :, c]) ** 2 for c in range(step))

    def whole(k: np.ndarray) -> np.ndarray:
        return ((x - entries[k]) ** 2).sum(1)

    best = whole(near.argmin(1))
    r, k = np.nonzero(near <= best[:, None])
    near = near[r, k]
    while step < n:
        upto = min(n, 2 * step)
        near = near + ((x[r, step:upto] - entries[k, step:upto]) ** 2).sum(1)
        step = upto
        first = np.searchsorted(r, rows)
        low = np.minimum.reduceat(near, first)
        lead = np.flatnonzero(near == low[r])
        best = np.minimum(best, whole(k[lead[np.searchsorted(r[lead], rows)]]))
        live = near <= best[r]
        r, k, near = r[live], k[live], near[live]
    at = np.searchsorted(r, rows)  # all that are left are nearest; entries of a row ascend
    return k[at], near[at]


def assigned(x: np.ndarray, books: np.ndarray, plain: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes by row and part, and the squared distances summed over parts. ``plain`` has the transformed books."""
    parts, _, width = books.shape
    codes, error = np.empty((len(x), parts), np.int64), np.zeros(len(x), np.int64)
    for p in range(parts):
        own = walsh(x[:, p * width : (p + 1) * width])
        codes[:, p], far = nearest(own, plain[p])
        error += far // own.shape[1]
    return codes, error


def first_books(kept: DataFrame, id_col: str, vec_col: str, dim: int, parts: int, entries: int, scale: int) -> np.ndarray:
    """The parts of the rows of the ``entries`` least ids, by part, entry and position."""
    rows = kept.select(F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v")).orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()
    width = -(-dim // parts)
    x = np.zeros((len(rows), width * parts), np.int64)
    for k, r in enumerate(rows):
        x[k, : len(r.v)] = np.floor(np.array(r.v, np.float64) * scale).astype(np.int64)
    return x.reshape(len(rows), parts, width).transpose(1, 0, 2).copy()


def compressed(df: DataFrame, id_col: str, vec_col: str, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, keep: list[str] | None = None) -> tuple[DataFrame, np.ndarray]:
    """``id, codes, error`` (and the columns ``keep``) of each vector, and the codebooks as an array by part, entry and position.

    Codebooks start as the parts of the rows with the least ids (ties by the vector, null ids last) and take ``rounds`` rounds of
    Lloyd's method. Every round is one pass over the vectors: tasks add up integer sums by part and entry, which is what
    is shuffled, and the driver holds ``parts * entries`` rows of them.

    Rows whose vector is null or holds a null, NaN or infinite component are left out. Vectors shorter than the longest end in
    zeros, and so do parts where ``parts`` does not divide the length. Repeated rows each count; ties go to the lower entry; with
    fewer rows than ``entries`` the books are as short; an empty table gives no rows and empty books. Only the named columns are
    read, so others' names never clash. Raises ValueError where squared distances do not fit 62 bits.
    """
    keep = keep or []
    if parts < 1 or entries < 1:
        raise ValueError("parts and entries must be positive")
    kept = df.where(usable(F.col(vec_col)))
    dim, top = extent(kept, vec_col, scale)
    width = -(-dim // parts) if dim else 0
    padded = 1 << max(0, width - 1).bit_length()
    if dim and padded * padded * parts * (2 * top) ** 2 >= 1 << 62:
        raise ValueError("components are too large for exact 64-bit distances")
    books = first_books(kept, id_col, vec_col, dim, parts, entries, scale) if dim else np.zeros((parts, 0, width), np.int64)
    sc, k = df.sparkSession.sparkContext, books.shape[1]
    spread = lambda v: np.pad(v, ((0, 0), (0, parts * width - dim)))

    def moved(sent):
        def add(batches):
            now = sent.value
            plain = [walsh(b) for b in now]
            total, count = np.zeros_like(now), np.zeros(now.shape[:2], np.int64)
            for b in pieces(batches, dim):
                x = spread(matrix(b.column(0), dim, scale))
                codes, _ = assigned(x, now, plain)
                for p in range(parts):
                    order = np.argsort(codes[:, p], kind="stable")
                    hit, first, n = np.unique(codes[order, p], return_index=True, return_counts=True)
                    total[p, hit] += np.add.reduceat(x[order, p * width : (p + 1) * width], first, axis=0)
                    count[p, hit] += n
            p, e = np.nonzero(count)
            yield pa.record_batch({"part": p.astype(np.int32), "entry": e.astype(np.int32), "n": count[p, e], "sums": pa.array(list(total[p, e]), pa.list_(pa.int64()))})

        return add

    if dim and k:
        vectors = kept.select(vec_col)
        for _ in range(rounds):
            sums = vectors.mapInArrow(moved(sc.broadcast(books)), "part int, entry int, n long, sums array<long>")
            for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")).collect():
                books[r.part, r.entry] = np.array(r.sums, np.int64) // r.n
    sent = sc.broadcast(books)

    def encode(batches):
        now = sent.value
        plain = [walsh(b) for b in now]
        for b in pieces(batches, dim):
            codes, error = assigned(spread(matrix(b.column(0), dim, scale)), now, plain) if k and dim else (np.zeros((b.num_rows, parts), np.int64), np.zeros(b.num_rows, np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32())), pa.array(error)], [*b.schema.names[1:], "codes", "error"])

    rest = kept.select(F.col(vec_col).alias("_v"), F.col(id_col).alias("id"), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields[1:])
    return rest.mapInArrow(encode, f"{fields}, codes array<int>, error long"), books


def decoded(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The integer vectors that codes (rows by parts) stand for, padding included."""
    return np.concatenate([books[p][codes[:, p]] for p in range(len(books))], 1)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_sums(rows: DataFrame, label: str, value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over rows of one label, nulls being one. Partial sums are shuffled, not rows; the sums are
    broadcast while they are few, else joined, where a hot label's rows are split by adaptive execution."""
    sums = staged(rows.groupBy(F.col(label).alias("_l")).agg(F.sum(value).alias(out)), "label-sums")
    few = sums.count() <= MOST_LABELS
    return rows.join(F.broadcast(sums) if few else sums, F.col(label).eqNullSafe(F.col("_l"))).drop("_l")


def op11_walsh_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of four bytes; null and non-finite vectors are left out, repeated rows each give one, an empty table gives none."""
    coded, books = compressed(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", keep=["label"])
    rows = with_sums(staged(coded, "vector-codes"), "label", "error", "label_error")
    code = F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))))
    return rows.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
