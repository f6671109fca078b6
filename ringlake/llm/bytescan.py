"""Vectorised reading of Arrow string columns: words, rolling hashes and runs over raw UTF-8 bytes.

Texts are never turned into Python strings here. A batch is cut into chunks of about ``CHUNK`` bytes at row
boundaries, so memory per task is bounded by the chunk and by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK = 1 << 20
U = np.uint64
#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser, so that equal bits of sums do not stay equal."""
    x = x + U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Masks that keep the first 0 to 8 bytes of a little-endian block.
FIRST = np.array([(1 << 8 * i) - 1 for i in range(9)], U)


def hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time through the finaliser.

    No polynomial of the bytes: sums modulo 2**64 are equal for some long words whatever the base."""
    out = mix((end - start).astype(U), seed)
    block = np.lib.stride_tricks.as_strided(np.concatenate([buf, np.zeros(8, np.uint8)]), (len(buf) + 1, 8), (1, 1))
    long = np.flatnonzero(end - start > 4096)
    live, at = np.flatnonzero((end > start) & (end - start <= 4096)), 0
    while len(live):
        pos = start[live] + at
        left = end[live] - pos
        own = np.ascontiguousarray(block[pos]).view("<u8").ravel() & FIRST[np.minimum(left, 8)]
        out[live] = mix(out[live] ^ own, seed + 1)
        live, at = live[left > 8], at + 8
    for i in long:
        out[i] ^= U(xxhash.xxh3_64_intdigest(buf[start[i] : end[i]], seed))
    return out


def spaced(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words with one space after each, and where each begins (and the last one's end)."""
    to = np.concatenate([[0], np.cumsum(end - start + 1)])
    flat = np.full(to[-1], 32, np.uint8)
    keep = np.ones(to[-1], bool)
    keep[to[1:] - 1] = False
    flat[keep] = buf[~SPACE[buf]]
    return flat.tobytes(), to


def digests(flat: bytes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """128-bit digests of byte ranges, as two columns."""
    h = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([h(flat[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]), np.int64).reshape(-1, 2).copy()


class Rolling:
    """Hashes of any span of a sequence of hashes, polynomials modulo 2**64 from one running sum (Karp-Rabin)."""

    def __init__(self, seed: int):
        self.seed = seed
        base = int(mix(np.array([seed + 77], U))[0]) | 1
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.back)):
                p = np.full(n, b, U)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def sums(self, values: np.ndarray) -> np.ndarray:
        self.powers(len(values) + 1)
        out = np.zeros(len(values) + 1, U)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start], self.seed)

    def windows(self, values: np.ndarray, k: int) -> np.ndarray:
        """Hash of every ``k`` consecutive values; the caller drops those that cross a row's end."""
        if len(values) < k:
            return np.zeros(0, U)
        s = self.sums(values)
        return mix((s[k:] - s[:-k]) * self.down[: len(values) - k + 1], self.seed + 1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def cut(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of about ``size`` text bytes with their bytes and offsets; a longer text stands alone, whole."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        buf, off = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
            yield batch.slice(at, to - at), buf[off[at] : off[to]], off[at : to + 1] - off[at]
            at = to


def runs(member: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``member`` bytes inside each row, and each row's first run."""
    n = len(member)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1]
    last[:-1] &= ~member[1:]
    edge = off[(off > 0) & (off < n)]
    first[edge] = member[edge]
    last[edge - 1] = member[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, off)


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``[^\x20\x09-\x0D]+``."""
    return runs(~SPACE[buf], off)


def letters(buf: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of all multi-byte characters."""
    low = LOWER[buf]
    return ((low >= 97) & (low <= 122)) | (buf >= 128)


def lowered(buf: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the Latin-1 letters U+00C0..U+00DE, on UTF-8 bytes."""
    out = LOWER[buf]
    if len(out) > 1:
        high = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1
        out[high] += 0x20
    return out


def codepoints(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Code points in each row."""
    c = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    return c[off[1:]] - c[off[:-1]]


def row_of(first: np.ndarray) -> np.ndarray:
    """Row number of each run, from the rows' first runs."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in schema)], schema=schema)
