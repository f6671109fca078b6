"""Patched frames of reference: token ids in blocks, each packed at the width that most of its values need.

A file is the magic, the blocks one after another, and a footer of three columns that locate everything: where each block
starts, and each document's id and number of tokens. The trailer holds the counts and a CRC of the footer.

A block is an eight-byte head (minimum, width, number of exceptions), ``BLOCK * width / 8`` bytes of values less the
minimum, then the positions and whole values of the exceptions, which are those that a percentile-chosen width cannot hold.
The last block is filled up with its minimum; the documents' lengths tell how many of its values count.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"PFORids1"
BLOCK = 512
HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("spare", "u1"), ("exceptions", "<u2")])
TRAILER = struct.Struct("<QQQI8s")
#: Blocks that are packed or unpacked at once.
AT_ONCE = 256


def pack(ids: np.ndarray, share: float = 0.9) -> tuple[bytes, np.ndarray]:
    """Blocks of ``ids`` (below 2**32) and each one's length in bytes. ``share`` of a block's values fit the chosen width."""
    n = -(-len(ids) // BLOCK)
    v = np.zeros((n, BLOCK), np.int64)
    flat = v.reshape(-1)
    flat[: len(ids)] = ids
    if len(ids) % BLOCK:
        flat[len(ids) :] = ids[(n - 1) * BLOCK :].min()
    low = v.min(1)
    v -= low[:, None]
    rank = min(BLOCK - 1, max(0, int(np.ceil(share * BLOCK)) - 1))
    fits = np.partition(v, rank, axis=1)[:, rank]
    width = np.frexp(fits.astype(np.float64))[1].astype(np.int64)  # bits of the value
    over = v >> width[:, None] > 0
    kept = np.where(over, 0, v)
    payload: list[bytes] = [b""] * n
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        bits = ((kept[at][:, :, None] >> np.arange(w)) & 1).astype(np.uint8).reshape(len(at), BLOCK * w)
        for i, row in zip(at.tolist(), np.packbits(bits, axis=1, bitorder="little"), strict=True):
            payload[i] = row.tobytes()
    count = over.sum(1)
    head = np.zeros(n, HEAD)
    head["low"], head["width"], head["exceptions"] = low, width, count
    b, place = np.nonzero(over)
    first = np.concatenate([[0], np.cumsum(count)])
    place, value = place.astype("<u2"), v[b, place].astype("<u4")
    out = [head[i : i + 1].tobytes() + payload[i] + place[first[i] : first[i + 1]].tobytes() + value[first[i] : first[i + 1]].tobytes() for i in range(n)]
    return b"".join(out), np.array([len(x) for x in out], np.int64)


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """All values of the blocks that begin at ``starts`` in ``data``, the last one's filling included."""
    n = len(starts)
    buf = np.frombuffer(data, np.uint8)
    head = buf[starts[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD).ravel()
    width, count = head["width"].astype(np.int64), head["exceptions"].astype(np.int64)
    body = starts + HEAD.itemsize
    out = np.zeros((n, BLOCK), np.int64)
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        bits = np.unpackbits(buf[body[at][:, None] + np.arange(BLOCK * w // 8)], axis=1, bitorder="little").reshape(len(at), BLOCK, w)
        out[at] = bits.astype(np.int64) @ (1 << np.arange(w))
    tail = body + BLOCK * width // 8
    for i in np.flatnonzero(count).tolist():
        c, t = int(count[i]), int(tail[i])
        out[i, np.frombuffer(data, "<u2", c, t)] = np.frombuffer(data, "<u4", c, t + 2 * c)
    return (out + head["low"].astype(np.int64)[:, None]).reshape(-1).astype(np.uint32)


class Writer:
    """Streams documents to one file; holds at most ``AT_ONCE`` blocks of ids and the footer."""

    def __init__(self, sink):
        self.sink, self.at, self.n = sink, sink.write(MAGIC) or len(MAGIC), 0
        self.at = len(MAGIC)
        self.starts: list[np.ndarray] = []
        self.docs: list[tuple[int, int]] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.n += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= AT_ONCE * BLOCK:
            self._flush(whole=True)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        end = len(ids) // BLOCK * BLOCK if whole else len(ids)
        for a in range(0, end, AT_ONCE * BLOCK):
            data, size = pack(ids[a : min(end, a + AT_ONCE * BLOCK)])
            self.starts.append(self.at + np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64))
            self.sink.write(data)
            self.at += len(data)
        self.waiting, self.held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(whole=False)
        starts = np.concatenate(self.starts) if self.starts else np.zeros(0, np.int64)
        docs = np.array(self.docs, "<i8").reshape(-1, 2)
        footer = starts.astype("<i8").tobytes() + docs[:, 0].tobytes() + docs[:, 1].tobytes()
        self.sink.write(footer + TRAILER.pack(len(starts), len(docs), self.at, zlib.crc32(footer), MAGIC))


class Reader:
    """Random access to one file: the footer is read first, then only the blocks asked for."""

    def __init__(self, source, size: int):
        self.source = source
        blocks, docs, self.end, crc, magic = TRAILER.unpack(self._read(size - TRAILER.size, TRAILER.size))
        footer = self._read(self.end, 8 * blocks + 16 * docs)
        if magic != MAGIC or zlib.crc32(footer) != crc or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of token ids, or a broken one")
        cols = np.frombuffer(footer, "<i8")
        self.starts, self.doc_ids, self.lengths = cols[:blocks], cols[blocks : blocks + docs], cols[blocks + docs :]

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def blocks(self, a: int, b: int) -> np.ndarray:
        """The values of blocks ``a`` up to ``b``."""
        if a >= b:
            return np.zeros(0, np.uint32)
        end = int(self.starts[b]) if b < len(self.starts) else self.end
        data = self._read(int(self.starts[a]), end - int(self.starts[a]))
        return unpack(data, self.starts[a:b] - self.starts[a])

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's ``k``-th document, from the blocks that hold it."""
        first = int(self.lengths[:k].sum())
        last = first + int(self.lengths[k])
        a, b = first // BLOCK, -(-last // BLOCK)
        return self.blocks(a, b)[first - a * BLOCK : last - a * BLOCK]

    def pieces(self) -> Iterator[tuple[int, bool, np.ndarray]]:
        """``number, whether it ends here, ids`` of all documents in order; a long one comes in several pieces."""
        k, left = 0, int(self.lengths[0]) if len(self.lengths) else 0
        for a in range(0, len(self.starts), AT_ONCE):
            ids, at = self.blocks(a, min(len(self.starts), a + AT_ONCE)), 0
            while k < len(self.lengths):
                take = min(left, len(ids) - at)
                at, left = at + take, left - take
                yield k, left == 0, ids[at - take : at]
                if left:
                    break
                k += 1
                left = int(self.lengths[k]) if k < len(self.lengths) else 0
        while k < len(self.lengths):  # documents without ids at the end
            yield k, True, np.zeros(0, np.uint32)
            k += 1
