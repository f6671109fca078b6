"""Documents as token ids in binary files: tokenised in tasks, ordered by id, packed as patched frames of reference."""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm import frames
from ringlake.llm.spaces import shared_dir, staged, table, widths

#: Where pieces end, for RE2: before a sign that follows a letter, and on both sides of a line feed between other characters.
SIGN, FEED = r"([A-Za-zÀ-ÖØ-öø-ʯ])([.,;:!?])", r"([^\s\x0b\x1c-\x1f\x85\p{Z}])\n([^\s\x0b\x1c-\x1f\x85\p{Z}])"
#: Texts in which some space does not stand alone between other characters, or that hold the mark of an end.
ODD = r"[\s\x0b\x1c-\x1f\x85\p{Z}] | [\s\x0b\x1c-\x1f\x85\p{Z}]|^ | $|\x01"
#: The same places before a space in such texts.
CUT = re.compile(r"(?<=\S)(?= \S)")
#: Bytes of texts that are encoded together, pieces whose ids a worker keeps, and pieces that make a row for the library.
TOGETHER, KEPT, ROW = 1 << 23, 600_000, 16
#: Ids of one file, at most (but for the last document's).
FILE_IDS = 1 << 28


class Encoder:
    """Encodes texts by their pieces where the tokenizer allows it: a word that recurs is then encoded once.

    With the byte-level pattern no pre-token spans the place before a space between two characters that are none, between a letter
    and a sign, or beside a lone line feed, and nothing in the pattern looks back; so the ids of a text are those of its
    pieces one after another. Arrow cuts and numbers the pieces; only those that a worker has not met go to the library.
    Tokenizers of another kind, or with added tokens that hold or strip spaces, encode whole texts.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        j = json.loads(spec)
        pre, added = j.get("pre_tokenizer") or {}, j.get("added_tokens") or []
        loose = any(re.search(r"\s|[^\W\d_][.,;:!?]", t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in added)
        plain = not any(j.get(k) for k in ("normalizer", "truncation", "padding")) and not (j.get("model") or {}).get("dropout")
        self.by_piece = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and plain and not loose
        self.bytes = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = len(token)  # one character of the byte-level alphabet stands for a byte
        for t in added:
            self.bytes[t["id"]] = len(t["content"].encode())
        self.known, self.ids, self.n = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _library(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)]
        n = np.array([len(x) for x in got], np.int64)
        return np.fromiter(chain.from_iterable(got), np.uint32, int(n.sum())), n

    def _fresh(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after another, and how many each has. Words that begin with their space are encoded in rows of some, which is
        cheaper than one by one: the bytes of the ids tell where each ends."""
        words = pc.match_substring_regex(pieces, r"^ [^\s\x0b\x1c-\x1f\x85\p{Z}](?:.|\n)*[^\s\x0b\x1c-\x1f\x85\p{Z}]$").to_numpy(zero_copy_only=False)
        one, many = pieces.filter(pa.array(~words)), pieces.filter(pa.array(words))
        listed = many.to_pylist()
        ids, _ = self._library(["".join(listed[a : a + ROW]) for a in range(0, len(listed), ROW)])
        ends = np.cumsum(pc.binary_length(many).to_numpy(zero_copy_only=False).astype(np.int64))
        at = np.cumsum(self.bytes[ids])
        upto = np.searchsorted(at, ends)
        if len(ends) and (upto[-1] >= len(at) or (at[upto] != ends).any()):  # a tokenizer that drops or replaces bytes
            self.by_piece = False
            return self._library(pieces.to_pylist())
        n = np.zeros(len(pieces), np.int64)
        n[words] = np.diff(upto + 1, prepend=0)
        alone, n[~words] = self._library(one.to_pylist())
        first = np.zeros(len(pieces), np.int64)
        order = np.concatenate([np.flatnonzero(words), np.flatnonzero(~words)])
        first[order] = np.cumsum(n[order]) - n[order]
        return np.concatenate([ids, alone])[_spread(first, n)], n

    def _pieces(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        coded = pieces.dictionary_encode()
        own = coded.dictionary
        place = pc.index_in(own, value_set=self.known)
        new = own.filter(pc.is_null(place))
        ids, n = self._fresh(new)
        at = place.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[place.is_null().to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(new))
        flat, size = np.concatenate([self.ids, ids]), np.concatenate([self.n, n])
        if len(self.known) < KEPT and len(new):
            self.known, self.ids, self.n = pa.concat_arrays([self.known, new]), flat, size
        start = np.cumsum(size) - size
        which = at[coded.indices.to_numpy()]
        return flat[_spread(start[which], size[which])], size[which]

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after another, and how many each has."""
        if not self.by_piece or not len(texts):
            return self._library(texts.to_pylist())
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd))
        marked = pc.replace_substring_regex(plain, SIGN, "\\1\x01\\2")
        marked = pc.replace_substring(pc.replace_substring_regex(marked, FEED, "\\1\x01\n\x01\\2"), " ", "\x01 ")
        lists = pc.split_pattern(marked, "\x01")
        rest = [CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        each = np.concatenate([np.diff(lists.offsets.to_numpy()), [len(x) for x in rest]]).astype(np.int64)
        flat, n = self._pieces(pa.concat_arrays([lists.flatten(), pa.array([x for r in rest for x in r], pa.string())]))
        own = np.add.reduceat(n, np.cumsum(each) - each)  # every text has a piece, the empty one too
        if not odd.any():
            return flat, own
        order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        size, first = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        size[order], first[order] = own, np.cumsum(own) - own
        return flat[_spread(first, size)], size


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places ``start`` up to ``start + n`` of each, one after another."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


_ENCODERS: dict[int, Encoder] = {}


def encoder(spec: str) -> Encoder:
    """The worker's encoder, which it keeps for later tasks."""
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def groups(column: pa.Array, most: int = TOGETHER):
    """Ranges of rows whose texts have about ``most`` bytes; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > most:
            yield at, i
            at, held = i, 0
        held += n
    if at < len(size):
        yield at, len(size)


def written_files(docs: DataFrame, tokenizer: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Writes ``docs`` as files of token ids and returns their list: ``part, file, path, docs, ids, bytes, start``.

    Files stand in the order of ids (nulls last, equal ids by their text's hash), so ``start`` counts the ids of all files before.
    Rows are dealt by ranges of id, hash and row, so repeated ids spread too. A task writes under names of its own attempt,
    and only the attempt whose list Spark commits counts; a lost executor costs its tasks alone. ``folder`` is any place that pyarrow
    can write from an executor, by default one under ``spark.checkpoint.dir``. ``tokenizer`` is a path that the driver reads; its
    text, a few MB, is broadcast.

    Null texts count as empty; every document, empty ones too, ends with ``end_id`` unless that is None. Texts are encoded whole.
    An empty table gives no files. Only the two named columns are read, so other names never clash.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    folder = folder or f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    end = np.array([] if end_id is None else [end_id], "<u4")

    def write(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        own = TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder)
        encode, open_, done = encoder(spec.value).encode, None, []

        def closed():
            writer, sink, path = open_
            writer.close()
            sink.close()
            done.append((own.partitionId(), len(done), path, len(writer.docs), writer.n, store.get_file_info(path).size))

        for b in batches:
            ids = b.column(0).fill_null(frames_null()).to_pylist()
            for x, y in groups(b.column(1)):
                flat, n = encode(b.column(1).slice(x, y - x).fill_null(""))
                upto = np.cumsum(n)
                for i, start, stop in zip(ids[x:y], (upto - n).tolist(), upto.tolist(), strict=True):
                    if open_ and open_[0].n >= FILE_IDS:
                        closed()
                        open_ = None
                    if open_ is None:
                        store.create_dir(base, recursive=True)
                        path = f"{base}/ids-{own.partitionId():06d}-{len(done):04d}-{uuid.uuid4().hex}.pfor"
                        sink = store.open_output_stream(path)
                        open_ = (frames.Writer(sink), sink, path)
                    open_[0].add(i, np.concatenate([flat[start:stop], end]))
        if open_:
            closed()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["part", "file", "path", "docs", "ids", "bytes"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t")).withColumn("h", F.xxhash64("t")).withColumn("n", F.monotonically_increasing_id())
    order = [F.col("i").asc_nulls_last(), "h", "n"]
    dealt = rows.repartitionByRange(widths(spark), *order).sortWithinPartitions(*order)
    files = staged(dealt.select("i", "t").mapInArrow(write, "part int, file int, path string, docs long, ids long, bytes long"), "token-file-list")
    start, out = 0, []
    for r in sorted(files.collect()):  # as many rows as files
        out.append((*r, start))
        start += r.ids
    return spark.createDataFrame(out, "part int, file int, path string, docs long, ids long, bytes long, start long")


def frames_null() -> int:
    """The id that stands for null in a file."""
    return -(1 << 63)


def read_files(files: DataFrame, folder_of: str | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, from the files alone.

    Each task reads files one after another, a few blocks at a time. The checksum is the unsigned CRC-32 of a document's ids as
    little-endian 32-bit integers.
    """
    base = folder_of or shared_dir(files.sparkSession)

    def read(batches):
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(base)
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_input_file(path) as source:
                    r = frames.Reader(source, source.size())
                    crc, sums = 0, np.zeros(len(r.lengths), np.int64)
                    for k, ends, ids in r.pieces():
                        crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        if ends:
                            sums[k], crc = crc, 0
                    begins = start + np.cumsum(r.lengths) - r.lengths
                    for at in range(0, len(sums), 1 << 16):
                        to = slice(at, at + (1 << 16))
                        own = r.doc_ids[to]
                        yield pa.record_batch({"doc_id": pa.array(own, mask=own == frames_null()), "start": begins[to], "n_tokens": pa.array(r.lengths[to]), "ids_crc32": sums[to]})

    n = max(1, files.count())
    return files.select("path", "start").repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op12_frame_packed_tokens(spark, sf_dir: str) -> DataFrame:
    """All documents as files of ids and read back; null texts hold the end id alone, an empty table gives no rows."""
    import public_tokenizers

    files = written_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_files(files)
