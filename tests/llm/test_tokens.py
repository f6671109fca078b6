"""Token files: the codec's round trip, the encoder by units, and the query against the library itself."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ringlake.llm import catalog, frames, token_files
from ringlake.llm.spaces import table

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
BYTE, WORD = public.path("byte_bpe_50k.json"), public.path("word_bpe_49k.json")


def test_round_trip_of_blocks():
    rng = np.random.default_rng(1)
    for n in (1, 511, 512, 513, 5000):
        for top in (0, 1, 300, 60000, 2**32 - 1):
            ids = rng.integers(0, top + 1, n).astype(np.uint32)
            ids[rng.random(n) < 0.03] = top
            data, size = frames.pack(ids)
            starts = np.concatenate([[0], np.cumsum(size)[:-1]])
            assert (frames.unpack(data, starts)[:n] == ids).all()


def test_exceptions_stay_outside_the_width():
    ids = np.full(512, 7, np.uint32)
    ids[::40] = 4_000_000_000
    data, _ = frames.pack(ids)
    head = np.frombuffer(data[:8], frames.HEAD)[0]
    assert (head["low"], head["width"], head["exceptions"]) == (7, 0, 13) and len(data) == 8 + 13 * 6


@pytest.mark.parametrize("sizes", [[], [0], [0, 0, 5, 0], [1, 512, 511, 0, 3000, 2], [400_000, 0, 7, 140_000]])
def test_files_stream_and_seek(sizes):
    rng = np.random.default_rng(2)
    docs = [(i * 3, rng.integers(0, 50_000, n).astype(np.uint32)) for i, n in enumerate(sizes)]
    f = io.BytesIO()
    w = frames.Writer(f)
    for i, d in docs:
        w.add(i, d)
    w.close()
    r = frames.Reader(io.BytesIO(f.getvalue()), len(f.getvalue()))
    got = [[] for _ in docs]
    ended = []
    for k, ends, ids in r.pieces():
        got[k].append(ids)
        ended += [k] * ends
    assert ended == list(range(len(docs))) and r.doc_ids.tolist() == [i for i, _ in docs] and len(r.starts) == -(-sum(sizes) // frames.BLOCK)
    assert all(np.concatenate(g).tolist() == d.tolist() for g, (_, d) in zip(got, docs))
    assert all(r.document(k).tolist() == d.tolist() for k, (_, d) in enumerate(docs))
    broken = bytearray(f.getvalue())
    broken[-frames.TRAILER.size - 1 if docs else 0] ^= 1
    with pytest.raises(ValueError):
        frames.Reader(io.BytesIO(bytes(broken)), len(broken))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_library(path):
    rng = random.Random(3)
    bits = ["a", "Z", "é", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", "!", "?<", "|endoftext|>", "<|endoftext|>", "中", " ", "\x1c", "\x85", "😀", "the", " the"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [" ".join(rng.choice(["word", "word,", "x.\ny", "a\n\nb", "é!", "d's", "1.5", "\x01"]) for _ in range(rng.randint(1, 9))) for _ in range(2000)]
    e = token_files.Encoder(open(path, encoding="utf-8").read())
    t = tokenizers.Tokenizer.from_file(path)
    assert e.by_piece == (path == BYTE)
    texts += ["", " ", "plain words only", "a.b,c;d:e!f?g\nh\n\ni\n j", "x's. y'll, z's"]
    for part in (texts[:1500], texts[1500:], texts, texts[-3:], []):
        flat, n = e.encode(pa.array(part, pa.string()))
        want = [x.ids for x in t.encode_batch(part, add_special_tokens=False)]
        assert n.tolist() == list(map(len, want)) and flat.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("kept", [0, 5])
def test_encoder_with_a_full_memory(monkeypatch, kept):
    monkeypatch.setattr(token_files, "KEPT", kept)
    t = tokenizers.Tokenizer.from_file(BYTE)
    e = token_files.Encoder(open(BYTE, encoding="utf-8").read())
    texts = ["the cat, the dog.", "the  cat " + "x" * 100, "cat, dog. the"] * 3
    for _ in range(2):
        assert e.encode(pa.array(texts))[0].tolist() == [i for x in t.encode_batch(texts, add_special_tokens=False) for i in x.ids]


def test_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "TOGETHER", 500)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["lorem", "ipsum", "dolor,", "Ünï", "42", "\n\nx", ""]) for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", " ", "long " * 60_000, "<|endoftext|> a"]
    ids = rng.sample(range(10_000), len(texts))
    rows = [(i, t, "en", "s", 0, "clash", 1) for i, t in zip(ids, texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, i string, n long").repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    t, start, want = tokenizers.Tokenizer.from_file(BYTE), 0, set()
    for i, x in sorted(zip(ids, texts)):
        own = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        want.add((i, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    got = catalog.queries()["op12_frame_packed_tokens"](spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got} == want


def test_null_and_repeated_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "b c"), (3, "a"), (3, "a"), (3, None), (None, None)] + [(9, "same")] * 300, "doc_id long, text string")
    files = token_files.written_files(docs, BYTE, end_id=2)
    got = token_files.read_files(files).orderBy("start").collect()
    assert [r.doc_id for r in got] == [3] * 3 + [9] * 300 + [None] * 2 and sum(r.n_tokens for r in got) == files.selectExpr("sum(ids)").first()[0]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    assert token_files.read_files(token_files.written_files(docs.limit(0), BYTE, end_id=None)).collect() == []


def test_files_hold_what_was_written(spark, tmp_path):
    from pyarrow import fs

    docs = table(spark, "/root/testdata/sf0.001", "documents") if __import__("os").path.isdir("/root/testdata/sf0.001") else spark.createDataFrame([(i, f"w{i} " * i) for i in range(50)], "doc_id long, text string")
    files = token_files.written_files(docs, BYTE, end_id=None, folder=str(tmp_path / "own")).collect()
    t = tokenizers.Tokenizer.from_file(BYTE)
    text = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    seen = 0
    for f in files:
        with fs.LocalFileSystem().open_input_file(f.path) as source:
            r = frames.Reader(source, source.size())
            assert source.size() == f.bytes and int(r.lengths.sum()) == f.ids and source.size() < 4 * f.ids + 16 * f.docs + 4096
            for k, i in list(enumerate(r.doc_ids.tolist()))[::7]:
                assert t.decode(r.document(k).tolist()) == text[i]
            seen += len(r.doc_ids)
    assert seen == len(text)
