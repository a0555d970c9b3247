from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from spendgrid.llm import sentencepiece_bpe, wavelet_files
from spendgrid.llm.common import Scratch


def odd_texts(seed, n):
    rng = random.Random(seed)
    alphabet = " " * 6 + "abcdeéthingsnor\n\t😀漢字。,.1289ÄßΩΣİ▁　\x00\x85'<|>" + "stre"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_encoder_equals_library():
    own = sentencepiece_bpe.encoder(sentencepiece_bpe.default_model())
    texts = odd_texts(1, 3000) + [" " * n + tail for n in range(60) for tail in ("", "a", "Ω", "　")] + ["a" * 5000, "abc" * 3000]
    assert [own.encode(t) for t in texts] == own.library.encode(texts)


def test_encode_documents(odd_docs, odd_rows, no_docs):
    lib = sentencepiece_bpe.encoder(sentencepiece_bpe.default_model()).library
    got = sentencepiece_bpe.digest(sentencepiece_bpe.encode_documents(odd_docs, sentencepiece_bpe.default_model())).collect()
    expected = []
    for i, t in odd_rows:
        ids = lib.encode(t or "")
        expected.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted(expected)
    assert sentencepiece_bpe.encode_documents(no_docs, sentencepiece_bpe.default_model()).count() == 0


def test_part_encoder_equals_tokenizer():
    own = wavelet_files.part_encoder(wavelet_files.default_tokenizer())
    texts = odd_texts(2, 3000) + ["it's you're 'S A'LL", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>", "", "  "]
    flat, upto = own.encode([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert flat[upto[k]:upto[k + 1]].tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids, t
    small = wavelet_files.PartEncoder(wavelet_files.default_tokenizer(), cache=50)
    again, _ = small.encode([t.encode() for t in texts])
    assert np.array_equal(again, flat)


@pytest.mark.parametrize("n,top", [(0, 9), (1, 1), (7, 2), (200_000, 49_000), (70_000, 3)])
def test_wavelet_queries(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    file = wavelet_files.WaveletFile(wavelet_files.pack(ids, np.zeros(1, np.int64), pa.array([1])))
    assert np.array_equal(file.tokens(), ids)
    for i in range(0, n, max(1, n // 40)):
        assert file.access(i) == ids[i]
    for token in {0, 1, top - 1, top, *(int(x) for x in ids[:3])}:
        at = np.flatnonzero(ids == token)
        assert file.count(token) == len(at)
        assert file.count(token, n // 3, n // 2) == ((at >= n // 3) & (at < n // 2)).sum()
        for k in range(0, len(at), max(1, len(at) // 5)):
            assert file.occurrence(token, k) == at[k]
    with pytest.raises(IndexError):
        file.access(n)


def test_files_of_odd_documents(spark, odd_docs, odd_rows, no_docs, tmp_path):
    tokenizer = wavelet_files.part_encoder(wavelet_files.default_tokenizer()).tokenizer

    def read(docs, name):
        shards = wavelet_files.write_shards(docs, wavelet_files.default_tokenizer(), str(tmp_path / name), shard_tokens=500)
        return wavelet_files.read_documents(Scratch(spark, "manifest").write(shards, "manifest")).collect()

    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    expected, start = [], 0
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in read(odd_docs, "odd")), key=lambda r: r[1])
    assert got == expected
    assert read(no_docs, "none") == []


@pytest.mark.parametrize("place", [0, 1, 2])
def test_documents_above_the_shard_size(spark, tmp_path, place):
    texts = ["ab " * 300, "cd " * 300]
    texts.insert(place, "long " * 4000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    shards = Scratch(spark, "manifest").write(wavelet_files.write_shards(
        docs, wavelet_files.default_tokenizer(), str(tmp_path / "long"), shard_tokens=500), "manifest")
    got = sorted(wavelet_files.read_documents(shards).collect(), key=lambda r: r["start"])
    tokenizer = wavelet_files.part_encoder(wavelet_files.default_tokenizer()).tokenizer
    sizes = [len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
    assert [(r["doc_id"], r["n_tokens"]) for r in got] == list(enumerate(sizes))
    assert shards.agg({"docs": "sum"}).first()[0] == 3


def test_a_file_of_a_lost_attempt_is_replaced(tmp_path):
    for data in (b"one", b"other"):
        path = wavelet_files._save(str(tmp_path), "part.wvm", data)
    assert open(path, "rb").read() == b"other" and len(list(tmp_path.iterdir())) == 1
