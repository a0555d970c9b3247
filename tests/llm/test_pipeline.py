from __future__ import annotations

import hashlib
import random

import __spark_entry__
import corpus_pipeline
from spendgrid.llm import sentencepiece_bpe
from tests.llm.conftest import words


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(w if k % 4 else rng.choice(["the", "of", "and", "to"]) for k, w in enumerate(words(seed, n, 10**6)))


def test_pipeline(spark, tmp_path):
    item = prose(7000, 30)
    license_line = "this line of the licence stands in very many of the documents"
    rows, expected = [], {}
    for k in range(30):
        text = prose(k, 120) + "\n" + prose(100 + k, 80)
        if k % 5 == 1:  # a line that others have too, changed by a letter
            rows.append((k, license_line[:k] + "x" + license_line[k + 1:] + "\n" + text))
            expected[k] = rows[-1][1] if k == 1 else text
        else:
            rows.append((k, text))
            expected[k] = text
    w = expected[3].split(" ")
    rows.append((40, " ".join(w[:20] + ["changed"] + w[21:150] + ["changed"] + w[151:])))  # a near copy of 3
    rows.append((41, "### " * 200))  # rejected
    rows.append((42, None))
    rows.append((43, "short"))
    text = prose(44, 150)
    rows.append((44, text[:300] + " " + item + " " + text[300:]))  # contaminated
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "near duplicates", "benchmark decontamination", "sentencepiece encoding"]
    got = {r["doc_id"]: r for r in __spark_entry__.queries()["pipeline"](spark, str(tmp_path)).collect()}
    lib = sentencepiece_bpe.encoder(sentencepiece_bpe.default_model()).library
    assert set(got) == set(expected)
    for i, text in expected.items():
        ids = lib.encode(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_stages_on_odd_and_empty_documents(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(0, "an item of the test")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_docs, str(tmp_path)).columns == odd_docs.columns, name
        assert stage(spark, no_docs, str(tmp_path)).collect() == [], name
