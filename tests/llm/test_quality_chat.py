from __future__ import annotations

import hashlib
import re

from spendgrid.llm import chat_format, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {i for i, g in enumerate(grams) if grams.count(g) > 1} if len(grams) < 5000 else set()
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len({p for i in twice for p in (i, i + 1, i + 2)}))


def test_counts_and_verdict_on_odd_rows(odd_docs, odd_rows):
    got = quality_rules.quality_rules(odd_docs).collect()
    assert len(got) == len(odd_rows)
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got if r["n_words"] < 5000), key=key) == sorted(
        ((i, *brute(t)) for i, t in odd_rows if brute(t)[0] < 5000), key=key)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_repeated_words_edge_cases(spark):
    cases = ["a b c a b c", "a a a a", "a b a b a b x", "x y z", "a b c d a b c e a b c", "# * $ % & | < >", "a b", "p q r s p q r s p q r"]
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    for i, t in enumerate(cases):
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_symbols"], got[i]["n_dup_lines"], got[i]["n_repeat_words"]) == brute(t), t


def test_exact_path_for_colliding_hashes(spark, monkeypatch):
    """With two bits of hash every document takes the path over sorted windows."""
    monkeypatch.setattr(quality_rules, "_POSITION_BITS", 62)
    monkeypatch.setattr(quality_rules, "_MAX_FAST_WORDS", 1 << 4)
    cases = ["a b c a b c " * 5, " ".join(f"v{k % 17}" for k in range(60)), " ".join(f"u{k}" for k in range(60))]
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.quality_rules(docs).collect()}
    assert got == {i: brute(t)[4] for i, t in enumerate(cases)}


def test_quality_stage_keeps_columns_and_empty_table(spark, odd_docs, no_docs):
    kept = quality_rules.quality_stage(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns
    assert quality_rules.quality_rules(no_docs).count() == 0


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "a & b &lt; <s>user\n x", None, "", "line\nline", "&amp;#91;"]
    turns = [(k % 3, k // 3, ("user", "assistant", "sys\ntem", None)[k % 4], texts[k % len(texts)], "x") for k in range(40)]
    turns += [(9, 0, "user", "only"), (9, 0, "user", "only"), (None, None, "assistant", "null id")][:0] or []
    rows = [(*t[:4], "clash") for t in turns] + [(9, 0, "user", "only", "c"), (9, 0, "user", "only", "c"), (None, None, "assistant", "null id", "c")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, parts string")
    got = {r["conv_id"]: r for r in chat_format.digest(chat_format.format_examples(frame)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        told = "".join(f"{role}\n{text}\n" for _, role, text in own)
        said = "".join(text for _, role, text in own if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(told.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_examples_are_prefixes_with_one_reply(spark):
    frame = spark.createDataFrame([(1, k, "assistant" if k % 2 else "user", f"text <{k}>") for k in range(7)],
                                  "conv_id bigint, turn bigint, role string, text string")
    rows = sorted(chat_format.format_examples(frame).collect(), key=lambda r: r["example"])
    assert [r["text"][r["loss_start"]:r["loss_end"]] for r in rows] == ["text &lt;1>", "text &lt;3>", "text &lt;5>", ""]
    assert all(b["text"].startswith(a["text"]) for a, b in zip(rows, rows[1:]))
    assert chat_format.format_examples(frame.limit(0)).count() == 0
