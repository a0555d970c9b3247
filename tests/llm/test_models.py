from __future__ import annotations

import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from spendgrid.llm import decontaminate, katz_model, secret_scan
from tests.llm.conftest import words


# --- language model -----------------------------------------------------------

def brute_katz(rows):
    texts = [((t or "").encode().lower().split() + ["</s>"], i is None or crc32(str(i).encode()) % 7 != 2) for i, t in rows]
    uni, pairs = Counter(), Counter()
    for tokens, training in texts:
        if training:
            uni.update(tokens)
            pairs.update(zip(["<s>", *tokens], tokens))
    n = sum(uni.values())
    of = lambda counts: katz_model.good_turing(np.array([0, *(Counter(counts.values()).get(r, 0) for r in range(1, katz_model.K + 2))]))
    d1, d2 = of(uni), of(pairs)
    kept = lambda d, c: (d[c] if c <= katz_model.K else 1) * c
    share = {w: kept(d1, c) / (n + 1) for w, c in uni.items()}
    unknown = 1 - sum(share.values())
    total, held, seen = Counter(), Counter(), Counter()
    for (v, w), c in pairs.items():
        total[v] += c
        held[v] += kept(d2, c)
        seen[v] += share[w]
    below = {v: total[v] + (held[v] >= total[v]) for v in total}
    back = {v: (1 - held[v] / below[v]) / (1 - seen[v]) for v in total}

    def p(v, w):
        c = pairs.get((v, w), 0)
        return kept(d2, c) / below[v] if c else back.get(v, 1.0) * share.get(w, unknown)

    for v in list(total)[:20]:  # distributions sum to one
        assert math.isclose(sum(p(v, w) for w in uni) + back[v] * unknown, 1, rel_tol=1e-9)
    out = []
    for (tokens, training), (i, _) in zip(texts, rows):
        base = sum(math.log10((uni.get(w, 0) + 1) / (n + len(uni) + 1)) for w in tokens)
        out.append((str(i), not training, len(tokens), sum(w in uni for w in tokens), n, base, sum(math.log10(p(v, w)) for v, w in zip(["<s>", *tokens], tokens))))
    return sorted(out)


def same(got, expected):
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g[:5] == e[:5]
        assert g[5:] == pytest.approx(e[5:], rel=1e-9)


def katz_rows(docs):
    return sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                  for r in katz_model.katz_scores(docs).collect())


def test_scores_equal_brute_force(spark, odd_docs, odd_rows, no_docs, monkeypatch):
    rows = odd_rows + [(200 + k, " ".join(words(k, 80, 60))) for k in range(40)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, batch bigint").repartition(4)
    same(katz_rows(docs), brute_katz(rows))
    assert katz_model.katz_scores(no_docs).collect() == []


def test_spread_contexts_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(katz_model, "CONTEXT_ENTRIES", 20)
    monkeypatch.setattr(katz_model, "BUCKET_ENTRIES", 50)
    rows = [(k, " ".join(words(k, 60, 12))) for k in range(30)]
    same(katz_rows(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)), brute_katz(rows))


def test_no_training_documents(spark):
    held = [k for k in range(60) if crc32(str(k).encode()) % 7 == 2]
    rows = [(k, "a b c") for k in held]
    same(katz_rows(spark.createDataFrame(rows, "doc_id bigint, text string")), brute_katz(rows))


def test_good_turing_factors():
    n = np.array([0, 1000, 400, 220, 140, 95, 70])
    d = katz_model.good_turing(n)
    tail = 6 * 70 / 1000
    assert d[1] == pytest.approx((2 * 400 / 1000 - tail) / (1 - tail))
    assert katz_model.good_turing(np.array([0, 5, 0, 0, 0, 0, 0]))[1] == 0.5
    for x in (np.arange(5, dtype=np.uint64) << np.uint64(50), np.zeros(0, np.uint32), np.array([1.5, -2.0])):
        assert np.array_equal(katz_model.unpack(katz_model.pack(x)), x)


# --- decontamination -------------------------------------------------------------

def local_score(a, b):
    h, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment():
    rng = random.Random(5)
    a = [np.array([rng.randrange(1, 5) for _ in range(rng.randrange(1, 20))], np.uint64) for _ in range(200)]
    b = [np.array([rng.randrange(1, 5) for _ in range(rng.randrange(1, 30))], np.uint64) for _ in range(200)]
    assert decontaminate.align(a, b)[0].tolist() == [local_score(x, y) for x, y in zip(a, b)]


@pytest.mark.parametrize("block_words", [500_000, 90])
def test_contaminated(spark, odd_docs, no_docs, block_words):
    rng = random.Random(6)
    items = [(k, " ".join(words(3000 + k, 30, 10**6))) for k in range(6)] + [(6, None), (7, ""), (8, "two words"), (9, "w1 w2 w3"), (None, " ".join(words(9999, 20, 10**6)))]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, k bigint")
    rows, expected = [], set()
    for k in range(60):
        text = words(k, 200, 10**6)
        if k % 3 == 0:
            item = items[k % 6][1].split()
            for _ in range(k % 5):  # up to four words changed
                item[rng.randrange(30)] = "other"
            text[100:100] = item
            expected.add((k, k % 6))
        if k % 10 == 1:
            text[50:50] = items[-1][1].split()
            expected.add((k, None))
        if k % 20 == 2:
            text[20:20] = ["two", "words"]
            expected.add((k, 8))
        if k == 4:  # a third of an item is no copy
            text[100:100] = items[1][1].split()[:10]
        rows.append((k, " ".join(text).upper() if k % 2 else " ".join(text), 5))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score bigint").repartition(3)
    got = decontaminate.contaminated(docs, benchmark, block_words).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected and len(got) == len(expected)
    if block_words == 90:
        assert decontaminate.contaminated(no_docs, benchmark).collect() == []
        assert decontaminate.contaminated(odd_docs, benchmark.limit(0)).collect() == []
        assert decontaminate.contaminated(odd_docs, benchmark).collect() == []


def test_edited_copies_of_items(spark):
    """Single edited copies, 20 to 30 per cent of the words changed, without and
    with an exact copy in the corpus."""
    rng = random.Random(16)
    items = [(k, " ".join(words(4000 + k, 30, 10**6))) for k in range(40)]
    rows, expected = [], set()
    for k, text in items:
        item = text.split()
        for at in rng.sample(range(30), rng.choice([6, 7, 8, 9])):
            item[at] = f"other{at}"
        whole = " ".join(item)
        if any(" ".join(item[x:x + 3]) in text for x in range(28) if not any(w.startswith("other") for w in item[x:x + 3])):
            expected.add((k, k))
        rows.append((k, " ".join(words(k, 50, 10**6)) + " " + whole + " " + " ".join(words(200 + k, 50, 10**6))))
        if k % 2:
            rows.append((100 + k, text))
            expected.add((100 + k, k))
    assert len(expected) >= 55
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected
    text = dict(rows)
    for r in got:
        item = items[r["item_id"]][1].split()
        assert r["score"] == local_score(item, text[r["doc_id"]].split()) / 60


def test_rare_seeds():
    items = decontaminate.Items(["a b c d e f g", "x y z", "one", "p q r s"])
    known = items.windows()
    assert len(known) == 5 + 1 + 2

    def places(of):
        """Seeds of each item for the counts of its windows, by place."""
        items = decontaminate.Items(["a b c d e f g", "x y z", "one", "p q r s"])
        grams, item, place = items.seeds[3]
        counts = np.zeros(len(known), dtype=np.int64)
        for g, i, p in zip(grams, item, place):
            counts[np.searchsorted(known, g)] = of[i][p]
        items.keep_rare(counts)
        return {(int(i), int(p)) for _, i, p in zip(*items.seeds.get(3, ([], [], [])))}, items

    # the middle window is common and both neighbours occur; one alone stays whatever it is
    assert places({0: [1, 2, 900, 2, 1], 1: [10**6], 3: [5, 5]})[0] == {(0, 0), (0, 1), (0, 3), (0, 4), (1, 0), (3, 0), (3, 1)}
    # neighbours that occur nowhere ask for nothing; copies raise all counts alike
    assert places({0: [0, 0, 900, 0, 0], 1: [0], 3: [5000, 4000]})[0] == {(0, 2), (3, 0), (3, 1)}
    rng = random.Random(9)
    for _ in range(200):
        of = {0: [rng.choice([0, 1, 3, 50, 4000]) for _ in range(5)], 1: [0], 3: [0, 0]}
        kept, _ = places(of)
        for p in range(4):  # no stretch of four words that occurs is without a seed
            assert not (of[0][p] and of[0][p + 1]) or {(0, p), (0, p + 1)} & kept
    none, items = places({0: [0] * 5, 1: [0], 3: [0, 0]})
    assert not none and list(items.seeds) == [1]


def test_common_windows_do_not_hide_copies(spark):
    """Half of all documents hold a phrase of every item; copies are found by the rest."""
    phrase = "as it was said before"
    items = [(k, f"{' '.join(words(7000 + k, 12, 10**6))} {phrase} {' '.join(words(7100 + k, 12, 10**6))}") for k in range(10)]
    rows = [(k, " ".join(words(k, 60, 10**6)) + " " + phrase + " " + " ".join(words(300 + k, 60, 10**6))) for k in range(300)]
    for k, text in items:
        item = text.split()
        for at in range(2, 29, 5):
            item[at] = f"other{at}"
        rows += [(1000 + k, "before " + text + " after"), (2000 + k, "before " + " ".join(item) + " after")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(n + k, k) for k in range(10) for n in (1000, 2000)}


# --- secrets -----------------------------------------------------------------------

def test_base_spans():
    text = 'password=token= abcdefghijk SECRET: "abcd1234" api_key=AKIAABCDEFGHIJKL0 ſecret=abcdefgh1 0123456789abcdef0123456789abcdef01'
    assert [(k, text[a:b]) for a, b, k in secret_scan.base_spans(text)] == [
        ("assign", 'SECRET: "abcd1234'), ("assign", "api_key=AKIAABCDEFGHIJKL0"), ("access", "AKIAABCDEFGHIJKL0"),
        ("hex", "0123456789abcdef0123456789abcdef01")]


def test_viterbi_equals_exhaustive_search():
    rng = np.random.default_rng(3)
    texts = ["a b c d e", "key = 0a9F x", "", "one", "x\ny z"]
    tokens = secret_scan.tokenize(pa.array(texts))
    for _ in range(20):
        field = secret_scan.Field(rng.normal(size=(len(secret_scan.NEIGHBOURS), secret_scan.N_SHAPES, 3)).astype(np.float32) * 0.5,
                                  rng.normal(size=(secret_scan.N_FILE, 3)).astype(np.float32), rng.normal(size=(3, 3)))
        score, tags = field.scores(tokens), field.decode(tokens)
        for a, b in zip(tokens.piece[:-1], tokens.piece[1:]):
            paths = np.array(np.meshgrid(*[range(3)] * (b - a))).reshape(b - a, -1).T
            value = sum(score[a + t, paths[:, t]] for t in range(b - a)) + sum(field.move[paths[:, t], paths[:, t + 1]] for t in range(b - a - 1))
            assert tags[a:b].tolist() == paths[np.argmax(value)].tolist()


def secret_texts(seed, n):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        w = [f"{rng.choice('abcdefg')}{rng.choice(['and', 'the', 'word', 'run'])}" for _ in range(40)]
        if k % 4 == 0:
            w[rng.randrange(40)] = f"password={hashlib.md5(str(rng.random()).encode()).hexdigest()[:18]}"
        if k % 4 == 1:
            w[rng.randrange(40)] = f"{rng.randrange(3000)}"
        out.append(" ".join(w))
    return out


def test_field_on_held_out_texts(spark):
    field = secret_scan.fit(secret_texts(1, 300))
    held = secret_texts(2, 200)
    tokens = secret_scan.tokenize(pa.array(held))
    truth, found = secret_scan.labels(tokens, held) > 0, field.decode(tokens) > 0
    assert (truth & found).sum() / truth.sum() > 0.9 and (truth & found).sum() / found.sum() > 0.9
    assert secret_scan.fit(["no secret here", None, ""]) is None


def other_secrets(seed):
    """(text around it, value) of kinds that no base pattern has, most of them unlike the weak labels too."""
    rng = random.Random(seed)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    draw = lambda n, of=letters: "".join(rng.choices(of, k=n))
    digits = letters[-10:]
    return [("{}", "sk_live_" + draw(24)), ("{}", "ghp_" + draw(36)), ("use {} here", f"xoxb-{draw(11, digits)}-{draw(12, digits)}-{draw(24)}"),
            ("{}", "AIza" + draw(35)), ("{}", f"eyJ{draw(33)}.eyJ{draw(60)}.{draw(43)}"), ("Authorization: Bearer {}", draw(30)),
            ("the pwd of it, {}", draw(20)), ("AccountKey='{}'", draw(64, letters + "+/"))]


def test_field_finds_secrets_outside_the_patterns():
    """Fitted where the corpus has one kind alone."""
    field = secret_scan.fit(secret_texts(1, 300))
    clean = [t for t in secret_texts(4, 400) if not secret_scan.base_spans(t)]
    hit = asked = 0
    for k, text in enumerate(clean[:60]):
        for form, value in other_secrets(k):
            whole = text[:90] + " " + form.format(value) + text[90:]
            assert not secret_scan.base_spans(whole)
            begin = whole.index(value)
            spans = secret_scan.scan_batch(pa.array([whole]), field)[0]
            asked += 1
            hit += any(a <= begin + len(value) // 2 < b for a, b, kind in spans if kind == "crf")
    assert hit / asked > 0.9
    innocent = clean + [t + " see /usr/share/doc/readme.txt, version 2.31.4 of 2024-05-17, mail ann.lee12@mail7.example.org or call 555-0134-2288" for t in clean]
    false = sum(len(spans) for spans in secret_scan.scan_batch(pa.array(innocent), field))
    assert false <= len(innocent) // 50


def test_sample_of_long_texts_is_bounded(spark):
    secret = "password=0a1b2c3d4e5f6a7b8c"
    rows = [(k, "word and run " * 500 + secret + " at the end of it" * 300) for k in range(5)] + [(9, "x " * 4000), (10, "short"), (11, None), (12, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    texts = secret_scan.sample_texts(docs, 60, excerpt=400)
    assert max(map(len, texts)) == 400 and sum(secret in t for t in texts) >= 2 and "short" in texts
    field = secret_scan.fit(texts)
    assert field is not None
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs, field).collect()}  # whole texts are scanned
    assert all(any(s["kind"] == "assign" and s["start"] == 6500 for s in got[k]) for k in range(5))


def test_scan_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    rows = odd_rows + [(500 + k, t) for k, t in enumerate(secret_texts(3, 40))]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id bigint, text string, spans string").repartition(3)
    got = secret_scan.digest(secret_scan.secret_scan(docs)).collect()
    expected = []
    for i, t in rows:
        spans = secret_scan.base_spans(t or "")
        expected.append((str(i), *(sum(k == kind for *_, k in spans) for kind in ("assign", "access", "hex")),
                         hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == sorted(expected)
    assert secret_scan.secret_scan(no_docs).collect() == []


def test_sample_holds_rare_matches_and_is_bounded(spark):
    """One text in a thousand has a base match; most rows have no id."""
    secrets = [t for t in secret_texts(5, 24) if secret_scan.base_spans(t)]
    rows = [(None if k % 3 else k, f"plain text number {k} without any") for k in range(4000)] + [(None, "the same row")] * 500
    rows += [(10_000 + k, t) for k, t in enumerate(secrets)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    texts = secret_scan.sample_texts(docs, 180)
    assert set(secrets) <= set(texts) and len(texts) == 180 and len(set(texts)) == 180
    assert texts == secret_scan.sample_texts(docs.repartition(2), 180)
    assert len([t for t in secret_scan.sample_texts(docs, 60) if t in secrets]) >= 2
    assert secret_scan.fit(texts) is not None


def test_stage_drops_rows_and_not_ids(spark, tmp_path):
    item = " ".join(words(5001, 40, 10**6))
    clean = [(None, " ".join(words(6000 + k, 60, 10**6))) for k in range(20)] + [(5, " ".join(words(6100, 60, 10**6))), (None, None)]
    leaked = [(None, "before it " + item + " after it"), (5, item)]
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in clean + leaked], "doc_id bigint, text string, _id int, text_hash int").repartition(3)
    out = decontaminate.decontaminate_stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, spark.createDataFrame(clean, "doc_id bigint, text string").collect()))
