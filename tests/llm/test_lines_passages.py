from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from spendgrid.llm import line_dedup, lists, passage_dedup
from spendgrid.llm.common import Scratch
from tests.llm.conftest import words


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edit(rng, text, n, alphabet="abcdefgh é"):
    t = list(text)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(t) + 1)
        if kind == 0 and at < len(t):
            t[at] = rng.choice(alphabet)
        elif kind == 1 and at < len(t):
            del t[at]
        else:
            t.insert(at, rng.choice(alphabet))
    return "".join(t)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(edits):
    rng = random.Random(edits)
    left = ["".join(rng.choice("abcé") for _ in range(rng.randrange(30))) for _ in range(2000)]
    right = [edit(rng, t, rng.randrange(5), "abcé") for t in left]
    assert line_dedup.within_edits(left, right, edits).tolist() == [edit_distance(a, b) <= edits for a, b in zip(left, right)]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines_within_reach_share_a_key(edits):
    rng = random.Random(edits)
    for _ in range(400):
        a = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(12, 40)))
        b = edit(rng, a, edits)
        if min(len(a), len(b)) >= 12:
            keys, of = line_dedup.segment_keys([a, b], edits, 12)
            assert set(keys[of == 0].tolist()) & set(keys[of == 1].tolist())


def test_groups_over_batches():
    rng = random.Random(1)
    rows = sorted(rng.randrange(20) for _ in range(300))
    batches = [pa.record_batch({"k": rows[i:i + 7]}) for i in range(0, 300, 7)] + [pa.record_batch({"k": pa.array([], pa.int64())})]
    seen = []
    for table, cuts in lists.whole_groups(iter(batches), ["k"]):
        groups = [table.column("k").to_pylist()[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        assert all(len(set(g)) == 1 for g in groups)
        seen += [(g[0], len(g)) for g in groups]
        pairs = {(x, y) for xs, ys in lists.pairs_within(cuts, most=5) for x, y in zip(xs.tolist(), ys.tolist())}
        assert pairs == {(x, y) for a, b in zip(cuts[:-1], cuts[1:]) for x in range(a, b) for y in range(x + 1, b)}
    assert seen == [(k, rows.count(k)) for k in sorted(set(rows))]


def line_rows(odd_rows):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (20, 25, 33, 60, 120)]
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 12]
    for k in range(60):
        rows.append((100 + k, "\n".join(edit(rng, rng.choice(base), rng.randrange(4)) for _ in range(4)) + f"\nown line of document number {k * 7919} here\nshort"))
    return rows


def test_line_classes_equal_brute_force(spark, odd_rows, no_docs):
    rows = line_rows(odd_rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, node string").repartition(3)
    at = sorted({(i, k, line) for i, t in rows for k, line in enumerate((t or "").split("\n"))})
    distinct = sorted({line for *_, line in at})
    root = {x: x for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    long = [x for x in distinct if len(x) >= 20]
    for n, a in enumerate(long):
        for b in long[:n]:
            if abs(len(a) - len(b)) <= 2 and a[:1] + b[:1] and edit_distance(a, b) <= 2 if len(a) < 400 else a == b:
                root[find(a)] = find(b)
    first = {}
    for i, k, line in at:
        first.setdefault(find(line), (i, k))
    got = line_dedup.document_lines(docs, Scratch(spark, "lines")).collect()
    assert {r["doc_id"]: [(c["doc_id"], c["line"]) for c in r["classes"]] for r in got} == {
        i: [first[find(line)] for line in (t or "").split("\n")] for i, t in rows}
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    for i, t in rows:
        lines = (t or "").split("\n")
        drop = [k for k, line in enumerate(lines) if len(line) >= 20 and first[find(line)] != (i, k)]
        if drop and 2 * sum(len(lines[k]) for k in drop) <= sum(map(len, lines)):
            assert kept[i] == "\n".join(line for k, line in enumerate(lines) if k not in drop)
        else:
            assert kept[i] == t
    assert line_dedup.dedup_lines(no_docs).collect() == []


def test_line_dedup_keeps_rows_and_columns(odd_docs, odd_rows):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns
    got = out.collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in odd_rows)
    assert sum(r["text"] is None for r in got) == sum(t is None for _, t in odd_rows)


def test_repeated_lines_go_whatever_their_share(spark, tmp_path):
    common = [" ".join(words(k, 8)) for k in range(6)]
    own = [f"{k * 7919} are the only words of this document itself, {k * 104729}" for k in range(4)]
    text = {k: "\n".join([*common, line]) for k, line in enumerate(own)}  # most of it boilerplate
    text[4] = "\n".join(["the same line ten times over in one document"] * 10)
    text[5] = text[1]  # a whole copy
    text[6] = "\n".join([common[0], own[2], own[3]])  # all of it stood before, in several places
    text[7] = None
    rows = list(text.items())
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in line_dedup.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert {i: r["dropped"] for i, r in got.items()} == {
        0: [], 1: [*range(6)], 2: [*range(6)], 3: [*range(6)], 4: [*range(1, 10)], 5: [*range(7)], 6: [0, 1, 2], 7: []}
    assert all(r["n_dropped"] == len(r["dropped"]) for r in got.values())
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup_stage(spark, docs, "").collect()}
    assert left == {0: text[0], 1: own[1], 2: own[2], 3: own[3], 4: "the same line ten times over in one document", 7: None}


def test_rows_without_id_are_asked_for_their_own_lines(spark):
    """Lines listed in many documents without an id: each text is read for its
    own ones, so the rows read are as many as those with ids of their own."""
    rng = random.Random(6)
    rows = []
    for k in range(60):
        line = " ".join(words(k, 9))
        rows += [line, edit(rng, line, 1)]
    frame = lambda ids: spark.createDataFrame([(i, t) for i, t in zip(ids, rows)], "doc_id bigint, text string").repartition(3)
    of = lambda docs: line_dedup.document_lines(docs, Scratch(spark, "lines")).agg({"n_repeated": "sum", "n_lines": "sum"}).first()
    assert tuple(of(frame([None] * 120))) == tuple(of(frame(range(120))))


def test_repeated_passages(spark, odd_docs, no_docs):
    passage, other = words(1001, 60), words(1002, 75)
    rows = [(k, " ".join(words(k, 40) + (passage if k % 2 else other) + words(500 + k, 30)) + "\nshort line") for k in range(20)]
    near = words(77, 120)
    rows += [(30 + k, " ".join(near[:50] + [f"z{k}"] + near[51:])) for k in range(4)]
    rows += [(40 + k, " ".join(words(900 + k, 200))) for k in range(10)]  # clean
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, start bigint").repartition(3)
    got = passage_dedup.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in got} == {*range(20), *range(30, 34)}
    for r in got:
        if r["doc_id"] < 20:
            size = 60 if r["doc_id"] % 2 else 75
            assert (r["start_word"], r["end_word"], r["class_id"]) == (40, 40 + size, r["doc_id"] % 2)
        else:
            assert (r["start_word"], r["end_word"], r["class_id"]) == (0, 120, 30)
        assert r["removed"] == (r["doc_id"] != r["class_id"])
    left = {r["doc_id"]: r["text"] for r in passage_dedup.remove_passages(docs).collect()}
    whole = dict(rows)
    assert left[0] == whole[0] and left[40] == whole[40] and left[30] == whole[30]
    assert left[2] == " ".join(words(2, 40) + words(502, 30)) + "\nshort line"
    assert left[31] == ""
    assert passage_dedup.repeated_passages(no_docs).collect() == []
    odd = passage_dedup.repeated_passages(odd_docs).select("doc_id", "class_id").distinct().collect()
    assert {r["doc_id"] for r in odd} == {None, 1, 2, 3} and {r["class_id"] for r in odd} == {None}


def repeated_words(rows, n):
    """For each row: which words lie in a run of n words that a row of another
    text holds, and which in one that an earlier one holds."""
    split = [(t or "").lower().split() for _, t in rows]
    of = {}
    for k, w in enumerate(split):
        for i in range(len(w) - n + 1):
            of.setdefault(tuple(w[i:i + n]), set()).add(k)
    shared, later = [], []
    for k, w in enumerate(split):
        a, b = set(), set()
        for i in range(len(w) - n + 1):
            holders = of[tuple(w[i:i + n])]
            if len({rows[h][1] for h in holders}) > 1 or len({rows[h][0] for h in holders}) > 1:
                a |= {*range(i, i + n)}
                if min(holders) < k:
                    b |= {*range(i, i + n)}
        shared.append(a)
        later.append(b)
    return shared, later


def test_passages_over_line_ends_equal_brute_force(spark):
    rng = random.Random(8)
    passages = [words(2000 + k, rng.randrange(50, 130), 300) for k in range(12)]
    rows = []
    for k in range(60):
        parts = [words(3000 + k, rng.randrange(5, 60))]
        for p in rng.sample(passages, rng.randrange(3)):
            at = rng.randrange(len(p) - 20) if rng.random() < 0.3 else 0  # some are cut, below the bound too
            parts += [p[at:], words(rng.randrange(10**6), rng.randrange(1, 30))]
        flat = [w for p in parts for w in p]
        out = "".join(w + rng.choice([" ", " ", " ", "  ", "\n", "\t"]) for w in flat)
        rows.append((k, out.upper() if k % 7 == 0 else out))
    rows += [(60 + k, rows[20 + k][1]) for k in range(5)] + [(65, None), (66, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    shared, later = repeated_words(rows, 50)
    found, removed = [set() for _ in rows], [set() for _ in rows]
    for r in passage_dedup.repeated_passages(docs).collect():
        (removed if r["removed"] else found)[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
        assert r["class_id"] < r["doc_id"] if r["removed"] else r["class_id"] == r["doc_id"]
    assert [a | b for a, b in zip(found, removed)] == shared
    assert removed == later
    left = {r["doc_id"]: r["text"] for r in passage_dedup.remove_passages(docs).collect()}
    for (i, t), gone in zip(rows, later):
        assert (left[i] or "").split() == [w for k, w in enumerate((t or "").split()) if k not in gone]
        assert gone or left[i] == t


def test_passage_in_hot_null_ids_and_long_text(spark):
    passage = words(41, 90)
    wrapped = " ".join(passage[:30]) + "\n" + " ".join(passage[30:60]) + "\n\n" + " ".join(passage[60:])
    rows = [(None, f"own{k} {wrapped} tail{k}") for k in range(40)] + [(None, f"own1 {wrapped} tail1")] * 20
    rows += [(5, " ".join(words(42, 150_000, 10**6)) + "\n" + wrapped), (6, " ".join(words(43, 300)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = passage_dedup.repeated_passages(docs).collect()
    assert len(got) == 41 and {r["doc_id"] for r in got} == {None, 5}
    assert all(r["end_word"] - r["start_word"] == 90 for r in got)
    assert sum(not r["removed"] for r in got) == 1


def test_bands_reach_the_wanted_recall():
    bands, rows = passage_dedup.tuned(0.8, 0.999, 30)
    assert bands * rows <= 30 and 1 - (1 - 0.8 ** rows) ** bands >= 0.999
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(300):
        a = rng.integers(0, 2**63, 90, dtype=np.uint64)
        b = a.copy()
        b[[40, 41]] = rng.integers(0, 2**63, 2, dtype=np.uint64)  # similarity 0.87
        keys = passage_dedup.band_keys(np.concatenate([a, b]), np.array([0, 90, 180]))
        met += bool((keys[0] == keys[1]).any())
    assert met == 300
