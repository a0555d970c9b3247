from __future__ import annotations

import random

import pytest

from spendgrid.llm import near_duplicates
from spendgrid.llm.common import Scratch
from spendgrid.llm.components import connected_components
from tests.llm.conftest import words


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, percent):
    """Components over all pairs of sets; (doc_id, n, component, kept)."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted((str(i), len(sets[k]), str(least[find(k)]) if sets[k] else str(i), i == least[find(k)] if sets[k] else True) for k, (i, _) in enumerate(rows))


def found(frame):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in frame.collect())


def edited(rng, text, changes):
    w = list(text)
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return w


@pytest.mark.parametrize("n,percent", [(4, 80), (5, 80)])
def test_components_equal_brute_force(spark, odd_docs, odd_rows, no_docs, n, percent):
    rng = random.Random(n)
    rows = list(odd_rows)
    at = 1000
    for group in range(6):  # near copies, close to the bound, of all sizes
        base = words(50 + group, rng.choice([12, 40, 90, 300]))
        for _ in range(25):
            rows.append((at, " ".join(edited(rng, base, rng.randrange(0, 1 + len(base) // 30)))))
            at += 1
    passage = words(99, 60)  # one passage in many otherwise different texts
    for k in range(40):
        rows.append((at, " ".join(words(at, rng.randrange(5, 60)) + passage)))
        at += 1
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, node bigint").repartition(3)
    assert found(near_duplicates.near_duplicates(docs, n, percent)) == brute(rows, n, percent)


def test_empty_table_and_stage(spark, odd_docs, no_docs):
    assert near_duplicates.near_duplicates(no_docs).collect() == []
    kept = near_duplicates.near_duplicate_stage(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    # both unrelated texts of id 12 stay
    assert ids == sorted(map(str, [1, 4, 5, 6, 7, 9, 10, 11, 12, 12, 13, None]))


def test_stage_keeps_unrelated_rows_of_one_id(spark):
    rows = [(1, " ".join(words(990, 80, 10**6))), (1, " ".join(words(991, 80, 10**6))), (2, " ".join(words(992, 80, 10**6)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, near_duplicates.near_duplicate_stage(spark, docs, "").collect())) == sorted(rows)


def test_small_blocks_find_the_same(spark, monkeypatch):
    """A chain: each text is near its neighbours only, all share values."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    base = words(7, 200)
    rows = [(k, " ".join([f"c{k}-{j}" if j < 12 * k and j >= 12 * (k - 1) else w for j, w in enumerate(base)])) for k in range(14)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(near_duplicates.near_duplicates(docs, 3, 70)) == brute(rows, 3, 70)


def test_null_and_shared_ids_are_checked_on_their_own_texts(spark):
    """Near copies whose rows have no id, or ids that other texts have too."""
    rng = random.Random(11)
    rows = []
    for k in range(12):
        base = words(600 + k, 80, 10**6)
        rows += [(None, " ".join(base)), (k, " ".join(words(700 + k, 80, 10**6))), (k, " ".join(edited(rng, base, 2)))]
    base = words(800, 80, 10**6)
    rows += [(None, " ".join(base)), (None, " ".join(edited(rng, base, 1))), (50, " ".join(edited(rng, base, 1)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(near_duplicates.near_duplicates(docs, 4, 80)) == brute(rows, 4, 80)


def test_stage_keeps_rows_without_id(spark):
    """Rows with a null id go only as near copies; what stays under an id that
    is there twice is no copy of another document."""
    rng = random.Random(12)
    base = words(900, 80, 10**6)
    own = [" ".join(words(910 + k, 80, 10**6)) for k in range(6)]
    rows = [(None, t) for t in own] + [(None, own[0]), (None, " ".join(edited(rng, own[1].split(), 1))), (None, None), (None, "")]
    rows += [(1, " ".join(base)), (1, " ".join(base)), (None, " ".join(edited(rng, base, 1)))]
    for k in range(2, 8):
        rows += [(k, " ".join(edited(rng, base, 1))), (k, " ".join(words(930 + k, 80, 10**6)))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, text_hash bigint").repartition(3)
    out = near_duplicates.near_duplicate_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect())
    near = {t for i, t in rows if i is None and shingles(t, 5) & shingles(own[1], 5)}
    assert sum(t in near for _, t in got) == 1
    assert [x for x in got if x[1] not in near] == sorted(
        [("None", t) for t in own if t not in near] + [("None", "None"), ("None", ""), ("1", " ".join(base))]
        + [(str(k), " ".join(words(930 + k, 80, 10**6))) for k in range(2, 8)])


def test_connected_components(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(100, 160)] + [(5, 900), (5, 901), (901, 7), (3, 3), (None, 4)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(frame, Scratch(spark, "components")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in root if find(x) != x}
