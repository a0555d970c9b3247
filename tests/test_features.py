import datetime as dt
import random

import pytest

from spendgrid.functions.dates import add_months
from spendgrid.operators import features as feat

T = dt.datetime


def test_month_arithmetic_clamps():
    assert add_months(dt.date(2024, 3, 31), -1) == dt.date(2024, 2, 29)
    assert add_months(T(2024, 2, 29, 5), -12) == T(2023, 2, 28, 5)
    assert add_months(dt.date(2023, 12, 15), 1) == dt.date(2024, 1, 15)


def test_timeline_and_eval_period(spark):
    df = spark.createDataFrame([(T(2024, 3, 31, 10),), (T(2023, 1, 1),)], "ts timestamp_ntz")
    tl = feat.timeline_frame(df, "ts", 1, 12).first()
    assert tl.latest_txn_ts == T(2024, 3, 31, 10)
    assert tl.training_end_ts == T(2024, 2, 29, 10)
    assert tl.training_start_ts == T(2023, 2, 28, 10)

    def end(**how):
        return feat.eval_period(tl, 3, **how)[1]

    assert end(training=True) == tl.training_end_ts
    assert end(training=False, interactive=True, table_exists=False) == tl.training_end_ts
    assert end(training=False, interactive=True) == tl.latest_txn_ts
    assert end(training=False) == tl.latest_txn_ts
    assert feat.eval_period(tl, 3, training=False)[0] == T(2023, 12, 31, 10)
    with pytest.raises(RuntimeError):
        end(training=True, interactive=True)


def test_timeline_of_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 31),)], "d date")
    assert feat.timeline_frame(df, "d", 1, 12).first().training_end_ts == T(2024, 2, 29)


def test_period_is_left_open(spark):
    df = spark.createDataFrame([(T(2024, 1, d),) for d in (1, 2, 3)], "ts timestamp_ntz")
    got = feat.period_rows(df, "ts", T(2024, 1, 1), T(2024, 1, 2)).collect()
    assert [r.ts for r in got] == [T(2024, 1, 2)]


def test_cold_start(spark):
    assert feat.is_cold_start(None, "ts", T(2024, 1, 1))
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    assert feat.is_cold_start(empty, "ts", T(2024, 1, 1))
    df = spark.createDataFrame([(T(2023, 12, 1),)], "ts timestamp_ntz")
    assert not feat.is_cold_start(df, "ts", T(2024, 1, 1))
    assert feat.is_cold_start(df, "ts", T(2023, 1, 1))


@pytest.mark.parametrize("dups,ok", [(0, True), (1, True), (2, False)])
def test_duplicate_threshold(spark, dups, ok):
    ids = list(range(100)) + list(range(dups))
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    if ok:
        feat.check_duplicates(df, "id", 0.01)
    else:
        with pytest.raises(feat.DuplicatesExceeded):
            feat.check_duplicates(df, "id", 0.01)


def test_duplicates_empty_and_nulls(spark):
    empty = spark.createDataFrame([], "id long")
    assert feat.duplicate_profile(empty, "id").first()["duplicate_ratio"] == 0.0
    df = spark.createDataFrame([(1,), (None,), (None,)], "id long")
    row = feat.duplicate_profile(df, "id").first()
    assert (row.total_rows, row.unique_ids, row.null_ids) == (3, 1, 2)
    out = feat.deduplicate(df, "id", threshold=1.0)
    assert sorted((r.id is None) for r in out.collect()) == [False, True]


def test_keep_one_per_id_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 9, "c"), (2, 1, "z")],
                               "id long, ts long, v string")
    got = {r.id: (r.ts, r.v) for r in feat.keep_one_per_id(df, "id", ["ts"]).collect()}
    assert got == {1: (9, "c"), 2: (1, "z")}


def test_inference_input(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 2)), (2, T(2024, 1, 3)), (3, T(2024, 1, 3))],
                               "id long, ts timestamp_ntz")
    got = sorted((r.id, r.ts) for r in feat.inference_input(df, "id", "ts").collect())
    assert got == [(2, T(2024, 1, 3)), (3, T(2024, 1, 3))]


def test_as_of_join_brute_force(spark):
    rng = random.Random(3)
    feats = [(u, T(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 24 * 20)), rng.random())
             for u in range(6) for _ in range(rng.randint(0, 30))]
    feats = list({(u, t): (u, t, v) for u, t, v in feats}.values())
    spine = [(i, rng.randint(0, 6), T(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 24 * 25)))
             for i in range(300)]
    fdf = spark.createDataFrame(feats, "user_id long, fts timestamp_ntz, v double")
    sdf = spark.createDataFrame(spine, "event_id long, user_id long, ts timestamp_ntz")
    got = {r.event_id: (r.fts, r.v) for r in feat.as_of_join(
        sdf, fdf, keys=["user_id"], spine_ts="ts", feature_ts="fts").collect()}
    for eid, u, t in spine:
        cands = [(ft, v) for uu, ft, v in feats if uu == u and ft <= t]
        want = max(cands) if cands else (None, None)
        assert got[eid] == want, eid
