"""A month's rows from states equal the grid's."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spendgrid.functions.dates import add_months
from spendgrid.operators import state as st
from spendgrid.operators.snapshot import snapshot

COLUMNS = ["sale_month", "elc_master_id", "consumer_id", "brand_id", "sales_amount", "txn_cnt", "item_cnt",
           "makeup_amount", "skincare_amount", "fragrance_amount", "haircare_amount", "other_amount"]
SCHEMA = ("sale_month date, elc_master_id string, consumer_id long, brand_id long, sales_amount double, txn_cnt long, item_cnt long, "
          "makeup_amount double, skincare_amount double, fragrance_amount double, haircare_amount double, other_amount double")


def facts(spark, seed, months=40, keys=25):
    rng = random.Random(seed)
    rows = []
    for k in range(keys):
        for m in range(months):
            if rng.random() < 0.25:
                money = lambda: rng.choice([0.0, 0.0, -3.25, round(rng.uniform(0, 50), 2)])
                rows.append((add_months(dt.date(2020, 1, 1), m), f"E{k}", k, k % 3, money(), rng.randrange(1, 4), rng.randrange(0, 5),
                             *[rng.choice([money(), None]) for _ in range(5)]))
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("calendar_start", ["2020-01-01", "2021-03-01"])
def test_month_equals_grid(spark, calendar_start):
    monthly = facts(spark, 1)
    grid = snapshot(monthly, calendar_start=calendar_start, calendar_end="2023-02-01")
    for month in ("2021-03-01", "2022-06-01", "2023-01-01", "2023-02-01"):
        one = st.snapshot_month(monthly, month, calendar_start=calendar_start, calendar_end="2023-02-01")
        assert one.columns == grid.columns and [f.dataType for f in one.schema] == [f.dataType for f in grid.schema]
        assert rows_of(one) == rows_of(grid.where(F.col("snapshot_dt") == F.lit(month).cast("date")))
    assert st.snapshot_month(monthly, "2024-01-01", calendar_start=calendar_start, calendar_end="2023-02-01").count() == 0


def test_folding_equals_grid(spark):
    monthly = facts(spark, 2)
    end = "2023-02-01"
    grid = snapshot(monthly, calendar_start="2020-01-01", calendar_end=end)
    month = dt.date(2021, 10, 1)
    state = st.month_state(monthly, month, calendar_start="2020-01-01")
    from spendgrid.sources.store import written_once
    while month < dt.date(2022, 9, 1):
        month = add_months(month, 1)
        state = written_once(st.fold_month(state, monthly, month), "state")
        if month in (dt.date(2021, 12, 1), dt.date(2022, 9, 1)):
            assert rows_of(state.select(sorted(state.columns))) == rows_of(
                st.month_state(monthly, month, calendar_start="2020-01-01").select(sorted(state.columns)))
            rows = st.snapshot_rows(state.join(st.next_sums(monthly, month, calendar_end=end), ["elc_master_id", "consumer_id", "brand_id"], "left"), month)
            assert rows_of(rows) == rows_of(grid.where(F.col("snapshot_dt") == F.lit(month)))


def test_no_grid_and_one_exchange(spark):
    monthly = facts(spark, 3)
    plan = st.snapshot_month(monthly, "2022-06-01", calendar_start="2020-01-01", calendar_end="2023-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_repeated_months_and_long_windows_are_errors(spark):
    month = dt.date(2024, 1, 1)
    row = (month, "a", 1, 1, 10.0, 1, 1, 1.0, 1.0, 1.0, 1.0, 1.0)
    twice = spark.createDataFrame([row, row], SCHEMA)
    with pytest.raises(Exception, match="two rows in one month"):
        st.snapshot_month(twice, "2024-03-01", calendar_start="2023-01-01", calendar_end="2024-06-01").collect()
    with pytest.raises(ValueError):
        st.snapshot_month(twice.limit(1), "2024-03-01", calendar_start="2023-01-01", calendar_end="2024-06-01", trailing_months=(3, 99))
    empty = spark.createDataFrame([], SCHEMA)
    assert st.snapshot_month(empty, "2024-03-01", calendar_start="2023-01-01", calendar_end="2024-06-01").collect() == []


def test_ratio_and_visit_states_fold(spark):
    rng = random.Random(4)
    keys = ["elc_master_id", "consumer_id", "brand_id"]
    rows = [(f"E{rng.randrange(6)}", 1, 1, rng.choice([None, 1, 2, 3]), dt.date(2022, rng.randrange(1, 7), 1), rng.randrange(1, 5)) for _ in range(120)]
    visits = spark.createDataFrame(rows, "elc_master_id string, consumer_id long, brand_id long, store_id long, sale_month date, n long")
    state = st.visit_state(visits, "2022-01-01")
    for m in range(2, 7):
        state = st.visit_state(visits, dt.date(2022, m, 1), state=state)
    got = {r["elc_master_id"]: r["most_freq_store_id"] for r in st.leading_stores(state).collect()}
    for e in {r[0] for r in rows}:
        count = {s: sum(r[5] for r in rows if r[0] == e and r[3] == s) for s in {r[3] for r in rows if r[0] == e} - {None}}
        assert got[e] == (max(count, key=lambda s: (count[s], -s)) if count else None)
    assert rows_of(state.select(*keys, "store_id", "n")) == rows_of(st.visit_state(visits, "2022-06-01").select(*keys, "store_id", "n"))
