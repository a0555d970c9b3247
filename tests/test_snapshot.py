import datetime as dt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spendgrid import oracle as O
from spendgrid.operators import CATEGORIES, category_prefix
from spendgrid.operators.snapshot import (densify, expand, month_grid, running_columns, snapshot,
                                           snapshot_columns, spans)

D = dt.date


def monthly_rows(spark, rows):
    """rows: (elc, consumer, brand, month, sales, txn, items, makeup, skincare,
    fragrance, haircare, other)"""
    cols = ["elc_master_id", "consumer_id", "brand_id", "sale_month", "sales_amount",
            "txn_cnt", "item_cnt"] + [f"{category_prefix(c)}_amount" for c in CATEGORIES]
    schema = ("elc_master_id string, consumer_id bigint, brand_id bigint, sale_month date, "
              "sales_amount double, txn_cnt bigint, item_cnt bigint, "
              + ", ".join(f"{category_prefix(c)}_amount double" for c in CATEGORIES))
    return spark.createDataFrame([tuple(r) for r in rows], schema), cols


@pytest.fixture(scope="module")
def gap_customer(spark):
    # purchases in months 1, 2 and 6 of 2020; calendar ends in month 9
    rows = [
        ("E1", 1, 7, D(2020, 1, 1), 10.0, 1, 2, 10.0, 0.0, 0.0, 0.0, 0.0),
        ("E1", 1, 7, D(2020, 2, 1), 25.0, 2, 3, 20.0, 5.0, 0.0, 0.0, 0.0),
        ("E1", 1, 7, D(2020, 6, 1), 7.0, 1, 1, 0.0, 7.0, 0.0, 0.0, 0.0),
        # one purchase in the last month only
        ("E2", 2, 7, D(2020, 9, 1), 3.5, 1, 1, 0.0, 0.0, 3.5, 0.0, 0.0),
    ]
    df, _ = monthly_rows(spark, rows)
    out = snapshot(df, calendar_start="2020-01-01", calendar_end="2020-09-01")
    return {(r["consumer_id"], r["snapshot_dt"]): r for r in out.collect()}


def test_grid_rows(gap_customer):
    assert len([k for k in gap_customer if k[0] == 1]) == 9
    assert [k for k in gap_customer if k[0] == 2] == [(2, D(2020, 9, 1))]


def test_targets(gap_customer):
    g = gap_customer
    assert g[(1, D(2020, 1, 1))]["target_makeup"] == 1      # Feb buys makeup
    assert g[(1, D(2020, 2, 1))]["target_makeup"] == 0      # Mar-May empty
    assert g[(1, D(2020, 3, 1))]["target_skincare"] == 1    # Jun skincare
    assert g[(1, D(2020, 3, 1))]["target_makeup"] == 0      # Jun makeup is 0
    assert g[(1, D(2020, 9, 1))]["target_skincare"] == 0    # last month
    assert g[(2, D(2020, 9, 1))]["target_fragrance"] == 0


def test_running_and_trailing(gap_customer):
    g = gap_customer
    r = g[(1, D(2020, 3, 1))]
    assert r["makeup_cnt_3m"] == 2.0 and r["makeup_amt_last"] is None
    assert g[(1, D(2020, 4, 1))]["makeup_cnt_3m"] == 1.0
    r = g[(1, D(2020, 9, 1))]
    assert r["first_purchase_dt"] == D(2020, 1, 1)
    assert r["last_purchase_dt"] == D(2020, 6, 1)
    assert r["months_since_last_purchase"] == 3.0
    assert r["months_since_first_purchase"] == 8.0
    assert r["makeup_min"] == 10.0 and r["makeup_max"] == 20.0
    assert r["makeup_avg"] == 15.0
    assert r["skincare_avg"] == 6.0
    assert r["sales_tot"] == 42.0 and r["txn_cnt_tot"] == 4.0
    assert r["sales_mnt_cnt_12m"] == 3.0
    assert r["avg_item_cnt"] == 2.0
    assert g[(1, D(2020, 6, 1))]["skincare_amt_last"] == 7.0


def test_calendar_start_after_first_purchase(spark):
    rows = [("E3", 3, 1, D(2019, 11, 1), 5.0, 1, 1, 5.0, 0.0, 0.0, 0.0, 0.0),
            ("E3", 3, 1, D(2020, 3, 1), 6.0, 1, 1, 6.0, 0.0, 0.0, 0.0, 0.0),
            # only before the calendar: grid still from the calendar start
            ("E4", 4, 1, D(2019, 5, 1), 1.0, 1, 1, 1.0, 0.0, 0.0, 0.0, 0.0),
            # only after the calendar end: no rows
            ("E5", 5, 1, D(2021, 5, 1), 1.0, 1, 1, 1.0, 0.0, 0.0, 0.0, 0.0)]
    df, _ = monthly_rows(spark, rows)
    grid = month_grid(df, calendar_start="2020-01-01", calendar_end="2020-04-01")
    got = sorted((r["consumer_id"], r["dt"]) for r in grid.collect())
    months = [D(2020, m, 1) for m in (1, 2, 3, 4)]
    assert got == [(3, m) for m in months] + [(4, m) for m in months]
    dense = {(r["consumer_id"], r["dt"]): r for r in densify(
        df, calendar_start="2020-01-01", calendar_end="2020-04-01").collect()}
    assert dense[(3, D(2020, 1, 1))]["sales_amount"] is None
    assert dense[(3, D(2020, 3, 1))]["sales_amount"] == 6.0


def test_against_reference_sql_random(spark):
    """Random gaps and calendars: the operator against the reference's
    cross-join + left-join formulation run in DuckDB."""
    import random
    rng = random.Random(7)
    rows = []
    for k in range(25):
        months = sorted(rng.sample(range(0, 40), rng.randint(1, 12)))
        for m in months:
            amt = [float(round(rng.choice([0, 0, rng.uniform(1, 90)]), 2)) for _ in CATEGORIES]
            rows.append((f"E{k}", k, k % 3, D(2018 + m // 12, m % 12 + 1, 1),
                         float(round(sum(amt), 2)), rng.randint(1, 3), rng.randint(1, 5), *amt))
    df, cols = monthly_rows(spark, rows)
    start, end = "2018-06-01", "2020-12-01"
    got = snapshot(df, calendar_start=start, calendar_end=end).toPandas()
    con = duckdb.connect()
    con.register("ms_in", pd.DataFrame(rows, columns=cols))
    sql = (f"""
    WITH ms AS (SELECT * FROM ms_in),
    fm AS (SELECT {O.KEYS}, min(sale_month) AS min_sale_month FROM ms GROUP BY ALL),
    calendar AS (SELECT CAST(dt AS DATE) AS dt FROM (SELECT unnest(generate_series(
        TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 MONTH)) AS dt)),
    grid AS (SELECT f.elc_master_id, f.consumer_id, f.brand_id, c.dt FROM fm f
             CROSS JOIN calendar c WHERE c.dt >= f.min_sale_month),
    dense AS (SELECT g.dt, g.elc_master_id, g.consumer_id, g.brand_id, s.* EXCLUDE ({O.KEYS})
              FROM grid g LEFT JOIN ms s ON g.elc_master_id = s.elc_master_id
              AND g.consumer_id = s.consumer_id AND g.brand_id = s.brand_id
              AND g.dt = s.sale_month)""" + O.snapshot_cte() + "\nSELECT * FROM snap")
    want = con.execute(sql).df()
    key = ["elc_master_id", "snapshot_dt"]
    got["snapshot_dt"] = pd.to_datetime(got["snapshot_dt"])
    want["snapshot_dt"] = pd.to_datetime(want["snapshot_dt"])
    got = got.sort_values(key).reset_index(drop=True)
    want = want[got.columns].sort_values(key).reset_index(drop=True)
    assert len(got) == len(want)
    for c in got.columns:
        a, b = got[c], want[c]
        if c.endswith("_dt") and c != "snapshot_dt":
            a, b = pd.to_datetime(a), pd.to_datetime(b)
        same = (a == b) | (a.isna() & b.isna())
        if a.dtype.kind == "f":
            same = same | ((a - b).abs() < 1e-9)
        assert same.all(), c


def test_properties(gap_customer):
    rows = sorted((v for k, v in gap_customer.items() if k[0] == 1),
                  key=lambda r: r["snapshot_dt"])
    prev = -1
    for r in rows:
        assert r["makeup_cnt_tot"] >= prev
        prev = r["makeup_cnt_tot"]
        assert (r["makeup_cnt_3m"] <= r["makeup_cnt_6m"] <= r["makeup_cnt_12m"]
                <= r["makeup_cnt_24m"] <= r["makeup_cnt_tot"])


def test_grid_rows_per_key_property(spark):
    """Rows per key = months from the key's first purchase (or the calendar
    start, if later) to the calendar end."""
    import random
    rng = random.Random(21)
    rows = []
    for k in range(40):
        for m in sorted(rng.sample(range(0, 60), rng.randint(1, 6))):
            rows.append((f"E{k}", k, 1, D(2017 + m // 12, m % 12 + 1, 1),
                         1.0, 1, 1, 1.0, 0.0, 0.0, 0.0, 0.0))
    df, _ = monthly_rows(spark, rows)
    start, end = D(2018, 3, 1), D(2020, 6, 1)
    got = {r["consumer_id"]: r["n"] for r in month_grid(
        df, calendar_start=start, calendar_end=end).groupBy("consumer_id").count()
        .withColumnRenamed("count", "n").collect()}

    def months(a, b):
        return (b.year - a.year) * 12 + b.month - a.month + 1

    want = {}
    for _, k, _, m, *rest in rows:
        want[k] = min(want.get(k, m), m)
    want = {k: months(max(m, start), end) for k, m in want.items() if m <= end}
    assert got == want


def test_snapshot_plan_has_one_exchange(spark):
    """Facts -> grid -> features: one hash exchange by the keys, no join."""
    rows = [("E1", 1, 7, D(2020, 1, 1), 10.0, 1, 2, 10.0, 0.0, 0.0, 0.0, 0.0),
            ("E1", 1, 7, D(2020, 4, 1), 5.0, 1, 1, 0.0, 5.0, 0.0, 0.0, 0.0)]
    df, _ = monthly_rows(spark, rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = snapshot(df, calendar_start="2020-01-01", calendar_end="2020-06-01")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "Join" not in plan, plan


def test_grid_rows_are_neither_sorted_nor_windowed(spark):
    rows = [("a", 1, 1, dt.date(2020, 1, 1), 5.0, 1, 1)]
    facts = spark.createDataFrame(rows, "elc_master_id string, consumer_id long, brand_id long, sale_month date, sales_amount double, txn_cnt long, item_cnt long")
    for p in ("makeup", "skincare", "fragrance", "haircare", "other"):
        facts = facts.withColumn(f"{p}_amount", F.lit(2.0))
    plan = snapshot(facts, calendar_start="2020-01-01", calendar_end="2021-01-01")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Generate")]
    assert "Sort" not in above and "Window" not in above and "Exchange" not in above


def test_frames_wider_than_a_number_has_bits(spark):
    schema = "elc_master_id string, consumer_id long, brand_id long, sale_month date, sales_amount double, txn_cnt long, item_cnt long"
    months = [dt.date(2010, 1, 1), dt.date(2013, 6, 1), dt.date(2016, 2, 1)]
    facts = spark.createDataFrame([("a", 1, 1, m, 5.0, 1, 1) for m in months], schema)
    for p in ("makeup", "skincare", "fragrance", "haircare", "other"):
        facts = facts.withColumn(f"{p}_amount", F.lit(2.0))
    carry = running_columns(trailing_months=(3, 70), avg_months=65)
    grid = expand(spans(facts, calendar_start="2010-01-01", calendar_end="2017-01-01", carry=carry))
    got = grid.select(*snapshot_columns(trailing_months=(3, 70), avg_months=65)).collect()
    assert len(got) == 85
    for r in got:
        back = [(r.snapshot_dt.year - m.year) * 12 + r.snapshot_dt.month - m.month for m in months]
        for n in (3, 70):
            assert r[f"makeup_cnt_{n}m"] == sum(0 <= b < n for b in back)
        assert r.makeup_avg_65m == (2.0 if any(0 <= b < 65 for b in back) else None)
        assert r.target_makeup == int(any(-3 <= b < 0 for b in back))
