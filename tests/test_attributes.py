import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from spendgrid.operators.attributes import (STORE_COLUMNS, ratio_attributes,
                                            store_attributes)

D = dt.date
LINES = ("elc_master_id string, consumer_id long, brand_id long, sale_dt date, "
         "txn_id long, store_id long, channel_cd string, loyalty_trans_flag string, "
         "src_txn_cd_desc string, sales_amount double, usd_discount_amount double")


def lines(spark, rows):
    return spark.createDataFrame(rows, LINES)


def stores_dim(spark):
    cols = ", ".join(f"{c} {'double' if c.endswith(('latitude', 'longitude')) else 'string'}"
                     for c in STORE_COLUMNS)
    rows = [(sid, *[f"{c}-{sid}" if not c.endswith(("latitude", "longitude")) else None
                    for c in STORE_COLUMNS]) for sid in (3, 5, 9)]
    return spark.createDataFrame(rows, f"store_id long, {cols}")


def test_most_frequent_store_ties_and_carry(spark):
    e = ("E", 1, 1)
    rows = [
        (*e, D(2020, 1, 3), 1, 5, "WEB", "N", "SALE", 10.0, 0.0),
        (*e, D(2020, 1, 9), 2, 5, "WEB", "N", "SALE", 10.0, 0.0),
        (*e, D(2020, 1, 9), 2, 5, "WEB", "N", "SALE", 4.0, 0.0),   # same txn: counted once
        (*e, D(2020, 2, 2), 3, 3, "WEB", "N", "SALE", 10.0, 0.0),
        (*e, D(2020, 2, 5), 4, 3, "WEB", "N", "SALE", 10.0, 0.0),   # 2-2 tie: lowest id
        (*e, D(2020, 4, 1), 5, None, "WEB", "N", "SALE", 1.0, 0.0),  # no store on the line
        ("F", 2, 1, D(2020, 3, 1), 6, None, "WEB", "N", "SALE", 1.0, 0.0),  # never a store
    ]
    out = store_attributes(lines(spark, rows), stores_dim(spark),
                           calendar_start="2020-01-01", calendar_end="2020-05-01")
    got = {(r.elc_master_id, r.snapshot_dt): (r.most_freq_store_id, r.store_name)
           for r in out.collect()}
    assert got[("E", D(2020, 1, 1))] == (5, "store_name-5")
    assert got[("E", D(2020, 2, 1))] == (3, "store_name-3")
    assert got[("E", D(2020, 3, 1))] == (3, "store_name-3")   # no visit: carried
    assert got[("E", D(2020, 5, 1))] == (3, "store_name-3")
    assert [k for k in got if k[0] == "F"] == [("F", D(2020, m, 1)) for m in (3, 4, 5)]
    assert got[("F", D(2020, 5, 1))] == (None, None)


def test_ratios(spark):
    e = ("E", 1, 1)
    rows = [
        (*e, D(2020, 1, 3), 1, 1, "FSS", "Y", "SALE", 100.0, 10.0),
        (*e, D(2020, 1, 3), 1, 1, "FSS", "Y", "RETURN", 50.0, 0.0),
        (*e, D(2020, 3, 3), 2, 1, "WEB", "N", "SALE", 50.0, 5.0),
        (*e, D(2020, 11, 3), 3, 1, "MOBILE", "N", "SALE", 100.0, 0.0),
    ]
    out = ratio_attributes(lines(spark, rows), calendar_start="2020-01-01",
                           calendar_end="2020-12-01")
    got = {r.snapshot_dt: r for r in out.collect()}
    jan, feb, mar, dec = (got[D(2020, m, 1)] for m in (1, 2, 3, 12))
    assert (jan.fss_txn_ratio, jan.loyalty_txn_ratio, jan.return_txn_ratio) == (1.0, 1.0, 1.0)
    assert jan.discount_ratio == pytest.approx(10 / 150)
    assert feb.fss_txn_ratio == 1.0                      # carried over the gap
    assert mar.fss_txn_ratio == 0.5 and mar.web_txn_ratio == 0.5
    assert mar.discount_ratio == pytest.approx(15 / 200) and mar.sales_q4_ratio == 0.0
    assert dec.mobile_txn_ratio == pytest.approx(1 / 3)
    assert dec.sales_q4_ratio == pytest.approx(100 / 300)
    assert dec.tablet_txn_ratio == 0.0


def test_master_joins_are_copartitioned(spark):
    """Grids partitioned by the entity id join without a new exchange."""
    from spendgrid.operators.attributes import master_table
    from spendgrid.operators.monthly import monthly_summary
    from spendgrid.operators.snapshot import snapshot

    e = ("E", 1, 1)
    rows = [(*e, D(2020, 1, 3), 1, 5, "WEB", "N", "SALE", 10.0, 0.0),
            (*e, D(2020, 3, 9), 2, 3, "FSS", "Y", "SALE", 10.0, 1.0)]
    sales = lines(spark, rows).withColumn("major_category", F.lit("Makeup"))
    kw = dict(calendar_start="2020-01-01", calendar_end="2020-05-01",
              partition_by=("elc_master_id",))
    snap = snapshot(monthly_summary(sales), **kw)
    ratios = ratio_attributes(sales, **kw)
    stores = store_attributes(sales, stores_dim(spark), **kw)
    cv = spark.createDataFrame([], "elc_master_id string, ethnic_group string, gender string, "
                               "language string, marital_status string, occupation_group string, "
                               "mosaic_segment string, mosaic_group string, age_range string, "
                               "ethnicity_detail string, income string, birth_year int, "
                               "cdp_region string, CDC_CODE string")
    from spendgrid.operators.attributes import CA_COLUMNS
    ca = spark.createDataFrame([], "elc_master_id string, consumer_id long, cdp_region string, "
                               + ", ".join(f"{c} string" for c in CA_COLUMNS))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        out = master_table(snap, cv, ca, ratios, stores)
        plan = re.sub(r"#\d+L?", "", out._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan
    assert "hashpartitioning(elc_master_id, consumer_id, brand_id, snapshot_dt" not in plan, plan
    assert out.count() == 5
