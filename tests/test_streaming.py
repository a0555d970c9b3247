import datetime as dt
import os

from pyspark.sql import functions as F

from spendgrid.functions.dates import month_start
from spendgrid.operators.monthly import monthly_summary
from spendgrid.sources import store
from spendgrid.streaming.refresh import start_monthly_refresh

SCHEMA = "consumer_id long, txn_id long, sale_dt date, sales_amount double, major_category string"


def test_incremental_monthly_refresh(spark):
    root = store.run_scratch(spark, "stream")
    src, table, ckpt = (os.path.join(root, x) for x in ("src", "table", "ckpt"))
    rows1 = [(1, 10, dt.date(2020, 1, 5), 5.0, "Makeup"),
             (1, 11, dt.date(2020, 2, 7), 7.0, "Skincare")]
    spark.createDataFrame(rows1, SCHEMA).write.parquet(os.path.join(src, "b1"))
    schema = spark.read.parquet(os.path.join(src, "b1")).schema

    def build(months):
        lines = spark.read.parquet(src + "/*").where(
            month_start(F.col("sale_dt")).isin(list(months)))
        return monthly_summary(lines, keys=("consumer_id",), categories=("Makeup", "Skincare"))

    def run():
        q = start_monthly_refresh(spark, source_dir=src + "/*", schema=schema,
                                  build_monthly=build, table_path=table,
                                  checkpoint_path=ckpt)
        q.awaitTermination(120)

    run()
    got = {(r.sale_month, r.txn_cnt) for r in spark.read.parquet(table).collect()}
    assert got == {(dt.date(2020, 1, 1), 1), (dt.date(2020, 2, 1), 1)}
    # a late line for January and a new month arrive
    rows2 = [(1, 12, dt.date(2020, 1, 20), 3.0, "Makeup"),
             (1, 13, dt.date(2020, 3, 2), 1.0, "Makeup")]
    spark.createDataFrame(rows2, SCHEMA).write.parquet(os.path.join(src, "b2"))
    run()
    got = {(r.sale_month, r.txn_cnt, r.sales_amount) for r in spark.read.parquet(table).collect()}
    assert got == {(dt.date(2020, 1, 1), 2, 8.0), (dt.date(2020, 2, 1), 1, 7.0),
                   (dt.date(2020, 3, 1), 1, 1.0)}
    run()  # nothing new: unchanged
    assert spark.read.parquet(table).count() == 3
