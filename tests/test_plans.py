import datetime as dt
import glob
import os

import numpy as np
from pyspark.sql import functions as F

from spendgrid.plans import scoring, training
from spendgrid.sources import store


def synthetic_master(spark, n=600):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.35)
        rows.append((dt.date(2023, 4, 1), f"E{i}", i * 10 + 1, 1, y, 0, 0, 0,
                     float(rng.normal(3 * y, 1)), "Y", "seg" + str(i % 3), "1"))
    return spark.createDataFrame(rows, "snapshot_dt date, elc_master_id string, "
                                 "consumer_id long, brand_id long, target_skincare int, "
                                 "target_makeup int, target_fragrance int, target_haircare int, "
                                 "sales_tot double, exists_in_cdp string, income string, "
                                 "email_opt_in_ind string")


def test_train_and_score(spark):
    master = synthetic_master(spark)
    res = training.train(master, target="skincare", snapshot_dt="2023-04-01",
                         max_evals=1, parallelism=1,
                         space={"learning_rate": (0.1, 0.5), "num_trees": (8, 12), "l2_leaf_reg": (1, 10), "depth": (2, 3)})
    rep = {(r.split, r.metric): r.value for r in res.report.collect()}
    assert rep[("test", "roc_auc")] > 0.8
    assert set(res.categorical) == {"income", "email_opt_in_ind"}
    scores = scoring.score_month(res.model, master, category="skincare",
                                 snapshot_dt="2023-04-01",
                                 categorical=["income"], numeric=res.numeric,
                                 indicators=["email_opt_in_ind"])
    path = store.run_scratch(spark, "scores")
    folder = store.run_scratch(spark, "scores_csv")
    stored = scoring.store_and_export(scores, table_path=path, export_folder=folder,
                                      table_name="db.skincare_score",
                                      write_dt=dt.datetime(2024, 1, 1))
    assert stored.count() == master.count()
    assert stored.where((F.col("pred_proba_skincare") < 0)
                        | (F.col("pred_proba_skincare") > 1)).count() == 0
    assert len(glob.glob(os.path.join(folder, "*", "*.csv"))) == 1
    empty = scoring.score_month(res.model, master, category="skincare",
                                snapshot_dt="2020-01-01", categorical=["income"],
                                numeric=res.numeric, indicators=["email_opt_in_ind"])
    assert empty is None and scoring.store_and_export(empty, table_path=path) is None


def test_months_of_one_run_equal_single_months(spark):
    from spendgrid.plans import preparation as prep

    src = prep.test_sources(spark, "/root/testdata/sf0.001")
    months = ("2000-05-01", "2000-06-01")
    for month, rows in zip(months, prep.snapshot_months_of(src, prep.TEST_PARAMS, months)):
        assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()  # the lines are not joined again
        want = prep.snapshot_month_of(src, prep.TEST_PARAMS, month)
        assert rows.count() == want.count() > 0 and rows.exceptAll(want).isEmpty()


def test_fact_lines_are_grouped_where_they_are(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from spendgrid.operators import state as st
    from spendgrid.operators.attributes import ratio_monthly
    from spendgrid.operators.monthly import monthly_summary
    from spendgrid.plans import preparation as prep

    # one key has a third of all lines
    sales = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("E"), F.col("id") % 50)).alias("elc_master_id"),
        F.lit(1).cast("long").alias("consumer_id"), (F.col("id") % 4).alias("brand_id"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 900).cast("int")).alias("sale_dt"), (F.col("id") % 700).alias("txn_id"),
        F.lit("FSS").alias("channel_cd"), F.lit("Makeup").alias("major_category"), (F.col("id") * 0.25).alias("sales_amount"),
        F.lit("SALE").alias("src_txn_cd_desc"), F.lit(0.5).alias("usd_discount_amount"), (F.col("id") % 7).alias("store_id"),
        F.lit("Y").alias("loyalty_trans_flag"), F.lit("x").alias("product_desc"))
    lines = prep.fact_lines(sales, "test_lines")
    assert "product_desc" not in lines.columns
    for facts in (monthly_summary, ratio_monthly, st.monthly_visits):
        assert "Exchange" not in facts(lines)._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, facts(lines).collect())) == sorted(map(repr, facts(sales).select(*facts(lines).columns).collect()))
    assert lines.where("elc_master_id = 'hot'").select(F.spark_partition_id()).distinct().count() > 1


def test_ranks_and_fits_use_many_tasks(spark):
    from spendgrid.operators import model as ml
    from spendgrid.operators.ranking import range_count

    assert range_count(270_000) >= 5  # wide training rows of a month at 1 GB
    rows = ml._dealt(spark.range(100).coalesce(1), ["id"], "dealt")
    assert rows.count() == 100 and len(rows.inputFiles()) == spark.sparkContext.defaultParallelism
