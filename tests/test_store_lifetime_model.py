import datetime as dt
import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendgrid.functions import lifetime as lt
from spendgrid.operators import matrix as mx
from spendgrid.operators import model as ml
from spendgrid.sources import store


def test_partition_overwrite_idempotent(spark):
    path = store.run_scratch(spark, "t_overwrite")
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1), (dt.date(2020, 2, 1), 2)],
                               "m date, v int")
    store.overwrite_partitions(df, path, ["m"])
    store.overwrite_partitions(df, path, ["m"])
    assert spark.read.parquet(path).count() == 2
    # replacing one partition leaves the other one alone
    store.overwrite_partitions(spark.createDataFrame([(dt.date(2020, 2, 1), 9)], "m date, v int"),
                               path, ["m"])
    got = sorted((r.m, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(dt.date(2020, 1, 1), 1), (dt.date(2020, 2, 1), 9)]


def test_tables_and_catalog(spark):
    from pyspark.sql.types import DateType, DoubleType, StructField, StructType
    store.ensure_database(spark, "sg_test")
    schema = StructType([StructField("sale_month", DateType()), StructField("amt", DoubleType())])
    name = "sg_test.monthly"
    store.create_partitioned_table(spark, name, schema, ["sale_month"],
                                   path=store.run_scratch(spark, "monthly_tbl"))
    assert store.table_exists(spark, name)
    store.insert_partitions(spark.createDataFrame([(dt.date(2020, 1, 1), 1.5)], schema), name)
    store.insert_partitions(spark.createDataFrame([(dt.date(2020, 1, 1), 2.5)], schema), name)
    assert [r.amt for r in spark.table(name).collect()] == [2.5]
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    store.create_empty_like(df, "sg_test.empty_like")
    assert spark.table("sg_test.empty_like").count() == 0
    assert spark.table("sg_test.empty_like").columns == ["k", "v"]
    funcs = store.save_function_catalog(spark, "sg_test.functions")
    assert funcs.where(F.col("function") == "sum").count() == 1


def test_feature_table_keys(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 2.0)], "id long, ts timestamp_ntz, f double")
    t = store.write_feature_table(df, "feat_t", primary_keys=["id"], timestamp_keys=["ts"],
                                  description="test", path=store.run_scratch(spark, "feat_t"))
    assert t.count() == 1
    assert store.feature_table_keys(spark, "feat_t") == {"primary_keys": ["id"],
                                                          "timestamp_keys": ["ts"]}
    dup = df.unionByName(df)
    with pytest.raises(ValueError):
        store.write_feature_table(dup, "feat_t2", primary_keys=["id"], timestamp_keys=["ts"])


def test_export_csv_parts(spark):
    folder = store.run_scratch(spark, "export")
    df = spark.range(50).repartition(4)
    out = store.export_csv(df, folder, "db.scores", dt.datetime(2024, 1, 2, 3, 4, 5))
    assert out.endswith("scores_2024-01-02 03:04:05")
    files = glob.glob(os.path.join(out, "*.csv"))
    assert len(files) == 4
    for name in files:
        with open(name) as fh:
            assert fh.readline().strip() == "id"
    assert spark.read.csv(out, header=True).count() == 50


def test_lifetime_functions(spark):
    spark.sql("DROP TEMPORARY FUNCTION IF EXISTS clv")
    spark.sql("DROP TEMPORARY FUNCTION IF EXISTS probability_alive")
    assert "probability_alive" in lt.function_problem(spark)
    lt.register_lifetime_functions(spark)
    assert lt.function_problem(spark) is None
    par = lt.LifetimeParams()
    row = spark.sql("SELECT probability_alive(1, 2, 3) AS p, probability_alive(0, 0, 5) AS p0, "
                    "clv(1, 2, 3, 4) AS c").first()
    want = 1 / (1 + par.a / (par.b + 1 - 1) * ((par.alpha + 3) / (par.alpha + 2)) ** (par.r + 1))
    assert row.p == pytest.approx(want) and row.p0 == 1.0 and row.c > 0


def test_rfm_summary(spark):
    m = spark.createDataFrame(
        [(1, dt.date(2020, 1, 1), 10.0), (1, dt.date(2020, 3, 1), 20.0),
         (1, dt.date(2020, 4, 1), 40.0), (2, dt.date(2020, 4, 1), 5.0)],
        "consumer_id long, sale_month date, sales_amount double")
    got = {r.consumer_id: r for r in lt.rfm_summary(m, observation_end="2020-06-01").collect()}
    assert (got[1].frequency, got[1].recency, got[1].T, got[1].monetary_value) == (2.0, 3.0, 5.0, 30.0)
    assert (got[2].frequency, got[2].recency, got[2].T, got[2].monetary_value) == (0.0, 0.0, 2.0, 0.0)


def test_one_hot_vocabulary(spark):
    fit_df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    enc = mx.OneHot(["c"]).fit(fit_df)
    out = enc.transform(spark.createDataFrame([("a", 1.0), ("z", 3.0)], "c string, x double"))
    assert out.columns == ["x", "c_a", "c_b"]
    assert [tuple(r) for r in out.collect()] == [(1.0, 1, 0), (3.0, 0, 0)]


def test_model_matrix_fills(spark):
    df = spark.createDataFrame(
        [("E", 1, None, None, "1", 0), ("F", 2, "x", 3, None, 1)],
        "elc_master_id string, consumer_id long, income string, age int, "
        "email_opt_in_ind string, target_skincare int")
    rows = mx.model_matrix(df, "skincare").collect()
    assert [tuple(r) for r in rows] == [("Unknown", "1", 0.0, 0), ("x", "Unknown", 3.0, 1)]
    prof = mx.dataset_profile(df.limit(0), "skincare",
                              keys=["elc_master_id", "consumer_id"]).first()
    assert prof.row_count == 0 and prof.duplicate_count == 0


def test_model_fit_and_score(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.4)
        rows.append((i, y, float(rng.normal(2.0 * y, 1.0)), "a" if (i + y) % 3 else "b"))
    df = spark.createDataFrame(rows, "id long, label int, x double, c string")
    model = ml.fit(df, ["c"], ["x"], ml.TreeParams(num_trees=10, depth=2))
    s1 = ml.predict(model, df, "p", ["id", "label"])
    s2 = ml.predict(model, df, "p", ["id", "label"])
    a = {r.id: r.p for r in s1.collect()}
    assert a == {r.id: r.p for r in s2.collect()}
    assert all(0.0 <= v <= 1.0 for v in a.values())
    from spendgrid.operators.metrics import roc_auc
    assert roc_auc(s1.withColumnRenamed("p", "score")).first()[0] > 0.8
    assert ml.batch_scores(model, df.limit(0), "x") is None
    best, cov = ml.search(df, df, ["c"], ["x"], max_evals=2, parallelism=2,
                          space={"learning_rate": (0.1, 0.5), "num_trees": (4, 8), "l2_leaf_reg": (1, 10), "depth": (2, 3)})
    assert isinstance(best, ml.TreeParams) and 0.0 <= cov <= 1.0


def test_pandas_scorer(spark):
    class Threshold:
        def predict_proba(self, x):
            p = (x["x"] > 0).astype(float).to_numpy()
            return np.stack([1 - p, p], axis=1)

    df = spark.createDataFrame([(1, -1.0), (2, 2.0)], "id long, x double")
    score = ml.pandas_scorer(spark, Threshold(), ["x"])
    got = {r.id: r.s for r in df.select("id", score("x").alias("s")).collect()}
    assert got == {1: 0.0, 2: 1.0}
