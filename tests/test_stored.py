"""The stored run: pruned reads, joins without exchange, checked switches."""

import os

import pytest
from pyspark.sql import functions as F

from spendgrid.operators.joins import dimension_join, hot_keys
from spendgrid.plans import preparation as prep
from spendgrid.plans import stored
from spendgrid.sources import store

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")
def test_run_reads_only_its_months_and_joins_in_place(spark):
    run = stored.StoredRun.scratch(spark, prep.test_sources(spark, SF), prep.TEST_PARAMS, buckets=4)
    run.load(last="2000-06-01")
    months = ["2000-04-01", "2000-05-01"]
    for m in months:
        run.advance(m)
    for table, schema in stored.DECLARED.items():
        got = {f.name: f.dataType for f in run.table(table).schema}
        assert got == {f.name: f.dataType for f in schema}
    run.advance("2000-05-01")  # again: the same partition
    assert run.table("snapshot_state").groupBy("state_dt").count().count() == 2
    fold = run.spark.sql("select 1")  # the fold's reads
    from spendgrid.operators import state as st
    folded = st.fold_month(run._state("snapshot_state", stored.first_of_month("2000-05-01")), run.table("sales_monthly_summary"), "2000-06-01")
    plan = plan_of(folded)
    assert plan.count("PartitionFilters: [isnotnull") == 2 and "2000-05-01" in plan and "2000-06-01" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan_of(st.fold_month(run._state("snapshot_state", stored.first_of_month("2000-05-01")),
                                                       run.table("sales_monthly_summary"), "2000-06-01"))
        run.publish("2000-05-01")
        of = lambda t: run.table(t).where("snapshot_dt = date'2000-05-01'")
        joined = of("sales_snapshot").join(of("custom_calculated_attributes"), ["elc_master_id", "consumer_id", "brand_id"]).join(
            of("store_calculated_attributes"), ["elc_master_id", "consumer_id", "brand_id"])
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert run.table("master_table").count() == of("sales_snapshot").count() > 0
    del fold


def test_failed_check_leaves_old_rows_readable(spark):
    path = store.run_scratch(spark, "switch")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store.switch_table(one, "switched", path=path, unique=["k"])
    with pytest.raises(store.NotUnique):
        store.switch_table(one.unionByName(one), "switched", path=path, unique=["k"])
    assert spark.table("switched").count() == 2
    failing = one.select(F.raise_error(F.lit("broken")).cast("int").alias("k"), "v")
    with pytest.raises(Exception, match="broken"):
        store.switch_table(failing, "switched", path=path)
    assert sorted(r["v"] for r in spark.table("switched").collect()) == ["a", "b"]
    store.switch_table(spark.createDataFrame([(3, "c")], "k int, v string"), "switched", path=path, unique=["k"])
    assert [tuple(r) for r in spark.table("switched").collect()] == [(3, "c")]
    assert store.drop_unused(spark, "switched", path) == 3
    assert [tuple(r) for r in spark.table("switched").collect()] == [(3, "c")]
    store.switch_table(spark.createDataFrame([(3, 4.0)], "k int, other double"), "switched", path=path)
    assert spark.table("switched").columns == ["k", "other"]


def test_dimension_join_keeps_rows_and_deals_hot_keys(spark):
    facts = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 97).cast("long").alias("store"))
    facts = store.written_once(facts, "facts")
    dim = spark.range(90).select(F.col("id").alias("store"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("label"))
    assert hot_keys(facts, "store", share=0.3) == [7] and hot_keys(facts.where("store is null"), "store") == []
    plain = sorted(map(repr, facts.join(dim, "store", "left").select("id", "store", "label").collect()))
    for hot in (None, (), [7], [7, 11]):
        assert sorted(map(repr, dimension_join(facts, dim, "store", hot=hot, salt=8).select("id", "store", "label").collect())) == plain
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = dimension_join(facts, dim, "store", hot=[7], salt=64)
        # half of the rows have one store; no task of the join has more than a quarter of them
        # and the rows without a store are spread too
        bare = joined.where("store is null").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(bare) > 1
        sizes = joined.where("store is not null").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert max(r["count"] for r in sizes) < 0.5 * sum(r["count"] for r in sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_right_keys_fail_the_job(spark):
    import datetime as dt

    from spendgrid.operators import attributes as attr
    from spendgrid.operators.joins import sales_details, unique_keys

    once = spark.createDataFrame([(1, "a"), (2, None), (None, "x"), (None, "y")], "k int, v string")
    assert sorted(map(tuple, unique_keys(once, ["k"], "lookup").collect())) == [(1, "a"), (2, None)]
    with pytest.raises(Exception, match="lookup: repeated key 1"):
        unique_keys(once.unionByName(once), ["k"], "lookup").collect()
    keys = spark.createDataFrame([("E1", 1, 1, dt.date(2024, 1, 1))], "elc_master_id string, consumer_id long, brand_id long, snapshot_dt date")
    cv = spark.createDataFrame([("E1", "noam", "U", 1980)], "elc_master_id string, cdp_region string, CDC_CODE string, birth_year int")
    for c in attr.CV_COLUMNS:
        cv = cv.withColumn(c, F.lit("x"))
    assert attr.with_consumer_variables(keys, cv).count() == 1
    with pytest.raises(Exception, match="consumer variables: repeated key E1"):
        attr.with_consumer_variables(keys, cv.unionByName(cv)).collect()
    ca = spark.createDataFrame([("E1", 1, "noam", "US")], "elc_master_id string, consumer_id long, cdp_region string, country_cd string")
    assert attr.with_exists_flag(keys, ca, columns=["country_cd"]).first()["exists_in_cdp"] == "Y"
    with pytest.raises(Exception, match="consumer attributes: repeated key"):
        attr.with_exists_flag(keys, ca.unionByName(ca), columns=["country_cd"]).collect()
    # an output that a repeated key fails is never visible
    path = store.run_scratch(spark, "never")
    with pytest.raises(Exception, match="repeated key"):
        store.overwrite_partitions(attr.with_exists_flag(keys, ca.unionByName(ca), columns=["country_cd"]), path, ["snapshot_dt"])
    assert not os.path.exists(path) or not [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def test_dimension_join_reads_its_facts_once(spark):
    facts = store.written_once(spark.range(100).select("id", (F.col("id") % 5).alias("store")), "facts_once")
    dim = spark.range(3).select(F.col("id").alias("store"), F.lit("s").alias("label"))
    for hot in ((), [2]):
        plan = dimension_join(facts, dim, "store", hot=hot)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parquet") == 1


def test_buckets_follow_lines_and_cores(spark):
    assert [stored.buckets_for(n, 12) for n in (0, 2_000_000, 22_000_000, 130_000_000)] == [8, 8, 12, 24]
    assert stored.buckets_for(700_000_000, 12) == 120 and stored.buckets_for(1, 2) == 8
    run = stored.StoredRun.scratch(spark, None, prep.TEST_PARAMS, buckets=6)
    run.create_tables()
    # a run that goes on with stored tables keeps their buckets
    again = stored.StoredRun(spark, None, prep.TEST_PARAMS, database=run.database, path=run.path)
    assert again.buckets == 6
