"""Nothing is rounded, dropped or left out without an error."""

import datetime as dt

import pytest

from spendgrid.functions.money import from_units, to_units
from spendgrid.operators import features as feat
from spendgrid.operators.filters import valid_headers
from spendgrid.operators.snapshot import densify
from pyspark.sql import functions as F


def test_sums_below_a_cent(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (0.123456,)], "x double")
    assert df.agg(from_units(F.sum(to_units(F.col("x"))))).first()[0] == 0.131456


def test_two_rows_of_a_month_are_an_error(spark):
    month = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("a", 1, 1, month, 10.0), ("a", 1, 1, month, 20.0)],
                               "elc_master_id string, consumer_id long, brand_id long, sale_month date, sales_amount double")
    with pytest.raises(Exception, match="two rows in one month"):
        densify(df, calendar_start="2023-01-01", calendar_end="2024-06-01").collect()


def test_missing_source_column_is_an_error(spark):
    with pytest.raises(ValueError, match="usd_net_order_total"):
        valid_headers(spark.createDataFrame([], "elc_master_id string, cdp_region string"))


def test_null_keys_match_nothing_as_of(spark):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    features = spark.createDataFrame([(None, day(1), 1.0), ("a", day(1), 2.0)], "k string, f timestamp_ntz, v double")
    spine = spark.createDataFrame([(None, day(1, 5)), (None, day(3)), ("a", day(1, 5)), ("a", day(3))], "k string, s timestamp_ntz")
    got = feat.as_of_join(spine, features, keys=["k"], spine_ts="s", feature_ts="f").collect()
    assert sorted((r["k"] or "", r["s"], r["v"]) for r in got) == [
        ("", day(1, 5), None), ("", day(3), None), ("a", day(1, 5), 2.0), ("a", day(3), 2.0)]


def test_training_on_many_categories(spark):
    from spendgrid.operators import model as ml

    rows = [(f"c{k % 500}", float(k % 7), float(k % 500 > 250)) for k in range(3000)]
    df = spark.createDataFrame(rows, "city string, x double, label double")
    fitted = ml.fit(df, ["city"], ["x"], ml.TreeParams(num_trees=2, depth=2))
    assert ml.predict(fitted, df, "p", ["city"]).count() == 3000
