import datetime as dt

from spendgrid.operators.filters import (brand_lookup, single_category_mapping,
                                         valid_headers)
from spendgrid.operators.tokens import baskets, product_tokens
from spendgrid.plans.views import ViewRegistry

import pytest


def test_single_category_mapping(spark):
    df = spark.createDataFrame(
        [("000001", "Makeup", "FERT"), ("000001", "Makeup", "FERT"),
         ("000002", "Makeup", "FERT"), ("000002", "Skincare", "FERT"),
         ("000003", None, "FERT"), ("000004", "Other", "HALB")],
        "sku_six_digit_identifier string, major_category_name string, product_type_code string")
    got = {r[0]: r[1] for r in single_category_mapping(df).collect()}
    assert got == {"000001": "Makeup"}


def test_header_filter_drops_null_change_code(spark):
    row = dict(elc_master_id="E", consumer_id=1, brand_id=1, sale_dt=dt.date(2020, 1, 5),
               txn_id=1, usd_net_order_total=5.0, currency_cd="USD", channel_cd="WEB",
               usd_product_total=5.0, usd_product_discount_total=0.0, usd_returns_total=0.0,
               loyalty_trans_flag="N", store_id=None, store_num=None, cdp_region="noam",
               valid_ind=1, consumer_valid_flag="Y", mac_pro_flag="N", visit_ind=1, CDC_CODE="U")
    schema = ("elc_master_id string, consumer_id bigint, brand_id bigint, sale_dt date, "
              "txn_id bigint, usd_net_order_total double, currency_cd string, channel_cd string, "
              "usd_product_total double, usd_product_discount_total double, "
              "usd_returns_total double, loyalty_trans_flag string, store_id bigint, "
              "store_num string, cdp_region string, valid_ind int, consumer_valid_flag string, "
              "mac_pro_flag string, visit_ind int, CDC_CODE string")
    rows = [dict(row), dict(row, txn_id=2, CDC_CODE=None), dict(row, txn_id=3, CDC_CODE="D"),
            dict(row, txn_id=4, currency_cd="EUR"), dict(row, txn_id=5, sale_dt=dt.date(2013, 7, 1))]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    got = [r.txn_id for r in valid_headers(df).collect()]
    assert got == [1]


def test_brand_lookup_null_code_dropped(spark):
    df = spark.createDataFrame(
        [(1, "EL", "d", "n", "noam"), (2, "CS", "d", "n", "noam"), (3, None, "d", "n", "noam"),
         (4, "MA", "d", "n", "emea")],
        "brand_id bigint, brand_cd string, brand_desc string, brand_name string, cdp_region string")
    assert [r.brand_id for r in brand_lookup(df).collect()] == [1]


def test_hash_constant(spark):
    from pyspark.sql import functions as F
    assert spark.range(1).select(F.hash(F.lit("a_b"))).first()[0] == 83329431


def test_product_token_text(spark):
    df = spark.createDataFrame(
        [("000001", "Skin Care", "Face/Body (Dry)", "Cleanser & Toner", "FERT"),
         ("000002", None, "x", "y", "FERT"), ("000003", "A", None, "y", "FERT")],
        "sku_six_digit_identifier string, major_category_name string, category_name string, "
        "sub_category_name string, product_type_code string")
    got = {r[0]: r[1] for r in product_tokens(df).collect()}
    assert got == {"000001": "skin_care_face_body_dry_cleanser_toner", "000003": None}


def test_baskets_repeat_and_sort(spark):
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame(
        [(1, 5, d), (1, 3, d), (1, 5, d), (1, None, d), (2, 9, dt.date(2023, 1, 1))],
        "consumer_id bigint, pdt_hash int, sale_dt date")
    got = {r[0]: r[1] for r in baskets(df, before="2022-04-01").collect()}
    assert got == {1: ["3", "5", "5"]}


def test_view_registry_unknown_key(spark):
    reg = ViewRegistry()
    reg.add("one", lambda s: s.range(3))
    assert reg.run(spark, "one").count() == 3
    assert spark.table("one").count() == 3
    with pytest.raises(ValueError):
        reg.run(spark, "missing")
