"""Adapter: the driver's TPC-H-style test tables in the reference's input
schemas.

Each function renames and denormalises columns so a test table has the
shape of one of the reference's sources; none of them filters, aggregates or
joins for the job. Mapping (see FIXTURES.md section 3):

* header  <- orders (+ customer name as the text entity id)
* detail  <- lineitem (+ order date / customer from orders, brand = region of
  the line's supplier)
* product <- part; brand lookup <- region; store dimension <- supplier
* consumer variables / attributes <- customer
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.sources.tables import read_table

# Fixed values of the test mapping.
# Part type -> major category (four named categories, the other two "Other").
PART_TYPE_CATEGORY = {
    "ECONOMY": "Makeup",
    "LARGE": "Skincare",
    "MEDIUM": "Fragrance",
    "PROMO": "Haircare",
    "SMALL": "Other",
    "STANDARD": "Other",
}
# Order priority -> sales channel.
PRIORITY_CHANNEL = {
    "1-URGENT": "FSS",
    "2-HIGH": "MOBILE",
    "3-MEDIUM": "WEB",
    "4-NOT SPECIFIED": "CALL",
    "5-LOW": "TABLET",
}
# Order priority -> currency ('4-NOT SPECIFIED' orders are in EUR and fail
# the header's currency filter).
PRIORITY_CURRENCY = {"2-HIGH": "CAD", "4-NOT SPECIFIED": "EUR"}
DEFAULT_CURRENCY = "USD"
REGION = "noam"


def _case_map(col: Column, mapping: dict[str, str], default=None) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = (F.when(col == key, value) if expr is None
                else expr.when(col == key, value))
    return expr.otherwise(F.lit(default))


def _sku(partkey: Column) -> Column:
    return F.lpad(partkey.cast("string"), 6, "0")


def product_dim(spark: SparkSession, base: str) -> DataFrame:
    p = read_table(spark, base, "part")
    return p.select(
        _sku(p.p_partkey).alias("sku_six_digit_identifier"),
        _case_map(p.p_type, PART_TYPE_CATEGORY).alias("major_category_name"),
        p.p_brand.alias("category_name"),
        p.p_name.alias("sub_category_name"),
        F.lit("FERT").alias("product_type_code"),
    )


def brand_source(spark: SparkSession, base: str) -> DataFrame:
    r = read_table(spark, base, "region")
    return r.select(
        r.r_regionkey.cast("bigint").alias("brand_id"),
        F.upper(F.substring(r.r_name, 1, 2)).alias("brand_cd"),
        r.r_name.alias("brand_desc"),
        F.initcap(r.r_name).alias("brand_name"),
        F.lit(REGION).alias("cdp_region"),
    )


def _orders_with_entity(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    c = read_table(spark, base, "customer").select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey, "left")


def header_source(spark: SparkSession, base: str) -> DataFrame:
    o = _orders_with_entity(spark, base)
    return o.select(
        F.col("c_name").alias("elc_master_id"),
        F.col("o_custkey").alias("consumer_id"),
        F.lit(None).cast("bigint").alias("brand_id"),
        F.to_date("o_orderdate").alias("sale_dt"),
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_totalprice").alias("usd_net_order_total"),
        _case_map(F.col("o_orderpriority"), PRIORITY_CURRENCY,
                  DEFAULT_CURRENCY).alias("currency_cd"),
        _case_map(F.col("o_orderpriority"), PRIORITY_CHANNEL).alias("channel_cd"),
        F.col("o_totalprice").alias("usd_product_total"),
        F.lit(0.0).alias("usd_product_discount_total"),
        F.lit(0.0).alias("usd_returns_total"),
        F.when(F.col("o_orderstatus") == "P", "Y").otherwise("N")
        .alias("loyalty_trans_flag"),
        F.lit(None).cast("bigint").alias("store_id"),
        F.lit(None).cast("string").alias("store_num"),
        # flags the tables lack: some orders fail each condition
        F.when(F.col("o_orderkey") % 71 == 19, "emea").otherwise(REGION).alias("cdp_region"),
        F.when(F.col("o_orderkey") % 97 == 3, 0).otherwise(1).alias("valid_ind"),
        F.when(F.col("o_custkey") % 89 == 5, "N").otherwise("Y").alias("consumer_valid_flag"),
        F.when(F.col("o_orderkey") % 83 == 7, "Y").otherwise("N").alias("mac_pro_flag"),
        F.when(F.col("o_orderkey") % 79 == 11, 0).otherwise(1).alias("visit_ind"),
        F.when(F.col("o_orderkey") % 73 == 13, "D")
        .when(F.col("o_orderkey") % 73 != 17, "U").alias("CDC_CODE"),
    )


def detail_source(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    o = _orders_with_entity(spark, base).select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "c_name")
    s = read_table(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    n = read_table(spark, base, "nation").select("n_nationkey", "n_regionkey")
    j = (li.join(o, li.l_orderkey == o.o_orderkey, "left")
         .join(s, li.l_suppkey == s.s_suppkey, "left")
         .join(n, F.col("s_nationkey") == n.n_nationkey, "left"))
    part = F.col("l_partkey").cast("string")
    return j.select(
        F.to_date("o_orderdate").alias("sale_dt"),
        _case_map(F.col("o_orderpriority"), PRIORITY_CHANNEL).alias("channel_cd"),
        F.col("c_name").alias("elc_master_id"),
        F.col("o_custkey").alias("consumer_id"),
        F.col("n_regionkey").cast("bigint").alias("brand_id"),
        F.col("l_orderkey").alias("txn_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("txn_detail_id"),
        F.when(F.col("l_linenumber") == 7, "Return").otherwise("Sale").alias("sale_line_type"),
        F.col("l_linenumber").alias("sale_line_num"),
        F.when(F.col("l_returnflag") == "R", "RETURN").otherwise("SALE")
        .alias("src_txn_cd_desc"),
        F.col("l_quantity").cast("int").alias("net_item_qty"),
        F.col("l_extendedprice").alias("usd_total_price"),
        F.try_divide("l_extendedprice", "l_quantity").alias("usd_unit_price"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("usd_discount_amount"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.concat(_sku(F.col("l_partkey")), F.lit("-"),
                 F.col("l_suppkey").cast("string")).alias("product_sku"),
        F.col("l_suppkey").alias("store_id"),
        F.concat(F.lit("Product "), part).alias("product_desc"),
        F.concat(F.lit("M"), F.col("l_partkey") % 5).alias("master_category"),
        F.concat(F.lit("C"), F.col("l_partkey") % 25).alias("category"),
        F.concat(F.lit("S"), F.col("l_partkey") % 125).alias("sub_category"),
        F.when(F.col("l_partkey") % 3 != 0, F.concat(F.lit("A"), F.col("l_partkey") % 7))
        .alias("subcategory_alter"),
        F.when(F.col("l_orderkey") % 67 == 23, "emea").otherwise(REGION).alias("cdp_region"),
    )


def consumer_variables(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    none = F.lit(None).cast("string")
    return c.select(
        c.c_name.alias("elc_master_id"),
        none.alias("ethnic_group"), none.alias("gender"),
        none.alias("language"), none.alias("marital_status"),
        none.alias("occupation_group"),
        c.c_mktsegment.alias("mosaic_segment"),
        none.alias("mosaic_group"), none.alias("age_range"),
        none.alias("ethnicity_detail"),
        c.c_mktsegment.alias("income"),
        (F.lit(1950) + c.c_nationkey).alias("birth_year"),
        F.lit(REGION).alias("cdp_region"),
        F.when(c.c_mktsegment == "BUILDING", "D").otherwise("U").alias("CDC_CODE"),
    )


def consumer_attributes(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    flag = lambda cond: F.when(cond, "1").otherwise("0")
    none = F.lit(None).cast("string")
    return c.select(
        c.c_name.alias("elc_master_id"),
        c.c_custkey.alias("consumer_id"),
        F.lit("US").alias("country_cd"),
        F.concat(F.lit("S"), c.c_nationkey.cast("string")).alias("state_cd"),
        F.lit("en").alias("lang_cd"),
        flag(c.c_acctbal > 0).alias("email_opt_in_ind"),
        flag(c.c_acctbal > 5000).alias("phone_opt_in_ind"),
        none.alias("city"), none.alias("zip_code"),
        flag(c.c_mktsegment == "AUTOMOBILE").alias("dm_opt_in_ind"),
        flag(c.c_acctbal > 2500).alias("mobile_contactable_ind"),
        c.c_nationkey.cast("string").alias("first_store_id"),
        c.c_nationkey.cast("string").alias("last_store_id"),
        c.c_nationkey.cast("string").alias("closest_store"),
        c.c_nationkey.cast("string").alias("most_frequent_store"),
        c.c_mktsegment.alias("first_channel"),
        F.lit("N").alias("deceased_flag"), F.lit("N").alias("prison_flag"),
        flag(c.c_acctbal > 7500).alias("mobile_opt_in_ind"),
        none.alias("dm_state"), none.alias("dm_country"),
        F.when(c.c_nationkey >= 20, "emea").otherwise(REGION).alias("cdp_region"),
    )


def store_dim(spark: SparkSession, base: str) -> DataFrame:
    s = read_table(spark, base, "supplier")
    n = read_table(spark, base, "nation")
    r = read_table(spark, base, "region")
    j = (s.join(n, s.s_nationkey == n.n_nationkey, "left")
         .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    none = F.lit(None).cast("string")
    return j.select(
        F.col("s_suppkey").alias("store_id"),
        F.lit("RETAIL").alias("store_channel"),
        F.col("s_nationkey").cast("string").alias("store_market_cd"),
        F.col("s_name").alias("store_name"),
        F.upper(F.substring("r_name", 1, 2)).alias("store_brand_cd"),
        F.col("r_name").alias("store_region"),
        F.col("n_name").alias("store_sub_region"),
        none.alias("store_state_prov_cd"), none.alias("store_city"),
        none.alias("store_postal_cd"),
        F.lit(None).cast("double").alias("store_latitude"),
        F.lit(None).cast("double").alias("store_longitude"),
        F.lit("A").alias("store_status_cd"),
    )
