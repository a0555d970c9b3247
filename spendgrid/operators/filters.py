"""Source views: validated headers and details, brand lookup, and the
one-category product mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrid.operators import (CURRENCIES, DEFAULT_START_DATE,
                                 EXCLUDED_BRAND_CODES, PRODUCT_TYPE_CODE,
                                 REGION)

HEADER_COLUMNS = (
    "elc_master_id", "consumer_id", "brand_id", "sale_dt", "txn_id",
    "usd_net_order_total", "currency_cd", "channel_cd", "usd_product_total",
    "usd_product_discount_total", "usd_returns_total", "loyalty_trans_flag",
    "store_id", "store_num",
)

DETAIL_COLUMNS = (
    "sale_dt", "channel_cd", "elc_master_id", "consumer_id", "brand_id",
    "txn_id", "txn_detail_id", "sale_line_type", "sale_line_num",
    "src_txn_cd_desc", "net_item_qty", "usd_total_price", "usd_unit_price",
    "product_id", "product_sku", "product_desc", "master_category", "category",
    "sub_category", "subcategory_alter",
)


def _required(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """``wanted``; a column that the source lacks is an error."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"source columns missing: {', '.join(missing)}")
    return list(wanted)


def valid_headers(header: DataFrame, *, start_date: str = DEFAULT_START_DATE,
                  region: str = REGION,
                  currencies: Sequence[str] = CURRENCIES,
                  extra_columns: Sequence[str] = ()) -> DataFrame:
    """Transaction headers that count as sales.

    Conjuncts: region, entity ids not null, valid / consumer-valid / not
    pro / visit flags, positive net total, currency in the list, change code
    other than 'D' (a null code is dropped, as with SQL ``<>``), and sale
    date strictly after ``start_date``. All are simple column predicates, so
    they reach the parquet scan as pushed filters.
    """
    cond = ((F.col("cdp_region") == region)
            & F.col("elc_master_id").isNotNull()
            & F.col("consumer_id").isNotNull()
            & (F.col("valid_ind") == 1)
            & (F.col("consumer_valid_flag") == "Y")
            & (F.col("mac_pro_flag") == "N")
            & (F.col("usd_net_order_total") > 0)
            & F.col("currency_cd").isin(list(currencies))
            & (F.col("visit_ind") == 1)
            & (F.col("CDC_CODE") != "D")
            & (F.col("sale_dt") > F.lit(start_date).cast("date")))
    cols = _required(header, list(HEADER_COLUMNS) + list(extra_columns))
    return header.where(cond).select(*cols)


def valid_details(detail: DataFrame, *, start_date: str = DEFAULT_START_DATE,
                  region: str = REGION,
                  extra_columns: Sequence[str] = ()) -> DataFrame:
    """Sale lines with a positive quantity, ids and sku present, after
    ``start_date``."""
    cond = ((F.col("cdp_region") == region)
            & F.col("elc_master_id").isNotNull()
            & F.col("consumer_id").isNotNull()
            & F.col("product_sku").isNotNull()
            & (F.col("sale_line_type") == "Sale")
            & (F.col("net_item_qty") > 0)
            & (F.col("sale_dt") > F.lit(start_date).cast("date")))
    cols = _required(detail, list(DETAIL_COLUMNS) + list(extra_columns))
    return detail.where(cond).select(*cols)


def brand_lookup(brands: DataFrame, *, region: str = REGION,
                 excluded_codes: Sequence[str] = EXCLUDED_BRAND_CODES
                 ) -> DataFrame:
    """Brands of the region without the excluded brand codes (a null code is
    dropped, as with SQL ``not in``)."""
    cond = ((F.col("cdp_region") == region)
            & ~F.col("brand_cd").isin(list(excluded_codes)))
    return brands.where(cond).select("brand_id", "brand_cd", "brand_desc",
                                     "brand_name")


def single_category_mapping(products: DataFrame, *,
                            key_cols: Sequence[str] = ("sku_six_digit_identifier",),
                            category_col: str = "major_category_name",
                            type_col: str | None = "product_type_code",
                            type_code: str = PRODUCT_TYPE_CODE) -> DataFrame:
    """Keys whose products map to exactly one (non-null) category.

    Same rows as ``distinct(key, category)`` followed by keeping keys with
    ``count(*) over (partition by key) = 1``, written as one grouped
    aggregate: a key has one distinct category exactly when its minimum and
    maximum category agree. One shuffle with map-side partial aggregation,
    so a key with many product rows does not land whole in one task.
    """
    rows = products.where(F.col(category_col).isNotNull())
    if type_col is not None:
        rows = rows.where(F.col(type_col) == type_code)
    agg = rows.groupBy(*key_cols).agg(
        F.min(category_col).alias("_lo"), F.max(category_col).alias("_hi"))
    return (agg.where(F.col("_lo") == F.col("_hi"))
            .select(*key_cols, F.col("_lo").alias(category_col)))


def distinct_pairs(products: DataFrame, *,
                   key_cols: Sequence[str] = ("sku_six_digit_identifier",),
                   category_col: str = "major_category_name",
                   type_col: str | None = "product_type_code",
                   type_code: str = PRODUCT_TYPE_CODE) -> DataFrame:
    """``select distinct key, category`` over valid product rows."""
    rows = products.where(F.col(category_col).isNotNull())
    if type_col is not None:
        rows = rows.where(F.col(type_col) == type_code)
    return rows.select(*key_cols, category_col).distinct()
