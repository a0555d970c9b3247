"""Monthly summary per entity key (the fact table the snapshot reads)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrid.functions.dates import month_start
from spendgrid.functions.money import from_units, to_units
from spendgrid.operators import CATEGORIES, ENTITY_KEYS, category_prefix

MONTH = "sale_month"


def with_month(sales: DataFrame, date_col: str = "sale_dt") -> DataFrame:
    """``sales`` with their month; rows that have it keep it, so rows dealt by
    their keys and month are grouped where they are."""
    return sales if MONTH in sales.columns else sales.withColumn(MONTH, month_start(F.col(date_col)))


def monthly_summary(sales: DataFrame, *,
                    keys: Sequence[str] = ENTITY_KEYS,
                    categories: Sequence[str] = CATEGORIES,
                    sales_before: str | None = None,
                    etl_ts: _dt.datetime | None = None,
                    date_col: str = "sale_dt", amount_col: str = "sales_amount",
                    txn_col: str = "txn_id",
                    category_col: str = "major_category") -> DataFrame:
    """Group sale lines by (month, keys): amount, distinct transactions,
    line count, and one amount column per category (0 when none).

    ``sales_before`` is the exclusive upper sale-date bound; ``etl_ts``
    stamps the rows (the reference's ``now()``) when given.

    Scale: the grouping key includes the month, so a customer with a third
    of all lines still spreads over one group per month, and map-side
    partial aggregation shrinks every group before the shuffle. The distinct
    transaction count is planned by Spark as a (keys, month, txn) aggregate
    followed by a partial count, so it needs no per-group set either.
    """
    rows = sales
    if sales_before is not None:
        rows = rows.where(F.col(date_col) < F.lit(sales_before).cast("date"))
    units = to_units(F.col(amount_col))
    aggs = [
        from_units(F.sum(units)).alias("sales_amount"),
        F.countDistinct(txn_col).alias("txn_cnt"),
        F.count(F.lit(1)).alias("item_cnt"),
    ]
    for cat in categories:
        aggs.append(from_units(F.sum(
            F.when(F.col(category_col) == cat, units).otherwise(F.lit(0))
        )).alias(f"{category_prefix(cat)}_amount"))
    out = with_month(rows, date_col).groupBy(MONTH, *keys).agg(*aggs)
    if etl_ts is not None:
        out = out.withColumn("etl_date", F.lit(etl_ts).cast("timestamp"))
        out = out.select(MONTH, "etl_date",
                         *[c for c in out.columns if c not in (MONTH, "etl_date")])
    return out


def first_month(monthly: DataFrame, *, keys: Sequence[str] = ENTITY_KEYS,
                month_col: str = MONTH) -> DataFrame:
    """First purchase month per key."""
    return monthly.groupBy(*keys).agg(F.min(month_col).alias("min_sale_month"))
