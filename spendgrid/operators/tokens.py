"""Product tokens and consumer baskets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrid.operators import PRODUCT_TYPE_CODE

# Characters replaced by '_' in a token, then runs of '_'
# collapsed (the reference's two nested regexp_replace calls).
TOKEN_SEPARATORS = "[&,/ ()-]"
TOKEN_RUNS = "_+"


def product_tokens(products: DataFrame, *,
                   key_col: str = "sku_six_digit_identifier",
                   level_cols: Sequence[str] = ("major_category_name",
                                                "category_name",
                                                "sub_category_name"),
                   type_col: str | None = "product_type_code",
                   type_code: str = PRODUCT_TYPE_CODE) -> DataFrame:
    """Distinct (sku, token) with a 32-bit hash of the token.

    token = lower-cased ``level1 || '_' || level2 || '_' || level3`` with the
    separator characters turned into '_' and runs of '_' collapsed; null if
    any level is null. ``pdt_hash`` is Spark's ``hash`` (Murmur3, seed 42).
    """
    rows = products.where(F.col(level_cols[0]).isNotNull())
    if type_col is not None:
        rows = rows.where(F.col(type_col) == type_code)
    parts = []
    for i, c in enumerate(level_cols):
        if i:
            parts.append(F.lit("_"))
        parts.append(F.col(c))
    text = F.lower(F.regexp_replace(F.regexp_replace(F.concat(*parts),
                                                     TOKEN_SEPARATORS, "_"),
                                    TOKEN_RUNS, "_"))
    tokens = rows.select(key_col, text.alias("pdt_clean")).distinct()
    return tokens.withColumn("pdt_hash", F.hash("pdt_clean"))


def baskets(lines: DataFrame, *, consumer_col: str = "consumer_id",
            item_col: str = "pdt_hash", date_col: str = "sale_dt",
            before: str | None = None) -> DataFrame:
    """Per consumer: every purchased item (as text), one entry per line,
    sorted.

    Built from (consumer, item, count) first: that aggregate runs with
    map-side combine, so the per-consumer step gathers at most one entry per
    distinct item, whatever the number of lines of a heavy consumer; the
    full list with repeats is expanded per row afterwards.
    """
    rows = lines
    if before is not None:
        rows = rows.where(F.col(date_col) < F.lit(before).cast("date"))
    item = F.col(item_col).cast("string")
    rows = rows.where(item.isNotNull())  # collect_list skips nulls
    counted = (rows.groupBy(consumer_col, item.alias("_item"))
               .agg(F.count(F.lit(1)).alias("_n")))
    bag = counted.groupBy(consumer_col).agg(
        F.array_sort(F.collect_list(F.struct("_item", "_n"))).alias("_bag"))
    return bag.select(consumer_col, F.flatten(F.transform(
        "_bag", lambda e: F.array_repeat(e["_item"], e["_n"].cast("int"))))
        .alias("basket"))
