"""Star joins of transaction lines with headers, products and brands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKU_KEY = "sku_six_digit_identifier"
PRODUCT_COLUMNS = ("product_desc", "master_category", "category",
                   "sub_category", "subcategory_alter")


def unique_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df`` as the right side of a join that must not multiply rows: a key
    that occurs twice fails the job while it runs, before any output is made
    visible. Rows are grouped by the join's own keys, so the join reads the
    grouped rows where they are. Rows with a null key cannot match and go."""
    rest = [c for c in df.columns if c not in keys]
    present = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    row = F.first(F.struct(*rest)) if rest else F.lit(None)
    grouped = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"), row.alias("_row"))
    repeated = F.raise_error(F.concat(F.lit(f"{name}: repeated key "), F.concat_ws("|", *[F.col(k).cast("string") for k in keys])))
    once = grouped.where(F.when(F.col("_times") > 1, repeated.cast("boolean")).otherwise(F.lit(True)))
    return once.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def _line_lookups(details: DataFrame, mapping: DataFrame, brands: DataFrame,
                  sku_len: int) -> DataFrame:
    """Lines joined to the brand lookup and the sku mapping (both inner, so
    both also filter). The small dimensions go first so the big join with
    the headers sees only surviving lines; Spark broadcasts a dimension only
    when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
    and falls back to a shuffle join otherwise."""
    lines = details.withColumn(
        SKU_KEY, F.substring("product_sku", 1, sku_len))
    lines = lines.join(unique_keys(brands.select("brand_id"), ["brand_id"], "brand lookup"), "brand_id", "inner")
    return lines.join(mapping, SKU_KEY, "inner")


def hot_keys(facts: DataFrame, key: str, *, share: float = 0.01) -> list:
    """Keys that hold at least ``share`` of the rows, most frequent first: at
    most ``2 / share`` candidates of a fixed-size frequency sketch (one
    aggregate pass), those above the bound kept. Nulls are no key."""
    if share <= 0:
        return []
    k = int(2 / share)
    rows = facts.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({key}, {k}, {max(10_000, 10 * k)})").alias("top")).first()
    return [r["item"] for r in rows["top"] or [] if r["count"] >= share * rows["n"]]


def dimension_join(facts: DataFrame, dim: DataFrame, key: str, *, hot: Sequence | None = (), salt: int = 64) -> DataFrame:
    """Left join of a dimension with unique ``key`` that neither null nor hot
    keys gather in one task.

    The join is on the key and a salt. Rows without a key cannot match; their
    salt spreads them. Rows of a ``hot`` key are dealt to ``salt`` copies of its
    dimension row; all other rows have the one copy. ``hot=None`` finds the keys
    by :func:`hot_keys`, one pass over ``facts``, which should then be a written
    table; what it does not find is left to Spark's splitting of skewed
    partitions. ``facts`` is read once. Where Spark measures the dimension as
    small it broadcasts it, and the salt does no harm.
    """
    hot = hot_keys(facts, key) if hot is None else list(hot)
    added = [c for c in dim.columns if c != key]
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    # a row's salt follows from its own values, so a task that runs again deals alike
    own = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(salt)).cast("int")
    row_salt = F.when(F.col(key).isNull() | is_hot, own).otherwise(0)
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salt - 1))).otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))
    j = facts.withColumn("_salt", row_salt).join(dim.withColumn("_salt", F.explode(copies)), [key, "_salt"], "left")
    return j.select(*facts.columns, *added)


def sales_details(details: DataFrame, headers: DataFrame, mapping: DataFrame,
                  brands: DataFrame, *, sku_len: int = 6,
                  category_col: str = "major_category_name",
                  header_columns: Sequence[str] = (),
                  line_columns: Sequence[str] = ()) -> DataFrame:
    """Sale lines with their major category and header amount.

    Inner joins: line -> header on ``txn_id``; ``substr(product_sku, 1, 6)``
    -> the one-category sku mapping; line brand -> brand lookup. Keys of the
    right sides are unique, or the job fails. The
    computed key is projected once, so the join stays an equi-join.
    ``header_columns`` and ``line_columns`` carry extra fields along.
    """
    once = unique_keys(mapping.select(SKU_KEY, category_col), [SKU_KEY], "category mapping")
    lines = _line_lookups(details, once, brands, sku_len)
    h = unique_keys(headers.select("txn_id", F.col("usd_net_order_total").alias("header_sales_amount"), *header_columns),
                    ["txn_id"], "transaction headers")
    j = lines.join(h, "txn_id", "inner")
    return j.select(
        "sale_dt", "channel_cd", "txn_id", "elc_master_id", "consumer_id",
        "brand_id", F.col(category_col).alias("major_category"),
        "header_sales_amount", "txn_detail_id", "sale_line_type",
        "sale_line_num", "src_txn_cd_desc", "net_item_qty",
        F.col("usd_total_price").alias("sales_amount"), "usd_unit_price",
        "product_id", "product_sku", *PRODUCT_COLUMNS, *line_columns, *header_columns)


def token_details(details: DataFrame, headers: DataFrame, tokens: DataFrame,
                  brands: DataFrame, *, sku_len: int = 6) -> DataFrame:
    """Sale lines with their product token (same joins as
    :func:`sales_details`, token lookup instead of the category mapping)."""
    lines = _line_lookups(details, tokens.select(SKU_KEY, "pdt_clean", "pdt_hash"),
                          brands, sku_len)
    j = lines.join(unique_keys(headers.select("txn_id"), ["txn_id"], "transaction headers"), "txn_id", "inner")
    return j.select(
        "sale_dt", "txn_id", "elc_master_id", "consumer_id", "pdt_clean",
        "pdt_hash", "txn_detail_id", "sale_line_type", "sale_line_num",
        "src_txn_cd_desc", "net_item_qty",
        F.col("usd_total_price").alias("sales_amount"), "usd_unit_price",
        "product_id", "product_sku", "product_desc")
