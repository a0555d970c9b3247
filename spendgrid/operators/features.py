"""Incremental feature refresh: timeline, evaluation period, cold start,
duplicate checks, latest-row inference input and point-in-time lookup."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import Window

from spendgrid.functions.dates import add_months, literal_of

# ------------------------------------------------------------------- periods


def latest_earliest(df: DataFrame, col: str) -> DataFrame:
    """One row: latest and earliest value of ``col``."""
    return df.agg(F.max(col).alias("latest"), F.min(col).alias("earliest"))


def timeline_frame(df: DataFrame, ts_col: str, targets_months: int,
                   features_months: int) -> DataFrame:
    """One row: the latest transaction, and end and start of the training
    feature window before it. ``ts - interval n month`` clamps to the month
    end and keeps the time; a date counts as its midnight."""
    last = F.max(F.col(ts_col).cast("timestamp_ntz"))
    end = last - F.expr(f"interval {int(targets_months)} month")
    return df.agg(last.alias("latest_txn_ts"), end.alias("training_end_ts"),
                  (end - F.expr(f"interval {int(features_months)} month"))
                  .alias("training_start_ts"))


def eval_period(timeline: Row, features_months: int, *, training: bool,
                interactive: bool = False, table_exists: bool = True
                ) -> tuple[_dt.datetime, _dt.datetime]:
    """(start, end] of the feature evaluation period; ``timeline`` is the row
    of :func:`timeline_frame`.

    It ends with the training window where a training dataset is made, and in
    an interactive run that finds no feature table yet; else with the latest
    transaction. Training datasets are not made interactively.
    """
    if training and interactive:
        raise RuntimeError("a training dataset is made by a job, not interactively")
    first_build = interactive and not table_exists
    end = timeline["training_end_ts" if training or first_build else "latest_txn_ts"]
    return add_months(end, -features_months), end


def period_rows(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Rows with ``start < ts <= end`` (literal bounds: pushed to the scan)."""
    ts = F.col(ts_col)
    dtype = df.schema[ts_col].dataType
    return df.where((ts > literal_of(start, dtype)) & (ts <= literal_of(end, dtype)))


def register_period_view(df: DataFrame, view: str, ts_col: str, start,
                         end) -> DataFrame:
    """Period rows registered as a temporary view named ``view``."""
    out = period_rows(df, ts_col, start, end)
    out.createOrReplaceTempView(view)
    return out


# ---------------------------------------------------------------- cold start


def cold_start_frame(df: DataFrame | None, ts_col: str, target_ts) -> DataFrame | bool:
    """Cold start unless the feature table has a row updated at or before
    the target's update time. ``None`` (no table) is always cold."""
    if df is None:
        return True
    first = F.min(F.col(ts_col))
    target = literal_of(target_ts, df.schema[ts_col].dataType)
    return df.agg(first.alias("earliest_update"),
                  (first.isNull() | (first > target)).alias("cold_start"))


def is_cold_start(df: DataFrame | None, ts_col: str, target_ts) -> bool:
    res = cold_start_frame(df, ts_col, target_ts)
    if isinstance(res, bool):
        return res
    return bool(res.first()["cold_start"])


# ---------------------------------------------------------------- duplicates


class DuplicatesExceeded(ValueError):
    pass


def duplicate_profile(df: DataFrame, id_cols: str | Sequence[str]) -> DataFrame:
    """One row: rows, distinct non-null ids, rows with a null id, and the
    duplicate ratio ``1 - distinct / rows`` (0 for an empty frame)."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    any_null = None
    for c in ids:
        cond = F.col(c).isNull()
        any_null = cond if any_null is None else (any_null | cond)
    n = F.count(F.lit(1))
    distinct = F.count_distinct(*[F.col(c) for c in ids])
    return df.agg(
        n.alias("total_rows"), distinct.alias("unique_ids"),
        F.sum(F.when(any_null, 1).otherwise(0)).alias("null_ids"),
        F.coalesce(F.lit(1.0) - F.try_divide(distinct.cast("double"),
                                             n.cast("double")),
                   F.lit(0.0)).alias("duplicate_ratio"))


def check_duplicates(df: DataFrame, id_cols, threshold: float = 0.01) -> dict:
    """Raise :class:`DuplicatesExceeded` above ``threshold``; one job."""
    row = duplicate_profile(df, id_cols).first().asDict()
    if row["duplicate_ratio"] > threshold:
        raise DuplicatesExceeded(
            f"{row['unique_ids']} ids in {row['total_rows']} rows: a share of "
            f"{row['duplicate_ratio']:.4f} repeats an id, {threshold} is allowed")
    return row


def keep_one_per_id(df: DataFrame, id_cols: str | Sequence[str],
                    order_cols: Sequence[str]) -> DataFrame:
    """One row per id: the row with the greatest ``order_cols`` (then the
    greatest remaining values, so the choice is deterministic).

    A grouped ``max`` over a struct instead of ``row_number()`` over a window:
    partial aggregation runs before the shuffle, so an id with a third of all
    rows is reduced map-side and never sorted in one task.
    """
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    rest = [c for c in df.columns if c not in ids]
    best = F.max(F.struct(*[F.col(c) for c in order_cols],
                          F.struct(*[F.col(c) for c in rest]).alias("row")))
    return (df.groupBy(*ids).agg(best.alias("_b"))
            .select(*ids, *[F.col(f"_b.row.{c}").alias(c) for c in rest]))


def deduplicate(df: DataFrame, id_cols: str | Sequence[str],
                order_cols: Sequence[str] = (), threshold: float = 0.01) -> DataFrame:
    """One row per id, provided that few enough rows repeat one."""
    check_duplicates(df, id_cols, threshold)
    return keep_one_per_id(df, id_cols, order_cols)


# ------------------------------------------------------- inference / lookups


def inference_input(features: DataFrame, id_col: str, ts_col: str) -> DataFrame:
    """Ids of the latest update, with that timestamp attached as a literal
    (one aggregate job, then a pushed-down equality filter)."""
    ts = literal_of(latest_earliest(features, ts_col).first()["latest"],
                    features.schema[ts_col].dataType)
    return (features.where(F.col(ts_col) == ts).select(id_col)
            .withColumn(ts_col, ts))


def as_of_join(spine: DataFrame, features: DataFrame, *, keys: Sequence[str],
               spine_ts: str, feature_ts: str,
               feature_cols: Sequence[str] | None = None,
               bucket: str = "day") -> DataFrame:
    """Point-in-time lookup: each spine row gets the feature row of the same
    keys with the latest ``feature_ts <= spine_ts`` (nulls when none, and
    where a key is null, as in a join).

    No pairs are formed. Spine and feature rows are unioned and ordered in
    time; within a (keys, time bucket) partition a running
    ``last(..., ignorenulls)`` carries the latest feature row forward, and
    the last feature row of every earlier bucket is handed in through a
    small per-bucket aggregate. Partitioning by the time bucket as well as
    the keys splits a key with a third of all rows into many tasks.
    """
    keys = list(keys)
    if feature_cols is None:
        feature_cols = [c for c in features.columns if c not in set(keys) | {feature_ts}]
    unit = bucket

    def bkt(c: Column) -> Column:
        return F.date_trunc(unit, c)

    payload = F.struct(F.col(feature_ts).alias("_fts"),
                       *[F.col(c) for c in feature_cols])
    f_rows = features.select(*keys, F.col(feature_ts).alias("_t"),
                             F.lit(1).alias("_kind"), payload.alias("_p"))
    s_cols = [c for c in spine.columns]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    unmatched, spine = spine.where(no_key), spine.where(~no_key)
    f_rows = f_rows.where(~no_key)
    s_rows = spine.select(*keys, F.col(spine_ts).alias("_t"),
                          F.lit(2).alias("_kind"),
                          F.lit(None).cast(f_rows.schema["_p"].dataType).alias("_p"),
                          F.struct(*[F.col(c) for c in s_cols]).alias("_s"))
    f_rows = f_rows.withColumn("_s", F.lit(None).cast(s_rows.schema["_s"].dataType))
    rows = f_rows.unionByName(s_rows).withColumn("_b", bkt(F.col("_t")))

    # latest feature row per (keys, bucket) -- null for buckets holding only
    # spine rows -- then carried into every later bucket
    last_in_bucket = rows.groupBy(*keys, "_b").agg(F.max(
        F.when(F.col("_kind") == 1, F.struct("_t", "_p"))).alias("_lb"))
    prev = Window.partitionBy(*keys).orderBy("_b").rowsBetween(
        Window.unboundedPreceding, -1)
    carry = last_in_bucket.select(
        *keys, "_b", F.last("_lb", ignorenulls=True).over(prev).alias("_carry"))

    within = (Window.partitionBy(*keys, "_b").orderBy("_t", "_kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (rows.select(*keys, "_b", "_kind", "_s",
                         F.last("_p", ignorenulls=True).over(within).alias("_hit"))
             .where(F.col("_kind") == 2))
    joined = found.join(carry, [*keys, "_b"], "left")
    best = F.coalesce(F.col("_hit"), F.col("_carry._p"))
    out = joined.select(*[F.col(f"_s.{c}").alias(c) for c in s_cols],
                        best["_fts"].alias(feature_ts),
                        *[best[c].alias(c) for c in feature_cols])
    return out.unionByName(unmatched.select(*s_cols), allowMissingColumns=True)
