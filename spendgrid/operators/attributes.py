"""Attribute tables per entity key and snapshot month, and the wide master
table.

The reference declares the behaviour-ratio and store tables and joins them
into the master table, but never fills them; the formulas here are ours
including the snapshot month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendgrid.functions.dates import month_start
from spendgrid.functions.money import to_units
from spendgrid.operators import CATEGORIES, ENTITY_KEYS, REGION
from spendgrid.operators.joins import dimension_join, unique_keys
from spendgrid.operators.monthly import with_month
from spendgrid.operators.snapshot import (SNAPSHOT, SPAN_FROM, expand, running_columns,
                                           snapshot_columns, sparse_running, spans)

# Channels with a transaction-share ratio.
RATIO_CHANNELS = {"fss": "FSS", "mobile": "MOBILE", "web": "WEB", "tablet": "TABLET"}
RETURN_LINE = "RETURN"


def _txn_month_flags(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, month, transaction) with its flags and amounts.
    Counting transactions this way (instead of several count-distincts)
    avoids Spark's Expand, which would copy every line once per distinct
    aggregate."""
    is_ret = F.col("src_txn_cd_desc") == RETURN_LINE
    q4 = F.quarter("sale_dt") == 4
    amt = to_units(F.col("sales_amount"))
    aggs = [F.max(F.when(F.col("channel_cd") == v, 1).otherwise(0)).alias(f"_{k}")
            for k, v in RATIO_CHANNELS.items()]
    aggs += [
        F.max(F.when(F.col("loyalty_trans_flag") == "Y", 1).otherwise(0)).alias("_loyal"),
        F.max(F.when(is_ret, 1).otherwise(0)).alias("_ret"),
        F.sum(amt).alias("_sales"),
        F.sum(to_units(F.col("usd_discount_amount"))).alias("_disc"),
        F.sum(F.when(q4, amt).otherwise(0)).alias("_q4"),
    ]
    return with_month(sales).groupBy(*keys, "sale_month", "txn_id").agg(*aggs)


def ratio_monthly(sales: DataFrame, *, keys: Sequence[str] = ENTITY_KEYS,
                  sales_before: str | None = None) -> DataFrame:
    """Per key and month: transactions, transactions per channel / with the
    loyalty flag / with a returned line, and sales, discount and Q4 amounts."""
    rows = sales
    if sales_before is not None:
        rows = rows.where(F.col("sale_dt") < F.lit(sales_before).cast("date"))
    per_txn = _txn_month_flags(rows, keys)
    flag_cols = [f"_{k}" for k in RATIO_CHANNELS] + ["_loyal", "_ret"]
    return per_txn.groupBy(*keys, "sale_month").agg(
        F.count(F.lit(1)).alias("_txn"),
        *[F.sum(c).alias(c) for c in flag_cols],
        *[F.sum(c).alias(c) for c in ("_sales", "_disc", "_q4")])


def ratio_carry(keys: Sequence[str] = ENTITY_KEYS) -> dict:
    """Running ratios over the months of :func:`ratio_monthly` (evaluated on
    months with transactions, carried over the gaps)."""
    run = sparse_running(keys)

    def ratio(num, den):
        return F.try_divide(F.sum(num).over(run).cast("double"),
                            F.sum(den).over(run).cast("double"))

    carry = {f"{k}_txn_ratio": ratio(f"_{k}", "_txn") for k in RATIO_CHANNELS}
    carry.update({"discount_ratio": ratio("_disc", "_sales"),
                  "sales_q4_ratio": ratio("_q4", "_sales"),
                  "loyalty_txn_ratio": ratio("_loyal", "_txn"),
                  "return_txn_ratio": ratio("_ret", "_txn")})
    return carry


def ratio_spans(sales: DataFrame, *, calendar_start, calendar_end,
                keys: Sequence[str] = ENTITY_KEYS,
                sales_before: str | None = None,
                partition_by: Sequence[str] | None = None) -> DataFrame:
    """The sparse form of :func:`ratio_attributes`: one row per key and month
    with sales (:func:`~spendgrid.operators.snapshot.spans`)."""
    return spans(ratio_monthly(sales, keys=keys, sales_before=sales_before),
                 calendar_start=calendar_start, calendar_end=calendar_end,
                 keys=keys, partition_by=partition_by, carry=ratio_carry(keys))


def ratio_attributes(sales: DataFrame, *, calendar_start, calendar_end,
                     keys: Sequence[str] = ENTITY_KEYS,
                     sales_before: str | None = None,
                     partition_by: Sequence[str] | None = None) -> DataFrame:
    """Behaviour ratios per key and snapshot month, over all sale lines up
    to that month: share of transactions per channel (fss, mobile, web,
    tablet), with the loyalty flag, and with a returned line; discount
    amount / sales amount; Q4 sales / all sales. Null when undefined.

    ``sales`` are sale lines with keys, sale_dt, txn_id, channel_cd,
    loyalty_trans_flag, src_txn_cd_desc, sales_amount, usd_discount_amount.
    The running ratios change only in months with transactions: evaluated on
    those rows and carried over the gaps, no window over the dense grid.
    """
    sparse = ratio_spans(sales, calendar_start=calendar_start, calendar_end=calendar_end,
                         keys=keys, sales_before=sales_before, partition_by=partition_by)
    return expand(sparse).select(F.col("dt").alias(SNAPSHOT), *keys, *RATIO_COLUMNS)


STORE_COLUMNS = ("store_channel", "store_market_cd", "store_name",
                 "store_brand_cd", "store_region", "store_sub_region",
                 "store_state_prov_cd", "store_city", "store_postal_cd",
                 "store_latitude", "store_longitude", "store_status_cd")


def store_leaders(sales: DataFrame, stores: DataFrame, *,
                  keys: Sequence[str] = ENTITY_KEYS,
                  sales_before: str | None = None, store_col: str = "store_id",
                  partition_by: Sequence[str] | None = None) -> DataFrame:
    """Per key and month with sales: the most frequent store so far (most
    transactions, ties to the lowest id) with its descriptors, as a struct
    ``_store`` (null before the first visit).

    No per-month re-count over all stores: per (key, store) a running
    transaction count is kept; the leader at a month is the running maximum
    of (count, -store id) over all of the key's (store, month) rows up to
    that month, since a store's latest count is its largest.
    """
    rows = sales
    if sales_before is not None:
        rows = rows.where(F.col("sale_dt") < F.lit(sales_before).cast("date"))
    month = month_start(F.col("sale_dt"))
    store = F.col(store_col)
    # transactions per (key, store, month); lines without a store stay as
    # rows with a null store, so every month with sales anchors the grid
    visits = (rows.groupBy(*keys, store.alias(store_col), month.alias("sale_month"))
              .agg(F.countDistinct("txn_id").alias("_n")))
    # one exchange of the aggregated visits; both windows and the leader
    # aggregate below partition on supersets of these columns and reuse it
    visits = visits.repartition(*(partition_by or keys))
    per_store = Window.partitionBy(*keys, store_col).orderBy("sale_month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    upto_month = Window.partitionBy(*keys).orderBy("sale_month").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = visits.withColumn("_cum", F.sum("_n").over(per_store))
    lead = F.max(F.when(store.isNotNull(), F.struct(
        F.col("_cum"), (-store).alias("_neg")))).over(upto_month)
    leaders = (ranked.select(*keys, "sale_month", lead.alias("_lead"))
               .groupBy(*keys, "sale_month").agg(F.max("_lead").alias("_lead")))
    # descriptors go onto the sparse leader rows (one per key and month with
    # sales), so the dense grid needs no dimension join
    dim = unique_keys(stores.select(F.col(store_col).alias("_sid"), *STORE_COLUMNS), ["_sid"], "store dimension")
    # a month before the first visit has no store: it stays out of the join
    return (dimension_join(leaders.withColumn("_sid", -F.col("_lead._neg")), dim, "_sid", hot=())
            .select(*keys, "sale_month", F.when(
                F.col("_sid").isNotNull(),
                F.struct(F.col("_sid").alias("most_freq_store_id"),
                         *[F.col(c) for c in STORE_COLUMNS])).alias("_store")))


def store_carry(keys: Sequence[str] = ENTITY_KEYS) -> dict:
    """The leader holds until the next month with sales."""
    return {"_store_now": F.last("_store", ignorenulls=True).over(sparse_running(keys))}


def store_spans(sales: DataFrame, stores: DataFrame, *, calendar_start,
                calendar_end, keys: Sequence[str] = ENTITY_KEYS,
                sales_before: str | None = None,
                store_col: str = "store_id",
                partition_by: Sequence[str] | None = None) -> DataFrame:
    """The sparse form of :func:`store_attributes`: one row per key and month
    with sales, the store in ``_store_now``."""
    anchors = store_leaders(sales, stores, keys=keys, sales_before=sales_before,
                            store_col=store_col, partition_by=partition_by)
    return spans(anchors, calendar_start=calendar_start,
                 calendar_end=calendar_end, keys=keys, columns=["_store"],
                 carry=store_carry(keys), carry_history=True,
                 partition_by=partition_by or keys)


def store_attributes(sales: DataFrame, stores: DataFrame, *, calendar_start,
                     calendar_end, keys: Sequence[str] = ENTITY_KEYS,
                     sales_before: str | None = None,
                     store_col: str = "store_id",
                     partition_by: Sequence[str] | None = None) -> DataFrame:
    """Most frequent store per key and snapshot month (most transactions up
    to that month, all history; ties go to the lowest store id) with the
    store's descriptors. Leaders come from :func:`store_leaders` and are
    carried over the months without sales by the grid expansion -- no window
    over the dense grid."""
    sparse = store_spans(sales, stores, calendar_start=calendar_start, calendar_end=calendar_end,
                         keys=keys, sales_before=sales_before, store_col=store_col, partition_by=partition_by)
    return expand(sparse).select(F.col("dt").alias(SNAPSHOT), *keys,
                                 "_store_now.most_freq_store_id",
                                 *[f"_store_now.{c}" for c in STORE_COLUMNS])


# The output columns taken from the consumer tables, in order.
CV_COLUMNS = ("ethnic_group", "gender", "language", "marital_status",
              "occupation_group", "mosaic_segment", "mosaic_group", "age_range",
              "ethnicity_detail", "income")
CA_COLUMNS = (
    "country_cd", "state_cd", "lang_cd", "email_opt_in_ind", "phone_opt_in_ind",
    "city", "zip_code", "dm_opt_in_ind", "mobile_contactable_ind",
    "first_store_id", "last_store_id", "closest_store", "most_frequent_store",
    "first_channel", "deceased_flag", "prison_flag", "mobile_opt_in_ind",
    "dm_state", "dm_country")
# those of them that the output holds as int
CA_INTS = {"email_opt_in_ind", "phone_opt_in_ind", "dm_opt_in_ind",
           "mobile_contactable_ind", "first_store_id", "last_store_id",
           "closest_store", "most_frequent_store", "mobile_opt_in_ind"}
RATIO_COLUMNS = tuple(f"{k}_txn_ratio" for k in RATIO_CHANNELS) + (
    "discount_ratio", "sales_q4_ratio", "loyalty_txn_ratio", "return_txn_ratio")


def consumer_variables_for(cv: DataFrame, region: str = REGION) -> DataFrame:
    """Right side of the consumer-variables join: the ON-clause filters
    (region, change code other than 'D') applied before the left join, which
    gives the same rows as filtering inside ON."""
    return cv.where((F.col("cdp_region") == region) & (F.col("CDC_CODE") != "D"))


def consumer_attributes_for(ca: DataFrame, region: str = REGION) -> DataFrame:
    return ca.where(F.col("cdp_region") == region)


def with_consumer_variables(df: DataFrame, cv: DataFrame,
                            region: str = REGION) -> DataFrame:
    right = consumer_variables_for(cv, region).select(
        F.col("elc_master_id").alias("_cv_id"), *CV_COLUMNS, "birth_year")
    right = unique_keys(right, ["_cv_id"], "consumer variables")
    j = df.join(right, df["elc_master_id"] == right["_cv_id"], "left")
    return j.drop("_cv_id")


def with_exists_flag(df: DataFrame, ca: DataFrame, region: str = REGION,
                     columns: Sequence[str] = ()) -> DataFrame:
    """Left join of the consumer attributes on (entity, consumer) with an
    ``exists_in_cdp`` 'Y'/'N' flag from the right key."""
    right = consumer_attributes_for(ca, region).select(
        F.col("elc_master_id").alias("_ca_id"),
        F.col("consumer_id").alias("_ca_consumer"), *columns)
    right = unique_keys(right, ["_ca_id", "_ca_consumer"], "consumer attributes")
    j = df.join(right, (df["elc_master_id"] == right["_ca_id"])
                & (df["consumer_id"] == right["_ca_consumer"]), "left")
    j = j.withColumn("exists_in_cdp",
                     F.when(F.col("_ca_consumer").isNotNull(), "Y").otherwise("N"))
    return j.drop("_ca_id", "_ca_consumer")


def _join_people(df: DataFrame, cv: DataFrame, ca: DataFrame, region: str) -> DataFrame:
    return with_exists_flag(with_consumer_variables(df, cv, region), ca, region, columns=CA_COLUMNS)


def _master_columns(base_cols: Sequence[str]) -> list:
    """Consumer variables, age, CDP attributes (indicator and store columns
    as int), then the ratio and store columns."""
    out = [F.col(c) for c in base_cols]
    out += [F.col(c) for c in CV_COLUMNS]
    out.append((F.year(SNAPSHOT) - F.col("birth_year")).alias("age"))
    out.append(F.col("exists_in_cdp"))
    out += [F.expr(f"try_cast({c} as int)").alias(c) if c in CA_INTS else F.col(c)
            for c in CA_COLUMNS]
    out += [F.col(c) for c in RATIO_COLUMNS]
    return out + [F.col("most_freq_store_id"), *[F.col(c) for c in STORE_COLUMNS]]


def _with_people(df: DataFrame, cv: DataFrame, ca: DataFrame, *, region: str,
                 base_cols: Sequence[str]) -> DataFrame:
    """The master columns of ``df``, which has the ratio and store columns."""
    return _join_people(df, cv, ca, region).select(*_master_columns(base_cols))


def _expand_master(sparse: DataFrame, cv: DataFrame, ca: DataFrame, *, keys: Sequence[str],
                   categories: Sequence[str], region: str) -> DataFrame:
    """Master rows of spans that carry the snapshot's running values, the
    ratios and ``_store_now``. What holds for a key is joined to its spans, so
    the grid's rows are the output's and are made last."""
    # text to number once for each span, not for each month of it
    people = _join_people(sparse, cv, ca, region)
    people = people.select(*[F.expr(f"try_cast({c} as int)").alias(c) if c in CA_INTS else F.col(c) for c in people.columns])
    snap_cols = snapshot_columns(keys=keys, last_categories=categories)
    rest = [*CV_COLUMNS, "birth_year", "exists_in_cdp", *CA_COLUMNS, *RATIO_COLUMNS, "_store_now.most_freq_store_id",
            *[F.col(f"_store_now.{c}").alias(c) for c in STORE_COLUMNS]]
    rows = expand(people).select(*snap_cols, *rest)
    return rows.select(*_master_columns(rows.columns[:len(snap_cols)]))


def master_table(snapshot: DataFrame, cv: DataFrame, ca: DataFrame,
                 ratios: DataFrame, stores: DataFrame, *,
                 keys: Sequence[str] = ENTITY_KEYS,
                 region: str = REGION) -> DataFrame:
    """Snapshot with consumer variables, age, CDP attributes (indicator and
    store columns as int), behaviour ratios and store attributes -- all left
    joins, so every snapshot row stays. (For tables built from the same sale
    lines, :func:`master_table_from_spans` gives the same rows without joins of
    grids.)"""
    jk = [*keys, SNAPSHOT]
    # 1:1 joins of frames as large as the snapshot: never broadcast (AQE
    # could pick a broadcast from the compressed shuffle size); grids built
    # with the same partition_by are co-partitioned, so the merge join reads
    # them in place.
    df = snapshot.join(ratios.select(*jk, *RATIO_COLUMNS).hint("merge"), jk, "left")
    df = df.join(stores.select(*jk, "most_freq_store_id", *STORE_COLUMNS).hint("merge"),
                 jk, "left")
    return _with_people(df, cv, ca, region=region, base_cols=snapshot.columns)


def master_rows(snapshot: DataFrame, ratios: DataFrame, leaders: DataFrame, stores: DataFrame,
                cv: DataFrame, ca: DataFrame, *, keys: Sequence[str] = ENTITY_KEYS,
                region: str = REGION) -> DataFrame:
    """Master rows of a single month from frames with one row per key:
    snapshot rows, ratios and ``most_freq_store_id``; left joins throughout."""
    dim = unique_keys(stores.select(F.col("store_id").alias("most_freq_store_id"), *STORE_COLUMNS), ["most_freq_store_id"], "store dimension")
    # stores meet the leaders, so the wide rows are not dealt by store
    described = dimension_join(leaders.select(*keys, "most_freq_store_id"), dim, "most_freq_store_id")
    df = snapshot.join(ratios.select(*keys, *RATIO_COLUMNS), list(keys), "left")
    df = df.join(described, list(keys), "left")
    return _with_people(df, cv, ca, region=region, base_cols=snapshot.columns)


def master_table_from_parts(monthly: DataFrame, ratio_rows: DataFrame,
                            leader_rows: DataFrame, cv: DataFrame, ca: DataFrame, *,
                            calendar_start, calendar_end,
                            keys: Sequence[str] = ENTITY_KEYS,
                            categories: Sequence[str] | None = None,
                            region: str = REGION,
                            partition_by: Sequence[str] | None = None) -> DataFrame:
    """The master table in one grid expansion: same rows and columns as
    :func:`master_table` over :func:`~spendgrid.operators.snapshot.snapshot`,
    :func:`ratio_attributes` and :func:`store_attributes` of the same sale
    lines.

    The three grids share their (key, month) anchor rows -- the months with
    sales -- so their sparse inputs are joined on those rows (one row per key
    and month with sales) and expanded once, carrying the snapshot's running
    values, the running ratios and the store leader together. This replaces
    two 1:1 joins of calendar-sized grids by joins of purchase-month rows.
    """
    jk = [*keys, "sale_month"]
    sparse = (monthly.join(ratio_rows, jk, "left")
              .join(leader_rows, jk, "left"))
    carry = {**running_columns(keys=keys), **ratio_carry(keys), **store_carry(keys)}
    fact_cols = [c for c in sparse.columns if c not in set(jk) | {"etl_date"}]
    sparse = spans(sparse, calendar_start=calendar_start, calendar_end=calendar_end,
                   keys=keys, columns=fact_cols, carry=carry,
                   carry_history=["_store"], partition_by=partition_by)
    return _expand_master(sparse, cv, ca, keys=keys, categories=tuple(categories or CATEGORIES), region=region)


def master_table_from_spans(snapshot_spans: DataFrame, ratios: DataFrame, stores: DataFrame,
                            cv: DataFrame, ca: DataFrame, *, keys: Sequence[str] = ENTITY_KEYS,
                            categories: Sequence[str] | None = None,
                            region: str = REGION) -> DataFrame:
    """The master table from the sparse forms of its tables: same rows and
    columns as :func:`master_table` over the expanded ones, if all are of the
    same sale lines (a key then has the same spans in each). The joins are of
    rows per month with sales; the grid is made once, after them."""
    jk = [*keys, SPAN_FROM]
    sparse = (snapshot_spans.join(ratios.select(*jk, *RATIO_COLUMNS).hint("merge"), jk, "left")
              .join(stores.select(*jk, "_store_now").hint("merge"), jk, "left"))
    return _expand_master(sparse, cv, ca, keys=keys, categories=tuple(categories or CATEGORIES), region=region)
