"""Named queries over the driver's test tables (``queries()`` and
``oracle_sql()`` in ``__spark_entry__``).

Each Spark query reads the whole test tables through the adapter and runs
library operators; each oracle entry is the DuckDB restatement.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid import oracle as O
from spendgrid.functions import lifetime as lt
from spendgrid.operators import attributes as attr
from spendgrid.operators import features as feat
from spendgrid.operators import filters as flt
from spendgrid.operators import matrix as mx
from spendgrid.operators import metrics as met
from spendgrid.operators import model as ml
from spendgrid.operators import sampling as smp
from spendgrid.operators import snapshot as snap
from spendgrid.operators import tokens as tok
from spendgrid.operators.encoding import Vocabulary
from spendgrid.operators.joins import token_details
from spendgrid.operators.monthly import first_month
from spendgrid.plans import preparation as prep
from spendgrid.plans.stored import StoredRun
from spendgrid.session import shared_checkpoint_dir
from spendgrid.sources import store, testdata
from spendgrid.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def query_table() -> dict[str, Query]:
    return _QUERIES


def oracle_table() -> dict[str, str]:
    return _ORACLE


def _setup(spark: SparkSession) -> None:
    # Test tables hold naive timestamps; fix the zone for date arithmetic.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # joins between grids partitioned by the entity id reuse that partitioning
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    shared_checkpoint_dir(spark)


def _src(spark: SparkSession, base: str) -> prep.Sources:
    _setup(spark)
    return prep.test_sources(spark, base)


P = prep.TEST_PARAMS

# ---------------------------------------------------------------- snapshot


@register("sales_details", O.with_sales(
    "SELECT sale_dt, txn_id, elc_master_id, consumer_id, brand_id, major_category, "
    "header_sales_amount, sale_line_num, net_item_qty, sales_amount, product_sku, "
    "product_desc, master_category, category, sub_category, subcategory_alter FROM sd"))
def q_sales_details(spark, base):
    s = prep.sales_of(_src(spark, base), P)
    return s.select("sale_dt", "txn_id", "elc_master_id", "consumer_id",
                    "brand_id", "major_category", "header_sales_amount",
                    "sale_line_num", "net_item_qty", "sales_amount",
                    "product_sku", "product_desc", "master_category", "category",
                    "sub_category", "subcategory_alter")


@register("monthly_summary", O.with_monthly("SELECT * FROM ms"))
def q_monthly_summary(spark, base):
    return prep.monthly_of(_src(spark, base), P)


@register("snapshot", O.with_snapshot("SELECT * FROM snap"))
def q_snapshot(spark, base):
    return prep.snapshot_of(_src(spark, base), P)

# ------------------------------------------------------- sources and views


@register("scan_project", "WITH " + O.adapter_ctes() + " SELECT * FROM src_product")
def q_scan_project(spark, base):
    _setup(spark)
    return testdata.product_dim(spark, base)


_VH_COLS = ("elc_master_id", "consumer_id", "sale_dt", "txn_id",
            "usd_net_order_total", "currency_cd", "channel_cd",
            "loyalty_trans_flag")


@register("valid_headers", O.with_sales("SELECT " + ", ".join(_VH_COLS) + " FROM vh"))
def q_valid_headers(spark, base):
    return prep.headers_of(_src(spark, base), P).select(*_VH_COLS)


_VD_COLS = ("sale_dt", "channel_cd", "elc_master_id", "consumer_id", "brand_id",
            "txn_id", "sale_line_num", "src_txn_cd_desc", "net_item_qty",
            "usd_total_price", "product_sku", "product_desc", "master_category",
            "category", "sub_category", "subcategory_alter")


@register("valid_details", O.with_sales("SELECT " + ", ".join(_VD_COLS) + " FROM vd"))
def q_valid_details(spark, base):
    return prep.details_of(_src(spark, base), P).select(*_VD_COLS)


@register("brand_lookup", O.with_sales("SELECT brand_id, brand_cd, brand_desc FROM bl"))
def q_brand_lookup(spark, base):
    return prep.brands_of(_src(spark, base), P).select("brand_id", "brand_cd",
                                                      "brand_desc")


@register("distinct_pairs", """
SELECT DISTINCT p_name, p_type FROM part WHERE p_type IS NOT NULL""")
def q_distinct_pairs(spark, base):
    _setup(spark)
    return flt.distinct_pairs(read_table(spark, base, "part"), key_cols=("p_name",),
                              category_col="p_type", type_col=None)


@register("unique_mapping", """
WITH pairs AS (SELECT DISTINCT p_name, p_size, p_type FROM part WHERE p_type IS NOT NULL),
smy AS (SELECT *, count(*) OVER (PARTITION BY p_name, p_size) AS cnt FROM pairs)
SELECT p_name, p_size, p_type FROM smy WHERE cnt = 1""")
def q_unique_mapping(spark, base):
    _setup(spark)
    return flt.single_category_mapping(read_table(spark, base, "part"),
                                       key_cols=("p_name", "p_size"),
                                       category_col="p_type", type_col=None)


@register("first_month", O.with_dense("SELECT * FROM fm"))
def q_first_month(spark, base):
    return first_month(prep.monthly_of(_src(spark, base), P))


@register("densify", O.with_dense("SELECT elc_master_id, consumer_id, brand_id, dt FROM grid"))
def q_densify(spark, base):
    return snap.month_grid(prep.monthly_of(_src(spark, base), P),
                           calendar_start=P.calendar_start,
                           calendar_end=P.calendar_end)


@register("densify_facts", O.with_dense("SELECT * FROM dense"))
def q_densify_facts(spark, base):
    return snap.densify(prep.monthly_of(_src(spark, base), P),
                        calendar_start=P.calendar_start,
                        calendar_end=P.calendar_end)


def _snapshot_subset(name: str, cols: list[str]):
    sel = ", ".join(["snapshot_dt", O.KEYS] + cols)

    @register(name, O.with_snapshot(f"SELECT {sel} FROM snap"))
    def q(spark, base):
        return prep.snapshot_of(_src(spark, base), P).select(
            "snapshot_dt", "elc_master_id", "consumer_id", "brand_id", *cols)
    return q


_CATS3 = ("makeup", "skincare", "fragrance")
_snapshot_subset("targets", [f"target_{c}" for c in _CATS3 + ("haircare",)])
_snapshot_subset("global_stats", ["first_purchase_dt", "last_purchase_dt",
                                  "sales_tot", "txn_cnt_tot",
                                  "sales_mnt_cnt_12m", "avg_item_cnt"])
_snapshot_subset("trailing_counts", [f"{c}_cnt_{n}m" for c in _CATS3
                                     for n in (3, 6, 12, 24)])
_snapshot_subset("trailing_avg", [f"{c}_avg_12m" for c in _CATS3])
_snapshot_subset("category_global", [f"{c}_{s}" for c in _CATS3
                                     for s in ("amt_tot", "cnt_tot", "min",
                                               "max", "avg")])

# --------------------------------------------------------- feature refresh

TARGETS_MONTHS, FEATURES_MONTHS = 3, 12


@register("timeline", f"""
WITH t AS (SELECT max(o_orderdate) AS latest_txn_ts FROM orders)
SELECT latest_txn_ts,
       latest_txn_ts - INTERVAL {TARGETS_MONTHS} MONTH AS training_end_ts,
       (latest_txn_ts - INTERVAL {TARGETS_MONTHS} MONTH) - INTERVAL {FEATURES_MONTHS} MONTH
         AS training_start_ts
FROM t""")
def q_timeline(spark, base):
    _setup(spark)
    return feat.timeline_frame(read_table(spark, base, "orders"), "o_orderdate",
                               TARGETS_MONTHS, FEATURES_MONTHS)


@register("eval_period", f"""
WITH t AS (SELECT max(o_orderdate) - INTERVAL {TARGETS_MONTHS} MONTH AS e FROM orders)
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders, t
WHERE o_orderdate > e - INTERVAL {FEATURES_MONTHS} MONTH AND o_orderdate <= e""")
def q_eval_period(spark, base):
    """Training-dataset refresh: the feature period ends at the training
    end of the orders timeline."""
    _setup(spark)
    orders = read_table(spark, base, "orders")
    timeline = feat.timeline_frame(orders, "o_orderdate", TARGETS_MONTHS,
                                   FEATURES_MONTHS).first()
    start, end = feat.eval_period(timeline, FEATURES_MONTHS, training=True,
                                  table_exists=False)
    view = feat.register_period_view(orders, "orders_eval_period", "o_orderdate",
                                     start, end)
    return view.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@register("latest_earliest",
          "SELECT max(ts) AS latest, min(ts) AS earliest FROM events")
def q_latest_earliest(spark, base):
    _setup(spark)
    return feat.latest_earliest(read_table(spark, base, "events"), "ts")


@register("duplicate_ratio", """
SELECT count(*) AS total_rows, count(DISTINCT user_id) AS unique_ids,
       sum(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS null_ids,
       coalesce(1.0 - CAST(count(DISTINCT user_id) AS DOUBLE)
                / NULLIF(CAST(count(*) AS DOUBLE), 0), 0.0) AS duplicate_ratio
FROM events""")
def q_duplicate_ratio(spark, base):
    _setup(spark)
    return feat.duplicate_profile(read_table(spark, base, "events"), "user_id")


@register("dedupe", """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def q_dedupe(spark, base):
    """Latest event per user (duplicates allowed: threshold 1)."""
    _setup(spark)
    ev = read_table(spark, base, "events")
    return feat.deduplicate(ev, "user_id", ("ts", "event_id"), threshold=1.0)


def _daily_features(spark, base):
    """The test's feature query: per user and day, events and value; the
    row becomes valid at the end of the day (``feature_ts``)."""
    from spendgrid.functions.money import from_units, to_units
    ev = read_table(spark, base, "events")
    day = F.date_trunc("day", F.col("ts"))
    return (ev.groupBy("user_id", (day + F.expr("interval 1 day")).alias("feature_ts"))
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0))
                 .alias("n_purchases"),
                 from_units(F.sum(to_units(F.col("value")))).alias("value_sum")))


_DAILY_SQL = f"""
daily AS (
  SELECT user_id, date_trunc('day', ts) + INTERVAL 1 DAY AS feature_ts,
         count(*) AS n_events,
         sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS n_purchases,
         {O.from_units('sum(' + O.units('value') + ')')} AS value_sum
  FROM events GROUP BY ALL)"""


@register("feature_table_roundtrip", f"WITH {_DAILY_SQL} SELECT * FROM daily")
def q_feature_table_roundtrip(spark, base):
    _setup(spark)
    return store.write_feature_table(
        _daily_features(spark, base), "user_daily_features",
        primary_keys=["user_id"], timestamp_keys=["feature_ts"],
        description="events and value per user and day",
        path=store.run_scratch(spark, "user_daily_features"))


@register("cold_start", f"""WITH {_DAILY_SQL}
SELECT min(feature_ts) AS earliest_update,
       (min(feature_ts) IS NULL OR min(feature_ts) > TIMESTAMP '2024-01-15 00:00:00') AS cold_start
FROM daily""")
def q_cold_start(spark, base):
    _setup(spark)
    return feat.cold_start_frame(_daily_features(spark, base), "feature_ts",
                                 "2024-01-15 00:00:00")


@register("inference_input", f"""WITH {_DAILY_SQL}
SELECT user_id, feature_ts FROM daily WHERE feature_ts = (SELECT max(feature_ts) FROM daily)""")
def q_inference_input(spark, base):
    _setup(spark)
    return feat.inference_input(_daily_features(spark, base), "user_id", "feature_ts")


@register("point_in_time", f"""WITH {_DAILY_SQL}
SELECT e.event_id, e.user_id, e.ts, d.feature_ts, d.n_events, d.n_purchases, d.value_sum
FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') e
ASOF LEFT JOIN daily d ON e.user_id = d.user_id AND e.ts >= d.feature_ts""")
def q_point_in_time(spark, base):
    """Each purchase event with the user's latest daily features available
    at that moment."""
    _setup(spark)
    ev = read_table(spark, base, "events")
    spine = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return feat.as_of_join(spine, _daily_features(spark, base), keys=["user_id"],
                           spine_ts="ts", feature_ts="feature_ts")

# ------------------------------------------------------ tokens and baskets


def _tokens(src):
    return tok.product_tokens(src.products)


def _emb(src):
    return token_details(prep.details_of(src, P), prep.headers_of(src, P),
                         _tokens(src), prep.brands_of(src, P))


@register("product_token", O.with_tokens("SELECT * FROM tok"))
def q_product_token(spark, base):
    return _tokens(_src(spark, base)).select("sku_six_digit_identifier", "pdt_clean")


@register("token_details", O.with_tokens(
    "SELECT sale_dt, txn_id, elc_master_id, consumer_id, pdt_clean, sale_line_num, "
    "net_item_qty, sales_amount, product_sku, product_desc FROM emb"))
def q_token_details(spark, base):
    return _emb(_src(spark, base)).select(
        "sale_dt", "txn_id", "elc_master_id", "consumer_id", "pdt_clean",
        "sale_line_num", "net_item_qty", "sales_amount", "product_sku", "product_desc")


@register("basket", O.with_tokens(f"""
SELECT consumer_id, array_to_string(list_sort(list(pdt_clean)), ' ') AS basket
FROM emb WHERE sale_dt < DATE '{P.basket_before}' GROUP BY consumer_id"""))
def q_basket(spark, base):
    """Token basket per consumer (tokens as text so the oracle can check it;
    ``basket_hash`` is the reference's hashed form)."""
    b = tok.baskets(_emb(_src(spark, base)), item_col="pdt_clean",
                    before=P.basket_before)
    return b.select("consumer_id", F.array_join("basket", " ").alias("basket"))


@register("basket_hash")
def q_basket_hash(spark, base):
    """The reference's basket: 32-bit token hashes as text, per consumer."""
    return tok.baskets(_emb(_src(spark, base)), item_col="pdt_hash",
                       before=P.basket_before)


def _decoded(src, hashed):
    """Hashed baskets with each hash looked up in the token table again."""
    texts = _tokens(src).select(F.col("pdt_hash").cast("string").alias("item"), "pdt_clean").distinct()
    items = hashed.select("consumer_id", F.explode("basket").alias("item")).join(texts, "item")
    counted = items.groupBy("consumer_id", "pdt_clean").agg(F.count("*").cast("int").alias("n"))
    return counted.groupBy("consumer_id").agg(F.array_join(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("pdt_clean", "n"))),
        lambda e: F.array_repeat(e["pdt_clean"], e["n"]))), " ").alias("basket"))


@register("basket_hash_decoded", O.with_tokens(f"""
SELECT consumer_id, array_to_string(list_sort(list(pdt_clean)), ' ') AS basket
FROM emb WHERE sale_dt < DATE '{P.basket_before}' GROUP BY consumer_id"""))
def q_basket_hash_decoded(spark, base):
    """The hashed baskets, each hash looked up in the token table again."""
    src = _src(spark, base)
    hashed = tok.baskets(_emb(src), item_col="pdt_hash", before=P.basket_before)
    return _decoded(src, hashed)


# ------------------------------------------------------ attribute tables


def _attr_sales(src):
    return prep.sales_of(src, P, header_columns=("loyalty_trans_flag",))


def _ratios(src):
    return attr.ratio_attributes(_attr_sales(src), calendar_start=P.calendar_start,
                                 calendar_end=P.calendar_end,
                                 sales_before=P.sales_before)


def _stores(src):
    return attr.store_attributes(_attr_sales(src), src.stores,
                                 calendar_start=P.calendar_start,
                                 calendar_end=P.calendar_end,
                                 sales_before=P.sales_before)


@register("ratio_attributes", O.with_everything("SELECT * FROM ratios"))
def q_ratio_attributes(spark, base):
    return _ratios(_src(spark, base))


@register("store_attributes", O.with_everything("SELECT * FROM stores"))
def q_store_attributes(spark, base):
    return _stores(_src(spark, base))


@register("left_on_filter", O.with_everything("""
SELECT f.elc_master_id, f.consumer_id, f.brand_id, f.min_sale_month,
       cv.mosaic_segment, cv.income, cv.birth_year
FROM fm f LEFT JOIN src_cv cv ON f.elc_master_id = cv.elc_master_id
     AND cv.cdp_region = 'noam' AND cv.CDC_CODE <> 'D'"""))
def q_left_on_filter(spark, base):
    src = _src(spark, base)
    df = attr.with_consumer_variables(first_month(prep.monthly_of(src, P)),
                                      src.consumer_variables)
    return df.select("elc_master_id", "consumer_id", "brand_id", "min_sale_month",
                     "mosaic_segment", "income", "birth_year")


@register("exists_flag", O.with_everything("""
SELECT f.elc_master_id, f.consumer_id, f.brand_id,
       CASE WHEN ca.consumer_id IS NOT NULL THEN 'Y' ELSE 'N' END AS exists_in_cdp,
       ca.country_cd
FROM fm f LEFT JOIN src_ca ca ON f.elc_master_id = ca.elc_master_id
     AND f.consumer_id = ca.consumer_id AND ca.cdp_region = 'noam'"""))
def q_exists_flag(spark, base):
    src = _src(spark, base)
    df = attr.with_exists_flag(first_month(prep.monthly_of(src, P)),
                               src.consumer_attributes, columns=("country_cd",))
    return df.select("elc_master_id", "consumer_id", "brand_id", "exists_in_cdp",
                     "country_cd")


def _master(src):
    t = prep.prepare_tables(src, P)
    return attr.master_table_from_spans(t.snapshot_spans, t.ratio_spans, t.store_spans,
                                        src.consumer_variables, src.consumer_attributes,
                                        categories=P.categories, region=P.region)


@register("master_table_onepass", O.with_everything(O.master_select()))
def q_master_table_onepass(spark, base):
    """The master table from purchase-month rows joined before any window;
    ``master_table`` joins the spans of the three tables. Same rows."""
    return prep.master_of(_src(spark, base), P)


@register("master_table", O.with_everything(O.master_select()))
def q_master_table(spark, base):
    return _master(_src(spark, base))

# ------------------------------------------- sampling, model data, metrics


SLICE_DT = "2000-06-01"
TARGET = "skincare"
_IDS = ["elc_master_id", "consumer_id", "brand_id"]


def _snap_slice(src):
    return prep.snapshot_month_of(src, P, SLICE_DT)


def _training_slice(src):
    """The training query: snapshot month, ids ending in 1, known to CDP."""
    m = prep.master_month_of(src, P, SLICE_DT).where(F.col("exists_in_cdp") == "Y")
    return smp.last_digit_sample(m, "consumer_id", ("1",))


_SLICE_SQL = f"SELECT * FROM snap WHERE snapshot_dt = DATE '{SLICE_DT}'"
_TRAIN_SQL = (f"SELECT * FROM master WHERE snapshot_dt = DATE '{SLICE_DT}' "
              "AND exists_in_cdp = 'Y' AND right(CAST(consumer_id AS VARCHAR), 1) IN ('1')")
_ROWID = "concat_ws('|', elc_master_id, CAST(consumer_id AS VARCHAR), CAST(brand_id AS VARCHAR))"
_HASH = f"CAST(('0x' || substr(md5({_ROWID}), 1, 8)) AS BIGINT)"


def _with_master_fixed(select: str) -> str:
    base = O.with_everything("")
    return base + f",\nmaster AS ({O.master_select()})\n" + select


@register("snapshot_slice", O.with_snapshot(_SLICE_SQL))
def q_snapshot_slice(spark, base):
    """Snapshot rows of one month, read back from a stored partitioned
    snapshot table of two months (the equality filter prunes to one)."""
    src = _src(spark, base)
    path = store.run_scratch(spark, "sales_snapshot")
    for rows in prep.snapshot_months_of(src, P, ("2000-05-01", SLICE_DT)):
        store.overwrite_partitions(rows, path, ["snapshot_dt"])
    t = spark.read.parquet(path)
    return t.where(F.col("snapshot_dt") == F.lit(SLICE_DT).cast("date"))


_FOLDED = ("2000-03-01", "2000-04-01", "2000-05-01", SLICE_DT)


@register("folded_snapshot", O.with_snapshot(
    "SELECT * FROM snap WHERE snapshot_dt IN (" + ", ".join(f"DATE '{m}'" for m in _FOLDED) + ")"))
def q_folded_snapshot(spark, base):
    """Snapshot rows of four months of a stored run: the first from the state
    computed from all facts, the others folded forward, each from one month of
    facts and the state of the month before."""
    run = StoredRun.scratch(spark, _src(spark, base), P)
    run.load()
    for month in _FOLDED:
        run.advance(month)
        run.publish_snapshot(month)
    return run.table("sales_snapshot").where(F.col("snapshot_dt").isin([_dt.date.fromisoformat(m) for m in _FOLDED]))


@register("stored_master_slice", _with_master_fixed(f"SELECT * FROM master WHERE snapshot_dt = DATE '{SLICE_DT}'"))
def q_stored_master_slice(spark, base):
    """One month of the master table, read back from the stored run that
    declared, filled and joined its tables."""
    run = StoredRun.scratch(spark, _src(spark, base), P)
    run.load()
    for month in _FOLDED[2:]:
        run.advance(month)
    run.publish(SLICE_DT)
    return run.table("master_table").where(F.col("snapshot_dt") == F.lit(SLICE_DT).cast("date"))


@register("stored_basket", O.with_tokens(f"""
SELECT consumer_id, array_to_string(list_sort(list(pdt_clean)), ' ') AS basket
FROM emb WHERE sale_dt < DATE '{P.basket_before}' GROUP BY consumer_id"""))
def q_stored_basket(spark, base):
    """The stored basket table of a run, its hashes looked up again."""
    src = _src(spark, base)
    return _decoded(src, StoredRun.scratch(spark, src, P).prepare_baskets())


@register("partition_overwrite", O.with_monthly("SELECT * FROM ms"))
def q_partition_overwrite(spark, base):
    """Monthly summary stored by month twice (a rerun replaces the same
    partitions instead of appending) and read back."""
    src = _src(spark, base)
    path = store.run_scratch(spark, "sales_monthly_summary")
    monthly = prep.monthly_of(src, P)
    store.overwrite_partitions(monthly, path, ["sale_month"])
    once = prep.materialize(spark.read.parquet(path).select(*monthly.columns), "monthly_rerun")
    store.overwrite_partitions(once, path, ["sale_month"])
    return spark.read.parquet(path).select(*monthly.columns)


@register("id_digit_sample", _with_master_fixed(
    "SELECT snapshot_dt, elc_master_id, consumer_id, brand_id, target_skincare FROM ("
    + _TRAIN_SQL + ")"))
def q_id_digit_sample(spark, base):
    return _training_slice(_src(spark, base)).select(
        "snapshot_dt", "elc_master_id", "consumer_id", "brand_id", "target_skincare")


@register("hash_sample", O.with_snapshot(
    f"SELECT snapshot_dt, {O.KEYS}, target_skincare FROM snap WHERE snapshot_dt = DATE '{SLICE_DT}' "
    f"AND {_HASH} < {int(0.3 * 2 ** 32)}"))
def q_hash_sample(spark, base):
    s = smp.hash_sample(_snap_slice(_src(spark, base)), _IDS, 0.3)
    return s.select("snapshot_dt", *_IDS, "target_skincare")


@register("hash_limit", O.with_snapshot(
    f"SELECT snapshot_dt, {O.KEYS}, sales_tot FROM snap WHERE snapshot_dt = DATE '{SLICE_DT}' "
    f"ORDER BY {_HASH}, elc_master_id, consumer_id, brand_id LIMIT 500"))
def q_hash_limit(spark, base):
    s = smp.hash_limit(_snap_slice(_src(spark, base)), _IDS, 500)
    return s.select("snapshot_dt", *_IDS, "sales_tot")


@register("stratified_split", O.with_snapshot(f"""
, sl AS ({_SLICE_SQL}),
rk AS (SELECT *, row_number() OVER (PARTITION BY target_skincare
                                    ORDER BY {_HASH}, elc_master_id, consumer_id, brand_id) AS r,
              count(*) OVER (PARTITION BY target_skincare) AS n FROM sl)
SELECT snapshot_dt, {O.KEYS}, target_skincare,
       CASE WHEN r <= ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM rk""".replace(
    "\n, sl AS", "\nSELECT * FROM (WITH sl AS", 1) + ")"))
def q_stratified_split(spark, base):
    # the split reads its input twice (range cuts, then ranks): write the
    # slice once instead of computing the snapshot twice
    s = prep.materialize(_snap_slice(_src(spark, base)).select(
        "snapshot_dt", *_IDS, "target_skincare"), "split_input")
    return smp.stratified_split(s, id_cols=_IDS, label_col="target_skincare",
                                test_size=0.3)


@register("model_matrix", _with_master_fixed(
    O.model_matrix_select(TARGET, "(" + _TRAIN_SQL + ")")))
def q_model_matrix(spark, base):
    return mx.model_matrix(_training_slice(_src(spark, base)), TARGET)


@register("dataset_profile", _with_master_fixed(f"""
SELECT count(*) AS row_count, {len([c for c in O.master_names() if c not in mx.DROP_COLUMNS])} AS column_count,
       round(avg(CAST(target_{TARGET} AS DOUBLE)), 6) AS target_ratio,
       count(*) - count(DISTINCT (elc_master_id, consumer_id, brand_id)) AS duplicate_count
FROM ({_TRAIN_SQL})"""))
def q_dataset_profile(spark, base):
    return mx.dataset_profile(_training_slice(_src(spark, base)), TARGET)


_SCORE_CAT = ["income", "first_channel", "store_region"]
_SCORE_NUM = ["sales_tot", "makeup_cnt_12m", "age", "discount_ratio"]
_SCORE_IND = ["email_opt_in_ind", "dm_opt_in_ind"]


@register("score_input", _with_master_fixed(
    "SELECT snapshot_dt, elc_master_id, consumer_id, brand_id, target_makeup, "
    "target_skincare, target_fragrance, target_haircare, "
    + ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in _SCORE_CAT) + ", "
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'Unknown') AS {c}" for c in _SCORE_IND) + ", "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _SCORE_NUM)
    + f" FROM master WHERE snapshot_dt = DATE '{SLICE_DT}'"))
def q_score_input(spark, base):
    return mx.score_input(prep.master_month_of(_src(spark, base), P, SLICE_DT), categorical=_SCORE_CAT,
                          numeric=_SCORE_NUM, indicators=_SCORE_IND,
                          snapshot_dt=SLICE_DT)


_HOT = ["income", "first_channel", "store_region"]


@register("one_hot", _with_master_fixed(
    ", matrix AS (SELECT elc_master_id, consumer_id, brand_id, target_skincare AS label, "
    + ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in _HOT) + f" FROM ({_TRAIN_SQL})),"
    f"""
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_HASH}, elc_master_id, consumer_id, brand_id) AS r,
              count(*) OVER (PARTITION BY label) AS n FROM matrix),
pairs AS (""" + " UNION ALL ".join(
        f"SELECT elc_master_id, consumer_id, brand_id, r > ceil(n * 0.3) AS train, '{c}' AS \"column\", {c} AS value FROM rk" for c in _HOT) + """),
vocabulary AS (SELECT "column", value, CAST(row_number() OVER (ORDER BY "column", value) - 1 AS INTEGER) AS number
               FROM (SELECT DISTINCT "column", value FROM pairs WHERE train))
SELECT elc_master_id, consumer_id, brand_id, p."column", p.value, number FROM pairs p
JOIN vocabulary v ON p."column" = v."column" AND p.value = v.value"""))
def q_one_hot(spark, base):
    """The ones of each row of the training slice, by a vocabulary fitted on its
    train split (a distributed table; values unseen there have none)."""
    m = prep.materialize(mx.model_matrix(_training_slice(_src(spark, base)), TARGET,
                                         keep_ids=_IDS), "one_hot_input")
    split = prep.materialize(smp.stratified_split(m, id_cols=_IDS, label_col="label"), "one_hot_split")
    words = Vocabulary(_HOT).fit(split.where(F.col("split") == "train"))
    return words.transform_long(split, _IDS)


def _scored(spark, base):
    """Test scores: label = document quality, score = n_chars/(1000+n_chars)."""
    _setup(spark)
    lab = read_table(spark, base, "labels")
    doc = read_table(spark, base, "documents").select("doc_id", "n_chars")
    n = F.col("n_chars").cast("double")
    return lab.join(doc, "doc_id").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label"),
        (n / (F.lit(1000.0) + n)).alias("score"))


_M = O.metrics_oracle()


@register("avg_precision", _M["avg_precision"])
def q_avg_precision(spark, base):
    return met.average_precision(_scored(spark, base))


@register("roc_auc", _M["roc_auc"])
def q_roc_auc(spark, base):
    return met.roc_auc(_scored(spark, base))


@register("ks_score", _M["ks_score"])
def q_ks_score(spark, base):
    return met.ks_statistic(_scored(spark, base))


@register("brier", _M["brier"])
def q_brier(spark, base):
    return met.brier_score(_scored(spark, base))


@register("coverage_at_decile", _M["coverage_at_decile"])
def q_coverage_at_decile(spark, base):
    return met.coverage_at(_scored(spark, base))

# ------------------------------------------------ lifetime functions, model


_LT = lt.LifetimeParams()
_RFM_SQL = f"""
, pm AS (SELECT consumer_id, sale_month, sum({O.units('sales_amount')}) AS c FROM ms GROUP BY ALL),
g AS (SELECT consumer_id, min(sale_month) AS f, max(sale_month) AS l, count(*) AS n,
             sum(c) AS tot, arg_min(c, sale_month) AS c0 FROM pm GROUP BY ALL),
rfm AS (
  SELECT consumer_id, CAST(n - 1 AS DOUBLE) AS frequency,
         CAST(date_diff('month', f, l) AS DOUBLE) AS recency,
         CAST(date_diff('month', f, DATE '{P.calendar_end}') AS DOUBLE) AS T,
         coalesce({O.from_units('tot - c0')} / NULLIF(CAST(n - 1 AS DOUBLE), 0), 0.0) AS monetary_value
  FROM g)"""


def _rfm(spark, base):
    return lt.rfm_summary(prep.monthly_of(_src(spark, base), P),
                          observation_end=P.calendar_end)


@register("rfm_summary", O.with_monthly(_RFM_SQL.replace(", pm AS", "SELECT * FROM (WITH pm AS", 1)
                                       + "\nSELECT * FROM rfm)"))
def q_rfm_summary(spark, base):
    return _rfm(spark, base)


# the closed form, written out apart from the library: r 0.24, alpha 4.41,
# a 0.79, b 2.43; odds of being gone are a / (b + x - 1) * ((alpha + T) / (alpha + tx)) ^ (r + x)
_ALIVE = ("CASE WHEN frequency = 0 THEN 1.0 ELSE (1.43 + frequency) / (1.43 + frequency + 0.79 "
          "* exp((0.24 + frequency) * (ln(4.41 + T) - ln(4.41 + recency)))) END")


@register("probability_alive", O.with_monthly(
    _RFM_SQL.replace(", pm AS", "SELECT * FROM (WITH pm AS", 1)
    + f"\nSELECT consumer_id, round({_ALIVE}, 6) AS p_alive FROM rfm)"))
def q_probability_alive(spark, base):
    rfm = _rfm(spark, base)
    lt.register_lifetime_functions(spark, _LT)
    rfm.createOrReplaceTempView("rfm_summary")
    return spark.sql("SELECT consumer_id, round(probability_alive(frequency, recency, T), 6)"
                     " AS p_alive FROM rfm_summary")


@register("clv", O.with_monthly(
    _RFM_SQL.replace(", pm AS", "SELECT * FROM (WITH pm AS", 1)
    + f"\nSELECT consumer_id, round({_ALIVE} * (0.24 + frequency) / (4.41 + T) * 12 "
    "* 6.25 * (15.44 + monetary_value * frequency) / (6.25 * frequency + 2.74), 4) AS clv FROM rfm)"))
def q_clv(spark, base):
    rfm = _rfm(spark, base)
    lt.register_lifetime_functions(spark, _LT)
    rfm.createOrReplaceTempView("rfm_summary")
    return spark.sql("SELECT consumer_id, round(clv(frequency, recency, T, monetary_value), 4)"
                     " AS clv FROM rfm_summary")


def _month_scores(spark, base):
    """Train gradient-boosted trees on the train split of the training
    slice (early stop on its test split) and score the whole month."""
    month = prep.materialize(prep.master_month_of(_src(spark, base), P, SLICE_DT), "master_month")
    ids = ["snapshot_dt", *_IDS]
    m = mx.model_matrix(month, TARGET, keep_ids=ids)  # a projection of the written month
    # only rows known to CDP train; all rows are scored
    known = mx.model_matrix(month.where(F.col("exists_in_cdp") == "Y"), TARGET, keep_ids=ids)
    split = smp.stratified_split(smp.last_digit_sample(known, "consumer_id", ("1",)),
                                 id_cols=_IDS, label_col="label")
    split = prep.materialize(split.withColumn("is_valid", F.col("split") == "test"),
                             "model_split")
    cat, ind, num = mx.feature_kinds(split.drop("label", "split", "is_valid", *ids))
    model = ml.fit(split, cat + ind, num, ml.TreeParams(num_trees=20, depth=3),
                   validation_col="is_valid", id_cols=_IDS)
    return ml.batch_scores(model, m, TARGET)


@register("batch_scores")
def q_batch_scores(spark, base):
    """Every row of the month, with its score."""
    return _month_scores(spark, base)


@register("batch_scores_complete", _with_master_fixed(
    "SELECT snapshot_dt, elc_master_id, consumer_id, brand_id, TRUE AS scored FROM master "
    f"WHERE snapshot_dt = DATE '{SLICE_DT}'"))
def q_batch_scores_complete(spark, base):
    """Which rows were scored: all of the month, each with a probability."""
    return _month_scores(spark, base).select(
        "snapshot_dt", *_IDS, F.col(f"pred_proba_{TARGET}").between(0.0, 1.0).alias("scored"))

# --------------------------------------------------- exports and CTAS shape


@register("csv_export", O.with_monthly("SELECT * FROM ms"))
def q_csv_export(spark, base):
    """Monthly summary exported as CSV parts with headers into a folder
    named for the run, then read back with the summary's schema."""
    monthly = prep.monthly_of(_src(spark, base), P)
    folder = store.run_scratch(spark, "exports")
    out = store.export_csv(monthly, folder, "analytics.sales_monthly_summary",
                           _dt.datetime(2001, 8, 1, 6, 0, 0))
    return spark.read.csv(out, header=True, schema=monthly.schema)


@register("master_table_empty", O.with_everything(
    "SELECT * FROM (" + O.master_select() + ") WHERE 1 = 0"))
def q_master_table_empty(spark, base):
    """The master table created empty from the query's schema, partitioned by
    snapshot month (``CREATE TABLE ... AS SELECT ... WHERE 1=0``), read back."""
    src = _src(spark, base)
    name = "master_table_empty"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    master = prep.master_of(src, P, materialize_sales=False)  # read for its schema only
    store.create_empty_like(master, name, partition_cols=["snapshot_dt"],
                            path=store.run_scratch(spark, name))
    return spark.table(name).select(*master.columns)
