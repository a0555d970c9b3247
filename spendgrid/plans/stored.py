"""The stored run: declared tables, filled month by month.

Tables are partitioned by month and, inside a month, bucketed and sorted by the
entity keys. Loading sale lines fills the monthly facts; :meth:`StoredRun.advance`
folds the states forward by one month and reads that month's facts and the
month before's states, nothing else; :meth:`StoredRun.publish` fills the month's
snapshot, ratio, store and master partitions from the states. Joins between
stored tables on the keys move no rows.

Every step replaces the partitions it writes, so it can be run again.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

from spendgrid.functions.dates import add_months, first_of_month
from spendgrid.operators import CATEGORIES, ENTITY_KEYS, FEATURE_CATEGORIES, TARGET_CATEGORIES, category_prefix
from spendgrid.operators import state as st
from spendgrid.operators.attributes import RATIO_COLUMNS, STORE_COLUMNS, master_table, ratio_monthly
from spendgrid.operators.joins import dimension_join, token_details
from spendgrid.operators.monthly import MONTH, monthly_summary
from spendgrid.operators.snapshot import SNAPSHOT, TRAILING_MONTHS
from spendgrid.operators.tokens import baskets, product_tokens
from spendgrid.plans.preparation import MASTER_HEADER_COLUMNS, PrepParams, Sources, brands_of, details_of, fact_lines, headers_of, materialize, sales_of
from spendgrid.sources import store
from spendgrid.session import scratch_path

_KEYS = [StructField("elc_master_id", StringType()), StructField("consumer_id", LongType()), StructField("brand_id", LongType())]


def _doubles(*names: str) -> list[StructField]:
    return [StructField(n, DoubleType()) for n in names]


def _per_category(p: str) -> list[str]:
    return [*(f"{p}_cnt_{n}m" for n in TRAILING_MONTHS), f"{p}_avg_12m",
            *(f"{p}_{what}" for what in ("amt_tot", "cnt_tot", "min", "max", "avg"))]


#: Declared schemas of the four tables, columns in their order.
MONTHLY_SCHEMA = StructType([
    StructField(MONTH, DateType()), StructField("etl_date", TimestampType()), *_KEYS, *_doubles("sales_amount"),
    StructField("txn_cnt", LongType()), StructField("item_cnt", LongType()), *_doubles(*(f"{category_prefix(c)}_amount" for c in CATEGORIES))])
SNAPSHOT_SCHEMA = StructType([
    StructField(SNAPSHOT, DateType()), *_KEYS, *[StructField(f"target_{category_prefix(c)}", IntegerType()) for c in TARGET_CATEGORIES],
    StructField("first_purchase_dt", DateType()), StructField("last_purchase_dt", DateType()),
    *_doubles("sales_tot", "txn_cnt_tot", "sales_mnt_cnt_12m", "avg_item_cnt", *(f"{category_prefix(c)}_amt_last" for c in CATEGORIES),
              "item_cnt_last", "txn_cnt_last", "sales_amt_last", *(n for c in FEATURE_CATEGORIES for n in _per_category(category_prefix(c))),
              "months_since_first_purchase", "months_since_last_purchase")])
RATIO_SCHEMA = StructType([StructField(SNAPSHOT, DateType()), *_KEYS, *_doubles(*RATIO_COLUMNS)])
STORE_SCHEMA = StructType([
    StructField(SNAPSHOT, DateType()), *_KEYS, StructField("most_freq_store_id", LongType()),
    *[StructField(c, DoubleType() if c in ("store_latitude", "store_longitude") else StringType()) for c in STORE_COLUMNS]])
DECLARED = {"sales_monthly_summary": MONTHLY_SCHEMA, "sales_snapshot": SNAPSHOT_SCHEMA,
            "custom_calculated_attributes": RATIO_SCHEMA, "store_calculated_attributes": STORE_SCHEMA}
STATE = "state_dt"
MIN_BUCKETS = 8
LINES_PER_BUCKET = 6_000_000


def buckets_for(lines: int, cores: int) -> int:
    """Buckets of a run's tables: one task reads and writes one, so there are as
    many as the cluster has cores, or a multiple, once ``lines`` fill a quarter
    of them; a small run keeps few files."""
    full = -(-lines // LINES_PER_BUCKET)
    if 4 * full < cores:
        return max(MIN_BUCKETS, full)
    return max(MIN_BUCKETS, cores * -(-full // cores))


class StoredRun:
    """A database of one region's tables below ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, src: Sources, params: PrepParams, *, database: str, path: str, buckets: int | None = None,
                 etl_ts: _dt.datetime | None = None):
        self.spark, self.src, self.p, self.database, self.path, self._buckets = spark, src, params, database, path, buckets
        self.etl_ts = etl_ts or _dt.datetime(1970, 1, 1)

    @classmethod
    def scratch(cls, spark: SparkSession, src: Sources, params: PrepParams, **options) -> "StoredRun":
        """A run of its own below the shared checkpoint folder."""
        name = f"run_{uuid.uuid4().hex[:12]}"
        return cls(spark, src, params, database=name, path=scratch_path(spark, f"spendgrid/{name}"), **options)

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    @property
    def buckets(self) -> int:
        """Buckets of every table: given, or those of the stored tables, or by
        the lines of the first :meth:`load`."""
        if self._buckets is None and store.table_exists(self.spark, self.name("sales_monthly_summary")):
            self._buckets = store.bucket_count(self.spark, self.name("sales_monthly_summary"))
        return self._buckets or MIN_BUCKETS

    def _create(self, table: str, schema: StructType, by: str) -> None:
        store.create_bucketed_table(self.spark, self.name(table), schema, partition_cols=[by], bucket_cols=ENTITY_KEYS,
                                    buckets=self.buckets, path=f"{self.path}/{table}")

    def _replace(self, df: DataFrame, table: str, by: str) -> None:
        if not store.table_exists(self.spark, self.name(table)):  # a table whose schema a query gives
            self._create(table, df.schema, by)
        store.replace_bucketed(df, self.name(table), bucket_cols=ENTITY_KEYS, buckets=self.buckets)

    def create_tables(self) -> None:
        """The database and its declared tables, where they do not exist."""
        store.ensure_database(self.spark, self.database)
        for table, schema in DECLARED.items():
            self._create(table, schema, MONTH if MONTH in schema.fieldNames() else SNAPSHOT)

    # --- facts -----------------------------------------------------------------

    def load(self, first=None, last=None) -> None:
        """Monthly facts of the sale lines from month ``first`` to ``last`` (all,
        if not given): the summary, the ratios' counts and the store visits. The
        lines are joined and written once, dealt as the facts group them."""
        sales = sales_of(self.src, self.p, header_columns=MASTER_HEADER_COLUMNS)
        if first is not None:
            sales = sales.where(F.col("sale_dt") >= F.lit(first_of_month(first)))
        if last is not None:
            sales = sales.where(F.col("sale_dt") < F.lit(add_months(first_of_month(last), 1)))
        sales = fact_lines(sales, "run_sales")
        if self._buckets is None and not store.table_exists(self.spark, self.name("sales_monthly_summary")):
            self._buckets = buckets_for(sales.count(), self.spark.sparkContext.defaultParallelism)
        self.create_tables()
        before = self.p.sales_before
        self._replace(monthly_summary(sales, categories=self.p.categories, sales_before=before, etl_ts=self.etl_ts), "sales_monthly_summary", MONTH)
        self._replace(ratio_monthly(sales, sales_before=before), "ratio_facts", MONTH)
        self._replace(st.monthly_visits(sales, sales_before=before), "store_visits", MONTH)

    # --- states ----------------------------------------------------------------

    def _state(self, table: str, month) -> DataFrame:
        return self.table(table).where(F.col(STATE) == F.lit(month)).drop(STATE)

    def _has_state(self, month) -> bool:
        """Whether the states of a month are complete: the last one is written."""
        name = "visit_state"
        return store.table_exists(self.spark, self.name(name)) and not self._state(name, month).isEmpty()

    def advance(self, month) -> None:
        """The states of ``month``: folded forward from the month before, or
        computed from all facts up to ``month`` where there is none."""
        month = first_of_month(month)
        before = add_months(month, -1)
        start = self.p.calendar_start
        folds = self._has_state(before)
        facts = self.table("sales_monthly_summary")
        if folds:
            snap = st.fold_month(self._state("snapshot_state", before), facts, month, last_categories=self.p.categories)
        else:
            snap = st.month_state(facts, month, calendar_start=start, last_categories=self.p.categories)
        ratios = st.ratio_state(self.table("ratio_facts"), month, calendar_start=start, state=self._state("ratio_state", before) if folds else None)
        visits = st.visit_state(self.table("store_visits"), month, state=self._state("visit_state", before) if folds else None)
        for table, rows in (("snapshot_state", snap), ("ratio_state", ratios), ("visit_state", visits)):
            self._replace(rows.withColumn(STATE, F.lit(month)), table, STATE)

    # --- published months --------------------------------------------------------

    def publish_snapshot(self, month, *, horizon: int = 3) -> None:
        """The month's snapshot partition. Targets see the facts that are
        loaded; publish again when later months are."""
        month = first_of_month(month)
        ahead = st.next_sums(self.table("sales_monthly_summary"), month, horizon=horizon, calendar_end=self.p.calendar_end)
        state = self._state("snapshot_state", month).join(ahead, list(ENTITY_KEYS), "left")
        self._replace(st.snapshot_rows(state, month, last_categories=self.p.categories), "sales_snapshot", SNAPSHOT)

    def publish(self, month, *, horizon: int = 3) -> None:
        """The month's partitions of the snapshot, ratio, store and master
        tables."""
        month = first_of_month(month)
        dt = F.lit(month).alias(SNAPSHOT)
        self.publish_snapshot(month, horizon=horizon)
        self._replace(st.ratio_rows_of(self._state("ratio_state", month)).select(dt, "*"), "custom_calculated_attributes", SNAPSHOT)
        leaders = materialize(st.leading_stores(self._state("visit_state", month)), "leaders")
        dim = self.src.stores.select(F.col("store_id").alias("most_freq_store_id"), *STORE_COLUMNS)
        stores = dimension_join(leaders, dim, "most_freq_store_id", hot=None)
        self._replace(stores.select(dt, "*"), "store_calculated_attributes", SNAPSHOT)
        self._replace(self.master_rows(month), "master_table", SNAPSHOT)

    def master_rows(self, month) -> DataFrame:
        """One month's master rows, from the stored tables."""
        of = lambda table: self.table(table).where(F.col(SNAPSHOT) == F.lit(first_of_month(month)))
        columns = SNAPSHOT_SCHEMA.fieldNames()
        return master_table(of("sales_snapshot").select(*columns), self.src.consumer_variables, self.src.consumer_attributes,
                            of("custom_calculated_attributes"), of("store_calculated_attributes"), region=self.p.region)

    def prepare_baskets(self) -> DataFrame:
        """The stored basket table: hashed product tokens per consumer, replaced
        as a whole."""
        store.ensure_database(self.spark, self.database)
        lines = token_details(details_of(self.src, self.p), headers_of(self.src, self.p), product_tokens(self.src.products), brands_of(self.src, self.p))
        rows = baskets(lines, item_col="pdt_hash", before=self.p.basket_before)
        store.switch_table(rows, self.name("emb_basket"), path=f"{self.path}/emb_basket", unique=["consumer_id"])
        return self.table("emb_basket")

    def run(self, months) -> None:
        """Load everything, then advance and publish ``months`` in order, then
        the baskets."""
        self.load()
        for month in months:
            self.advance(month)
            self.publish(month)
        self.prepare_baskets()
