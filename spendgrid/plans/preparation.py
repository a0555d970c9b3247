"""Data preparation: validated sources -> sales lines -> monthly summary ->
snapshot, tokens and baskets, attribute tables and the master table."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.operators import (CATEGORIES, DEFAULT_START_DATE,
                                 ENTITY_KEYS, EXCLUDED_BRAND_CODES, REGION)
from spendgrid.operators.filters import (brand_lookup, single_category_mapping,
                                         valid_details, valid_headers)
from spendgrid.operators.joins import sales_details
from spendgrid.operators.monthly import MONTH, monthly_summary, with_month
from spendgrid.operators.snapshot import snapshot, snapshot_spans
from spendgrid.sources import testdata


@dataclass(frozen=True)
class PrepParams:
    """Dates and lists of one preparation run (the reference's literals,
    turned into arguments)."""

    calendar_end: str                      # last snapshot month
    start_date: str = DEFAULT_START_DATE   # sales strictly after this day
    calendar_start: str = DEFAULT_START_DATE
    sales_before: str = "2024-01-01"       # monthly summary upper bound
    basket_before: str = "2022-04-01"
    region: str = REGION
    excluded_brand_codes: tuple[str, ...] = EXCLUDED_BRAND_CODES
    categories: tuple[str, ...] = CATEGORIES
    etl_ts: _dt.datetime | None = None


# Parameters for the driver's test tables (orders run 1995-01 .. 2001-08).
TEST_PARAMS = PrepParams(
    calendar_end="2001-07-01",
    start_date="1995-01-01",
    calendar_start="1995-01-01",
    sales_before="2001-08-01",
    basket_before="1999-01-01",
    excluded_brand_codes=("MI",),
)


@dataclass
class Sources:
    """The reference's source tables as DataFrames."""

    header: DataFrame
    detail: DataFrame
    products: DataFrame
    brands: DataFrame
    consumer_variables: DataFrame | None = None
    consumer_attributes: DataFrame | None = None
    stores: DataFrame | None = None
    extra: dict = field(default_factory=dict)


class _TestSources:
    """Sources over the driver's test tables (same attributes as
    :class:`Sources`), each frame built on first use, so a query builds only
    the frames it reads."""

    def __init__(self, spark: SparkSession, base: str):
        self._spark, self._base = spark, base
        self.extra: dict = {}

    @cached_property
    def header(self) -> DataFrame:
        return testdata.header_source(self._spark, self._base)

    @cached_property
    def detail(self) -> DataFrame:
        return testdata.detail_source(self._spark, self._base)

    @cached_property
    def products(self) -> DataFrame:
        return testdata.product_dim(self._spark, self._base)

    @cached_property
    def brands(self) -> DataFrame:
        return testdata.brand_source(self._spark, self._base)

    @cached_property
    def consumer_variables(self) -> DataFrame:
        return testdata.consumer_variables(self._spark, self._base)

    @cached_property
    def consumer_attributes(self) -> DataFrame:
        return testdata.consumer_attributes(self._spark, self._base)

    @cached_property
    def stores(self) -> DataFrame:
        return testdata.store_dim(self._spark, self._base)


def test_sources(spark: SparkSession, base: str) -> "_TestSources":
    return _TestSources(spark, base)


def headers_of(src: Sources, p: PrepParams, extra=()) -> DataFrame:
    return valid_headers(src.header, start_date=p.start_date, region=p.region,
                         extra_columns=extra)


def details_of(src: Sources, p: PrepParams) -> DataFrame:
    return valid_details(src.detail, start_date=p.start_date, region=p.region,
                         extra_columns=("usd_discount_amount", "store_id"))


def brands_of(src: Sources, p: PrepParams) -> DataFrame:
    return brand_lookup(src.brands, region=p.region,
                        excluded_codes=p.excluded_brand_codes)


def sales_of(src: Sources, p: PrepParams, header_columns=()) -> DataFrame:
    return sales_details(
        details_of(src, p),
        headers_of(src, p, extra=header_columns),
        single_category_mapping(src.products),
        brands_of(src, p),
        header_columns=header_columns,
        line_columns=("usd_discount_amount", "store_id"))


def monthly_of(src: Sources, p: PrepParams) -> DataFrame:
    return monthly_summary(sales_of(src, p), categories=p.categories,
                           sales_before=p.sales_before, etl_ts=p.etl_ts)


def snapshot_of(src: Sources, p: PrepParams, **kw) -> DataFrame:
    return snapshot(monthly_of(src, p), calendar_start=p.calendar_start,
                    calendar_end=p.calendar_end, last_categories=p.categories,
                    **kw)


def materialize(df: DataFrame, name: str = "sales_lines") -> DataFrame:
    """Write ``df`` once as parquet into a fresh folder under the shared
    checkpoint folder and read it back: the plan runs once (an eager
    ``checkpoint()`` of an uncached plan computes it twice), the lineage is
    cut, and the files survive executor loss. Used where several tables are
    derived from the same sale lines."""
    from spendgrid.sources.store import written_once
    return written_once(df, name)


MASTER_HEADER_COLUMNS = ("loyalty_trans_flag",)
# What the monthly facts, ratios and visits read of a sale line.
FACT_COLUMNS = (*ENTITY_KEYS, "sale_dt", "txn_id", "channel_cd", "major_category", "sales_amount", "src_txn_cd_desc",
                "usd_discount_amount", "store_id", "loyalty_trans_flag")
# All spans of one run are hash-partitioned by the entity id alone, so the
# master table joins them without moving them again.
GRID_PARTITION = ("elc_master_id",)


@dataclass
class PreparedTables:
    """Tables of one preparation run derived from one set of sale lines."""

    sales: DataFrame
    monthly: DataFrame
    snapshot: DataFrame
    ratios: DataFrame
    stores: DataFrame
    # their sparse forms, which the master table joins
    snapshot_spans: DataFrame
    ratio_spans: DataFrame
    store_spans: DataFrame


def prepare_tables(src: Sources, p: PrepParams, *, materialize_sales: bool = True
                   ) -> PreparedTables:
    """Sale lines (joined once, optionally checkpointed), then the monthly
    summary, snapshot, behaviour ratios and store attributes from them."""
    from spendgrid.operators import attributes as attr
    sales = sales_of(src, p, header_columns=MASTER_HEADER_COLUMNS)
    if materialize_sales:
        sales = materialize(sales)
    monthly = monthly_summary(sales, categories=p.categories,
                              sales_before=p.sales_before, etl_ts=p.etl_ts)
    grid = {"calendar_start": p.calendar_start, "calendar_end": p.calendar_end,
            "partition_by": GRID_PARTITION}
    lines = {**grid, "sales_before": p.sales_before}
    return PreparedTables(
        sales, monthly, snapshot(monthly, last_categories=p.categories, **grid),
        attr.ratio_attributes(sales, **lines), attr.store_attributes(sales, src.stores, **lines),
        snapshot_spans(monthly, **grid), attr.ratio_spans(sales, **lines),
        attr.store_spans(sales, src.stores, **lines))


def master_of(src: Sources, p: PrepParams, *, materialize_sales: bool = True) -> DataFrame:
    """The master table of a run in one grid expansion
    (:func:`~spendgrid.operators.attributes.master_table_from_parts`): the
    sale lines are joined once (and written once), the monthly facts, ratio
    counts and store leaders are computed on purchase months and expanded
    together."""
    from spendgrid.operators.attributes import (master_table_from_parts,
                                                ratio_monthly, store_leaders)
    sales = sales_of(src, p, header_columns=MASTER_HEADER_COLUMNS)
    if materialize_sales:
        sales = materialize(sales)
    monthly = monthly_summary(sales, categories=p.categories,
                              sales_before=p.sales_before)
    ratio_rows = ratio_monthly(sales, sales_before=p.sales_before)
    leaders = store_leaders(sales, src.stores, sales_before=p.sales_before,
                            partition_by=GRID_PARTITION)
    return master_table_from_parts(
        monthly, ratio_rows, leaders, src.consumer_variables,
        src.consumer_attributes, calendar_start=p.calendar_start,
        calendar_end=p.calendar_end, categories=p.categories,
        region=p.region, partition_by=GRID_PARTITION)


def fact_lines(sales: DataFrame, name: str) -> DataFrame:
    """Sale lines as the facts read them, with their month, written once and
    dealt by key and month: the three groupings of a month's facts move no rows,
    and a key with many lines is dealt by its months."""
    from spendgrid.sources.store import dealt_once
    return dealt_once(with_month(sales.select(*FACT_COLUMNS)), name, (*ENTITY_KEYS, MONTH))


# --- one month ---------------------------------------------------------------

def month_sales_of(src: Sources, p: PrepParams, month, *, horizon: int = 3, header_columns=MASTER_HEADER_COLUMNS) -> DataFrame:
    """Sale lines that a month's tables need: none after ``horizon`` months
    past it. The bound reaches the scans of lines and headers."""
    from spendgrid.functions.dates import add_months, first_of_month
    bound = add_months(first_of_month(month), horizon + 1)
    sales = sales_of(src, p, header_columns=header_columns)
    return sales.where(F.col("sale_dt") < F.lit(bound))


def snapshot_month_of(src: Sources, p: PrepParams, month) -> DataFrame:
    """One month of :func:`snapshot_of`, by one grouped aggregate over the
    monthly facts up to its targets, without the grid."""
    from spendgrid.operators.state import snapshot_month
    monthly = monthly_summary(month_sales_of(src, p, month, header_columns=()), categories=p.categories, sales_before=p.sales_before)
    return snapshot_month(monthly, month, calendar_start=p.calendar_start, calendar_end=p.calendar_end, last_categories=p.categories)


def snapshot_months_of(src: Sources, p: PrepParams, months) -> list[DataFrame]:
    """:func:`snapshot_month_of` for several months: the lines are joined and
    summarised once, up to the targets of the last month, and the monthly facts
    written; each month is one aggregate over them."""
    from spendgrid.functions.dates import first_of_month
    from spendgrid.operators.state import snapshot_month
    last = max(first_of_month(m) for m in months)
    monthly = materialize(monthly_summary(month_sales_of(src, p, last, header_columns=()), categories=p.categories, sales_before=p.sales_before), "monthly")
    return [snapshot_month(monthly, m, calendar_start=p.calendar_start, calendar_end=p.calendar_end, last_categories=p.categories) for m in months]


def master_month_of(src: Sources, p: PrepParams, month) -> DataFrame:
    """One month of the master table: the sale lines are joined and written
    once; snapshot, ratios and leading stores are one grouped aggregate each,
    with one row per key, and meet on the keys. Facts move by the entity id, in
    which the aggregates and their joins, people included, find them."""
    from spendgrid.functions.dates import add_months, first_of_month
    from spendgrid.operators import state as st
    from spendgrid.operators.attributes import master_rows, ratio_monthly

    sales = fact_lines(month_sales_of(src, p, month), "month_sales")
    upto = sales.where(F.col("sale_dt") < F.lit(add_months(first_of_month(month), 1)))
    by_entity = lambda facts: facts.repartition(*GRID_PARTITION)
    monthly = by_entity(monthly_summary(sales, categories=p.categories, sales_before=p.sales_before))
    snap = st.snapshot_month(monthly, month, calendar_start=p.calendar_start, calendar_end=p.calendar_end, last_categories=p.categories)
    ratios = st.ratio_rows_of(st.ratio_state(by_entity(ratio_monthly(upto, sales_before=p.sales_before)), month, calendar_start=p.calendar_start))
    leaders = st.leading_stores(st.visit_state(by_entity(st.monthly_visits(upto, sales_before=p.sales_before)), month))
    return master_rows(snap, ratios, leaders, src.stores, src.consumer_variables, src.consumer_attributes, region=p.region)
