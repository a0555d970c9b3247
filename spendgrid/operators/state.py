"""One month of the snapshot, the ratios and the store leaders without the
grid of all months.

:func:`~spendgrid.operators.snapshot.snapshot` builds every month of every key.
Scoring and training read one month of it. What that month's row needs from the
past fits in one *state* row per key:

* running sums, counts, minima and maxima, first and last purchase month;
* for every flag that trailing windows count, the last months as bits of a
  number (bit ``k``: the flag ``k`` months ago), so that a count over ``n``
  months is ``bit_count(bits & (2**n - 1))``;
* the positive amounts of the last ``RING`` months as an array, newest first,
  for trailing averages;
* the month's own values.

:func:`month_state` computes the state of a month from monthly facts in one
grouped aggregate (no window, no grid). :func:`fold_month` moves a stored state
forward by one month from that month's facts alone: bits shift, the ring takes
a value in front and loses its last. :func:`snapshot_rows` turns a state into
snapshot rows, equal to the grid's rows of that month. Ratios and stores have
states of plain sums, which :func:`fold_sums` adds up.

Every state has one row per key (per key and store for visits), whatever the
number of months behind it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgrid.functions.dates import add_months, first_of_month
from spendgrid.functions.money import from_units, mean_from_units, to_units
from spendgrid.operators import CATEGORIES, ENTITY_KEYS, FEATURE_CATEGORIES, TARGET_CATEGORIES, category_prefix
from spendgrid.operators.attributes import RATIO_CHANNELS, STORE_COLUMNS
from spendgrid.operators.monthly import MONTH, with_month
from spendgrid.operators.snapshot import SNAPSHOT, TRAILING_MONTHS

RING = 12
BITS = 62  # months that a number remembers
_SUMS = ("sales_units", "txn_tot", "item_pos", "item_pos_n")


def _back(month: _dt.date, column: str = MONTH) -> Column:
    """Months from the row's month to ``month``; negative after it."""
    return F.lit(month.year * 12 + month.month) - (F.year(column) * 12 + F.month(column))


def _bit(back: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(back, F.lit(0)).cast("int"))


def _low_bits(n: int) -> Column:
    return F.lit((1 << n) - 1).cast("long")


def month_state(monthly: DataFrame, month, *, keys: Sequence[str] = ENTITY_KEYS,
                calendar_start=None, horizon: int = 0, calendar_end=None,
                feature_categories: Sequence[str] = FEATURE_CATEGORIES,
                last_categories: Sequence[str] = CATEGORIES,
                target_categories: Sequence[str] = TARGET_CATEGORIES) -> DataFrame:
    """The state of all keys with a purchase up to ``month``.

    Facts before ``calendar_start`` make a key known and count for nothing
    else, as in the grid. With a ``horizon`` the sums of the following months
    (up to ``calendar_end``) come along as ``next_<category>``, so that a month's
    snapshot is one pass over the facts. Two rows of a key in one month are an
    error.
    """
    month = first_of_month(month)
    last = add_months(month, horizon)
    if calendar_end is not None:
        last = min(last, first_of_month(calendar_end))
    rows = monthly.where(F.col(MONTH) <= F.lit(max(last, month))).withColumn("_back", _back(month))
    # what many aggregates read is worked out once for a row, not in each of them
    known = F.col("_back") >= 0
    rows = rows.withColumn("_counts", known if calendar_start is None else known & (F.col(MONTH) >= F.lit(first_of_month(calendar_start))))
    back, counts = F.col("_back"), F.col("_counts")
    prefixes = [category_prefix(c) for c in feature_categories]
    rows = rows.withColumns({
        "_bit": _bit(back), "_recent": counts & (back < BITS),
        **{f"_{p}_units": F.when(counts, to_units(F.col(f"{p}_amount"))) for p in prefixes},
        **{f"_{p}_pos": F.when(counts & (F.col(f"{p}_amount") > 0), F.col(f"{p}_amount")) for p in prefixes}})
    now = counts & (back == 0)
    when = lambda value: F.when(counts, value)
    remembered = F.when(known & (back < BITS), F.col("_bit"))
    zero = F.lit(0).cast("long")

    def bits(amount: Column) -> Column:
        return F.coalesce(F.bit_or(F.when(F.col("_recent") & (amount > 0), F.col("_bit"))), zero)

    sales, item = F.col("sales_amount"), F.col("item_cnt")
    aggs = [
        F.count_if(known).alias("_known"), F.sum(remembered).alias("_months"), F.bit_or(remembered).alias("_distinct"),
        F.min(when(F.col(MONTH))).alias("first_purchase_dt"), F.max(when(F.col(MONTH))).alias("last_purchase_dt"),
        F.sum(when(to_units(sales))).alias("sales_units"), F.sum(when(F.col("txn_cnt"))).alias("txn_tot"),
        F.sum(F.when(counts & (item > 0), item)).alias("item_pos"), F.count_if(counts & (item > 0)).alias("item_pos_n"),
        bits(sales).alias("sales_bits"),
    ]
    for p in prefixes:
        positive, units = F.col(f"_{p}_pos"), F.col(f"_{p}_units")
        here = positive.isNotNull()
        aggs += [
            F.sum(units).alias(f"{p}_units"), F.count(positive).alias(f"{p}_n"), F.min(positive).alias(f"{p}_min"), F.max(positive).alias(f"{p}_max"),
            F.coalesce(F.sum(F.when(here, units)), F.lit(0)).cast("long").alias(f"{p}_pos_units"), bits(positive).alias(f"{p}_bits"),
            F.array(*[F.coalesce(F.sum(F.when(here & (back == k), units)), zero) for k in range(RING)]).alias(f"{p}_ring"),
        ]
    values = [f"{category_prefix(c)}_amount" for c in last_categories] + ["item_cnt", "txn_cnt", "sales_amount"]
    aggs += [F.max(F.when(now, F.col(v))).alias(f"now_{v}") for v in values]
    if horizon:
        ahead = (back < 0) & (F.col(MONTH) <= F.lit(last))
        aggs += [F.sum(F.when(ahead, to_units(F.col(f"{category_prefix(c)}_amount")))).alias(f"next_{category_prefix(c)}") for c in target_categories]
    state = rows.groupBy(*keys).agg(*aggs)
    repeated = F.raise_error(F.lit("a key has two rows in one month; summarise by month first"))
    # distinct powers of two add up to their bits; a repeated one does not
    return state.where(F.when(F.col("_months") != F.col("_distinct"), repeated.cast("boolean")).otherwise(F.col("_known") > 0)).drop(
        "_known", "_months", "_distinct")


def _plus(a: Column, b: Column) -> Column:
    """Sum in which a null adds nothing; null if both are."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def fold_month(state: DataFrame, facts: DataFrame, month, *, keys: Sequence[str] = ENTITY_KEYS,
               feature_categories: Sequence[str] = FEATURE_CATEGORIES,
               last_categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """The state of ``month`` from the state of the month before and the
    ``month``'s facts (one row per key). Both sides are read once; stored
    bucketed by the keys, they join where they are. Keys are never null
    (validated headers and lines have none)."""
    month = first_of_month(month)
    keys = list(keys)
    values = [f"{category_prefix(c)}_amount" for c in last_categories] + ["item_cnt", "txn_cnt", "sales_amount"]
    values = list(dict.fromkeys(values + [f"{category_prefix(c)}_amount" for c in feature_categories]))
    new = facts.where(F.col(MONTH) == F.lit(month)).select(*[F.col(k).alias(f"n_{k}") for k in keys], *[F.col(v).alias(f"n_{v}") for v in values],
                                                           F.lit(True).alias("n_here"))
    old = state.select(*[F.col(c).alias(f"o_{c}") for c in state.columns], F.lit(True).alias("o_here"))
    same = [F.col(f"o_{k}") == F.col(f"n_{k}") for k in keys]
    both = old.join(new, on=same, how="full")
    here = F.col("n_here").isNotNull()
    o, n = (lambda c: F.col(f"o_{c}")), (lambda c: F.col(f"n_{c}"))
    this = F.lit(month)
    item, zero = n("item_cnt"), F.lit(0).cast("long")

    def shifted(name: str, amount: Column) -> Column:
        moved = F.shiftleft(F.coalesce(o(name), zero), 1).bitwiseAND(_low_bits(BITS))
        return moved.bitwiseOR(F.when(amount > 0, 1).otherwise(0).cast("long"))

    out = [F.when(F.col("o_here").isNotNull(), o(k)).otherwise(n(k)).alias(k) for k in keys]
    out += [
        F.coalesce(o("first_purchase_dt"), F.when(here, this)).alias("first_purchase_dt"),
        F.when(here, this).otherwise(o("last_purchase_dt")).alias("last_purchase_dt"),
        _plus(o("sales_units"), to_units(n("sales_amount"))).alias("sales_units"), _plus(o("txn_tot"), n("txn_cnt")).alias("txn_tot"),
        _plus(o("item_pos"), F.when(item > 0, item)).alias("item_pos"),
        (F.coalesce(o("item_pos_n"), zero) + F.when(item > 0, 1).otherwise(0)).alias("item_pos_n"),
        shifted("sales_bits", n("sales_amount")).alias("sales_bits"),
    ]
    for category in feature_categories:
        p = category_prefix(category)
        amount = n(f"{p}_amount")
        positive = F.when(amount > 0, amount)
        units = F.coalesce(to_units(positive), zero)
        out += [
            _plus(o(f"{p}_units"), to_units(amount)).alias(f"{p}_units"),
            (F.coalesce(o(f"{p}_n"), zero) + F.when(amount > 0, 1).otherwise(0)).alias(f"{p}_n"),
            F.least(o(f"{p}_min"), positive).alias(f"{p}_min"), F.greatest(o(f"{p}_max"), positive).alias(f"{p}_max"),
            (F.coalesce(o(f"{p}_pos_units"), zero) + units).alias(f"{p}_pos_units"), shifted(f"{p}_bits", amount).alias(f"{p}_bits"),
            F.concat(F.array(units), F.slice(F.coalesce(o(f"{p}_ring"), F.array_repeat(zero, RING)), 1, RING - 1)).alias(f"{p}_ring"),
        ]
    out += [F.when(here, n(v)).alias(f"now_{v}") for v in [f"{category_prefix(c)}_amount" for c in last_categories] + ["item_cnt", "txn_cnt", "sales_amount"]]
    return both.select(*out)


def next_sums(monthly: DataFrame, month, *, horizon: int = 3, calendar_end=None, keys: Sequence[str] = ENTITY_KEYS,
              target_categories: Sequence[str] = TARGET_CATEGORIES) -> DataFrame:
    """``next_<category>`` per key over the ``horizon`` months after ``month``:
    what a stored state lacks for its targets. Reads those months only."""
    month = first_of_month(month)
    last = add_months(month, horizon)
    if calendar_end is not None:
        last = min(last, first_of_month(calendar_end))
    rows = monthly.where((F.col(MONTH) > F.lit(month)) & (F.col(MONTH) <= F.lit(last)))
    return rows.groupBy(*keys).agg(*[F.sum(to_units(F.col(f"{category_prefix(c)}_amount"))).alias(f"next_{category_prefix(c)}")
                                     for c in target_categories])


def snapshot_rows(state: DataFrame, month, *, keys: Sequence[str] = ENTITY_KEYS,
                  target_categories: Sequence[str] = TARGET_CATEGORIES, feature_categories: Sequence[str] = FEATURE_CATEGORIES,
                  last_categories: Sequence[str] = CATEGORIES, trailing_months: Sequence[int] = TRAILING_MONTHS,
                  avg_months: int = RING, active_months: int = 12) -> DataFrame:
    """The snapshot's rows of ``month`` (its columns, in its order) from a state
    with ``next_<category>`` sums."""
    if max(*trailing_months, avg_months, active_months) > BITS or avg_months > RING:
        raise ValueError(f"a state remembers flags of {BITS} months and amounts of {RING}")
    counted = lambda name, n: F.bit_count(F.col(name).bitwiseAND(_low_bits(n)))
    cols = [F.lit(first_of_month(month)).alias(SNAPSHOT), *[F.col(k) for k in keys]]
    cols += [F.when(F.col(f"next_{category_prefix(c)}") > 0, 1).otherwise(0).cast("int").alias(f"target_{category_prefix(c)}") for c in target_categories]
    cols += [
        F.col("first_purchase_dt"), F.col("last_purchase_dt"), from_units(F.col("sales_units")).alias("sales_tot"),
        F.col("txn_tot").cast("double").alias("txn_cnt_tot"), counted("sales_bits", active_months).cast("double").alias(f"sales_mnt_cnt_{active_months}m"),
        F.try_divide(F.col("item_pos").cast("double"), F.col("item_pos_n").cast("double")).alias("avg_item_cnt"),
    ]
    cols += [F.col(f"now_{category_prefix(c)}_amount").alias(f"{category_prefix(c)}_amt_last") for c in last_categories]
    cols += [F.col("now_item_cnt").cast("double").alias("item_cnt_last"), F.col("now_txn_cnt").cast("double").alias("txn_cnt_last"),
             F.col("now_sales_amount").alias("sales_amt_last")]
    for category in feature_categories:
        p = category_prefix(category)
        cols += [counted(f"{p}_bits", n).cast("double").alias(f"{p}_cnt_{n}m") for n in trailing_months]
        recent = F.aggregate(F.slice(f"{p}_ring", 1, avg_months), F.lit(0).cast("long"), lambda a, b: a + b)
        cols += [
            F.when(counted(f"{p}_bits", avg_months) > 0, mean_from_units(recent, counted(f"{p}_bits", avg_months))).alias(f"{p}_avg_{avg_months}m"),
            from_units(F.col(f"{p}_units")).alias(f"{p}_amt_tot"), F.col(f"{p}_n").cast("double").alias(f"{p}_cnt_tot"),
            F.col(f"{p}_min"), F.col(f"{p}_max"), F.when(F.col(f"{p}_n") > 0, mean_from_units(F.col(f"{p}_pos_units"), F.col(f"{p}_n"))).alias(f"{p}_avg"),
        ]
    out = state.select(*cols)
    return out.select("*", F.months_between(SNAPSHOT, "first_purchase_dt").alias("months_since_first_purchase"),
                      F.months_between(SNAPSHOT, "last_purchase_dt").alias("months_since_last_purchase"))


def snapshot_month(monthly: DataFrame, month, *, calendar_start, calendar_end, keys: Sequence[str] = ENTITY_KEYS,
                   target_categories: Sequence[str] = TARGET_CATEGORIES, feature_categories: Sequence[str] = FEATURE_CATEGORIES,
                   last_categories: Sequence[str] = CATEGORIES, horizon: int = 3,
                   trailing_months: Sequence[int] = TRAILING_MONTHS, avg_months: int = RING) -> DataFrame:
    """The rows of one calendar month of :func:`~spendgrid.operators.snapshot.snapshot`,
    in one grouped aggregate over the facts up to ``horizon`` months after it.
    No rows outside the calendar."""
    state = month_state(monthly, month, keys=keys, calendar_start=calendar_start, calendar_end=calendar_end, horizon=horizon,
                        feature_categories=feature_categories, last_categories=last_categories, target_categories=target_categories)
    if not first_of_month(calendar_start) <= first_of_month(month) <= first_of_month(calendar_end):
        state = state.where(F.lit(False))
    return snapshot_rows(state, month, keys=keys, target_categories=target_categories, feature_categories=feature_categories,
                         last_categories=last_categories, trailing_months=trailing_months, avg_months=avg_months)


# --- ratios and stores ---------------------------------------------------------------

_RATIO_SUMS = ("_txn", *[f"_{k}" for k in RATIO_CHANNELS], "_loyal", "_ret", "_sales", "_disc", "_q4")


def fold_sums(state: DataFrame | None, more: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """A state of plain sums with more rows added, whichever months they are of."""
    rows = more.select(*keys, *sums) if state is None else state.select(*keys, *sums).unionByName(more.select(*keys, *sums))
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def ratio_state(ratio_rows: DataFrame, month, *, calendar_start=None, keys: Sequence[str] = ENTITY_KEYS,
                state: DataFrame | None = None) -> DataFrame:
    """Sums of :func:`~spendgrid.operators.attributes.ratio_monthly` up to
    ``month``, or of ``month`` alone on top of an earlier ``state``. A key whose
    months lie before the calendar is kept, with null sums."""
    month = first_of_month(month)
    rows = ratio_rows.where(F.col(MONTH) <= F.lit(month)) if state is None else ratio_rows.where(F.col(MONTH) == F.lit(month))
    if calendar_start is not None:
        inside = F.col(MONTH) >= F.lit(first_of_month(calendar_start))
        rows = rows.select(*keys, *[F.when(inside, F.col(c)).alias(c) for c in _RATIO_SUMS])
    return fold_sums(state, rows, keys, _RATIO_SUMS)


def ratio_rows_of(state: DataFrame, keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Behaviour ratios per key from their sums."""
    ratio = lambda num, den: F.try_divide(F.col(num).cast("double"), F.col(den).cast("double"))
    return state.select(
        *keys, *[ratio(f"_{k}", "_txn").alias(f"{k}_txn_ratio") for k in RATIO_CHANNELS], ratio("_disc", "_sales").alias("discount_ratio"),
        ratio("_q4", "_sales").alias("sales_q4_ratio"), ratio("_loyal", "_txn").alias("loyalty_txn_ratio"), ratio("_ret", "_txn").alias("return_txn_ratio"))


def monthly_visits(sales: DataFrame, *, keys: Sequence[str] = ENTITY_KEYS, sales_before=None, store_col: str = "store_id") -> DataFrame:
    """Transactions per key, store and month (``n``); a null store for lines without one."""
    rows = sales if sales_before is None else sales.where(F.col("sale_dt") < F.lit(sales_before).cast("date"))
    return with_month(rows).groupBy(*keys, store_col, MONTH).agg(F.countDistinct("txn_id").alias("n"))


def visit_state(visits: DataFrame, month, *, keys: Sequence[str] = ENTITY_KEYS, store_col: str = "store_id", state: DataFrame | None = None) -> DataFrame:
    """Transactions per key and store up to ``month``."""
    month = first_of_month(month)
    rows = visits.where(F.col(MONTH) <= F.lit(month)) if state is None else visits.where(F.col(MONTH) == F.lit(month))
    return fold_sums(state, rows, [*keys, store_col], ["n"])


def leading_stores(state: DataFrame, keys: Sequence[str] = ENTITY_KEYS, store_col: str = "store_id") -> DataFrame:
    """``most_freq_store_id`` per key: most transactions, ties to the lowest id;
    null for a key that has been to no known store."""
    first = F.max(F.when(F.col(store_col).isNotNull(), F.struct("n", (-F.col(store_col)).alias("minus"))))
    return state.groupBy(*keys).agg(first.alias("_first")).select(*keys, (-F.col("_first.minus")).alias("most_freq_store_id"))
