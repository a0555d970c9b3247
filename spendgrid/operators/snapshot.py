"""Monthly snapshot grid and its window features.

The snapshot has one row per entity key and month, from the key's first
purchase month to the calendar end. Months without a purchase carry null
facts, so every ROWS frame below counts months.

Plan shape: the monthly facts are hash-partitioned once by the entity keys and
sorted; every window runs on these purchase months. A purchase month stands for
a span of grid months up to the next purchase and carries all that their rows
need, so the ``explode`` into the grid is the last step: the grid's rows (many
times as many) are projected and never exchanged, sorted or held. A key's
partition holds at most one row per calendar month, so even a key with a third
of all transactions gives a window partition of a few hundred rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgrid.functions.dates import first_of_month
from spendgrid.functions.money import from_units, mean_from_units, to_units
from spendgrid.operators import (CATEGORIES, ENTITY_KEYS, FEATURE_CATEGORIES,
                                 TARGET_CATEGORIES, category_prefix)
from spendgrid.operators.monthly import MONTH

SNAPSHOT = "snapshot_dt"
FACT_COLUMNS = ("sales_amount", "txn_cnt", "item_cnt")
TRAILING_MONTHS = (3, 6, 12, 24)


SPAN_MONTH, SPAN_INDEX = "_span_month", "_span_index"
SPAN_FROM, SPAN_TO, SPAN_LATE = "_span_from", "_span_to", "_span_late"
SPAN_COLUMNS = (SPAN_MONTH, SPAN_FROM, SPAN_TO, SPAN_LATE)


def _sparse(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(SPAN_INDEX)


def sparse_running(keys: Sequence[str] = ENTITY_KEYS) -> Window:
    """Running frame over a key's purchase months (the sparse rows that
    :func:`densify` expands): ``carry`` expressions use it."""
    return _sparse(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def spans(monthly: DataFrame, *, calendar_start, calendar_end,
          keys: Sequence[str] = ENTITY_KEYS, month_col: str = MONTH,
          columns: Sequence[str] | None = None,
          carry: dict[str, Column] | None = None,
          partition_by: Sequence[str] | None = None,
          carry_history: bool | Sequence[str] = False) -> DataFrame:
    """The sparse form of :func:`densify`: one row per key and purchase month
    with the months ``_span_from`` .. ``_span_to`` of the grid that it stands
    for, ``_span_late`` (months from the purchase to ``_span_from``, 0 unless
    the purchase lies before the calendar), the facts and the ``carry``
    values. :func:`expand` makes the grid of it."""
    start = first_of_month(calendar_start)
    end = first_of_month(calendar_end)
    if columns is None:
        columns = [c for c in monthly.columns
                   if c not in set(keys) | {month_col, "etl_date"}]
    carry = carry or {}
    m, index = F.col(SPAN_MONTH), F.col(SPAN_INDEX)
    in_cal = m >= F.lit(start)
    facts = monthly.where(F.col(month_col) <= F.lit(end))
    if partition_by:
        facts = facts.repartition(*partition_by)

    def keep(c: str) -> bool:
        if isinstance(carry_history, bool):
            return carry_history
        return c in set(carry_history)

    facts = facts.select(*keys, F.col(month_col).alias(SPAN_MONTH),
                         (F.year(month_col) * 12 + F.month(month_col)).alias(SPAN_INDEX),
                         *[F.col(c) if keep(c) else F.when(F.col(month_col) >= F.lit(start), F.col(c)).alias(c)
                           for c in [month_col, *columns]])
    order = _sparse(keys)
    nxt = F.lead(m).over(order)
    span_start = (F.when(in_cal, m)
                  .when(nxt.isNull() | (nxt > F.lit(start)), F.lit(start)))
    repeated = F.raise_error(F.lit("a key has two rows in one month; summarise by month first"))
    span_end = (F.when(F.lead(index).over(order) == index, repeated.cast("date"))
                .otherwise(F.coalesce(F.add_months(nxt, -1), F.lit(end))))
    late = F.when(in_cal, 0).otherwise(F.lit(start.year * 12 + start.month) - index)
    return (facts.select(*keys, SPAN_MONTH, month_col, *columns,
                         *[e.alias(n) for n, e in carry.items()],
                         span_start.alias(SPAN_FROM), span_end.alias(SPAN_TO), late.alias(SPAN_LATE))
            .where(F.col(SPAN_FROM).isNotNull() & (F.col(SPAN_FROM) <= F.col(SPAN_TO))))


def expand(sparse: DataFrame) -> DataFrame:
    """The rows of :func:`spans`, one for each month of the span: ``dt``, and
    ``_age``, the months since the purchase. A purchase's own month has age 0."""
    step = F.col("_step")
    last = F.months_between(SPAN_TO, SPAN_FROM).cast("int")
    return (sparse.select("*", F.explode(F.sequence(F.lit(0), last)).alias("_step"))
            .select(F.add_months(SPAN_FROM, step).alias("dt"), (step + F.col(SPAN_LATE)).alias(AGE),
                    *[c for c in sparse.columns if c not in SPAN_COLUMNS]))


AGE = "_age"


def densify(monthly: DataFrame, *, calendar_start, calendar_end,
            keys: Sequence[str] = ENTITY_KEYS, month_col: str = MONTH,
            columns: Sequence[str] | None = None,
            carry: dict[str, Column] | None = None,
            partition_by: Sequence[str] | None = None,
            carry_history: bool | Sequence[str] = False) -> DataFrame:
    """Dense (keys, month) grid with the monthly facts; null facts in months
    without a purchase.

    Rows: every calendar month (``calendar_start`` .. ``calendar_end``, both
    truncated to the month) from the key's first purchase month on -- the
    reference's cross join of keys with the calendar, filtered by
    ``dt >= first month`` and left-joined with the facts on (keys, month).

    Written as one pass instead of a join: within a key (one hash exchange on
    the keys), each purchase month spans the months up to the next purchase
    (``lead``), and ``explode(sequence(...))`` emits them; the purchase's facts
    go on the first month only. The last purchase before the calendar opens
    spans from the calendar start, so keys that began earlier still start
    there. Two rows of a key in one month are an error. No second read of the facts and no join exchange; a window over
    the keys afterwards needs no exchange either. Each key yields at most one
    row per calendar month.

    ``carry`` maps output names to window expressions over
    :func:`sparse_running` evaluated on the purchase rows (facts before the
    calendar start are blanked for them, as the grid never holds those
    months; ``carry_history=True`` keeps them, or a list keeps just those
    columns) and copied onto every month
    of the row's span. A running total only changes in a purchase month, so
    it costs one evaluation per purchase month rather than one per calendar
    month.

    ``partition_by`` (a subset of ``keys``, e.g. the entity id alone) hash-
    partitions by those columns instead: every grid built this way -- the
    snapshot and the attribute tables -- is then co-partitioned, and joins
    between them on (keys, month) need no exchange (with
    ``spark.sql.requireAllClusterKeysForCoPartition=false``).
    """
    if columns is None:
        columns = [c for c in monthly.columns
                   if c not in set(keys) | {month_col, "etl_date"}]
    carry = carry or {}
    grid = expand(spans(monthly, calendar_start=calendar_start, calendar_end=calendar_end,
                        keys=keys, month_col=month_col, columns=columns, carry=carry,
                        partition_by=partition_by, carry_history=carry_history))
    return grid.select("dt", *keys, *[in_month(F.col(c)).alias(c) for c in (month_col, *columns)], *carry)


def in_month(value: Column) -> Column:
    """A purchase's value in its own month of the grid; null in the months after."""
    return F.when(F.col(AGE) == 0, value)


def month_grid(monthly: DataFrame, *, calendar_start, calendar_end,
               keys: Sequence[str] = ENTITY_KEYS,
               month_col: str = MONTH) -> DataFrame:
    """(keys, dt): every calendar month from the key's first purchase month
    on (the grid of :func:`densify` without the facts)."""
    return densify(monthly, calendar_start=calendar_start,
                   calendar_end=calendar_end, keys=keys, month_col=month_col,
                   columns=[]).select(*keys, "dt")


def _pos(col: Column) -> Column:
    return F.when(col > 0, col)


BITS = 62  # months that a number remembers


def _low_bits(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1


def _recent_flags(keys: Sequence[str], flag: Column, months: int) -> Column:
    """The flag of the last ``months`` months as bits, the purchase's own month
    in bit 0. Months of one frame differ by less than ``months``, so each has a
    place of its own modulo ``months``; the bits are then turned to the month."""
    index = F.col(SPAN_INDEX)
    place = F.pmod(-index, F.lit(months))
    shift = lambda way, value, n: F.call_function(way, value, n)
    bits = F.bit_or(F.when(flag, shift("shiftleft", F.lit(1).cast("long"), place))).over(_sparse(keys).rangeBetween(1 - months, 0))
    bits = F.coalesce(bits, F.lit(0).cast("long"))
    turned = shift("shiftright", bits, place).bitwiseOR(shift("shiftleft", bits, months - place))
    return turned.bitwiseAND(_low_bits(F.lit(months)))


def _recent_sums(keys: Sequence[str], value: Column, months: int) -> Column:
    """Sums of ``value`` over the last 1, 2 .. ``months`` months, as an array."""
    index = F.col(SPAN_INDEX)
    inside = F.collect_list(F.when(value.isNotNull(), F.struct(index.alias("at"), value.cast("long").alias("value")))).over(
        _sparse(keys).rangeBetween(1 - months, 0))
    return F.transform(F.sequence(F.lit(1), F.lit(months)), lambda n: F.aggregate(
        inside, F.lit(0).cast("long"), lambda total, e: total + F.when(e["at"] > index - n, e["value"]).otherwise(0)))


def _trailing_flags(name: str, n: int) -> Column:
    """Flagged months among a grid month and the ``n - 1`` before it. The months
    since the purchase have no flag, so as many fewer bits are counted."""
    if n > BITS:
        return _trailing_sum(f"{name}_wide", n)
    return F.bit_count(F.col(_recent(name)).bitwiseAND(_low_bits(F.greatest(F.lit(n) - F.col(AGE), F.lit(0)))))


def _trailing_sum(name: str, n: int) -> Column:
    return F.coalesce(F.get(F.col(_recent(name)), F.lit(n - 1) - F.col(AGE)), F.lit(0).cast("long"))


def _recent(name: str) -> str:
    return f"_recent_{name}"


def running_columns(*, keys: Sequence[str] = ENTITY_KEYS,
                    target_categories: Sequence[str] = TARGET_CATEGORIES,
                    feature_categories: Sequence[str] = FEATURE_CATEGORIES,
                    horizon: int = 3, trailing_months: Sequence[int] = TRAILING_MONTHS,
                    avg_months: int = 12, active_months: int = 12) -> dict[str, Column]:
    """What a purchase month's span needs for its grid months: running
    aggregates, ``_recent_*`` (flags and sums of the last months, from which the
    trailing windows are read) and the ``horizon`` purchases that follow, for the
    targets. All are evaluated on the purchase months alone."""
    run, order, index = sparse_running(keys), _sparse(keys), F.col(SPAN_INDEX)
    widest = max(*trailing_months, avg_months, active_months)

    def flags(name: str, flag: Column, months: int) -> dict[str, Column]:
        found = {_recent(name): _recent_flags(keys, flag, min(months, BITS))}
        if months > BITS:
            found[_recent(f"{name}_wide")] = _recent_sums(keys, F.when(flag, 1), months)
        return found

    sales, item = F.col("sales_amount"), F.col("item_cnt")
    first = F.min(MONTH).over(run)
    out = {
        "first_purchase_dt": first,
        "last_purchase_dt": F.max(MONTH).over(run),
        "_since_first": F.months_between(F.col(MONTH), first),
        "sales_tot": from_units(F.sum(to_units(sales)).over(run)),
        "txn_cnt_tot": F.sum("txn_cnt").over(run).cast("double"),
        "avg_item_cnt": F.try_divide(F.sum(_pos(item)).over(run).cast("double"),
                                     F.count(_pos(item)).over(run).cast("double")),
        **flags("sales", sales > 0, active_months),
    }
    for cat in feature_categories:
        p = category_prefix(cat)
        amt = F.col(f"{p}_amount")
        pos_n = F.count(_pos(amt)).over(run)
        pos_units = F.sum(to_units(_pos(amt))).over(run)
        out.update({
            f"{p}_amt_tot": from_units(F.sum(to_units(amt)).over(run)),
            f"{p}_cnt_tot": pos_n.cast("double"),
            f"{p}_min": F.min(_pos(amt)).over(run),
            f"{p}_max": F.max(_pos(amt)).over(run),
            f"{p}_avg": F.when(pos_n > 0, mean_from_units(pos_units, pos_n)),
            **flags(f"{p}_flags", amt > 0, widest),
            _recent(f"{p}_units"): _recent_sums(keys, to_units(_pos(amt)), avg_months),
        })
    for k in range(1, horizon + 1):
        out[f"_next_{k}"] = F.lead(index, k).over(order) - index
        for cat in target_categories:
            p = category_prefix(cat)
            out[f"_next_{k}_{p}"] = F.coalesce(F.lead(to_units(F.col(f"{p}_amount")), k).over(order), F.lit(0).cast("long"))
    return out


def snapshot_columns(*, keys: Sequence[str] = ENTITY_KEYS,
                     target_categories: Sequence[str] = TARGET_CATEGORIES,
                     feature_categories: Sequence[str] = FEATURE_CATEGORIES,
                     last_categories: Sequence[str] = CATEGORIES,
                     horizon: int = 3,
                     trailing_months: Sequence[int] = TRAILING_MONTHS,
                     avg_months: int = 12,
                     active_months: int = 12) -> list[Column]:
    """The snapshot's output columns, in order, over the expanded spans that
    carry :func:`running_columns` of the same arguments. A month's row follows
    from its span alone: the grid is neither sorted nor windowed."""
    since, age = F.col("_since_first"), F.col(AGE)
    cols: list[Column] = [F.col("dt").alias(SNAPSHOT), *[F.col(k) for k in keys]]

    for cat in target_categories:
        ahead = F.lit(0).cast("long")
        for k in range(1, horizon + 1):
            ahead = ahead + F.when(F.col(f"_next_{k}") <= age + horizon, F.col(f"_next_{k}_{category_prefix(cat)}")).otherwise(0)
        cols.append(F.when(ahead > 0, 1).otherwise(0)
                    .cast("int").alias(f"target_{category_prefix(cat)}"))

    cols += [
        F.col("first_purchase_dt"), F.col("last_purchase_dt"),
        F.col("sales_tot"), F.col("txn_cnt_tot"),
        _trailing_flags("sales", active_months)
        .cast("double").alias(f"sales_mnt_cnt_{active_months}m"),
        F.col("avg_item_cnt"),
    ]
    for cat in last_categories:
        cols.append(in_month(F.col(f"{category_prefix(cat)}_amount"))
                    .alias(f"{category_prefix(cat)}_amt_last"))
    cols += [
        in_month(F.col("item_cnt")).cast("double").alias("item_cnt_last"),
        in_month(F.col("txn_cnt")).cast("double").alias("txn_cnt_last"),
        in_month(F.col("sales_amount")).alias("sales_amt_last"),
    ]
    for cat in feature_categories:
        p = category_prefix(cat)
        for n in trailing_months:
            cols.append(_trailing_flags(f"{p}_flags", n).cast("double")
                        .alias(f"{p}_cnt_{n}m"))
        pos_n = _trailing_flags(f"{p}_flags", avg_months)
        cols.append(F.when(pos_n > 0, mean_from_units(
            _trailing_sum(f"{p}_units", avg_months), pos_n))
            .alias(f"{p}_avg_{avg_months}m"))
        cols += [F.col(f"{p}_amt_tot"),
                 F.col(f"{p}_cnt_tot"),
                 F.col(f"{p}_min"), F.col(f"{p}_max"), F.col(f"{p}_avg")]
    cols += [
        (since + age).alias("months_since_first_purchase"),
        F.when(F.col("last_purchase_dt").isNotNull(), age.cast("double")).alias("months_since_last_purchase")]
    return cols


def snapshot_spans(monthly: DataFrame, *, calendar_start, calendar_end,
                   keys: Sequence[str] = ENTITY_KEYS,
                   partition_by: Sequence[str] | None = None, **windows) -> DataFrame:
    """The sparse form of :func:`snapshot`: spans with :func:`running_columns`
    (whose arguments ``windows`` are)."""
    return spans(monthly, calendar_start=calendar_start, calendar_end=calendar_end, keys=keys,
                 partition_by=partition_by, carry=running_columns(keys=keys, **windows))


def snapshot(monthly: DataFrame, *, calendar_start, calendar_end,
             keys: Sequence[str] = ENTITY_KEYS,
             target_categories: Sequence[str] = TARGET_CATEGORIES,
             feature_categories: Sequence[str] = FEATURE_CATEGORIES,
             last_categories: Sequence[str] = CATEGORIES,
             horizon: int = 3,
             trailing_months: Sequence[int] = TRAILING_MONTHS,
             avg_months: int = 12,
             label_complete: bool = False,
             partition_by: Sequence[str] | None = None) -> DataFrame:
    """Full snapshot: targets over the next ``horizon`` months, running
    first/last purchase and totals, active months in 12, current-month
    values, trailing category counts and averages, running category stats,
    and months since first / last purchase.

    The last ``horizon`` months of a key have truncated targets (the last
    month's is always 0), as in the reference; ``label_complete=True`` adds
    a flag telling whether the whole forward window lies in the calendar.
    """
    out = expand(snapshot_spans(
        monthly, calendar_start=calendar_start, calendar_end=calendar_end, keys=keys,
        target_categories=target_categories, feature_categories=feature_categories,
        horizon=horizon, trailing_months=trailing_months, avg_months=avg_months,
        partition_by=partition_by))
    out = out.select(*snapshot_columns(
        keys=keys, target_categories=target_categories, feature_categories=feature_categories,
        last_categories=last_categories, horizon=horizon, trailing_months=trailing_months,
        avg_months=avg_months))
    if label_complete:
        end = first_of_month(calendar_end)
        out = out.withColumn(
            "label_complete",
            F.add_months(F.col(SNAPSHOT), horizon) <= F.lit(end))
    return out
