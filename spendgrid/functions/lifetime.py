"""Customer-lifetime SQL functions and the RFM summary that feeds them.

The reference calls ``probability_alive(frequency, recency, T)`` and
``clv(frequency, recency, T, monetary_value)`` from SQL but does not define
them. Here they are SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``,
so they run inside codegen like any built-in), with the caller's fitted
parameters baked in:

* probability alive: the BG/NBD closed form (Fader, Hardie and Lee, 2005),
  ``1 / (1 + [x > 0] * a / (b + x - 1) * ((alpha + T) / (alpha + t_x))^(r + x))``
* clv (our definition): probability alive x expected purchase rate of an
  alive customer ``(r + x) / (alpha + T)`` x ``horizon`` x the gamma-gamma
  expected spend ``p (gamma + m x) / (p x + q - 1)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from spendgrid.functions.money import from_units, to_units


@dataclass(frozen=True)
class LifetimeParams:
    r: float = 0.24
    alpha: float = 4.41
    a: float = 0.79
    b: float = 2.43
    p: float = 6.25
    q: float = 3.74
    gamma: float = 15.44
    horizon: float = 12.0


def probability_alive_sql(par: LifetimeParams, x="frequency", tx="recency", t="T",
                          d: str = "D") -> str:
    """SQL text of the closed form; ``d`` is the double-literal suffix
    (``D`` for Spark SQL, empty for engines without one)."""
    return (f"CASE WHEN {x} > 0 THEN 1.0{d} / (1.0{d} + ({par.a}{d} / ({par.b}{d} + {x} - 1.0{d})) * "
            f"power(({par.alpha}{d} + {t}) / ({par.alpha}{d} + {tx}), {par.r}{d} + {x})) "
            f"ELSE 1.0{d} END")


def clv_sql(par: LifetimeParams, x="frequency", tx="recency", t="T",
            m="monetary_value", d: str = "D") -> str:
    alive = probability_alive_sql(par, x, tx, t, d)
    rate = f"(({par.r}{d} + {x}) / ({par.alpha}{d} + {t}))"
    spend = (f"({par.p}{d} * ({par.gamma}{d} + {m} * {x}) / "
             f"({par.p}{d} * {x} + {par.q}{d} - 1.0{d}))")
    return f"({alive}) * {rate} * {par.horizon}{d} * {spend}"


def register_lifetime_functions(spark: SparkSession,
                                par: LifetimeParams = LifetimeParams()) -> None:
    """Create ``probability_alive`` and ``clv`` as temporary SQL functions."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION probability_alive("
        "frequency DOUBLE, recency DOUBLE, T DOUBLE) RETURNS DOUBLE RETURN "
        + probability_alive_sql(par))
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION clv(frequency DOUBLE, recency DOUBLE, "
        "T DOUBLE, monetary_value DOUBLE) RETURNS DOUBLE RETURN " + clv_sql(par))


def function_problem(spark: SparkSession) -> str | None:
    """What keeps the two SQL functions from working in this session, or None.
    They are called on constants, so nothing is read or registered."""
    try:
        spark.sql("SELECT probability_alive(1, 2, 3), clv(1, 2, 3, 4)").first()
    except AnalysisException as missing:
        return missing.getMessage() or str(missing)
    return None


def rfm_summary(monthly: DataFrame, *, id_cols=("consumer_id",),
                month_col: str = "sale_month", amount_col: str = "sales_amount",
                observation_end=None) -> DataFrame:
    """Per customer, in months: ``frequency`` = purchase months after the
    first, ``recency`` = first to last purchase month, ``T`` = first purchase
    month to ``observation_end`` (the latest month when omitted), and
    ``monetary_value`` = mean amount of the repeat months (0 without any).

    One grouped aggregate (``min_by`` picks the first month's amount), so
    partial aggregation applies whatever the size of a customer.
    """
    ids = list(id_cols)
    per_month = monthly.groupBy(*ids, month_col).agg(
        F.sum(to_units(F.col(amount_col))).alias("_c"))
    if observation_end is None:
        end = per_month.agg(F.max(month_col)).first()[0]
    else:
        end = observation_end
    g = per_month.groupBy(*ids).agg(
        F.min(month_col).alias("_first"), F.max(month_col).alias("_last"),
        F.count(F.lit(1)).alias("_n"), F.sum("_c").alias("_tot"),
        F.min_by("_c", month_col).alias("_c0"))
    freq = F.col("_n") - 1
    end_lit = F.lit(str(end)[:10]).cast("date")
    return g.select(
        *ids, freq.cast("double").alias("frequency"),
        F.months_between("_last", "_first").alias("recency"),
        F.months_between(end_lit, "_first").alias("T"),
        F.coalesce(F.try_divide(from_units(F.col("_tot") - F.col("_c0")),
                                freq.cast("double")), F.lit(0.0)).alias("monetary_value"))
