"""Model matrix: feature selection, null filling by kind, one-hot
encoding with a fixed vocabulary, score-query projection and dataset
profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values of the reference training job: ids, dates, targets and
# sensitive attributes left out of the features, and 0/1 indicators that
# are treated as categories.
DROP_COLUMNS = ('snapshot_dt', 'elc_master_id', 'consumer_id', 'brand_id',
                'first_purchase_dt', 'last_purchase_dt',
                'store_latitude', 'store_longitude', 'store_brand_cd',
                'ethnic_group', 'ethnicity_detail', 'gender', 'language',
                'age_range', 'lang_cd', 'mosaic_segment', 'mosaic_group',
                'exists_in_cdp', 'first_store_id', 'last_store_id',
                'most_frequent_store', 'store_name', 'closest_store',
                'most_freq_store_id', 'deceased_flag', 'prison_flag',
                'target_makeup', 'target_skincare', 'target_fragrance',
                'target_haircare')
INDICATOR_COLUMNS = ('email_opt_in_ind', 'phone_opt_in_ind', 'dm_opt_in_ind',
                     'mobile_opt_in_ind', 'mobile_contactable_ind')
UNKNOWN = "Unknown"
ID_COLUMNS = ("snapshot_dt", "elc_master_id", "consumer_id", "brand_id")


def feature_kinds(df: DataFrame, *, drop: Sequence[str] = DROP_COLUMNS,
                  indicators: Sequence[str] = INDICATOR_COLUMNS
                  ) -> tuple[list[str], list[str], list[str]]:
    """(categorical, indicator, numeric) feature columns of ``df``:
    text columns are categorical, listed indicators become categories, the
    rest is numeric. Dropped columns are left out."""
    keep = [f for f in df.schema.fields if f.name not in set(drop)]
    ind = [f.name for f in keep if f.name in set(indicators)]
    cat = [f.name for f in keep
           if isinstance(f.dataType, StringType) and f.name not in set(ind)]
    num = [f.name for f in keep if f.name not in set(cat) | set(ind)]
    return cat, ind, num


def filled_features(categorical: Sequence[str], indicators: Sequence[str],
                    numeric: Sequence[str]) -> list[Column]:
    """Select-list with nulls filled by kind: categories 'Unknown',
    indicators as text or 'Unknown', numbers as double or 0."""
    cols = [F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in categorical]
    cols += [F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c)
             for c in indicators]
    cols += [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
             for c in numeric]
    return cols


def model_matrix(df: DataFrame, target: str, *,
                 drop: Sequence[str] = DROP_COLUMNS,
                 indicators: Sequence[str] = INDICATOR_COLUMNS,
                 keep_ids: Sequence[str] = ()) -> DataFrame:
    """Features (filled by kind) plus ``label`` = ``target_<target>``."""
    cat, ind, num = feature_kinds(df, drop=drop, indicators=indicators)
    return df.select(*keep_ids, *filled_features(cat, ind, num),
                     F.col(f"target_{target}").cast("int").alias("label"))


def score_input(df: DataFrame, *, categorical: Sequence[str],
                numeric: Sequence[str], indicators: Sequence[str] = (),
                ids: Sequence[str] = ID_COLUMNS,
                targets: Sequence[str] = ("target_makeup", "target_skincare",
                                          "target_fragrance", "target_haircare"),
                snapshot_dt: str | None = None) -> DataFrame:
    """The scoring query: ids, targets and the model's features filled by
    kind, for one snapshot month."""
    rows = df
    if snapshot_dt is not None:
        rows = rows.where(F.col("snapshot_dt") == F.lit(snapshot_dt).cast("date"))
    return rows.select(*ids, *targets,
                       *filled_features(categorical, indicators, numeric))


def dataset_profile(df: DataFrame, target: str, *,
                    keys: Sequence[str] = ("elc_master_id", "consumer_id", "brand_id"),
                    drop: Sequence[str] = DROP_COLUMNS) -> DataFrame:
    """One row: rows, feature columns, target ratio and duplicated keys."""
    n_features = len([c for c in df.columns if c not in set(drop)])
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("row_count"), F.lit(n_features).alias("column_count"),
        F.round(F.avg(F.col(f"target_{target}").cast("double")), 6).alias("target_ratio"),
        (n - F.count_distinct(*[F.col(k) for k in keys])).alias("duplicate_count"))


class OneHot:
    """One-hot encoding with the vocabulary of the fitting frame.

    ``fit`` reads the distinct values of each categorical column (one
    aggregate; vocabularies are small by nature). ``transform`` emits
    ``<col>_<value>`` 0/1 columns for the fitted values only: values unseen
    at fit time get all zeros, fitted values absent from the frame still get
    their (all-zero) column. Non-categorical columns come first.
    """

    def __init__(self, columns: Sequence[str] | None = None):
        self.columns = list(columns) if columns is not None else None
        self.vocabulary: dict[str, list] = {}

    def fit(self, df: DataFrame) -> "OneHot":
        if self.columns is None:
            self.columns = [f.name for f in df.schema.fields
                            if isinstance(f.dataType, StringType)]
        if not self.columns:
            return self
        row = df.agg(*[F.array_sort(F.collect_set(c)).alias(c)
                       for c in self.columns]).first()
        self.vocabulary = {c: list(row[c] or []) for c in self.columns}
        return self

    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c in self.columns for v in self.vocabulary[c]]

    def transform(self, df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in set(self.columns)]
        dummies = [F.when(F.col(c) == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}")
                   for c in self.columns for v in self.vocabulary[c]]
        return df.select(*rest, *dummies)
