"""Sinks and catalog: databases, partitioned tables, dynamic partition
overwrite, feature tables with key metadata, CSV export, function catalog."""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendgrid.session import scratch_path


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def run_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared checkpoint folder."""
    return scratch_path(spark, f"spendgrid/{name}-{uuid.uuid4().hex[:12]}")


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet into a fresh shared folder and read back: its
    plan runs once however often the result is read, lineage is cut, and the
    files survive the loss of executors."""
    path = run_scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt_once(df: DataFrame, name: str, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """:func:`written_once` with the rows dealt by ``by`` to ``parts`` bucket files
    (the session's shuffle partitions, if not given): the rows move once, and
    groups and joins on these columns, or on more, read them where they are."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = run_scratch(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(parts, *by).write.format("parquet").bucketBy(parts, *by).option("path", path).saveAsTable(table)
    return spark.table(table)


def create_partitioned_table(spark: SparkSession, name: str, schema: StructType,
                             partition_cols: Sequence[str],
                             path: str | None = None) -> None:
    """``create table if not exists`` with a declared schema, as parquet,
    partitioned by ``partition_cols`` (placed last, as parquet stores them)."""
    if table_exists(spark, name):
        return
    fields = [f for f in schema.fields if f.name not in partition_cols]
    fields += [schema[c] for c in partition_cols]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = ", ".join(f"`{c}`" for c in partition_cols)
    loc = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {_quoted(name)} ({cols}) USING parquet "
              f"PARTITIONED BY ({parts}){loc}")


def create_bucketed_table(spark: SparkSession, name: str, schema: StructType, *, partition_cols: Sequence[str],
                          bucket_cols: Sequence[str], buckets: int, path: str | None = None) -> None:
    """``create table if not exists`` with a declared schema, partitioned by
    ``partition_cols`` and, inside a partition, dealt to ``buckets`` files sorted
    by ``bucket_cols``. Tables of equal buckets join on these columns where they
    are: no exchange of either side."""
    if table_exists(spark, name):
        return
    fields = [f for f in schema.fields if f.name not in partition_cols]
    fields += [schema[c] for c in partition_cols]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    listed = lambda names: ", ".join(f"`{c}`" for c in names)
    loc = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {_quoted(name)} ({cols}) USING parquet PARTITIONED BY ({listed(partition_cols)}) "
              f"CLUSTERED BY ({listed(bucket_cols)}) SORTED BY ({listed(bucket_cols)}) INTO {buckets} BUCKETS{loc}")


def replace_bucketed(df: DataFrame, name: str, *, bucket_cols: Sequence[str], buckets: int) -> None:
    """Replace the partitions of a bucketed table that ``df`` has rows of. Rows
    are dealt as the buckets are, so a task writes one file of each partition
    that it holds."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    dealt = df.select(*spark.table(name).columns).repartition(buckets, *bucket_cols)
    dealt.write.insertInto(name, overwrite=True)


def overwrite_partitions(df: DataFrame, path: str,
                         partition_cols: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic partition
    overwrite): re-running a month rewrites that month only, so the step is
    idempotent, unlike an append. Rows are dealt by the partition columns
    first, and large partitions to several tasks, so a partition gets files
    of Spark's advisory size and not one from every task."""
    (df.hint("rebalance", *partition_cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def insert_partitions(df: DataFrame, table_name: str, partition_cols: Sequence[str] = ()) -> None:
    """Insert into a catalog table by column name (not position), replacing
    the partitions present in ``df``. Rows are dealt by ``partition_cols``
    first, as :func:`overwrite_partitions` does."""
    spark = df.sparkSession
    target = spark.table(table_name).columns
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    dealt = df.hint("rebalance", *partition_cols) if partition_cols else df
    dealt.select(*target).write.insertInto(table_name, overwrite=True)


def create_empty_like(df: DataFrame, name: str,
                      partition_cols: Sequence[str] = (),
                      path: str | None = None) -> None:
    """Empty table with the schema of a query (``CTAS ... where 1=0``);
    with ``path`` an external table stored there."""
    w = df.limit(0).write.format("parquet")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def overwrite_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


class NotUnique(ValueError):
    """Keys that must be unique are not."""


def switch_table(df: DataFrame, name: str, *, path: str, unique: Sequence[str] = (),
                 properties: dict[str, str] | None = None) -> DataFrame:
    """Replace a table's rows in one step.

    ``df`` runs once: it is written to a new folder below ``path`` beside the
    rows in use, the written files are checked (``unique`` columns), and only
    then does one catalog command point the name to the new folder. If the plan
    or the check fails, the old rows stay readable; readers that began before
    the switch keep the old files, which are left to :func:`drop_unused`.
    """
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/version-{uuid.uuid4().hex[:12]}"
    df.write.parquet(version)
    written = spark.read.schema(df.schema).parquet(version)
    if unique and written.groupBy(*unique).count().where(F.col("count") > 1).limit(1).count():
        raise NotUnique(f"table {name}: {list(unique)} are not unique")
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    stored = spark.table(name).schema if table_exists(spark, name) else None
    if stored is not None and stored.simpleString() != df.schema.simpleString():
        spark.sql(f"DROP TABLE {_quoted(name)}")  # other columns: another table
        stored = None
    if stored is not None:
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{version}'")
        if listed:
            spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ({listed})")
        spark.catalog.refreshTable(name)
    else:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        props = f" TBLPROPERTIES ({listed})" if listed else ""
        spark.sql(f"CREATE TABLE {_quoted(name)} ({cols}) USING parquet LOCATION '{version}'{props}")
    return spark.table(name)


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {_quoted(name)}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def bucket_count(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE FORMATTED {_quoted(name)}").collect()
    return int(next(r["data_type"] for r in rows if r["col_name"] == "Num Buckets"))


def drop_unused(spark: SparkSession, name: str, path: str) -> int:
    """Remove the versions below ``path`` that ``name`` does not point to; how many."""
    used = table_location(spark, name).rstrip("/").rsplit("/", 1)[-1]
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith("version-") and f.getPath().getName() != used]
    return sum(bool(fs.delete(p, True)) for p in old)


def write_feature_table(df: DataFrame, name: str, *, primary_keys: Sequence[str],
                        timestamp_keys: Sequence[str], description: str = "",
                        path: str | None = None) -> DataFrame:
    """Create (or replace) a feature table and write ``df`` into it.

    Keys are stored as table properties; (primary keys, timestamp keys) must
    be unique, or the table stays as it was (:func:`switch_table`).
    """
    props = {
        "primary_keys": ",".join(primary_keys),
        "timestamp_keys": ",".join(timestamp_keys),
        "comment": description.replace("'", " "),
    }
    return switch_table(df, name, path=path or run_scratch(df.sparkSession, name.replace(".", "_")),
                        unique=[*primary_keys, *timestamp_keys], properties=props)


def feature_table_keys(spark: SparkSession, name: str) -> dict[str, list[str]]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    props = {r["key"]: r["value"] for r in rows}
    return {k: [c for c in props.get(k, "").split(",") if c]
            for k in ("primary_keys", "timestamp_keys")}


def export_csv(df: DataFrame, folder: str, table_name: str,
               write_dt: _dt.datetime) -> str:
    """CSV parts with headers, written in parallel, in a folder named for the
    run (``<table>_<Y-m-d H:M:S>``)."""
    short = table_name.split(".", 1)[1] if "." in table_name else table_name
    out = os.path.join(folder, f"{short}_{write_dt.strftime('%Y-%m-%d %H:%M:%S')}")
    df.write.mode("overwrite").csv(out, header=True, sep=",")
    return out


def save_function_catalog(spark: SparkSession, name: str) -> DataFrame:
    """``SHOW FUNCTIONS`` stored as a table."""
    out = spark.sql("SHOW FUNCTIONS")
    overwrite_table(out, name)
    return spark.table(name)
