"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are written against. AQE re-plans joins and
# coalesces small shuffle partitions at runtime; skew-join splits hot
# partitions. The co-partition setting lets a join on (keys, month) reuse a
# hash partitioning on keys alone, so the densify join and the window that
# follows it share one exchange (see operators/snapshot.py).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "spendgrid",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local or cluster session with the recommended settings.

    On a cluster, pass ``master=None`` to keep the launcher's master and set
    ``shuffle_partitions`` so one partition holds ~128-256 MB of shuffle data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.host", "127.0.0.1")
        conf.setdefault("spark.driver.bindAddress", "127.0.0.1")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_checkpoint_dir(spark)
    return spark


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only a local session without the setting (tests)
    gets a folder of our own; on a cluster an unset folder is an error.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: point it at a folder "
                             "shared by all executors (a machine-local folder does "
                             "not survive executor loss)")
        # local runs and tests only: a private folder on this machine
        configured = tempfile.mkdtemp(prefix="spendgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written tables."""
    return os.path.join(shared_checkpoint_dir(spark), name)
