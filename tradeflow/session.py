"""SparkSession construction and cluster-level settings shared by every report."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every report relies on. AQE coalesces the small post-aggregation
# partitions and splits skewed join partitions at run time; the session time
# zone is pinned so that date arithmetic is identical on every executor.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Dimension tables are broadcast only when they are known to be small:
    # keep Spark's own automatic threshold modest so that a dimension that
    # grows with the data falls back to a shuffle join by itself.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tradeflow", extra: dict | None = None) -> SparkSession:
    """Return a session configured for the reports.

    On a cluster ``master`` stays ``None`` (taken from spark-submit) and the
    shuffle partition count should be sized so that one partition holds about
    128-256 MB of shuffled data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Unset, a private scratch folder is created
    and registered for a local master; any other master is an error, since
    executors would write to their own disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tradeflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
