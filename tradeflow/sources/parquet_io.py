"""Parquet report files and guards for missing inputs."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _file_system(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (local, HDFS, object store)."""
    fs, location = _file_system(spark, path)
    return bool(fs.exists(location))


def has_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is a file, or a folder with a file that is not hidden (``_SUCCESS``, ``.crc``)."""
    fs, location = _file_system(spark, path)
    if not fs.exists(location):
        return False
    return any(s.isDirectory() or not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(location))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of its file system, if it is there."""
    fs, location = _file_system(spark, path)
    fs.delete(location, True)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str],
                 optional: Mapping[str, object] | None = None) -> DataFrame:
    """Read only ``columns`` (pruned scan; names resolve case-insensitively).
    Columns listed in ``optional`` may be absent and are then added with their
    default value."""
    df = spark.read.parquet(path)
    present = {c.lower(): c for c in df.columns}
    optional = dict(optional or {})
    cols = []
    for c in columns:
        if c.lower() in present:
            cols.append(F.col(present[c.lower()]).alias(c))
        elif c in optional:
            cols.append(F.lit(optional[c]).alias(c))
        else:
            raise KeyError(f"column {c} not in {path}")
    return df.select(*cols)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace-if-exists Parquet write, snappy compressed: the whole output is replaced, all partitions of it."""
    writer = df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` holds and leave every other one as it is (dynamic partition overwrite).

    The new files are staged and moved in place when the job commits, so a failed run leaves the old partitions.
    A partition for which ``df`` has no row is not touched: delete it with ``drop_partition``. The rebalance hint
    groups a partition's rows into few files and splits a large one."""
    (df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite").option("compression", "snappy")
       .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def drop_partition(spark: SparkSession, path: str, **values) -> None:
    """Delete one partition's folder, given as ``column=value`` in the order of the partition columns."""
    delete_path(spark, "/".join([path.rstrip("/"), *[f"{c}={v}" for c, v in values.items()]]))
