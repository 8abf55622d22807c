"""Intermediate results that several views read: written once in the cluster's shared folder, dropped by the caller."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.session import ensure_checkpoint_dir
from tradeflow.sources.parquet_io import delete_path, write_parquet

BUCKETED_PREFIX = "tradeflow_"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: readers prune its columns, and a lost executor reads it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_parquet(df, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path, out.stored_table = path, None
    return out


def store_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` bucketed by ``key`` and read it back: grouping or joining by ``key`` then needs no shuffle (AQE keeps the buckets).

    ``buckets`` defaults to the session's shuffle partitions. The rows are first moved to their buckets, so each
    bucket is one file. The table is known to this session only; its files lie in the shared folder."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = BUCKETED_PREFIX + path.rsplit("/", 1)[-1].replace("-", "_")
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").option("path", path).option("compression", "snappy")
       .bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table))
    out = spark.table(table)
    out.stored_path, out.stored_table = path, table
    return out


def release(stored: DataFrame) -> None:
    """Drop a stored result: its table, if it has one, and its files."""
    spark = stored.sparkSession
    if stored.stored_table:
        spark.sql(f"drop table if exists {stored.stored_table}")
    delete_path(spark, stored.stored_path)
