"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import re
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# regular expressions of the input contracts
SPACE_CLASS = r"[\x20\x09-\x0D]+"
NON_WORD_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (``addPyFile``), once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):                         # run from a zip already: nothing to send
        target = os.path.join(tempfile.mkdtemp(prefix="llm-package-"), os.path.basename(package) + "_package.zip")
        with zipfile.ZipFile(target, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def give_back() -> None:
    """Return freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)             # the C library may have none
    if trim is not None:
        trim(0)


def frugal(run):
    """``run`` for ``mapInArrow``, which gives freed memory back after each partition: an idle worker lives on beside the next stage."""
    @functools.wraps(run)
    def partition(batches):
        yield from run(batches)
        give_back()
    return partition


BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Hand rows to the Python workers in Arrow batches of ``limit`` bytes (and one row) at most.

    Spark's own bound is 64 MB a batch, held by the JVM and by the worker. A smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", spark.conf.get(name).strip().lower()).groups()
    held = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit]
    if held <= 0 or held > limit:
        spark.conf.set(name, str(limit))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """(doc_id, text, extra ...) alone, whatever else the table holds; NULL text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *[F.col(c) for c in extra])


def boxed(docs: DataFrame) -> DataFrame:
    """(_row, _id, _hash): each row whole, as one struct that no other name can clash with, its id and its text's hash (NULL as empty)."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_hash"))


def unboxed(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of the boxed rows, in order; ``changed`` ones instead of their own, if the rows have them."""
    return rows.select(*[changed.get(c, F.col("_row").getField(c)).alias(c) for c in columns])


def fold(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL id: as the empty text)."""
    key = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % F.lit(modulus)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` is the fast way for texts that are pure ASCII)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def split_words(text: Column, separators: str) -> Column:
    """Words of ``text`` between runs of ``separators``; an empty array if there is none."""
    return F.array_remove(F.split(F.regexp_replace(text, separators, " "), " "), "")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Unset, a scratch folder is made and registered, for a local master only: on
    a cluster executors would not see each other's files there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there.

    What the write shuffled is dropped with it, not when the driver next collects garbage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
    written = spark.read.schema(df.schema).parquet(path)
    written.llm_path = path
    return written


def discard(written: DataFrame) -> None:
    """Delete the files of a table that ``materialise`` wrote, once nothing will read it any more."""
    spark = written.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(written.llm_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def copies_back(df: DataFrame, count_column: str) -> DataFrame:
    """One row again for each of ``count_column`` equal rows that an aggregation merged."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(count_column)))).drop("_copy", count_column)
