"""Operator 12: exact dedup by skew-safe combining.

Native: DataFrame functions only. Equal texts are found in three stages, each of
which groups by the digest *and* the text itself:

1. local: every task merges its own equal texts before anything is shuffled;
2. salted: the rows of a hot digest meet in ``salts`` groups, chosen by id;
3. global: the salt winners of the hot digests are combined.

A digest is hot if it holds more than one row in ``HOT_PARTS``, so there are
fewer than ``HOT_PARTS`` hot digests in a table of any size: that is the proven
bound of the one broadcast here. Every other digest has a single salt, and its
salted group is the whole group already.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table

HOT_PARTS = 8192


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_classes(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex, salts: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when their characters are; of equal texts the row of the
    largest doc_id stays (a NULL id is smaller than any other; a class of NULL ids
    alone keeps one row, its keep_id is NULL). Rows repeated with their id count
    in group_size one by one, and one of them is kept. NULL text is the empty
    text; texts of any length are compared whole; an empty table gives no rows.
    Only doc_id and text are read, so other columns may have any name.

    ``digest`` only deals the rows out. Were two texts to share a digest, they
    would still be two classes: such digests are joined back by text as well.
    ``salts`` (default: the session's shuffle partitions) spread a hot digest.
    """
    spark = docs.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))

    counts = materialise(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "exact-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * HOT_PARTS > total).select("digest", F.lit(True).alias("hot"))     # fewer than HOT_PARTS rows
    rows = rows.join(F.broadcast(hot), "digest", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(F.lit(0)).cast("int")

    merged = (rows.groupBy("digest", "hot", salt.alias("salt"), "text")
                  .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    merged = materialise(merged, "exact-salted")
    winners = (merged.where("hot").groupBy("digest", "text")
                     .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")).withColumn("hot", F.lit(True)))
    columns = ["digest", "hot", "keep_id", "group_size", "text"]
    classes = merged.where("not hot").select(columns).unionByName(winners.select(columns))
    shared = materialise(classes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"), "exact-shared")

    named = [F.col("digest").alias("_digest"), "keep_id", "group_size"]
    members = rows.select("doc_id", "digest", "hot")
    if not shared.isEmpty():
        members = members.join(shared, "digest", "left_anti")
        alike = rows.select("doc_id", "digest", "text").join(shared, "digest", "left_semi")
        by_text = _numbered(alike.join(classes.join(shared, "digest", "left_semi").select(*named, F.col("text").alias("_text")),
                                       (F.col("digest") == F.col("_digest")) & (F.col("text") == F.col("_text"))),
                            "digest", "text", "doc_id", "keep_id", "group_size")
        classes = classes.join(shared, "digest", "left_anti")
    else:
        by_text = None
    key = F.col("digest") == F.col("_digest")
    few = classes.where("hot").select(named)                            # one row per hot digest
    cold = _numbered(members.where("not hot").join(classes.where("not hot").select(named), key), "digest", "doc_id", "keep_id", "group_size")
    dealt = _numbered(members.where("hot").join(F.broadcast(few), key), "digest", "doc_id", "keep_id", "group_size")
    out = cold.unionByName(dealt)
    return out if by_text is None else out.unionByName(by_text)


def _numbered(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of one id and one text, merged and numbered again: the first copy of the id that stays is kept."""
    copies = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return copies.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
                         "digest")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of equal rows of one id and text, one."""
    kept = exact_classes(docs).where("kept").select(F.struct(F.col("doc_id"), F.col("digest")).alias("_llm_key"))
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), sha256_hex(text).alias("digest")).alias("_llm_key"),
                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_llm_row"))
    chosen = one.dropDuplicates(["_llm_key"]).alias("l").join(kept.alias("r"), F.col("l._llm_key").eqNullSafe(F.col("r._llm_key")), "left_semi")
    return chosen.select("_llm_row.*")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact classes of all ``documents``, one row per document."""
    return exact_classes(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")
