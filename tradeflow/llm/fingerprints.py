"""Operator 10: document fingerprints, bottom-k sketches of word-shingle hashes.

Native: DataFrame functions only. A sketch is the sorted array of the ``k``
smallest distinct 64-bit hashes of a text's shingles. The k smallest of a union
are among the k smallest of its parts, so sketches of parts merge exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, ascii_lower, split_words, table, texts

K, SHINGLE_WORDS = 128, 5
BLOCK_ROWS, MAX_BLOCKS = 512, 4096
NO_ID = -(1 << 63)


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, width: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` and the sketch of column ``text``: shingles of ``width`` lower-cased words; fewer words are one shingle, none no shingle."""
    words, n, hashes = f"_{name}_words", f"_{name}_n", f"_{name}_hashes"
    out = df.withColumn(words, F.transform(split_words(ascii_lower(F.col(text)), SPACE_CLASS), lambda w: F.xxhash64(w)))
    out = out.withColumn(n, F.size(words))
    shingles = F.transform(F.sequence(F.lit(0), F.col(n) - width), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))
    out = out.withColumn(hashes, F.when(F.col(n) >= width, shingles).when(F.col(n) > 0, F.array(F.xxhash64(words))).otherwise(
        F.array().cast("array<bigint>")))
    return out.withColumn(name, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).drop(words, n, hashes)


def merge(sketches: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """(key, sketch): the sketch of the union of each key's parts.

    Tasks pass on the k smallest values of a key only (a limited window rank), so
    a key of very many parts meets in one task with k values per task at most.
    """
    values = sketches.select(key, F.explode(sketch).alias("h"))
    rank = F.dense_rank().over(Window.partitionBy(key).orderBy("h"))
    low = values.withColumn("r", rank).where(F.col("r") <= k).groupBy(key, "h").agg(F.max("r").alias("r"))
    return low.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(sketch))


def _unit(h: Column) -> Column:
    return (h.cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)


def distinct_count(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    n = F.size(sketch)
    return F.when(n < k, n.cast("double")).otherwise(F.lit(k - 1.0) / F.greatest(_unit(F.get(sketch, F.lit(k - 1))), F.lit(2.0 ** -64)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1; exact if the union has at most k shingles. Two empty sketches: 1."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds, 0 to 1; 1 for an empty a."""
    j, na, nb = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (na + nb) / (1.0 + j) / na))


def as_text(sketch: Column) -> Column:
    """The sketch as a string of 16 hex digits per value."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(df: DataFrame, columns: dict[str, str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` (doc_id, text, ...) and, under new names, columns of the next row by (doc_id, text); after the last comes the first.

    Ids are cut into blocks at approximate quantiles and each block is a window
    of its own; a copy of the next block's first row closes it. Only block
    bounds and first ids (MAX_BLOCKS at most) reach the driver. NULL ids come first.
    """
    spark = df.sparkSession
    df = df.withColumn("_id", F.coalesce("doc_id", F.lit(NO_ID)))
    n = df.count()
    blocks = max(1, min(MAX_BLOCKS, n // block_rows))
    bounds = sorted({int(x) for x in df.select("_id").approxQuantile("_id", [i / blocks for i in range(1, blocks)], 0.25 / blocks)}) if blocks > 1 else []
    # two levels of bounds: a few comparisons a row
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs]).cast("array<bigint>")
    tops, inner = longs([g[0] for g in groups]), F.array(*[longs(g) for g in groups]) if groups else None
    if groups:
        top = F.size(F.filter(tops, lambda b: b <= F.col("_id"))) - 1
        low = F.when(F.col("_top") < 0, 0).otherwise(F.col("_top") * step + F.size(F.filter(F.get(inner, F.col("_top")), lambda b: b <= F.col("_id"))))
        df = df.withColumn("_top", top).withColumn("_block", low.cast("int")).drop("_top")
    else:
        df = df.withColumn("_block", F.lit(0))
    firsts = {r["_block"]: r["first"] for r in df.groupBy("_block").agg(F.min("_id").alias("first")).collect()}
    order = sorted(firsts)
    before = {firsts[b]: order[i - 1] for i, b in enumerate(order)}     # first id -> the block that it closes
    rows = df.withColumn("_closing", F.lit(0))
    if before:
        closes = spark.createDataFrame([(i, b) for i, b in before.items()], "_first long, _into int")
        heads = df.where(F.col("_id").isin(list(before))).withColumn(
            "_rank", F.row_number().over(Window.partitionBy("_id").orderBy("text"))).where("_rank = 1").drop("_rank")
        heads = heads.join(F.broadcast(closes), F.col("_id") == F.col("_first")).withColumn("_block", F.col("_into")).drop("_first", "_into")
        rows = rows.unionByName(heads.withColumn("_closing", F.lit(1)))
    window = Window.partitionBy("_block").orderBy("_closing", "_id", "text")
    for new, old in columns.items():
        rows = rows.withColumn(new, F.lead(old).over(window))
    return rows.where("_closing = 0").drop("_closing", "_block", "_id")


def edited(text: Column, following: Column) -> Column:
    """``text`` whose last floor(n / 2) characters are replaced by as many first ones (or all) of ``following``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def fingerprint(docs: DataFrame, k: int = K, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text, next_text, sketch, next_sketch), one row per document; NULL texts are empty.

    Equal rows stay separate rows, next to each other; a single document is its own next one. Texts of any length are
    sketched whole; an empty table gives no rows. Only doc_id and text are read, so other columns may have any name.
    """
    return with_next(with_sketch(texts(docs), "text", "sketch", k, width), {"next_text": "text", "next_sketch": "sketch"})


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprint(table(spark, sf_dir, "documents"))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "sketch", "next_sketch",
                       edited(F.col("text"), F.col("next_text")).alias("edited"))
    rows = with_sketch(rows, "edited", "edited_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_count(F.col("sketch")).alias("n_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_contained"))
