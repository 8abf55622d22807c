"""Operator 2: benchmark decontamination with a broadcast hash set of test n-grams.

Native: DataFrame functions only. Items become windows of ``width`` consecutive
words (a shorter item is one window); the windows' 64-bit hashes form the set.
Documents become arrays of window hashes inside one projection, are probed by a
hash join and every hit is verified against the window's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NON_WORD_CLASS, ascii_lower, boxed, copies_back, materialise, split_words, table, texts, unboxed

WIDTH = 10
BROADCAST_BYTES = 64 << 20


def normal_words(text: Column) -> Column:
    return split_words(ascii_lower(text), NON_WORD_CLASS)


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(h, size, window, items): distinct windows of the items, with the ids (as text) of the items that hold each."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item"),
                             normal_words(F.coalesce("text", F.lit(""))).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(width))
    starts = words.select("item", "words", size.alias("size"),
                          F.explode(F.sequence(F.lit(1), F.size("words") - size + 1)).alias("start"))
    window = F.slice("words", F.col("start"), F.col("size"))
    # a window's hash is the hash of its words' hashes, as on the documents' side
    h = F.xxhash64(F.transform(window, lambda w: F.xxhash64(w)))
    return (starts.select("item", "size", h.alias("h"), F.array_join(window, " ").alias("window"))
            .groupBy("h", "size", "window").agg(F.collect_set("item").alias("items")))


def hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, spans (array of (pos, size), word positions from 0), items.

    The windows of the benchmark are broadcast if they take at most
    ``broadcast_bytes``; a larger benchmark is joined by a shuffle on the hash,
    with the same result. Equal rows of ``docs`` keep their number. NULL or
    empty texts, and an empty benchmark, give no span. Texts of any length are
    scanned whole; an empty table gives no rows. Only doc_id and text (of the
    benchmark: item_id and text) are read, so other columns may have any name.
    """
    windows = materialise(item_windows(benchmark, width), "windows")
    stats = windows.agg(F.sum(F.octet_length("window") + 64 + F.size("items") * 24).alias("bytes"),
                        F.collect_set("size").alias("sizes")).first()
    sizes = sorted(stats["sizes"])                     # at most ``width`` values
    words = texts(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), normal_words(F.col("text")).alias("words"))
    words = words.withColumn("n_words", F.size("words")).withColumn("word_hashes", F.transform("words", lambda w: F.xxhash64(w)))

    def hashes(size: int) -> Column:
        last = F.col("n_words") - size
        return F.when(last >= 0, F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("word_hashes", i + k) for k in range(size)]))
        ).otherwise(F.array().cast("array<bigint>"))

    # entry 0 is a NULL that keeps documents without a hit; then the windows, size by size
    probes = words.withColumn("hashes", F.concat(F.array(F.lit(None).cast("bigint")), *[hashes(s) for s in sizes]))
    # (the outer form: for the inner one Spark adds a filter that computes the arrays inside out, word by word)
    probes = probes.select("doc_id", "text_hash", "n_words", "words", F.posexplode_outer("hashes").alias("entry", "h"))
    joined = probes.join(F.broadcast(windows) if (stats["bytes"] or 0) <= broadcast_bytes else windows, "h", "left")
    joined = joined.where(F.col("size").isNotNull() | (F.col("entry") == 0))
    pos, base = F.lit(None).cast("int"), F.lit(1)
    for s in sizes:
        pos = F.when(F.col("size") == s, F.col("entry") - base).otherwise(pos)
        base = base + F.greatest(F.col("n_words") - s + 1, F.lit(0))
    found = joined.withColumn("pos", pos)
    same = F.array_join(F.slice("words", F.col("pos") + 1, F.col("size")), " ") == F.col("window")
    found = found.where((F.col("entry") == 0) | ((F.col("pos") >= 0) & same))
    return copies_back(found.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count(F.when(F.col("entry") == 0, 1)).alias("n_rows"),
        F.collect_set(F.when(F.col("size").isNotNull(), F.struct("pos", "size"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")), "n_rows")


def hit_words(spans: Column) -> Column:
    """Number of words inside at least one span (a running maximum of ends over sorted spans)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.sort_array(spans), start,
        lambda a, s: F.struct((a["n"] + F.greatest(s["pos"] + s["size"] - F.greatest(s["pos"], a["end"]), F.lit(0))).alias("n"),
                              F.greatest(a["end"], s["pos"] + s["size"]).alias("end")), lambda a: a["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, remove: str = "documents") -> DataFrame:
    """``docs`` without benchmark passages, all columns kept.

    ``remove="documents"`` drops every document with a hit; ``"spans"`` cuts the
    hit words (with the separators after them) out of the text and sets n_chars,
    if there is such a column, to the new length. Documents without a hit stay
    byte for byte; NULL texts stay NULL. Repeated rows stay or go together, an
    empty table stays empty, texts of any length are read whole, and other
    columns may have any name.
    """
    found = hits(docs, benchmark, width).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash"), F.col("spans").alias("_spans")).dropDuplicates(["_hit_id", "_hit_hash"])
    here = F.col("_id").eqNullSafe(F.col("_hit_id")) & (F.col("_hash") == F.col("_hit_hash"))
    if remove == "documents":
        return unboxed(boxed(docs).join(found.select("_hit_id", "_hit_hash"), here, "left_anti"), docs.columns)
    word = NON_WORD_CLASS.replace("[", "[^", 1)
    pieces = boxed(docs).join(found, here, "left").withColumn("_gaps", F.split("_row.text", word)).withColumn(
        "_kept", F.regexp_extract_all("_row.text", F.lit(f"({word})"), F.lit(1)))
    cut = F.transform("_kept", lambda w, i: F.when(
        F.exists("_spans", lambda s: (i >= s["pos"]) & (i < s["pos"] + s["size"])), F.lit("")).otherwise(
            F.concat(w, F.get("_gaps", i + 1))))
    text = F.when(F.col("_spans").isNull(), F.col("_row.text")).otherwise(F.concat(F.get("_gaps", F.lit(0)), F.array_join(cut, "")))
    out, changed = pieces.withColumn("_text", text), {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_spans").isNull(), F.col("_row.n_chars")).otherwise(
            F.char_length("_text").cast(docs.schema["n_chars"].dataType))
    return unboxed(out, docs.columns, **changed)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of ``hits`` over whole documents: counts of words and items, and a hash of the items."""
    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = hit_words(F.col("spans"))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))
