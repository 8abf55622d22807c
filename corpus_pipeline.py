"""A corpus pipeline of five operators: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared folder and reads again for the next stage. All
stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeflow.llm import decontamination, language_id, line_dedup, packing, simhash
from tradeflow.llm.common import bound_batches, fold, materialise, ship, table


BATCH_BYTES = 2 << 20


def _ready(spark: SparkSession) -> None:
    """The package at the workers, and small batches: a stage starts in workers that still hold what the one before left."""
    ship(spark)
    bound_batches(spark, BATCH_BYTES)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or near no learned language, go."""
    _ready(spark)
    return language_id.keep_identified(docs, language_id.learn(docs.where(fold("doc_id", language_id.FOLDS) != 0)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: a line stays where it first stands; documents left without a line go."""
    _ready(spark)
    return line_dedup.drop_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the document of smallest id of each group stays."""
    _ready(spark)
    return simhash.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a test passage go."""
    _ready(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of token ids in sequences of at most 2048."""
    import public_tokenizers
    _ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_near_dedup", near_duplicates),
          ("decontamination", benchmark), ("packing", pack)]

#: SQL has no counterpart of hyperdimensional profiles, XXH64 fingerprints or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences of all ``documents`` that the stages keep.

    NULL, empty and letterless texts go in the first stage; repeated rows and exact copies lose their lines in the
    second, and go there or in the third. Texts of any length are read whole. An empty table gives no pieces. Other
    columns, whatever their names, stay with their rows up to the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
