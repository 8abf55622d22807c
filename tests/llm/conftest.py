import pytest

from tradeflow.llm.common import ship

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, h long, size int, pos int, line string, "
          "fp long, a long, b long, component long, words string, x string, score double, row long, kind string, training boolean, "
          "node long, sketch string, id long, n int")
LONG = "the quick brown fox jumps over the lazy dog near the old river bank " * 400


def document(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", None if text is None else len(text), 1, 2, 3, "l", 4, 5, 6, 7, "w", "x", 0.5, 8, "k", True, 9, "s", 10, 11)


ROWS = [
    document(1, "The cat sat on the mat and looked at the quiet garden for a long time today."),
    document(2, "The cat sat on the mat and looked at the quiet garden for a long time today."),     # exact copy
    document(3, "Ein ganz anderer Satz über Bären und Wölfe im dunklen Wald.\nNoch eine Zeile mit Wörtern.", "de"),
    document(4, ""), document(5, None), document(None, "A text without an id, which is still a text."),
    document(6, " \n\t "), document(7, "word"), document(8, LONG), document(9, "x" * 50000),
    document(10, "日本語 текст mixed ÀÉ 123 a@b.co +1 (663) 555-6869 10.0.0.1"),
    document(11, "Ein ganz anderer Satz über Bären und Wölfe im dunklen Wald.\nNoch eine Zeile ohne alle Worte.", None),
    document(12, "repeat repeat repeat repeat repeat repeat repeat"),
    document(12, "repeat repeat repeat repeat repeat repeat repeat"),                                  # repeated row
]


@pytest.fixture(scope="package")
def llm(spark):
    ship(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")              # many small jobs
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="package")
def docs(llm):
    """Nulls, empty, blank and very long texts, copies, a repeated row and extra columns with clashing names."""
    return llm.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="package")
def no_docs(llm):
    return llm.createDataFrame([], SCHEMA)


@pytest.fixture(scope="package")
def bench(llm):
    rows = [(1, "fox jumps over the lazy dog near the old river bank"), (2, "quiet GARDEN, for a"), (3, None), (4, "!!"),
            (None, "dunklen Wald"), (2, "quiet garden for a")]
    return llm.createDataFrame(rows, "item_id long, text string")
