import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql.types import DateType, DecimalType, IntegerType, StringType, StructField, StructType

from tradeflow.sources.csv_br import read_br_csv, write_br_csv
from tradeflow.sources.parquet_io import read_columns, write_parquet

SCHEMA = StructType([StructField("ID", IntegerType()), StructField("NOME", StringType()),
                     StructField("VALOR", DecimalType(18, 6)), StructField("DIA", DateType())])


def test_br_csv_roundtrip_keeps_values(spark):
    rows = [(1, " ", Decimal("-1234.500000"), dt.date(2000, 1, 31)), (2, "a;b", None, None),
            (3, None, Decimal("0.000001"), dt.date(1999, 12, 1))]
    df = spark.createDataFrame(rows, SCHEMA)
    path = os.path.join(tempfile.mkdtemp(prefix="tf-csv-"), "out")
    write_br_csv(df, path)
    text = "".join(open(os.path.join(path, f), encoding="utf-8").read()
                   for f in sorted(os.listdir(path)) if f.endswith(".csv"))
    assert "-1234,500000" in text and ";" in text
    back = sorted(read_br_csv(spark, path, SCHEMA).collect())
    assert [tuple(r) for r in back] == rows


def test_br_csv_reader_is_lenient(spark):
    folder = tempfile.mkdtemp(prefix="tf-csv-")
    with open(os.path.join(folder, "f.csv"), "w", encoding="utf-8-sig") as fh:
        fh.write("ID;NOME;VALOR;DIA\n1;x;1.234,56;20/09/2024\n2;y;abc;31/02/2025\n3;z;7,5;2025-01-02\n")
    out = sorted(read_br_csv(spark, folder, SCHEMA).collect())
    assert [(r.ID, r.VALOR, r.DIA) for r in out] == [
        (1, Decimal("1234.560000"), dt.date(2024, 9, 20)), (2, None, None), (3, Decimal("7.500000"), dt.date(2025, 1, 2))]


def test_br_csv_keeps_quotes_breaks_and_empty_texts(spark):
    rows = [(1, 'ACME "SUL" LTDA; FILIAL', Decimal("1.500000"), None), (2, "two\nlines", None, None), (3, "", None, None),
            (4, None, None, None), (5, '"', None, dt.date(2001, 2, 3))]
    path = os.path.join(tempfile.mkdtemp(prefix="tf-csv-"), "out")
    write_br_csv(spark.createDataFrame(rows, SCHEMA), path)
    assert sorted(tuple(r) for r in read_br_csv(spark, path, SCHEMA, multi_line=True).collect()) == rows


def test_br_csv_dot_decimals(spark):
    folder = tempfile.mkdtemp(prefix="tf-csv-")
    with open(os.path.join(folder, "f.csv"), "w", encoding="utf-8") as fh:
        fh.write("ID;NOME;VALOR;DIA\n1;x;1234.56;\n2;y;1.234,56;\n3;z;1.2.3;\n")
    assert [r.VALOR for r in sorted(read_br_csv(spark, folder, SCHEMA).collect())] == [Decimal("1234.56"), Decimal("1234.56"), None]


def test_parquet_pruned_read_and_optional_column(spark):
    df = spark.createDataFrame([(1, "a")], "cod_filial int, nm string")
    path = os.path.join(tempfile.mkdtemp(prefix="tf-pq-"), "t.parquet")
    write_parquet(df, path)
    out = read_columns(spark, path, ["COD_FILIAL", "COD_SUPERVISOR"], optional={"COD_SUPERVISOR": 0})
    assert out.columns == ["COD_FILIAL", "COD_SUPERVISOR"] and out.collect()[0] == (1, 0)
