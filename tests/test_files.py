"""Star files, monthly replacement, declared schemas, guards, coercion counts, buckets."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_SF
from tests.harness import canonical_rows
from tradeflow.plans import customers, file_queries, jobs, star, stock
from tradeflow.plans.catalog import LIFECYCLE_SINCE, STAR_SINCE, STOCK_YEAR
from tradeflow.sources import csv_br, jdbc, schemas
from tradeflow.sources.erp_fixture import ERP_VIEWS, ErpTables
from tradeflow.sources.erp_tables import ErpParquetTables, land
from tradeflow.sources.parquet_io import replace_partitions, write_parquet
from tradeflow.sources.star_files import StarFiles, write_star
from tradeflow.sources.stored import release, store, store_bucketed


def folder():
    return tempfile.mkdtemp(prefix="tf-files-")


def rows(df):
    return canonical_rows(df.columns, [tuple(r) for r in df.collect()])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files_of(path):
    return {os.path.relpath(os.path.join(d, n), path): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


@pytest.fixture(scope="module")
def erp(spark):
    return ErpTables(spark, SMALL_SF)


# ---- star files ----

@pytest.fixture(scope="module")
def star_files(erp):
    return file_queries.exported_star(erp, STAR_SINCE)


def test_sales_base_of_files_equals_the_relations(erp, star_files):
    assert rows(customers.sales_base_of_files(star_files, LIFECYCLE_SINCE)) == rows(customers.sales_base(erp, LIFECYCLE_SINCE))


def test_a_date_opens_its_months_only(star_files):
    fact = customers.sales_base_of_files(star_files, dt.date(2000, 11, 15))
    scan = next(line for line in plan(fact).splitlines() if "valor_liquido" in line and "PartitionFilters" in line)
    assert "ano#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    months = {(r.ANO, r.MES) for r in fact.select("ANO", "MES").distinct().collect()}
    assert months and min(months) >= (2000, 11)
    lines = star_files.fact_since("fato_venda", dt.date(2000, 11, 15), ["num_pedido"])
    read = lines.select(F.input_file_name().alias("f")).distinct().collect()
    assert read
    assert all("ano=2000/mes=11" in r.f or "ano=2000/mes=12" in r.f or "ano=2001" in r.f for r in read)
    assert fact.where((F.col("ANO") == 2000) & (F.dayofmonth("DATA_MOVIMENTACAO") < 15) & (F.col("MES") == 11)).count() == 0


def test_the_calendar_prunes_while_the_query_runs(star_files):
    last = star_files.last_months(3)
    fact = customers.sales_base_of_files(star_files, months=last)
    assert "dynamicpruning" in plan(fact).lower()
    calendar = sorted((r.ano, r.mes) for r in star_files.table("dim_calendario").collect())
    assert {(r.ANO, r.MES) for r in fact.select("ANO", "MES").distinct().collect()} == set(calendar[-3:])


def test_optional_star_columns_have_their_defaults(spark, erp):
    root = folder()
    fact = star.fato_venda(erp, dt.date(2000, 6, 1)).drop("cod_supervisor", "origem_pedido")
    write_star({"fato_venda": fact, "dim_produto": star.dim_produto(erp), "dim_cliente": star.dim_cliente(erp),
                "dim_vendedor": star.dim_vendedor(erp)}, root)
    base = customers.sales_base_of_files(StarFiles(spark, root))
    assert base.select("COD_SUPERVISOR", "ORIGEM_PEDIDO").distinct().collect() == [(0, "N/I")]
    assert base.count() == fact.count()


def test_star_files_that_are_not_there(spark):
    with pytest.raises(schemas.MissingInput, match="fato_venda"):
        customers.sales_base_of_files(StarFiles(spark, folder()))
    none = customers.sales_base_of_files(StarFiles(spark, folder(), missing="empty"))
    assert none.count() == 0 and customers.customer_summary(none).count() == 0


def test_undated_facts_lie_in_month_zero(spark):
    root = folder()
    fact = spark.createDataFrame([(1, None), (2, dt.date(2000, 3, 31)), (3, dt.date(2000, 4, 1))], "num_pedido long, data_movimentacao date")
    fact = fact.select(*[F.col(f.name).cast(f.dataType) if f.name in fact.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in schemas.STAR_SCHEMAS["fato_venda"].fields])
    write_star({"fato_venda": fact}, root)
    files = StarFiles(spark, root)
    assert sorted((r.ano, r.mes, r.indice) for r in files.table("dim_calendario").collect()) == [(0, 0, -1), (2000, 3, 24002), (2000, 4, 24003)]
    assert [(r.ano, r.mes) for r in files.last_months(1).collect()] == [(2000, 4)]
    assert sorted(r.num_pedido for r in files.fact_since("fato_venda", dt.date(2000, 3, 31), ["num_pedido"]).collect()) == [2, 3]


# ---- missing ids ----

def test_missing_ids_take_the_names_of_row_zero(spark):
    fact = spark.createDataFrame([(1, None, None, None), (2, 0, 0, 0), (3, 7, 7, 7), (4, 8, None, 9)],
                                 "NUM_PEDIDO long, COD_CLIENTE long, COD_PRODUTO long, COD_VENDEDOR int")
    fact = fact.withColumns({"COD_FILIAL": F.lit(None).cast("int"), "COD_SUPERVISOR": F.lit(None).cast("int"),
                             "DATA_MOVIMENTACAO": F.lit(None).cast("date"), "QT_VENDIDA": F.lit(None).cast("decimal(18,2)"),
                             "VALOR_LIQUIDO": F.lit(None).cast("decimal(18,2)"), "ORIGEM_PEDIDO": F.lit(None).cast("string")})
    products = spark.createDataFrame([(None, " none ", "c0", None), (7, "seven", None, "s")], "cod_produto long, nm_produto string, categoria string, secao string")
    clients = spark.createDataFrame([(0, "zero"), (7, "Seven")], "cod_cliente long, nm_cliente string")
    sellers = spark.createDataFrame([(7, None)], "cod_vendedor int, nm_vendedor string")
    out = {r.NUM_PEDIDO: r for r in customers.label_sales(fact, products, clients, sellers).collect()}
    names = lambda r: (r.nm_produto, r.categoria, r.secao, r.nm_cliente, r.nm_vendedor)
    assert names(out[1]) == names(out[2]) == ("NONE", "C0", "N/I", "ZERO", "NAO CADASTRADO")
    assert names(out[3]) == ("SEVEN", "N/I", "S", "SEVEN", "N/I") and names(out[4])[3:] == ("NAO CADASTRADO", "NAO CADASTRADO")
    assert (out[1].COD_CLIENTE, out[1].COD_PRODUTO, out[1].ANO, out[1].VALOR_LIQUIDO, out[1].ORIGEM_PEDIDO) == (0, 0, 0, 0, "NAO CADASTRADO")


# ---- monthly replacement ----

def test_a_month_run_again_replaces_itself_alone(spark, erp):
    path = os.path.join(folder(), "excess")
    jobs.run_monthly_excess(erp, path, STOCK_YEAR)
    before, whole = files_of(path), rows(jobs.read_monthly_excess(spark, path, STOCK_YEAR))
    jobs.run_monthly_excess(erp, path, STOCK_YEAR, [5])
    after = files_of(path)
    assert {k for k in after if "mes=5/" not in k} == {k for k in before if "mes=5/" not in k}
    assert all(after[k] == before[k] for k in after if "mes=5/" not in k)
    assert {k for k in after if "mes=5/" in k}.isdisjoint(before) and rows(jobs.read_monthly_excess(spark, path, STOCK_YEAR)) == whole
    whole_year = stock.excess_stock_monthly(erp, STOCK_YEAR)
    assert whole == rows(whole_year.select(*jobs.read_monthly_excess(spark, path, STOCK_YEAR).columns))


def test_a_month_without_rows_loses_its_folder(spark, erp):
    path = os.path.join(folder(), "excess")
    jobs.run_monthly_excess(erp, path, STOCK_YEAR, [4, 5])
    tables = {n: erp[n] for n in ERP_VIEWS}
    tables["pchistest"] = erp["pchistest"].where("month(data) <> 5")
    jobs.run_monthly_excess(tables, path, STOCK_YEAR, [5])
    assert {k.split("/")[1] for k in files_of(path)} == {"mes=4"}


@pytest.mark.parametrize("months", [[1], [3, 7], [12]])
def test_some_months_equal_those_months_of_the_year(erp, months):
    year = stock.excess_stock_monthly(erp, STOCK_YEAR).where(F.col("mes").isin(months))
    assert rows(stock.excess_stock_monthly(erp, STOCK_YEAR, months)) == rows(year)


def test_a_failed_run_leaves_the_partitions(spark):
    path = os.path.join(folder(), "t")
    good = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "ano int, mes int, x string")
    replace_partitions(good, path, ["ano", "mes"])
    bad = good.withColumn("x", F.when(F.col("mes") == 2, F.raise_error(F.lit("stop"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="stop"):
        replace_partitions(bad, path, ["ano", "mes"])
    assert rows(spark.read.parquet(path).select("ano", "mes", "x")) == rows(good)


# ---- schemas and guards ----

def test_every_relation_is_declared_as_the_reports_get_it(erp):
    assert len(schemas.ERP_SCHEMAS) == 26 and set(schemas.ERP_SCHEMAS) == set(ERP_VIEWS)
    for name, schema in schemas.ERP_SCHEMAS.items():
        assert [(f.name, f.dataType) for f in erp[name].schema] == [(f.name, f.dataType) for f in schema], name


def test_star_tables_are_declared_as_they_are_built(erp):
    day = dt.date(2000, 1, 1)
    for name, df in star.star_schema(erp, day, day, day).items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.STAR_SCHEMAS[name]], name


@pytest.mark.parametrize("change, message", [
    (lambda d: d.withColumn("codusur", F.col("codusur").cast("string")), "pcusuari.codusur: declared int, found string"),
    (lambda d: d.withColumn("codusur", F.col("codusur").cast("bigint")), "pcusuari.codusur: declared int, found bigint"),
    (lambda d: d.drop("nome"), "pcusuari.nome: declared string, found no such column"),
])
def test_drift_is_named(spark, erp, change, message):
    root = folder()
    write_parquet(change(erp["pcusuari"]), f"{root}/pcusuari")
    with pytest.raises(schemas.SchemaDrift) as raised:
        ErpParquetTables(spark, root)["pcusuari"]
    assert str(raised.value) == message and len(raised.value.differences) == 1


def test_what_widens_is_read(spark, erp):
    root = folder()
    small = erp["pcmov"].withColumns({"codprod": F.col("codprod").cast("int"), "qt": F.col("qt").cast("decimal(10,1)"),
                                      "dtmov": F.col("dtmov").cast("timestamp"), "extra": F.lit(1)}).withColumnRenamed("numped", "NUMPED")
    write_parquet(small, f"{root}/pcmov")
    read = ErpParquetTables(spark, root)["pcmov"]
    assert read.schema.simpleString() == schemas.ERP_SCHEMAS["pcmov"].simpleString()
    assert rows(read.select("codprod", "dtmov", "numped")) == rows(erp["pcmov"].select("codprod", "dtmov", "numped"))


def test_optional_columns_of_a_relation(spark, erp):
    root = folder()
    write_parquet(erp["pcprest"].drop("vpago", "dtdevol"), f"{root}/pcprest")
    read = ErpParquetTables(spark, root)["pcprest"]
    assert read.where("vpago is not null or dtdevol is not null").count() == 0 and read.count() == erp["pcprest"].count()


def test_relations_without_files(spark):
    with pytest.raises(schemas.MissingInput, match="pcmov"):
        ErpParquetTables(spark, folder())["pcmov"]
    tables = ErpParquetTables(spark, folder(), missing="empty")
    assert tables["pcmov"].count() == 0 and stock.excess_stock_monthly(tables, 2000).count() == 0
    with pytest.raises(ValueError):
        ErpParquetTables(spark, folder(), missing="ignore")


def test_csv_without_files(spark):
    schema = schemas.REPORT_SCHEMAS["returns_receivable"]
    empty = folder()
    open(os.path.join(empty, "_SUCCESS"), "w").close()
    for path in (os.path.join(folder(), "none"), empty):
        with pytest.raises(schemas.MissingInput):
            csv_br.read_br_csv(spark, path, schema)
        assert csv_br.read_br_csv(spark, path, schema, missing="empty").schema == schema
        frame, counts = csv_br.read_br_csv_counted(spark, path, schema, missing="empty")
        assert frame.count() == 0 and counts.alarms() == [] and counts.counts()[0] == ("CLASSIFICACAO", 0, 0, 0)


def test_landing_and_reading_back(spark, erp):
    root = folder()
    names = ["pcverba", "pcest", "pclib"]
    assert set(land(erp, root, names)) == set(names)
    landed = ErpParquetTables(spark, root)
    assert all(rows(landed[n]) == rows(erp[n]) for n in names)


def test_coercions_are_counted_in_the_pass_that_reads(spark):
    path = folder()
    with open(os.path.join(path, "f.csv"), "w", encoding="utf-8") as fh:
        fh.write("A;B;C\n1;1,5;2000-01-02\nx;;31/02/2000\n;n/d;junk\n4;2;\n")
    schema = schemas.declared("A int, B decimal(9,2), C date, D int")
    frame, counts = csv_br.read_br_csv_counted(spark, path, schema)
    out = store(frame, "counted")
    assert counts.counts() == [("A", 4, 3, 1), ("B", 4, 3, 1), ("C", 4, 3, 2), ("D", 4, 0, 0)]
    assert counts.alarms() == [] and counts.alarms(0.6) == ["C"]
    assert sorted(rows(out), key=str) == sorted(rows(csv_br.read_br_csv(spark, path, schema)), key=str)
    assert [tuple(r) for r in counts.report().where("coluna = 'C'").collect()] == [("C", 4, 3, 2)]


# ---- buckets ----

def test_a_bucketed_base_groups_without_a_shuffle(spark):
    base = spark.range(2000).select((F.col("id") % 37).cast("string").alias("nm_cliente"), (F.col("id") % 211).alias("NUM_PEDIDO"),
                                    F.lit(dt.date(2000, 1, 1)).alias("DATA_MOVIMENTACAO"), F.lit(1).alias("COD_VENDEDOR"),
                                    F.lit("v").alias("nm_vendedor"), F.lit(Decimal("2.50")).alias("VALOR_LIQUIDO"))
    stored = store_bucketed(base, "b", "nm_cliente", 4)
    per = stored.groupBy("nm_cliente", "NUM_PEDIDO").agg(F.sum("VALOR_LIQUIDO").alias("v")).groupBy("nm_cliente").agg(F.sum("v"))
    assert "Exchange" not in plan(per) and "Exchange" in plan(base.groupBy("nm_cliente").count())
    assert rows(customers.customer_summary(stored)) == rows(customers.customer_summary(base))
    path = stored.stored_path.replace("file:", "")
    assert os.path.isdir(path)
    release(stored)
    assert not os.path.exists(path) and not spark.catalog.tableExists(stored.stored_table)


# ---- relational extract (texts and options only: there is no database) ----

def test_bind_values():
    query = "select ':a' as t, x /* :b */ from r -- :c\nwhere d >= :day and n = :n and s = :text and :none is null and x::int = :n"
    got = jdbc.bind(query, {"day": dt.date(2000, 1, 31), "n": Decimal("1.50"), "text": "O'Neil; drop", "none": None})
    assert got == ("select ':a' as t, x /* :b */ from r -- :c\nwhere d >= DATE '2000-01-31' and n = 1.50 and s = 'O''Neil; drop' "
                   "and NULL is null and x::int = 1.50")
    for values, error in (({}, KeyError), ({"day": 1, "n": 2, "text": 3, "none": 4, "more": 5}, KeyError),
                          ({"day": float("nan"), "n": 2, "text": 3, "none": 4}, ValueError), ({"day": [1], "n": 2, "text": 3, "none": 4}, TypeError)):
        with pytest.raises(error):
            jdbc.bind(query, values)


def test_read_options():
    got = jdbc.read_options("jdbc:x", "pcmov", {"user": "u", "fetchsize": "5"}, jdbc.Ranges("dtmov", dt.date(2000, 1, 1), dt.date(2001, 1, 1), 12))
    assert got == {"url": "jdbc:x", "dbtable": "pcmov", "user": "u", "fetchsize": "5", "partitionColumn": "dtmov", "lowerBound": "2000-01-01",
                   "upperBound": "2001-01-01", "numPartitions": "12"}
    assert jdbc.read_options("u", "select 1 from t where m = :m", {}, values={"m": 3})["dbtable"] == "(select 1 from t where m = 3) extract_rows"
    with pytest.raises(ValueError):
        jdbc.Ranges("x", 5, 5, 2).options()
    with pytest.raises(ValueError):
        jdbc.read_options("u", "pcmov", {}, values={"m": 3})
