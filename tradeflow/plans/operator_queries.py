"""Single-operator queries over whole ERP relations.

Each function isolates one operator of the inventory (P13, A1-A3, A10-A13,
W1, J4, J6-J8, J11, U1-U4, P17, F7, F13, F14, S2-S5) so it is checked on its
own against the SQL oracle, on the full tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.functions import labels
from tradeflow.functions.dates import ISO_DATE, br_date_text, lenient_date
from tradeflow.functions.numeric import br_grouped_text, br_money_text, br_number
from tradeflow.functions.text import contains_regex
from tradeflow.operators import aggregate as agg
from tradeflow.operators.joins import anti_join, dedup_on_key, exists_code_or_wildcard, salted_left_join
from tradeflow.plans import funds, star, stock
from tradeflow.plans.customers import SALES_COLUMNS
from tradeflow.plans.common import Tables
from tradeflow.sources.csv_br import read_br_csv, read_br_csv_counted, write_br_csv
from tradeflow.sources.parquet_io import read_columns, write_parquet
from tradeflow.sources.schemas import REPORT_SCHEMAS, declared
from tradeflow.sources.stored import scratch_path, store


def _spark(tables: Tables) -> SparkSession:
    return getattr(tables, "spark", None) or SparkSession.getActiveSession()


def _product_supplier(tables: Tables) -> DataFrame:
    p = tables["pcprodut"].alias("p")
    f = tables["pcfornec"].alias("f")
    return p.join(f, F.col("p.codfornec") == F.col("f.codfornec"), "left")


def null_safe_ne(tables: Tables) -> DataFrame:
    """``class != 'OUTROS'`` that keeps products whose class is unknown."""
    j = _product_supplier(tables)
    klass = F.when(F.col("f.codfornec").isNull(), F.lit(None)).otherwise(
        labels.supplier_class(F.col("f.classificacao"), "upper"))
    out = j.select(F.col("p.codprod").alias("codprod"), F.col("p.codfornec").alias("codfornec"),
                   klass.alias("classificacao"))
    return out.where(~F.col("classificacao").eqNullSafe("OUTROS"))


def _stock_by_class(tables: Tables) -> DataFrame:
    e = tables["pcest"].alias("e")
    return (_product_supplier(tables).join(e, F.col("e.codprod") == F.col("p.codprod"), "left")
            .select(F.col("f.classificacao").alias("classificacao"), F.col("e.codfilial").alias("codfilial"),
                    F.col("e.qtestger").alias("qtestger")))


def group_sum_keep_nulls(tables: Tables) -> DataFrame:
    """A2: grouped sum keeping null keys as a group."""
    return agg.group_sum(_stock_by_class(tables), ["classificacao", "codfilial"], "qtestger")


def group_sum_drop_nulls(tables: Tables) -> DataFrame:
    """A1: grouped sum dropping rows with a null key first."""
    return agg.group_sum(_stock_by_class(tables), ["classificacao", "codfilial"], "qtestger", keep_null_keys=False)


def filter_group_sum(tables: Tables) -> DataFrame:
    """A3: sale movements only, quantity summed per branch."""
    return agg.filter_group_sum(tables["pcmov"], "codoper", "S", "codfilial", "qt")


MONTH_LABELS = [f"M{m:02d}" for m in range(1, 13)]


def pivot_branch_month(tables: Tables, year: int) -> DataFrame:
    """A10: sold quantity, branch x month of ``year``, zero filled."""
    in_year = (F.col("dtmov") >= dt.date(year, 1, 1)) & (F.col("dtmov") < dt.date(year + 1, 1, 1))
    m = tables["pcmov"].where((F.col("codoper") == "S") & in_year)
    m = m.withColumn("mes", F.month("dtmov"))
    return agg.pivot_sum(m, "codfilial", "mes", list(range(1, 13)), "qt", labels=MONTH_LABELS)


def unpivot_branch_measures(tables: Tables) -> DataFrame:
    """Two measures per branch turned into (measure, value) rows."""
    wide = tables["pcmov"].groupBy("codfilial").agg(F.sum("qt").alias("QT"), F.sum("punit").alias("PUNIT"))
    return agg.unpivot(wide, "codfilial", ["QT", "PUNIT"], "medida", "valor")


def rollup_category_section(tables: Tables) -> DataFrame:
    """Sold quantity rolled up category -> section -> grand total."""
    m = tables["pcmov"].alias("m")
    p = tables["pcprodut"].alias("p")
    j = m.join(p, F.col("m.codprod") == F.col("p.codprod"), "inner").select(
        F.col("p.codcategoria").alias("codcategoria"), F.col("p.codsec").alias("codsec"), F.col("m.qt").alias("qt"))
    return agg.rollup_sum(j, ["codcategoria", "codsec"], "qt")


def share_by_branch(tables: Tables) -> DataFrame:
    """Each branch's share of the sold quantity (scalar-subquery total)."""
    sums = agg.group_sum(tables["pcmov"].where(F.col("codoper") == "S"), "codfilial", "qt", name="qt")
    return agg.share_of_total(sums, "qt", "share_pct")


def anti_join_orders_without_items(tables: Tables) -> DataFrame:
    """Order headers that have no item line (NOT EXISTS)."""
    return anti_join(tables["pcpedc"].select("numped", "codcli", "data"), tables["pcpedi"].select("numped"), "numped")


def semi_join_released_titles(tables: Tables) -> DataFrame:
    """Titles allowed by the release table (EXISTS with OR / wildcard),
    written as an equi-join on the distinct release codes plus scalar flags."""
    p = tables["pcprest"].alias("p")
    lib = tables["pclib"].where((F.col("codtabela") == funds.RELEASE_TABLE_COLLECTION)
                                & (F.col("codfunc") == funds.RELEASE_FUNCTION) & F.col("codigoa").isNotNull())
    out = exists_code_or_wildcard(p, F.col("p.codcob"), lib.select("codigoa"), funds.RELEASE_WILDCARD_TEXT)
    return out.select("numped", "codcob", "valor")


def expression_key_join(tables: Tables) -> DataFrame:
    """Title -> supervisor through NVL(title supervisor, rep supervisor)."""
    p = tables["pcprest"].alias("p")
    u = tables["pcusuari"].alias("u")
    s = tables["pcsuperv"].alias("s")
    return (p.join(u, F.col("p.codusur") == F.col("u.codusur"), "inner")
             .join(s, F.coalesce(F.col("p.codsupervisor"), F.col("u.codsupervisor")) == F.col("s.codsupervisor"), "inner")
             .select(F.col("p.numped").alias("numped"), F.col("s.codsupervisor").alias("codsupervisor"),
                     F.col("s.nome").alias("supervisor")))


def scalar_subquery_lot_one(tables: Tables) -> DataFrame:
    """Per stock address, the quantity of lot '1' with the same expiry
    (correlated scalar subquery written as pre-aggregation + left join)."""
    s = tables["pcestendereco"].alias("s")
    lot1 = (tables["pcestenderecoi"].where(F.col("numlote") == stock.LOT_ONE)
            .groupBy("codprod", "codendereco", "dtval").agg(F.sum("qt").alias("lot1_qt")).alias("l"))
    j = s.join(lot1, (F.col("l.codprod") == F.col("s.codprod")) & (F.col("l.codendereco") == F.col("s.codendereco"))
               & (F.col("l.dtval") == F.col("s.dtval")), "left")
    return j.select(F.col("s.codendereco").alias("codendereco"), F.col("s.codprod").alias("codprod"),
                    F.col("s.dtval").alias("dtval"), F.coalesce(F.col("l.lot1_qt"), F.lit(0)).alias("qt_lote1"))


def union_by_name(tables: Tables) -> DataFrame:
    """Applications and ledger entries in one relation (by column name)."""
    a = tables["pcaplicverba"].select("numverba", F.col("vlaplic").alias("valor"), F.lit("APLIC").alias("origem"))
    m = tables["pcmovcrfor"].select(F.lit("MOV").alias("origem"), "valor", "numverba", "tipo")
    return a.unionByName(m, allowMissingColumns=True)


def distinct_on_key(tables: Tables) -> DataFrame:
    """U2 keyed / T10: one product-branch row per product, the lowest branch wins."""
    pf = tables["pcprodfilial"]
    return dedup_on_key(pf, "codprod", ["codfilial", "estoquepordtvalidadepk"])


def distinct_rows(tables: Tables) -> DataFrame:
    """GROUP BY without aggregates == DISTINCT."""
    return tables["pcestenderecoi"].select("codprod", "numlote").distinct()


def sorted_domain(tables: Tables) -> DataFrame:
    """U4: sorted distinct values of a column (a selector's options)."""
    return tables["pcprodut"].select("codcategoria").distinct().orderBy("codcategoria")


def regex_search_customers(tables: Tables, pattern: str) -> DataFrame:
    """Case-insensitive regex over customer names; NULL never matches."""
    return tables["pcclient"].where(contains_regex(F.col("fantasia"), pattern)).select("codcli", "fantasia")


def br_number_roundtrip(tables: Tables) -> DataFrame:
    """F13 (with its F14-style rendering): unit prices rendered as pt-BR text
    (``1.234,56``) and parsed back."""
    m = tables["pcmov"].select("numped", "codprod", "numlote", "punit")
    text = br_grouped_text(F.col("punit"))
    return m.select("numped", "codprod", "numlote", text.alias("texto"), br_number(text).alias("valor"))


def br_currency(tables: Tables) -> DataFrame:
    """fund values as ``R$ 1.234,56`` text (NULL -> ``R$ 0,00``)."""
    v = tables["pcverba"]
    return v.select("numverba", br_money_text(F.col("valor")).alias("valor_fmt"))


def lenient_dates(tables: Tables) -> DataFrame:
    """Dates written in two formats (and some invalid texts) parsed back
    strictly per format; invalid ones become NULL."""
    v = tables["pcverba"].select("numverba", "dtcadastro")
    text = (F.when(F.col("numverba") % 7 == 0, F.concat(F.lit("31/02/"), F.year("dtcadastro").cast("string")))
            .when(F.col("numverba") % 2 == 0, br_date_text(F.col("dtcadastro")))
            .otherwise(F.date_format("dtcadastro", ISO_DATE)))
    return v.select("numverba", text.alias("texto"), lenient_date(text).alias("data"))


def csv_roundtrip(tables: Tables) -> DataFrame:
    """S3 then S2: the fund ledger written as a pt-BR CSV file and read back
    with the declared schema (the analysis layer's input)."""
    spark = _spark(tables)
    path = scratch_path(spark, "fund_ledger_csv")
    write_br_csv(funds.fund_ledger(tables), path)
    return read_br_csv(spark, path, REPORT_SCHEMAS["fund_ledger"])


def parquet_roundtrip(tables: Tables, since) -> DataFrame:
    """S5 then S4: the sales fact written as snappy Parquet, read back with the
    dashboard's column list (upper-case names resolve case-insensitively)."""
    spark = _spark(tables)
    path = scratch_path(spark, "fato_venda")
    write_parquet(star.fato_venda(tables, since), path)
    return read_columns(spark, path, SALES_COLUMNS)


def range_join_trailing_sales(tables: Tables, year: int) -> DataFrame:
    """Sales of the 90 days before each month start of ``year`` per branch
    and product (range predicate rewritten as an explode of each movement to the
    month starts whose window holds it)."""
    first = dt.date(year, 1, 1)
    m = tables["pcmov"].where((F.col("codoper") == "S") & F.col("dtmov").between(
        first - dt.timedelta(days=stock.SALES_WINDOW_DAYS), dt.date(year, 12, 1)))
    m = m.withColumn("ref", F.explode(stock._months_after(F.col("dtmov"), stock.SALES_WINDOW_DAYS, year)))
    return m.groupBy(F.month("ref").alias("mes"), "codfilial", "codprod").agg(F.sum("qt").alias("qtd_vendas_90d"))


def sales_by_customer_salted(tables: Tables) -> DataFrame:
    """J3/U2 with hot keys: all movements, half of them on customer 1 and a tenth without a customer, joined to the
    customer names by the salted join and summed per name."""
    moved = tables["pcmov"].select("numped", "codprod", "numlote", "qt", F.when(F.col("numped") % 2 == 0, 1).when(
        F.col("numped") % 5 > 0, F.col("codcli")).cast("bigint").alias("codcli"))
    named = salted_left_join(moved, tables["pcclient"].select("codcli", "cliente"), "codcli", F.struct("numped", "codprod", "numlote"))
    return named.groupBy("cliente").agg(F.sum("qt").alias("qt"), F.count(F.lit(1)).alias("linhas"))


SKETCH_ERROR = 0.05     # three standard errors of a sketch of 2^12 registers


def customers_by_branch_sketch(tables: Tables, since) -> DataFrame:
    """A7 with mergeable sketches: one sketch of the customers per branch and month is stored; the sketches of a year are
    united without the rows and compared with the exact count (``dentro_do_erro``: no more than SKETCH_ERROR off)."""
    sales = star.fato_venda(tables, since).select(
        F.col("cod_filial").alias("codfilial"), F.year("data_movimentacao").alias("ano"), F.month("data_movimentacao").alias("mes"), "cod_cliente")
    stored = store(agg.distinct_sketches(sales, ["codfilial", "ano", "mes"], "cod_cliente"), "customer_sketches")
    year = agg.distinct_of_sketches(stored, ["codfilial", "ano"], name="estimated").join(
        stored.groupBy("codfilial", "ano").agg(F.sum("n_rows").alias("linhas")), ["codfilial", "ano"])
    exact = sales.select("codfilial", "ano", "cod_cliente").distinct().groupBy("codfilial", "ano").agg(F.count("cod_cliente").alias("clientes"))
    return year.join(exact, ["codfilial", "ano"]).select(
        "codfilial", "ano", "linhas", "clientes",
        (F.abs(F.col("estimated") - F.col("clientes")) <= F.greatest(F.lit(1.0), F.col("clientes") * SKETCH_ERROR)).alias("dentro_do_erro"))


def csv_coercion_report(tables: Tables) -> DataFrame:
    """What the lenient reader made of a CSV file: per column the rows, the filled fields and those that became
    NULL because they did not parse. The file holds funds with impossible dates, words for amounts and codes with a
    letter; the counts are taken while the file is read, not in a pass of their own."""
    spark, k = _spark(tables), F.col("numverba")
    day = F.when(k % 7 == 0, "31/02/2000").when(k % 11 != 0, br_date_text(F.col("dtcadastro")))
    amount = F.when(k % 5 == 0, "n/d").when(k % 13 != 0, br_grouped_text(F.col("valor")))
    code = F.when(F.col("codfornec") % 3 == 0, F.concat(F.lit("F"), F.col("codfornec").cast("string"))).otherwise(F.col("codfornec").cast("string"))
    path = scratch_path(spark, "fund_texts_csv")
    write_br_csv(tables["pcverba"].select("numverba", day.alias("dtcadastro"), amount.alias("valor"), code.alias("codfornec")), path)
    schema = declared("numverba bigint, dtcadastro date, valor decimal(18,2), codfornec bigint")
    rows, coercions = read_br_csv_counted(spark, path, schema)
    write_parquet(rows, scratch_path(spark, "fund_texts"))            # the pass that is counted
    return coercions.report()


def returns_positions(returns_status: DataFrame) -> DataFrame:
    """The place of each return in its branch, in the order of the extract (due date ascending, payment date
    descending with open titles first) and in the order of the analysis (value descending, class ascending, NULLs last)."""
    tie = [F.col(c).asc_nulls_last() for c in ("CODFORNEC", "DTEMISSAO", "VALOR_VERBA_DEVOLUCAO", "COMPRADOR", "DATA_VENCIMENTO", "DATA_PAGAMENTO")]
    extract = agg.report_order([("DATA_VENCIMENTO", "asc"), ("DATA_PAGAMENTO", "desc")], nulls="oracle")
    analysis = agg.report_order([("DATA_PAGAMENTO", "desc"), ("VALOR_VERBA_DEVOLUCAO", "desc"), ("CLASSIFICACAO", "asc")], nulls="pandas")
    place = lambda order: F.row_number().over(Window.partitionBy("FILIAL").orderBy(*order, *tie))
    return returns_status.select("FILIAL", "CODFORNEC", "DTEMISSAO", "DATA_VENCIMENTO", "DATA_PAGAMENTO", "VALOR_VERBA_DEVOLUCAO",
                                 place(extract).alias("lugar_extrato"), place(analysis).alias("lugar_analise"))
