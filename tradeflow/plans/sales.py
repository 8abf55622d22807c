"""Sales extracts: rep and telesales revenue, daily order lists, customer documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import labels, text
from tradeflow.functions.dates import as_date
from tradeflow.plans.common import Tables, money_out, rep_line_revenue

# Fixed values of the extracts.
HOUSE_EMITTER = 8888        # orders keyed in by the house, not by telesales
EXCLUDED_BRANCH = 10        # branch left out of the revenue extracts
SALE_OPERATION = "S"        # stock movement code of a sale
TELESALES_ORIGIN = "T"
ORDER_SALE_CONDITIONS = (1, 5)


def rep_revenue(tables: Tables, start, end) -> DataFrame:
    """Revenue per branch, order origin, rep and product for house orders.

    Grouped by the raw origin codes (T3), so one label can appear on several
    rows. The date window is inclusive on both ends (T20)."""
    m = tables["pcmov"].alias("m")
    p = tables["pcpedc"].alias("p")
    u = tables["pcusuari"].alias("u")
    s = tables["pcsuperv"].alias("s")
    lines = m.where(
        F.col("m.dtmov").between(as_date(start), as_date(end))
        & F.col("m.dtcancel").isNull()
        & (F.col("m.codfilial") != EXCLUDED_BRANCH)
        & (F.col("m.codoper") == SALE_OPERATION))
    # LEFT JOIN pcpedc + WHERE p.codemitente = 8888 is an inner join.
    house = p.where(F.col("p.codemitente") == HOUSE_EMITTER).select("p.numped", "p.tipofv", "p.origemped")
    joined = (lines
              .join(u, F.col("u.codusur") == F.col("m.codusur"), "inner")
              .join(s, F.col("s.codsupervisor") == F.col("u.codsupervisor"), "left")
              .join(house.alias("p"), F.col("p.numped") == F.col("m.numped"), "inner"))
    grouped = joined.groupBy(
        F.col("m.codfilial"), F.col("u.nome").alias("rca"), F.col("s.nome").alias("supervisor"),
        F.col("m.codprod"), F.col("m.codusur"), F.col("p.tipofv"), F.col("p.origemped"),
    ).agg(F.sum(rep_line_revenue(m)).alias("faturamento"))
    return grouped.select(
        F.col("codfilial").alias("filial"),
        labels.origin_rep_report(F.col("tipofv"), F.col("origemped")).alias("origempedido"),
        F.col("codusur").alias("codigo_rca"), "rca", "supervisor", "codprod",
        money_out(F.col("faturamento")).alias("faturamento"))


def telesales_revenue(tables: Tables, start, end) -> DataFrame:
    """Telesales revenue per day of month, branch, product and operator."""
    m = tables["pcmov"].alias("m")
    p = tables["pcpedc"].alias("p")
    lines = m.where(
        F.col("m.dtmov").between(as_date(start), as_date(end))
        & (F.col("m.codoper") == SALE_OPERATION)
        & F.col("m.dtcancel").isNull()
        & (F.col("m.codfilial") != EXCLUDED_BRANCH))
    orders = p.where((F.col("p.origemped") == TELESALES_ORIGIN) & F.col("p.dtcancel").isNull()
                     & (F.col("p.codemitente") != HOUSE_EMITTER)).select("p.numped", "p.codemitente")
    joined = lines.join(orders.alias("p"), F.col("p.numped") == F.col("m.numped"), "inner")
    grouped = joined.groupBy(
        F.dayofmonth("m.dtmov").alias("dia_faturamento"), F.col("m.codfilial").alias("filial"),
        F.col("m.codprod"), F.col("p.codemitente").alias("codigo_rca"),
    ).agg(F.sum(rep_line_revenue(m)).alias("faturamento"))
    return grouped.select("filial", "codprod", "dia_faturamento", "codigo_rca",
                          money_out(F.col("faturamento")).alias("faturamento"))


def day_orders_rep(tables: Tables, day) -> DataFrame:
    """Order lines of one day (sale conditions 1 and 5) with rep,
    supervisor, customer, product and promotion."""
    c = tables["pcpedc"].alias("c")
    i = tables["pcpedi"].alias("i")
    orders = c.where((F.col("c.data") == as_date(day)) & F.col("c.condvenda").isin(*ORDER_SALE_CONDITIONS))
    joined = (orders
              .join(i, F.col("i.numped") == F.col("c.numped"), "inner")
              .join(tables["pcpromocaomed"].alias("pm"),
                    F.col("pm.codpromocaomed") == F.col("i.codpromocaomed"), "left")
              .join(tables["pcusuari"].alias("u"), F.col("u.codusur") == F.col("c.codusur"), "left")
              .join(tables["pcsuperv"].alias("s"),
                    F.col("s.codsupervisor") == F.col("u.codsupervisor"), "left")
              .join(tables["pcclient"].alias("cli"), F.col("cli.codcli") == F.col("c.codcli"), "inner")
              .join(tables["pcprodut"].alias("pr"), F.col("pr.codprod") == F.col("i.codprod"), "inner"))
    return joined.select(
        F.col("c.codfilial").alias("filial"), F.col("c.codusur").alias("cod_rca"),
        F.col("u.nome").alias("nm_rca"), F.col("s.codsupervisor").alias("codsupervisor"),
        F.col("s.nome").alias("supervisor"), F.col("c.codcli").alias("cod_cliente"),
        F.col("cli.cliente").alias("nm_cliente"), F.col("i.codprod").alias("cod_produto"),
        F.col("pr.descricao").alias("nm_produto"), money_out(F.col("i.qt")).alias("qt_vendida"),
        money_out(F.col("i.pvenda")).alias("vl_venda"), F.col("i.posicao").alias("posicao_pedido"),
        F.col("pm.descricaoresumida").alias("descricaoresumida"))


def day_orders_telesales(tables: Tables, day) -> DataFrame:
    """R12, telesales variant: every order of the day not keyed by the house,
    kept even without items (all joins are outer)."""
    c = tables["pcpedc"].alias("c")
    orders = c.where((F.col("c.data") == as_date(day)) & F.col("c.condvenda").isin(*ORDER_SALE_CONDITIONS)
                     & (F.col("c.codemitente") != HOUSE_EMITTER))
    joined = (orders
              .join(tables["pcpedi"].alias("i"), F.col("i.numped") == F.col("c.numped"), "left")
              .join(tables["pcempr"].alias("e"), F.col("e.matricula") == F.col("c.codemitente"), "left")
              .join(tables["pcclient"].alias("cli"), F.col("cli.codcli") == F.col("c.codcli"), "left")
              .join(tables["pcprodut"].alias("pr"), F.col("pr.codprod") == F.col("i.codprod"), "left")
              .join(tables["pcusuari"].alias("u"), F.col("u.codusur") == F.col("e.codusur"), "left")
              .join(tables["pcsuperv"].alias("s"),
                    F.col("s.codsupervisor") == F.col("u.codsupervisor"), "left"))
    return joined.select(
        F.col("c.codfilial").alias("filial"), F.col("c.codemitente").alias("cod_televenda"),
        F.col("e.nome").alias("nm_televenda"), F.col("s.codsupervisor").alias("codsupervisor"),
        F.col("s.nome").alias("supervisor"), F.col("c.codcli").alias("cod_cliente"),
        F.col("cli.cliente").alias("nm_cliente"), F.col("i.codprod").alias("cod_produto"),
        F.col("pr.descricao").alias("nm_produto"), money_out(F.col("i.qt")).alias("qt_vendida"),
        money_out(F.col("i.pvenda")).alias("vl_venda"), F.col("i.posicao").alias("posicao_pedido"))


def customer_documents(tables: Tables) -> DataFrame:
    """Customer tax document cleaned to digits and typed CPF/CNPJ."""
    cli = tables["pcclient"]
    digits = text.digits_only(F.col("cgcent"))
    return cli.select(
        F.col("codcli").alias("cod_cliente"), F.col("cliente").alias("nm_cliente"), "fantasia", "codcliprinc",
        text.document_number(digits).alias("documento_limpo"),
        text.document_type(digits).alias("tp_documento"))
