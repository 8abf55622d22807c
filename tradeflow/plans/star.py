"""Sales star schema (7 dimensions, 3 facts) built from the ERP relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import labels
from tradeflow.functions.dates import as_date
from tradeflow.functions.numeric import nvl0
from tradeflow.plans.common import Tables, money_out

# Fixed values of the star-schema extract.
HOLDING_BRANCH = 99          # branch code excluded from the branch dimension
RESELLER_FLAG = "S"          # suppliers that count as resellers


def product_hierarchy(tables: Tables) -> DataFrame:
    """Product with department, section (keyed by section and department) and
    category (keyed by category and section); all left joins (J2)."""
    p = tables["pcprodut"].alias("p")
    dep = tables["pcdepto"].alias("dep")
    sec = tables["pcsecao"].alias("sec")
    cat = tables["pccategoria"].alias("cat")
    return (p.join(dep, F.col("dep.codepto") == F.col("p.codepto"), "left")
             .join(sec, (F.col("sec.codsec") == F.col("p.codsec")) & (F.col("sec.codepto") == F.col("dep.codepto")), "left")
             .join(cat, (F.col("cat.codcategoria") == F.col("p.codcategoria")) & (F.col("cat.codsec") == F.col("sec.codsec")), "left"))


def dim_produto(tables: Tables) -> DataFrame:
    return (product_hierarchy(tables)
            .where(F.col("p.dtexclusao").isNull())
            .select(F.col("p.codprod").alias("cod_produto"), F.col("p.descricao").alias("nm_produto"),
                    F.col("cat.categoria").alias("categoria"), F.col("sec.descricao").alias("secao"),
                    F.col("dep.descricao").alias("departamento")))


def dim_filial(tables: Tables) -> DataFrame:
    return (tables["pcfilial"].where(F.col("codigo") != HOLDING_BRANCH)
            .select(F.col("codigo").alias("cod_filial"), F.col("razaosocial").alias("nm_filial")).distinct())


def dim_fornecedor(tables: Tables) -> DataFrame:
    return (tables["pcfornec"].where(F.col("revenda") == RESELLER_FLAG)
            .select(F.col("codfornec").alias("cod_fornecedor"), F.col("fornecedor").alias("nm_fornecedor"),
                    labels.supplier_class(F.col("classificacao"), "upper").alias("classificacao"))
            .distinct())


def dim_cliente(tables: Tables) -> DataFrame:
    return (tables["pcclient"]
            .select(F.col("codcli").alias("cod_cliente"), F.col("cliente").alias("nm_cliente"),
                    F.col("tipofj").alias("tipo_pj")).distinct())


def dim_vendedor(tables: Tables) -> DataFrame:
    return (tables["pcusuari"]
            .select(F.col("codusur").alias("cod_vendedor"), F.col("nome").alias("nm_vendedor")).distinct())


def dim_supervisor(tables: Tables) -> DataFrame:
    return tables["pcsuperv"].select(F.col("codsupervisor").alias("cod_supervisor"),
                                     F.col("nome").alias("nm_supervisor"))


def dim_televendas(tables: Tables) -> DataFrame:
    """Employees that keyed at least one order (EXISTS as a left-semi join).
    The order side is reduced to its distinct emitter codes (map-side partial
    aggregation) before the join, so the order table is never joined row by row."""
    emitters = tables["pcpedc"].select(F.col("codemitente")).distinct()
    e = tables["pcempr"]
    return (e.join(emitters, e.matricula == emitters.codemitente, "left_semi")
            .select(F.col("matricula").cast("int").alias("cod_televenda"), F.col("nome").alias("nm_televenda"))
            .distinct())


def fato_venda(tables: Tables, since) -> DataFrame:
    """Sales fact at line grain: one row per movement key with gross and net
    values rounded per line before the sum (A15). Net really subtracts ST and
    IPI; a missing quantity makes the line NULL (T4)."""
    m = tables["pcmov"].alias("m")
    u = tables["pcusuari"].alias("u")
    s = tables["pcsuperv"].alias("s")
    p = tables["pcpedc"].select("numped", "codemitente", "tipofv", "origemped").alias("p")
    lines = m.where((F.col("m.codoper") == "S") & (F.col("m.dtmov") >= as_date(since)) & F.col("m.dtcancel").isNull())
    joined = (lines.join(u, F.col("u.codusur") == F.col("m.codusur"), "left")
                   .join(s, F.col("s.codsupervisor") == F.col("u.codsupervisor"), "left")
                   .join(p, F.col("p.numped") == F.col("m.numped"), "left"))
    gross = F.round((nvl0(F.col("m.punit")) + nvl0(F.col("m.vloutros")) + nvl0(F.col("m.vlfrete_rateio"))) * F.col("m.qt"), 2)
    net = F.round((nvl0(F.col("m.punit")) - nvl0(F.col("m.st")) - nvl0(F.col("m.vlipi"))) * F.col("m.qt"), 2)
    grouped = joined.groupBy(
        F.col("m.codfilial").alias("cod_filial"), F.col("m.dtmov").alias("data_movimentacao"),
        F.col("m.numped").alias("num_pedido"), F.col("m.codusur").alias("cod_vendedor"),
        F.col("s.codsupervisor").alias("cod_supervisor"), F.col("m.codcli").alias("cod_cliente"),
        F.col("m.codfornec").alias("cod_fornecedor"), F.col("m.codprod").alias("cod_produto"),
        F.col("m.numlote").alias("num_lote"), F.col("m.datavalidade").alias("data_validade"),
        F.col("p.codemitente").alias("cod_televenda"), F.col("p.tipofv").alias("tipofv"),
        F.col("p.origemped").alias("origemped"),
    ).agg(F.sum("m.qt").alias("qt_vendida"), F.sum(gross).alias("valor_bruto"), F.sum(net).alias("valor_liquido"))
    return grouped.select(
        "cod_filial", "data_movimentacao", "num_pedido", "cod_vendedor", "cod_televenda", "cod_supervisor",
        "cod_cliente", "cod_fornecedor", "cod_produto", "num_lote", "data_validade",
        labels.origin_sales_fact(F.col("tipofv"), F.col("origemped")).alias("origem_pedido"),
        "qt_vendida", "valor_bruto", "valor_liquido")


def fato_pedido_venda(tables: Tables, since) -> DataFrame:
    """Order fact: header x item for live orders since a date. The source sorts
    by status for its file; a DataFrame carries no order, sinks may sort."""
    pc = tables["pcpedc"].alias("pc")
    pi = tables["pcpedi"].alias("pi")
    orders = pc.where((F.col("pc.data") >= as_date(since)) & F.col("pc.dtcancel").isNull())
    return orders.join(pi, F.col("pi.numped") == F.col("pc.numped"), "inner").select(
        F.col("pc.numped").alias("numero_pedido"), F.col("pc.numtransvenda").alias("numtransvenda"),
        F.col("pc.data").alias("data_pedido"), F.col("pc.codcli").alias("cod_cliente"),
        F.col("pc.codusur").alias("cod_vendedor"), F.col("pc.codemitente").alias("cod_emitente"),
        F.col("pc.codfilial").alias("cod_filial"), F.col("pi.codprod").alias("cod_produto"),
        money_out(F.col("pc.vltotal")).alias("valor_total"), money_out(F.col("pc.vlatend")).alias("valor_atendido"),
        money_out(F.col("pi.pvenda")).alias("vl_venda_unitario"), money_out(F.col("pi.qt")).alias("quantidade"),
        money_out(F.col("pi.qtfalta")).alias("qtd_falta"), F.col("pi.numlote").alias("num_lote"),
        labels.origin_order_fact(F.col("pc.tipofv"), F.col("pc.origemped")).alias("origem_pedido"),
        labels.order_status(F.col("pc.posicao")).alias("posicao_pedido"))


def fato_receber(tables: Tables, since) -> DataFrame:
    """Open receivables issued since a date (T15: the cut is the date itself).
    Pass-through columns a receivable relation lacks come out as typed NULLs (P19)."""
    pr = tables["pcprest"]
    present = {c.lower() for c in pr.columns}

    def optional(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in present else F.lit(None).cast(kind)

    live = pr.where((F.col("dtemissao") >= as_date(since)) & F.col("dtcancel").isNull() & F.col("dtpag").isNull())
    return live.select(
        F.col("codcli").alias("cod_cliente"), optional("prest", "string").alias("prestacao"),
        optional("duplic", "bigint").alias("duplicata"), money_out(F.col("valor")).alias("valor"),
        F.col("dtvenc").alias("dt_vencimento"), optional("vpago", "double").alias("valor_pago"),
        optional("txperm", "double").alias("txperm"), F.col("dtpag").alias("dt_pagamento"),
        F.col("dtemissao").alias("dt_emissao"), F.col("codfilial").alias("cod_filial"),
        F.col("codusur").alias("cod_vendedor"), optional("valordesc", "double").alias("vl_desconto"),
        optional("vldevol", "double").alias("vl_devolucao"), optional("dtdevol", "date").alias("dt_devolucao"),
        F.col("codsupervisor").alias("cod_supervisor"), F.col("numtransvenda").alias("numtransvenda"),
        F.col("numped").alias("numped"), optional("codemitentepedido", "bigint").alias("cod_emitente_pedido"))


def star_schema(tables: Tables, sales_since, orders_since, receivables_since) -> dict[str, DataFrame]:
    """Every table of the star schema, keyed by table name."""
    return {
        "dim_produto": dim_produto(tables), "dim_filial": dim_filial(tables),
        "dim_fornecedor": dim_fornecedor(tables), "dim_cliente": dim_cliente(tables),
        "dim_vendedor": dim_vendedor(tables), "dim_supervisor": dim_supervisor(tables),
        "dim_televendas": dim_televendas(tables),
        "fato_venda": fato_venda(tables, sales_since),
        "fato_pedido_venda": fato_pedido_venda(tables, orders_since),
        "fato_receber": fato_receber(tables, receivables_since),
    }
