"""Stock reports: last-entry cost, current and monthly excess stock, near-expiry stock."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import labels
from tradeflow.functions.dates import as_date
from tradeflow.functions.numeric import greatest_null_strict, half_up_ratio, nvl0
from tradeflow.plans.common import Tables

# Fixed values of the stock reports.
STOCK_BRANCH_EXCLUDED = 10
PHARMA_COVER_DAYS, BEAUTY_COVER_DAYS = 90, 60       # target cover per class
SALES_WINDOW_DAYS = 90
NEW_PRODUCT_DAYS = 120
NO_SALES_COVER = 9999
EXCLUDED_DEPARTMENTS = ("IMOBILIZADO", "ESTOQUE DE INSUMOS", "MATERIAIS DE CONSUMO")
LOT_ONE = "1"
PICKING_ADDRESS = "AP"
OTHER_CLASS = labels.CLASS_SPELLINGS["title"][2]


def last_entry_cost(tables: Tables) -> DataFrame:
    """Distinct (product, last entry value, branch, class) over left joins."""
    p = tables["pcprodut"].alias("p")
    f = tables["pcfornec"].alias("f")
    e = tables["pcest"].alias("e")
    return (p.join(f, F.col("p.codfornec") == F.col("f.codfornec"), "left")
             .join(e, F.col("p.codprod") == F.col("e.codprod"), "left")
             .select(F.col("p.codprod").alias("codprod"),
                     F.col("e.valorultent").cast("double").alias("valorultent"),
                     F.col("e.codfilial").alias("codfilial"),
                     labels.supplier_class(F.col("f.classificacao"), "mixed").alias("classificacao"))
             .distinct())


def _product_attributes(tables: Tables, base: DataFrame, prod_col: str) -> DataFrame:
    """Joins product -> supplier (inner), department/section/category/buyer (left).
    Supplier and masters carry no broadcast hint (sizes decide); the
    product master is joined by key (it grows with the catalogue)."""
    p = tables["pcprodut"].alias("p")
    f = tables["pcfornec"].alias("f")
    dep = tables["pcdepto"].alias("dep")
    sec = tables["pcsecao"].alias("sec")
    cat = tables["pccategoria"].alias("cat")
    ep = tables["pcempr"].alias("ep")
    return (base.join(p, F.col("p.codprod") == F.col(prod_col), "inner")
                .join(f, F.col("f.codfornec") == F.col("p.codfornec"), "inner")
                .join(dep, F.col("dep.codepto") == F.col("p.codepto"), "left")
                .join(sec, (F.col("sec.codsec") == F.col("p.codsec")) & (F.col("sec.codepto") == F.col("dep.codepto")), "left")
                .join(cat, (F.col("cat.codcategoria") == F.col("p.codcategoria")) & (F.col("cat.codsec") == F.col("sec.codsec")), "left")
                .join(ep, F.col("ep.matricula") == F.col("f.codcomprador"), "left"))


def excess_stock(tables: Tables, as_of) -> DataFrame:
    """Excess stock value today per branch and product (classes F and H).

    Every window is bounded above by ``as_of`` (T23). Coverage is rounded to
    2 dp before it is used (A9); no sales -> coverage 9999 and excess 0; a
    product first bought within 120 days is never in excess."""
    as_of = as_of if isinstance(as_of, dt.date) else as_date(as_of)
    start = as_of - dt.timedelta(days=SALES_WINDOW_DAYS)
    new_from = as_of - dt.timedelta(days=NEW_PRODUCT_DAYS)

    # Only empty days are counted; a product without one has no row here and counts 0 below.
    zero_days = (tables["pchistest"].where(F.col("data").between(start, as_of) & (F.col("qtestger") == 0))
                 .groupBy("codfilial", "codprod").agg(F.count("*").alias("qtd_dias_zerados")))
    # Cancelled lines are included in this report (unlike the monthly one).
    sales = (tables["pcmov"].where((F.col("codoper") == "S") & F.col("dtmov").between(start, as_of))
             .groupBy("codfilial", "codprod").agg(F.sum("qt").alias("qtd_vendas_90d")))
    new = (tables["pcest"].where(F.col("dtprimcompra").between(new_from, as_of))
           .select(F.col("codfilial").alias("n_codfilial"), F.col("codprod").alias("n_codprod"),
                   F.col("dtprimcompra").alias("data_primeira_compra")))

    e = tables["pcest"].alias("e").where(
        (F.col("codfilial") != STOCK_BRANCH_EXCLUDED) & (F.col("qtestger") != 0))
    joined = _product_attributes(tables, e, "e.codprod").where(F.col("f.classificacao").isin("F", "H"))
    stock = joined.groupBy(
        F.col("e.codfilial").alias("codfilial"), F.col("f.classificacao").alias("class_code"),
        F.col("e.codprod").alias("codprod"), F.col("p.descricao").alias("produto"),
        F.col("cat.categoria").alias("categoria"), F.col("sec.descricao").alias("secao"),
        F.col("dep.descricao").alias("departamento"), F.col("f.codfornec").alias("codfornec"),
        F.col("f.fornecedor").alias("fornecedor"), F.col("f.codcomprador").alias("cod_comprador"),
        F.col("e.custoultent").alias("valor_ultima_entrada"), F.col("ep.nome").alias("comprador"),
    ).agg(F.sum("e.qtestger").alias("qtd_total_estoque"), F.sum("e.qtgirodia").alias("qtd_giro_dia"))
    cover = F.when(F.col("qtd_giro_dia") > 0, half_up_ratio(F.col("qtd_total_estoque"), F.col("qtd_giro_dia"), 2)).otherwise(F.lit(0))
    stock = stock.withColumn("cobertura", cover).withColumn(
        "classificacao", labels.supplier_class(F.col("class_code"), "title"))

    r = (stock.join(sales, ["codfilial", "codprod"], "left")
              .join(zero_days, ["codfilial", "codprod"], "left")
              .join(new, (F.col("codfilial") == F.col("n_codfilial")) & (F.col("codprod") == F.col("n_codprod")), "left"))
    sold = nvl0(F.col("qtd_vendas_90d"))
    zeros = nvl0(F.col("qtd_dias_zerados"))
    value = F.round(F.col("qtd_total_estoque") * F.col("valor_ultima_entrada"), 2)
    cov = F.col("cobertura")
    is_new = F.col("n_codfilial").isNotNull() & F.col("n_codprod").isNotNull()
    # (value / cover) * (cover - target), rounded once and exactly
    def beyond(target: int) -> Column:
        return half_up_ratio(value * (cov - target), cov, 2)

    raw_excess = (F.when(is_new, F.lit(0))
                  .when(sold == 0, F.lit(0))
                  .when(cov.isNull() | (cov == 0), F.lit(0))
                  .when(F.col("classificacao") == "Farma", beyond(PHARMA_COVER_DAYS))
                  .when(F.col("classificacao") == "HB", beyond(BEAUTY_COVER_DAYS))
                  .otherwise(F.lit(0)))
    days_with_stock = F.lit(SALES_WINDOW_DAYS) - zeros
    return r.select(
        "codfilial", "classificacao", "codprod", "produto", "categoria", "secao", "departamento",
        "cod_comprador", "comprador", "codfornec", "fornecedor",
        F.col("valor_ultima_entrada").cast("double").alias("valor_ultima_entrada"),
        "qtd_total_estoque", "qtd_giro_dia",
        cov.cast("double").alias("cobertura_estoque_original"),
        F.when(sold == 0, F.lit(NO_SALES_COVER)).otherwise(cov).cast("double").alias("cobertura_estoque_ajustada"),
        sold.cast("double").alias("qtd_vendas_90d"),
        zeros.alias("qtd_dias_zerados"),
        value.cast("double").alias("valor_estoque"),
        F.when(days_with_stock > 0, half_up_ratio(sold, days_with_stock, 2)).cast("double").alias("giro_medio_corrigido"),
        greatest_null_strict(F.lit(0), raw_excess).cast("double").alias("valor_excedente"),
        labels.flag_when_null(F.col("n_codfilial"), labels.NO_PT, labels.YES_PT).alias("is_produto_novo"),
        F.col("data_primeira_compra"),
    )


ALL_MONTHS = tuple(range(1, 13))


def _months_after(day: Column, horizon_days: int, year: int, months: Sequence[int] = ALL_MONTHS) -> Column:
    """Month starts m of ``year`` with ``day < m <= day + horizon`` — the months
    whose trailing window ``[m - horizon, m)`` contains ``day`` (J4 as explode)."""
    first = F.add_months(F.trunc(day, "month"), 1)
    starts = F.sequence(first, F.date_add(day, horizon_days), F.expr("interval 1 month"))
    return F.filter(starts, lambda m: (F.year(m) == year) & F.month(m).isin(*months))


def excess_stock_monthly(tables: Tables, year: int, months: Sequence[int] = ALL_MONTHS) -> DataFrame:
    """Excess stock on the 1st of each of ``months`` of ``year`` (default: all twelve), all in one job.

    The reference runs one query per month against a one-row date relation and a
    range predicate. Here each fact row is exploded to the (at most four) month
    starts whose trailing window contains it, so every aggregate is keyed by
    (branch, product, month) and joined on that key: no calendar join, no
    sequential loop."""
    starts = [dt.date(year, m, 1) for m in sorted(set(months))]
    if not starts:
        raise ValueError("no month asked for")
    first_month, last_month = starts[0], starts[-1]
    hist = tables["pchistest"]

    def windowed(df: DataFrame, day_col: str, horizon: int) -> DataFrame:
        lo = first_month - dt.timedelta(days=horizon)
        return (df.where((F.col(day_col) >= lo) & (F.col(day_col) < last_month))
                  .withColumn("ref", F.explode(_months_after(F.col(day_col), horizon, year, months)))
                  .withColumn("mes", F.month("ref")))

    # Days without stock are filtered before the explode: the others would count 0.
    zero_days = (windowed(hist.where(F.col("qtestger") <= 0), "data", SALES_WINDOW_DAYS)
                 .groupBy("codfilial", "codprod", "mes").agg(F.count("*").alias("qtd_dias_zerados")))
    sales = (windowed(tables["pcmov"].where((F.col("codoper") == "S") & F.col("dtcancel").isNull()),
                      "dtmov", SALES_WINDOW_DAYS)
             .groupBy("codfilial", "codprod", "mes").agg(F.sum("qt").alias("qtd_vendas_90d")))
    new = (windowed(tables["pcest"], "dtprimcompra", NEW_PRODUCT_DAYS)
           .select(F.col("codfilial").alias("n_codfilial"), F.col("codprod").alias("n_codprod"),
                   F.col("mes").alias("n_mes")))

    # Position on the 1st of each month (J5: equality with the month start).
    snap = hist.where(F.col("data").isin(*starts)).alias("he")
    joined = _product_attributes(tables, snap, "he.codprod").where(
        ~F.upper(F.trim(F.col("dep.descricao"))).isin(*EXCLUDED_DEPARTMENTS))
    pos = joined.select(
        F.col("he.codfilial").alias("codfilial"), F.col("he.codprod").alias("codprod"),
        F.month("he.data").alias("mes"), F.col("he.qtestger").alias("qtd_total_estoque"),
        F.col("he.custorep").alias("valor_ultima_entrada"), F.col("p.descricao").alias("produto"),
        labels.supplier_class(F.col("f.classificacao"), "title").alias("classificacao"),
        F.col("cat.categoria").alias("categoria"), F.col("sec.descricao").alias("secao"),
        F.col("dep.descricao").alias("departamento"), F.col("f.codcomprador").alias("codcomprador"),
        F.col("ep.nome").alias("comprador"), F.col("f.codfornec").alias("codfornec"),
        F.col("f.fornecedor").alias("fornecedor"))

    keys = ["codfilial", "codprod", "mes"]
    r = (pos.join(sales, keys, "left").join(zero_days, keys, "left")
            .join(new, (F.col("codfilial") == F.col("n_codfilial")) & (F.col("codprod") == F.col("n_codprod"))
                  & (F.col("mes") == F.col("n_mes")), "left"))
    qty = F.col("qtd_total_estoque")
    cost = F.col("valor_ultima_entrada")
    sold = nvl0(F.col("qtd_vendas_90d"))
    zeros = nvl0(F.col("qtd_dias_zerados"))
    days = F.lit(SALES_WINDOW_DAYS) - zeros

    def excess_for(target: int) -> Column:
        # (qty - sold / days * target) * cost, rounded once and exactly (T24); NULL without a day in stock
        return half_up_ratio((qty * days - sold * target) * cost, days, 2)

    raw_excess = (F.when(F.col("n_codprod").isNotNull(), F.lit(0))
                  .when(sold == 0, F.round(qty * cost, 2))
                  .when(F.col("classificacao") == "Farma", excess_for(PHARMA_COVER_DAYS))
                  .when(F.col("classificacao") == "HB", excess_for(BEAUTY_COVER_DAYS))
                  .otherwise(F.lit(0)))
    return r.select(
        "codfilial", "classificacao", "codprod", "produto", "categoria", "secao", "departamento",
        "codcomprador", "comprador", "codfornec", "fornecedor",
        cost.cast("double").alias("valor_ultima_entrada"), qty.alias("qtd_total_estoque"),
        sold.cast("double").alias("qtd_vendas_90d"), zeros.alias("qtd_dias_zerados"),
        F.round(qty * cost, 2).cast("double").alias("valor_estoque"),
        F.when(days <= 0, F.lit(0)).otherwise(half_up_ratio(sold, days, 4)).cast("double").alias("vmd_corrigida"),
        greatest_null_strict(F.lit(0), raw_excess).cast("double").alias("valor_excedente"),
        labels.flag_when_null(F.col("n_codprod"), labels.NO_PT, labels.YES_PT).alias("is_produto_novo"),
        "mes")


def near_expiry_rows(tables: Tables, start, end, with_lot: bool = False) -> DataFrame:
    """Stock by address whose expiry falls in [start, end], with the quantity
    rule of the near-expiry extracts (lot table, lot-1 sum J11).

    The two stock tables meet first and the expiry range is applied before any
    master is joined, so the masters see the expiring rows only. A product's
    date-control flags are made distinct before they are joined: the source joins
    the product-branch table on the product alone, which repeats a row once per
    branch, and the caller's DISTINCT removes those copies again (T6)."""
    first, last = as_date(start), as_date(end)
    lots = tables["pcestenderecoi"]
    one = F.col("numlote") == LOT_ONE
    same_lot = (lots.where(one & F.col("dtval").between(first, last)).groupBy("codprod", "codendereco", "dtval")
                .agg(F.sum("qt").alias("lot_one_qt")))
    lots = lots.select("codprod", "codendereco", "numlote", F.col("dtval").alias("lot_expiry"), F.col("qt").alias("lot_qt"))
    expiring = (tables["pcestendereco"].where(F.col("qt") > 0).join(lots, ["codprod", "codendereco"], "left")
                .withColumn("data_validade", F.coalesce("lot_expiry", "dtval"))
                .where(F.col("data_validade").between(first, last)).drop("dtval"))
    expiring = expiring.join(same_lot.withColumnRenamed("dtval", "lot_expiry"), ["codprod", "codendereco", "lot_expiry"], "left")

    suppliers = (tables["pcfornec"].select("codfornec", "fornecedor", labels.supplier_class(F.col("classificacao"), "title").alias("classificacao"))
                 .where(F.col("classificacao") != OTHER_CLASS))
    products = (tables["pcprodut"].select("codprod", "descricao", "codfornec", "estoqueporlote").join(suppliers, "codfornec")
                .join(tables["pcprodfilial"].select("codprod", "estoquepordtvalidadepk").distinct(), "codprod"))
    costs = tables["pcest"].select("codprod", "codfilial", F.round("custoultent", 2).alias("valor_ultima_entrada"))
    rows = (expiring.join(tables["pcendereco"], "codendereco").join(products, "codprod")
            .join(costs, ["codprod", "codfilial"], "left"))
    counted = F.col("lot_qt").isNotNull()
    by_date = (F.col("lot_expiry").isNotNull() & (F.col("estoquepordtvalidadepk") == "S") & (F.col("numlote") == LOT_ONE)
               & (F.col("tipoender") == PICKING_ADDRESS))
    quantity = (F.when(counted & (F.col("estoqueporlote") == "S"), F.col("lot_qt"))
                .when(counted & by_date, nvl0(F.col("lot_one_qt"))).otherwise(F.col("qt")))
    keys = ["codfilial", "classificacao", "fornecedor", "codprod", "descricao"] + (["numlote"] if with_lot else [])
    return rows.select(*keys, quantity.alias("qt"), "valor_ultima_entrada", "data_validade").where(F.col("qt") > 0)


def near_expiry(tables: Tables, start, end) -> DataFrame:
    """Quantity per (branch, product, expiry) with product attributes and
    total = quantity x last cost.

    Reproduces the source's GROUP-BY-as-DISTINCT on (..., expiry, qty, cost),
    which merges equal quantities of different addresses (T6). The DISTINCT
    shuffles on all eight columns after a map-side distinct, so a (branch,
    product) holding a large share of the stock rows is spread over many
    tasks; the re-sum and the attribute DISTINCT also combine map-side and
    then only move one row per key."""
    rows = (near_expiry_rows(tables, start, end)
            .select("codfilial", "classificacao", "fornecedor", "codprod", "descricao", "data_validade",
                    "qt", "valor_ultima_entrada")
            .distinct())
    sums = (rows.groupBy("codfilial", "codprod", "data_validade").agg(F.sum("qt").alias("quantidade")))
    attrs = rows.select("codfilial", "codprod", "classificacao", "fornecedor", "descricao",
                        "valor_ultima_entrada").distinct()
    out = sums.join(attrs, ["codfilial", "codprod"], "left")
    return out.select(
        "codfilial", "classificacao", "fornecedor", "codprod", "descricao",
        F.col("quantidade").cast("double").alias("quantidade"),
        F.col("valor_ultima_entrada").cast("double").alias("valor_ultima_entrada"), "data_validade",
        (F.col("quantidade") * F.col("valor_ultima_entrada")).cast("double").alias("total"))


def near_expiry_product(tables: Tables, start, end, with_lot: bool = False) -> DataFrame:
    """R8 (and R9 with ``with_lot``): distinct (branch, class, supplier, product
    [, lot], qty, cost) without the expiry date in the key, and the rounded total."""
    keys = ["codfilial", "classificacao", "fornecedor", "codprod", "descricao"] + (["numlote"] if with_lot else [])
    rows = near_expiry_rows(tables, start, end, with_lot).select(*keys, "qt", "valor_ultima_entrada").distinct()
    return rows.select(
        *keys, F.col("qt").cast("double").alias("quantidade_realizada"),
        F.col("valor_ultima_entrada").cast("double").alias("valor_ultima_entrada"),
        F.round(F.col("qt") * F.col("valor_ultima_entrada"), 2).cast("double").alias("total_realizado"))
