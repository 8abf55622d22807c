"""Customer lifecycle over the sales star schema.

The source screens work on one selected customer at a time; here every view
is computed for all customers at once (grouped by customer) with an optional
customer filter. Names, not ids, are the grouping keys, as in the source (T13).
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions import labels
from tradeflow.functions.dates import month_or_zero, year_or_zero
from tradeflow.functions.numeric import ratio
from tradeflow.functions.text import clean_label
from tradeflow.operators import aggregate as agg
from tradeflow.operators.joins import anti_join, dedup_on_key, left_join_known
from tradeflow.plans import star
from tradeflow.plans.common import Tables
from tradeflow.sources.star_files import StarFiles
from tradeflow.sources.stored import store, store_bucketed

# Fixed values of the lifecycle screens.
RECENCY_DAYS = 30
BAIT_SUGGESTIONS = 8
TOP_CATEGORIES = 10
TOP_ITEMS = 100
TOP_EROSION = 20
LIST_SEPARATOR = ", "
SALES_COLUMNS = ("COD_FILIAL", "DATA_MOVIMENTACAO", "NUM_PEDIDO", "COD_VENDEDOR", "COD_SUPERVISOR", "COD_CLIENTE",
                 "COD_PRODUTO", "QT_VENDIDA", "VALOR_LIQUIDO", "ORIGEM_PEDIDO")
FACT_IDS = ("COD_FILIAL", "NUM_PEDIDO", "COD_VENDEDOR", "COD_SUPERVISOR", "COD_CLIENTE", "COD_PRODUTO")


def _clean_dim(dim: DataFrame, id_col: str, text_cols: Sequence[str]) -> DataFrame:
    """Dimension as the dashboard loads it: id NULL -> 0, one row per id (T10),
    text NULL -> 'N/I', stripped, upper case."""
    dim = dim.withColumn(id_col, F.coalesce(F.col(id_col), F.lit(0)))
    dim = dedup_on_key(dim, id_col)
    return dim.withColumns({c: clean_label(F.col(c), labels.NOT_INFORMED) for c in text_cols})


def label_sales(fact: DataFrame, products: DataFrame, clients: DataFrame, reps: DataFrame) -> DataFrame:
    """The ten fact columns with product, customer and rep names: unmatched names become 'NAO CADASTRADO',
    amounts NULL -> 0, year/month NULL -> 0, ids NULL -> 0.

    A missing id counts as id 0, also in the dimensions, so it takes the names of a dimension's row 0 if there is
    one. It stays NULL for the joins (where its rows are spread over many tasks) and becomes 0 afterwards."""
    base = fact
    spread = F.struct("NUM_PEDIDO", "COD_PRODUTO", "DATA_MOVIMENTACAO")
    for dim, id_col, key, names in ((products, "cod_produto", "COD_PRODUTO", ["nm_produto", "categoria", "secao"]),
                                    (clients, "cod_cliente", "COD_CLIENTE", ["nm_cliente"]),
                                    (reps, "cod_vendedor", "COD_VENDEDOR", ["nm_vendedor"])):
        dim = _clean_dim(dim, id_col, names).withColumnRenamed(id_col, "_id")
        unnamed = dim.where(F.col("_id") == 0).select(F.first(F.struct(*names))).scalar()
        base = left_join_known(base, dim, key, "_id", spread).withColumns(
            {c: F.when(F.col(key).isNull(), unnamed.getField(c)).otherwise(F.col(c)) for c in names}).drop("_id")
    names = ["nm_produto", "categoria", "secao", "nm_cliente", "nm_vendedor", "ORIGEM_PEDIDO"]
    return base.withColumns({
        "ANO": year_or_zero(F.col("DATA_MOVIMENTACAO")), "MES": month_or_zero(F.col("DATA_MOVIMENTACAO")),
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in ("QT_VENDIDA", "VALOR_LIQUIDO", *FACT_IDS)},
        **{c: F.upper(F.coalesce(F.col(c), F.lit(labels.NOT_REGISTERED))) for c in names}})


def _of_reps(base: DataFrame, reps: Sequence[str]) -> DataFrame:
    return base.where(F.col("nm_vendedor").isin(*reps)) if reps else base


def sales_base(tables: Tables, since, reps: Sequence[str] = ()) -> DataFrame:
    """Sales lines with their names, straight from the ERP relations. ``reps`` filters by rep name (empty = all, P14)."""
    fact = star.fato_venda(tables, since).select(*[F.col(c.lower()).alias(c) for c in SALES_COLUMNS])
    # The keyed dedup keeps one row per code, so it subsumes the dimensions'
    # DISTINCT: read the two masters directly (one aggregation each).
    clients = tables["pcclient"].select(F.col("codcli").alias("cod_cliente"), F.col("cliente").alias("nm_cliente"))
    return _of_reps(label_sales(fact, star.dim_produto(tables).drop("departamento"), clients, sellers_of(tables)), reps)


def sales_base_of_files(files: StarFiles, since: dt.date | None = None, months: DataFrame | None = None,
                        reps: Sequence[str] = ()) -> DataFrame:
    """Sales lines with their names from an exported star schema.

    Either every line dated ``since`` or later, or the lines of ``months`` (rows of the star's calendar): both open
    the folders of those months only. Supervisor and order origin may be missing from an older file (P19)."""
    if months is not None:
        fact = files.fact_of_months("fato_venda", months, SALES_COLUMNS)
    elif since is not None:
        fact = files.fact_since("fato_venda", since, SALES_COLUMNS)
    else:
        fact = files.table("fato_venda", SALES_COLUMNS)
    fact = fact.select(*[F.col(c.lower()).alias(c) for c in SALES_COLUMNS])
    dims = [files.table(name, columns) for name, columns in (
        ("dim_produto", ["cod_produto", "nm_produto", "categoria", "secao"]), ("dim_cliente", ["cod_cliente", "nm_cliente"]),
        ("dim_vendedor", ["cod_vendedor", "nm_vendedor"]))]
    return _of_reps(label_sales(fact, *dims), reps)


CELL_KEYS = ("nm_cliente", "COD_CLIENTE", "nm_produto", "categoria", "secao", "ORIGEM_PEDIDO", "ANO", "MES")


def sales_cells(base: DataFrame) -> DataFrame:
    """The base reduced to (customer, product, category, section, origin, month): one row per cell with the sums and the
    last day that the macro, mix, gap, share and matrix views need.

    Every one of those views takes cells in place of the base and gives the same rows: sums of sums, maxima of
    maxima, and distinct counts over columns that are keys here. Only views of single orders need the lines."""
    positive = F.col("VALOR_LIQUIDO") > 0
    return base.groupBy(*CELL_KEYS).agg(
        F.sum("VALOR_LIQUIDO").alias("VALOR_LIQUIDO"), F.sum(F.when(positive, F.col("VALOR_LIQUIDO"))).alias("VALOR_POSITIVO"),
        F.sum("QT_VENDIDA").alias("QT_VENDIDA"), F.max("DATA_MOVIMENTACAO").alias("DATA_MOVIMENTACAO"))


def _last_day(base: DataFrame) -> Column:
    """'Today' of the dashboard: the latest movement date, as a scalar subquery."""
    return base.select(F.max("DATA_MOVIMENTACAO")).scalar()


def sales_macro_kpis(base: DataFrame, prev_year: int, cur_year: int, approx: bool = False) -> DataFrame:
    """Net revenue, active customers, revenue of the current and previous year with the change in percent (W3), and the
    number of distinct product names.

    The lines are first summed per (customer, product); the distinct counts (A7) then run over those rows: each gives
    one row for its customer, which carries the sums, and one for its product. No Expand, one scan. ``approx`` counts
    with HyperLogLog++ sketches (about 1 % off) and needs no second shuffle."""
    def year(y):
        return agg.conditional_sum(F.col("VALOR_LIQUIDO"), F.col("ANO") == y)

    sums = [F.sum("VALOR_LIQUIDO").alias("FATURAMENTO_LIQUIDO"), year(cur_year).alias("FATURAMENTO_ANO"), year(prev_year).alias("FATURAMENTO_ANO_ANTERIOR")]
    names = ["FATURAMENTO_LIQUIDO", "FATURAMENTO_ANO", "FATURAMENTO_ANO_ANTERIOR"]
    if approx:
        row = base.agg(*sums, F.approx_count_distinct("COD_CLIENTE", 0.01).alias("CLIENTES_ATIVOS"),
                       F.approx_count_distinct("nm_produto", 0.01).alias("MIX_ATIVO"))
    else:
        pairs = base.groupBy("COD_CLIENTE", "nm_produto").agg(*sums)
        measures = [F.col(n) for n in names]
        sides = F.array(F.struct(F.col("COD_CLIENTE").alias("cliente"), F.lit(None).cast("string").alias("produto"), *measures),
                        F.struct(F.lit(None).cast("long").alias("cliente"), F.col("nm_produto").alias("produto"),
                                 *[F.lit(None).cast(pairs.schema[n].dataType).alias(n) for n in names]))
        members = pairs.select(F.inline(sides)).groupBy("cliente", "produto").agg(*[F.sum(n).alias(n) for n in names])
        row = members.agg(*[F.sum(n).alias(n) for n in names], F.count("cliente").alias("CLIENTES_ATIVOS"), F.count("produto").alias("MIX_ATIVO"))
    row = row.select("FATURAMENTO_LIQUIDO", "CLIENTES_ATIVOS", *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names[1:]], "MIX_ATIVO")
    cur = F.col("FATURAMENTO_ANO").cast("double")
    prev = F.col("FATURAMENTO_ANO_ANTERIOR").cast("double")
    return row.withColumn("VARIACAO_PCT", F.when(prev > 0, (cur / prev - 1) * 100).otherwise(F.lit(0.0)))


def sales_yoy(base: DataFrame) -> DataFrame:
    """W3 for every year: revenue, previous year's revenue (lag) and change in
    percent. The window runs over one row per year only."""
    years = base.groupBy("ANO").agg(F.sum("VALOR_LIQUIDO").alias("FATURAMENTO"))
    w = Window.orderBy("ANO")
    prev = F.lag("FATURAMENTO").over(w)
    out = years.withColumn("FATURAMENTO_ANTERIOR", prev)
    cur_d, prev_d = F.col("FATURAMENTO").cast("double"), F.col("FATURAMENTO_ANTERIOR").cast("double")
    return out.withColumn("VARIACAO_PCT", F.when(prev_d > 0, (cur_d / prev_d - 1) * 100).otherwise(F.lit(0.0)))


def sales_month_year(base: DataFrame) -> DataFrame:
    return base.groupBy("ANO", "MES").agg(F.sum("VALOR_LIQUIDO").alias("VALOR_LIQUIDO"))


def top_categories(base: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """Observed categories only (T12), largest revenue first, name as tie-break."""
    sums = base.groupBy("categoria").agg(F.sum("VALOR_LIQUIDO").alias("VALOR_LIQUIDO"))
    return agg.top_n(sums, n, [F.col("VALOR_LIQUIDO").desc(), F.col("categoria")])


def sales_by_origin(base: DataFrame) -> DataFrame:
    return base.groupBy("ORIGEM_PEDIDO").agg(F.sum("VALOR_LIQUIDO").alias("VALOR_LIQUIDO"))


def rep_names(reps: DataFrame) -> DataFrame:
    """(rep, VENDEDOR): code and cleaned name of each rep, from (cod_vendedor, nm_vendedor)."""
    return _clean_dim(reps, "cod_vendedor", ["nm_vendedor"]).select(F.col("cod_vendedor").alias("rep"), F.col("nm_vendedor").alias("VENDEDOR"))


def sellers_of(tables: Tables) -> DataFrame:
    """Rep dimension of the sales base, straight from its relation."""
    return tables["pcusuari"].select(F.col("codusur").alias("cod_vendedor"), F.col("nome").alias("nm_vendedor"))


def customer_summary(base: DataFrame, reps: DataFrame | None = None) -> DataFrame:
    """Per customer: rep shown (the rep of the latest order, A16), lifetime value,
    average ticket per distinct order (A9), last purchase, days of inactivity
    against the latest date of the whole base (F15) and order count (A7).

    Two hash aggregations instead of COUNT(DISTINCT): lines -> orders (keyed by
    customer and order, so a hot customer spreads over many tasks), then
    orders -> customer. The rep is carried as a code and named at the end, from ``reps`` (cod_vendedor, nm_vendedor)
    or, without it, from a second pass over the base."""
    today = _last_day(base)
    orders = base.groupBy("nm_cliente", "NUM_PEDIDO").agg(
        F.sum("VALOR_LIQUIDO").alias("valor"), F.max("DATA_MOVIMENTACAO").alias("dia"),
        F.max("COD_VENDEDOR").alias("rep"))
    per = orders.groupBy("nm_cliente").agg(
        F.max_by(F.col("rep"), agg.date_long_key(F.col("dia"), F.col("NUM_PEDIDO"))).alias("rep"),
        F.sum("valor").alias("LTV"), F.count(F.lit(1)).alias("PEDIDOS"), F.max("dia").alias("ULTIMA_COMPRA"))
    names = rep_names(reps) if reps is not None else base.select(F.col("COD_VENDEDOR").alias("rep"), F.col("nm_vendedor").alias("VENDEDOR")).distinct()
    out = per.join(names, "rep", "left").drop("rep").withColumn("VENDEDOR", F.coalesce("VENDEDOR", F.lit(labels.NOT_REGISTERED)))
    out = out.withColumn("TICKET_MEDIO", ratio(F.col("LTV"), F.col("PEDIDOS")))
    days = F.datediff(today, F.col("ULTIMA_COMPRA"))
    return out.withColumns({"DIAS_INATIVO": days, "RECENTE": days < RECENCY_DAYS})


def customer_items(base: DataFrame, cur_year: int, n: int = TOP_ITEMS) -> DataFrame:
    """Per customer, the top ``n`` (product, category) by revenue with quantity,
    last purchase and ATIVO/CHURN status (A8, W1, F15)."""
    items = base.groupBy("nm_cliente", "nm_produto", "categoria").agg(
        F.sum("QT_VENDIDA").alias("QTD"), F.sum("VALOR_LIQUIDO").alias("TOTAL_RS"),
        F.max("DATA_MOVIMENTACAO").alias("ULTIMA_VEZ"))
    top = agg.top_per_group(items, "nm_cliente",
                            [F.col("TOTAL_RS").desc(), F.col("nm_produto"), F.col("categoria")], n, "RANK")
    return top.withColumn("STATUS", labels.item_activity(F.col("ULTIMA_VEZ"), cur_year))


def category_section_share(base: DataFrame) -> DataFrame:
    """Per customer, positive sales rolled up category -> section (A12) with the share of the customer's total.
    ``nivel`` 0 = customer total, 1 = category, 2 = category x section.

    One scan: the lines (or cells) are summed per (customer, category, section) before the rollup repeats a row."""
    if "VALOR_POSITIVO" in base.columns:                                # cells
        pos = base.where(F.col("VALOR_POSITIVO").isNotNull()).withColumn("VALOR_LIQUIDO", F.col("VALOR_POSITIVO"))
    else:
        pos = base.where(F.col("VALOR_LIQUIDO") > 0)
    roll = agg.rollup_sum(pos, ["categoria", "secao"], "VALOR_LIQUIDO", prefix=["nm_cliente"])
    total = F.max(F.when(F.col("nivel") == 0, F.col("VALOR_LIQUIDO"))).over(Window.partitionBy("nm_cliente"))
    return roll.withColumn("SHARE_PCT", F.try_divide(F.col("VALOR_LIQUIDO").cast("double") * 100, total.cast("double")))


def category_gap_of(base: DataFrame, customers: DataFrame) -> DataFrame:
    """J8/U5 as rows: (nm_cliente, categoria) for every category of the base that a requested customer never bought.

    ``customers`` (nm_cliente) is the request, a list as long as the caller asks for. Each category of the domain is
    repeated for the requested customers and the pairs bought are removed by an anti join; the domain is a table and
    is never gathered in one value."""
    bought = base.select("nm_cliente", "categoria").distinct()
    asked = customers.select(F.array_sort(F.collect_set("nm_cliente"))).scalar()
    wanted = bought.select("categoria").distinct().select("categoria", F.explode(asked).alias("nm_cliente"))
    return anti_join(wanted, bought, ["nm_cliente", "categoria"]).select("nm_cliente", "categoria")


def top_customers(base: DataFrame, n: int) -> DataFrame:
    """The ``n`` customers of largest revenue (ties: lower name)."""
    sums = base.groupBy("nm_cliente").agg(F.sum("VALOR_LIQUIDO").alias("VALOR_LIQUIDO"))
    return agg.top_n(sums, n, [F.col("VALOR_LIQUIDO").desc(), F.col("nm_cliente")])


def _customer_categories(base: DataFrame) -> tuple[DataFrame, Column]:
    """Per customer, the sorted set of categories bought, and the sorted domain of all categories as a scalar subquery,
    for the views that show the missing categories as one text. Both come from the distinct (customer, category) pairs."""
    pairs = base.select("nm_cliente", "categoria").distinct()
    domain = pairs.select(F.array_sort(F.collect_set("categoria"))).scalar()
    per = pairs.groupBy("nm_cliente").agg(F.array_sort(F.collect_list("categoria")).alias("bought"))
    return per, domain


def category_gap(base: DataFrame) -> DataFrame:
    """Per customer: categories bought and, as one text, the ones never bought among all categories of the base (the
    dashboard's card; the text is as long as the domain, so rows on request are ``category_gap_of``)."""
    per, domain = _customer_categories(base)
    gap = F.array_except(domain, F.col("bought"))
    shown = F.filter(F.col("bought"), lambda c: c != labels.NOT_REGISTERED)
    return per.select(
        "nm_cliente",
        F.size("bought").alias("N_CATEGORIAS_CLIENTE"),
        F.size(domain).alias("N_CATEGORIAS_TOTAL"),
        F.array_join(shown, LIST_SEPARATOR).alias("CATEGORIAS_ATUAIS"),
        F.size(gap).alias("N_FALTANTES"),
        F.array_join(gap, LIST_SEPARATOR).alias("CATEGORIAS_FALTANTES"))


def top_product_per_category(base: DataFrame) -> DataFrame:
    """Best-selling product name of each category (ties: lower name)."""
    sums = base.groupBy("categoria", "nm_produto").agg(F.sum("VALOR_LIQUIDO").alias("VALOR_LIQUIDO"))
    return agg.top_per_group(sums, "categoria", [F.col("VALOR_LIQUIDO").desc(), F.col("nm_produto")], 1)


def bait_products(base: DataFrame, n: int = BAIT_SUGGESTIONS) -> DataFrame:
    """Per customer, the first ``n`` missing categories (alphabetical) with
    their best-selling product as entry product.

    Categories are numbered in order. Of a customer who bought k of them, the
    first n missing numbers lie among the first n + k, so a row holds the
    customer's own numbers only, never the whole domain. The numbered best
    products (one row per category) are joined without a hint: a shuffle stage
    that AQE measures and broadcasts only under its size threshold."""
    pairs = base.select("nm_cliente", "categoria").distinct()
    numbered = pairs.select("categoria").distinct().withColumn("_number", F.row_number().over(Window.orderBy("categoria")))
    last = numbered.select(F.max("_number")).scalar()
    per = pairs.join(numbered, "categoria").groupBy("nm_cliente").agg(F.collect_list("_number").alias("_own"))
    first = F.sequence(F.lit(1), F.least(F.size("_own") + n, last))
    gap = F.slice(F.sort_array(F.array_except(first, F.col("_own"))), 1, n)
    rows = per.select("nm_cliente", F.posexplode(gap).alias("pos", "_number"))
    best = top_product_per_category(base).select("categoria", "nm_produto").join(numbered, "categoria")
    return rows.join(best, "_number").select("nm_cliente", (F.col("pos") + 1).alias("ORDEM"), "categoria", "nm_produto")


def mix_erosion(base: DataFrame, prev_year: int, cur_year: int, n: int | None = TOP_EROSION,
                require_both_years: bool = False) -> DataFrame:
    """Customers whose number of distinct categories fell from ``prev_year`` to ``cur_year`` (J12). A customer absent in
    a year counts 0 there (T11); ``require_both_years`` keeps only customers present in both years.

    Two reductions instead of two distinct counts: (customer, category) with a flag per year, then the flags summed
    per customer."""
    def bought(y):
        return F.max((F.col("ANO") == y).cast("int"))

    pairs = base.groupBy("nm_cliente", "categoria").agg(bought(prev_year).alias("antes"), bought(cur_year).alias("agora"))
    per = pairs.groupBy("nm_cliente").agg(F.sum("antes").alias("MIX_ANTERIOR"), F.sum("agora").alias("MIX_ATUAL"))
    if require_both_years:
        per = per.where((F.col("MIX_ANTERIOR") > 0) & (F.col("MIX_ATUAL") > 0))
    out = (per.select(F.col("nm_cliente").alias("CLIENTE"),
                      (F.col("MIX_ANTERIOR") - F.col("MIX_ATUAL")).alias("PERDA_DE_MIX"))
              .where(F.col("PERDA_DE_MIX") > 0))
    if n is None:
        return out
    return agg.top_n(out, n, [F.col("PERDA_DE_MIX").desc(), F.col("CLIENTE")])


def _month_label() -> Column:
    return F.concat(F.lpad(F.col("MES").cast("string"), 2, "0"), F.lit("/"), F.col("ANO").cast("string"))


def _year_month() -> Column:
    return F.col("ANO") * 100 + F.col("MES")


def item_month_matrix(base: DataFrame, years: Sequence[int], customers: Sequence[str] = ()) -> DataFrame:
    """Per customer and product: quantity per ``MM/YYYY`` column (explicit list,
    zero filled, A10), ``OUTROS`` for the months outside ``years`` and the total
    over all months. The cells and the total are conditional sums of one
    aggregation (one shuffle on the row key); each row's month is computed once
    as an integer ``yyyymm`` and compared as such."""
    if customers:
        base = base.where(F.col("nm_cliente").isin(*customers))
    keyed = base.select("nm_cliente", "nm_produto", "QT_VENDIDA", _year_month().alias("_ym"))
    cells = [F.coalesce(F.sum(F.when(F.col("_ym") == y * 100 + m, F.col("QT_VENDIDA"))), F.lit(0)).alias(f"{m:02d}/{y}")
             for y in years for m in range(1, 13)]
    listed = F.coalesce(F.col("_ym").isin(*[y * 100 + m for y in years for m in range(1, 13)]), F.lit(False))
    cells.append(F.coalesce(F.sum(F.when(~listed, F.col("QT_VENDIDA"))), F.lit(0)).alias("OUTROS"))
    return keyed.groupBy("nm_cliente", "nm_produto").agg(*cells, F.sum("QT_VENDIDA").alias("TOTAL"))


def item_months(base: DataFrame, customers: Sequence[str] = ()) -> DataFrame:
    """The item matrix over an open domain: per customer and product a map ``MM/YYYY`` -> quantity with every month that
    occurs, oldest first, and the total. No list of years and no rest column."""
    if customers:
        base = base.where(F.col("nm_cliente").isin(*customers))
    return agg.pivot_map(base, ["nm_cliente", "nm_produto"], _month_label(), _year_month(), "QT_VENDIDA", "MESES", total="TOTAL")


def item_month_columns(base: DataFrame, customers: Sequence[str] = ()) -> DataFrame:
    """The item matrix with one column per month that occurs, oldest first, zero filled, and the total (for files)."""
    if customers:
        base = base.where(F.col("nm_cliente").isin(*customers))
    wide = agg.pivot_found(base, ["nm_cliente", "nm_produto"], _month_label(), _year_month(), "QT_VENDIDA")
    months = [c for c in wide.columns if c not in ("nm_cliente", "nm_produto")]
    total = F.lit(0)
    for c in months:
        total = total + F.col(f"`{c}`")
    return wide.withColumn("TOTAL", total)


def lifecycle_views(tables: Tables, since, prev_year: int, cur_year: int, matrix_years: Sequence[int],
                    reps: Sequence[str] = (), materialize: bool = True) -> dict[str, DataFrame]:
    """All customer-lifecycle views over one sales base (the dashboard's tabs).

    With ``materialize`` the base is stored once, bucketed by customer, in the cluster's shared folder, and its cells
    once as Parquet: the views read the columns they need of those, and the views of single customers need no
    shuffle. A lost executor re-reads the stored tables. ``release`` drops them."""
    base = sales_base(tables, since, reps)
    if materialize:
        base = store_bucketed(base, "sales_base", "nm_cliente")
        cells = store(sales_cells(base), "sales_cells")
    else:
        cells = sales_cells(base)
    return {
        "sales_macro_kpis": sales_macro_kpis(cells, prev_year, cur_year),
        "sales_yoy": sales_yoy(cells),
        "sales_month_year": sales_month_year(cells),
        "top_categories": top_categories(cells),
        "sales_by_origin": sales_by_origin(cells),
        "customer_summary": customer_summary(base, sellers_of(tables)),
        "customer_items": customer_items(cells, cur_year),
        "category_section_share": category_section_share(cells),
        "category_gap": category_gap(cells),
        "bait_products": bait_products(cells),
        "mix_erosion": mix_erosion(cells, prev_year, cur_year),
        "item_month_matrix": item_month_matrix(cells, matrix_years),
        "item_months": item_months(cells),
    }
