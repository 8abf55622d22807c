"""Excess-stock rules on hand-made ERP rows (cases the mapped data cannot reach)."""

import datetime as dt
from decimal import Decimal

import pytest

from tradeflow.plans import stock

D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    # products: 1 zero-stock all window, 2 null cost, 3 new, 4 no sales, 5 zero coverage (current report)
    prodrows = [(p, f"P{p}", 1, 1, "S1", "C1", "N", None) for p in (1, 2, 3, 4, 5)]
    prodrows += [(6, "P6", 1, 2, "S1", "C1", "N", None),      # department ' imobilizado ' (excluded, T16)
                 (7, "P7", 1, 9, "S1", "C1", "N", None)]      # no department row (NULL, dropped)
    t = {
        "pcprodut": df(prodrows, "codprod long, descricao string, codfornec long, codepto long, codsec string, "
                                 "codcategoria string, estoqueporlote string, dtexclusao date"),
        "pcfornec": df([(1, "SUP", "F", 1, 1, "S")], "codfornec long, fornecedor string, classificacao string, "
                                                      "codcomprador int, codcli long, revenda string"),
        "pcdepto": df([(1, "HIGIENE"), (2, " imobilizado ")], "codepto long, descricao string"),
        "pcsecao": df([("S1", 1, "SEC")], "codsec string, codepto long, descricao string"),
        "pccategoria": df([("C1", "S1", "CAT")], "codcategoria string, codsec string, categoria string"),
        "pcempr": df([(1, "BUYER", 1)], "matricula int, nome string, codusur int"),
    }
    hist = []
    ref = D(2000, 1, 1)
    for p, cost in ((1, Decimal("2.00")), (2, None), (3, Decimal("5.00")), (4, Decimal("3.00")),
                    (6, Decimal("1.00")), (7, Decimal("1.00"))):
        hist.append((1, p, ref, 100, cost))                       # position on the 1st
        for k in range(1, 91):                                    # 90 days before
            q = 0 if p == 1 else 10
            hist.append((1, p, ref - dt.timedelta(days=k), q, cost))
    t["pchistest"] = df(hist, "codfilial int, codprod long, data date, qtestger int, custorep decimal(18,2)")
    mov = [(1, p, D(1999, 12, 1), Decimal("9.00"), "S", None) for p in (1, 2, 3, 5)]
    t["pcmov"] = df(mov, "codfilial int, codprod long, dtmov date, qt decimal(18,2), codoper string, dtcancel date")
    est = [(1, 1, 50, 1, Decimal("2.00"), Decimal("2.00"), D(1998, 1, 1)),
           (1, 2, 50, 1, None, Decimal("2.00"), D(1998, 1, 1)),
           (1, 3, 50, 1, Decimal("5.00"), Decimal("5.00"), D(1999, 11, 1)),
           (1, 4, 50, 1, Decimal("3.00"), Decimal("3.00"), D(1998, 1, 1)),
           (1, 5, 50, 0, Decimal("3.00"), Decimal("3.00"), D(1998, 1, 1))]
    t["pcest"] = df(est, "codfilial int, codprod long, qtestger int, qtgirodia int, custoultent decimal(18,2), "
                         "valorultent decimal(18,2), dtprimcompra date")
    return t


def test_monthly_rules(tables):
    rows = {r.codprod: r for r in stock.excess_stock_monthly(tables, 2000).where("mes = 1").collect()}
    zero = rows[1]                       # 90 zero days: daily sales 0, excess NULL (Oracle GREATEST)
    assert zero.qtd_dias_zerados == 90 and zero.vmd_corrigida == Decimal("0") and zero.valor_excedente is None
    assert rows[2].valor_excedente is None                       # null cost
    assert rows[3].valor_excedente == Decimal("0") and rows[3].is_produto_novo == "Sim"
    assert rows[4].valor_excedente == Decimal("300.00")          # no sales: full value 100 x 3.00
    assert 6 not in rows and 7 not in rows                       # excluded / unknown department (T16)


def test_current_rules(tables):
    rows = {r.codprod: r for r in stock.excess_stock(tables, D(2000, 1, 1)).collect()}
    assert rows[4].cobertura_estoque_ajustada == 9999 and rows[4].valor_excedente == 0      # no sales
    assert rows[5].cobertura_estoque_original == 0 and rows[5].valor_excedente == 0        # zero coverage
    assert rows[3].is_produto_novo == "Sim" and rows[3].valor_excedente == 0
    # coverage 50/1 = 50 < 90 days for Farma -> negative excess floors at 0
    assert rows[1].valor_excedente == 0
