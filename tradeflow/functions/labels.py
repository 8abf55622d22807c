"""Business labels as built-in column expressions (no Python UDFs).

Every function returns a ``Column``; the label texts below are fixed values
that the reports must reproduce exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Label texts and codes the reports must reproduce exactly.
# ---------------------------------------------------------------------------
CLASS_SPELLINGS = {
    # spelling name: (pharma, health & beauty, other)
    "upper": ("FARMA", "HB", "OUTROS"),
    "title": ("Farma", "HB", "Outros"),
    "mixed": ("FARMA", "HB", "Outros"),
}
ORIGIN_ELECTRONIC = "PEDIDO ELETRÔNICO"
ORIGIN_LOGISTICS = "OPERADOR LOGÍSTICO"
ORIGIN_SALES_FORCE = "FORÇA DE VENDAS"
ORIGIN_TELEMARKETING = "TELEMARKETING"
ORIGIN_ECOMMERCE = "E-COMMERCE"
ORIGIN_OTHER = "OUTROS"
ORDER_STATUS = {
    "P": "aguardado liberação",
    "B": "pedido bloqueado",
    "L": "pedido liberado",
    "F": "pedido faturado",
    "C": "pedido cancelado",
    "R": "pedido em separacao",
    "D": "pedido duplicado",
    "M": "pedido em montagem",
}
ORDER_STATUS_OTHER = "outros"
FUND_ACTIVE, FUND_CANCELLED = "ATIVA", "CANCELADA"
DUE_OVERDUE, DUE_SETTLED, DUE_OPEN, DUE_PAID = "VENCIDA", "LIQUIDADA", "A VENCER", "QUITADA"
PAY_PAID, PAY_PENDING = "QUITADA", "PENDENTE"
YES_PT, NO_PT = "Sim", "Não"
REVERSAL_NO, REVERSAL_YES = "N", "S"
UNDEFINED_NAME = "NÃO DEFINIDO"
UNCLASSIFIED_UPPER = "NÃO CLASSIFICADO"
UNCLASSIFIED_TITLE = "Não Classificado"
NOT_REGISTERED = "NAO CADASTRADO"
NOT_INFORMED = "N/I"
ACTIVE_ITEM, CHURN_ITEM = "ATIVO", "CHURN"


def supplier_class(code: Column, spelling: str = "upper") -> Column:
    """P5: supplier class code F/H/anything -> label, in one of three spellings."""
    pharma, beauty, other = CLASS_SPELLINGS[spelling]
    return (F.when(code == "F", F.lit(pharma))
            .when(code == "H", F.lit(beauty))
            .otherwise(F.lit(other)))


def origin_rep_report(tipofv: Column, origemped: Column) -> Column:
    """P6 variant used by the rep revenue report: unmatched -> OUTROS."""
    return (F.when((tipofv == "PE") & (origemped == "F"), F.lit(ORIGIN_ELECTRONIC))
            .when((tipofv == "OL") & (origemped == "F"), F.lit(ORIGIN_LOGISTICS))
            .when(tipofv.isNull() & (origemped == "F"), F.lit(ORIGIN_SALES_FORCE))
            .when(origemped == "T", F.lit(ORIGIN_TELEMARKETING))
            .when(origemped == "W", F.lit(ORIGIN_ECOMMERCE))
            .otherwise(F.lit(ORIGIN_OTHER)))


def origin_sales_fact(tipofv: Column, origemped: Column) -> Column:
    """P6 variant of the sales fact: anything unmatched is the sales force."""
    return _origin(tipofv, origemped, F.lit(ORIGIN_SALES_FORCE))


def _origin(tipofv: Column, origemped: Column, other: Column) -> Column:
    """Rules that the two facts share: channels T and W by themselves, channel F by its order type."""
    by_type = F.when(tipofv == "PE", ORIGIN_ELECTRONIC).when(tipofv == "OL", ORIGIN_LOGISTICS)
    channel = F.when(origemped == "T", ORIGIN_TELEMARKETING).when(origemped == "W", ORIGIN_ECOMMERCE).when(origemped == "F", by_type)
    return F.coalesce(channel, other)


def origin_order_fact(tipofv: Column, origemped: Column) -> Column:
    """P6 variant of the order fact: origin F -> sales force, unmatched -> OUTROS."""
    return _origin(tipofv, origemped, F.when(origemped == "F", ORIGIN_SALES_FORCE).otherwise(ORIGIN_OTHER))


def order_status(code: Column) -> Column:
    """Order position code -> status text."""
    expr = None
    for key, text in ORDER_STATUS.items():
        expr = (F.when(code == key, F.lit(text)) if expr is None
                else expr.when(code == key, F.lit(text)))
    return expr.otherwise(F.lit(ORDER_STATUS_OTHER))


def flag_when_null(col: Column, if_null: str, if_not_null: str) -> Column:
    """Two-valued flag from nullness (ATIVA/CANCELADA, N/S, Sim/Não...)."""
    return F.when(col.isNull(), F.lit(if_null)).otherwise(F.lit(if_not_null))


def overdue_days(as_of, due: Column) -> Column:
    """Days past due, 0 when not overdue or the due date is null."""
    diff = F.datediff(F.lit(as_of), due)
    return F.when(diff > 0, diff).otherwise(F.lit(0))


def fund_due_status(as_of, due: Column, balance: Column) -> Column:
    """Overdue with a positive balance -> VENCIDA; zero balance ->
    LIQUIDADA; everything else (including a null due date) -> A VENCER."""
    diff = F.datediff(F.lit(as_of), due)
    return (F.when((diff > 0) & (balance > 0), F.lit(DUE_OVERDUE))
            .when(balance == 0, F.lit(DUE_SETTLED))
            .otherwise(F.lit(DUE_OPEN)))


def returns_due_status(as_of, due: Column, paid_on: Column) -> Column:
    """P10: paid -> QUITADA; else overdue -> VENCIDA; else A VENCER."""
    diff = F.datediff(F.lit(as_of), due)
    return (F.when(paid_on.isNotNull(), F.lit(DUE_PAID))
            .when(diff > 0, F.lit(DUE_OVERDUE))
            .otherwise(F.lit(DUE_OPEN)))


def item_activity(last_purchase: Column, current_year: int) -> Column:
    """ATIVO when the last purchase falls in the current year, else CHURN."""
    return F.when(F.year(last_purchase) == current_year, F.lit(ACTIVE_ITEM)).otherwise(F.lit(CHURN_ITEM))
