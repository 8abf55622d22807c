"""Helpers shared by the report plans."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions.numeric import nvl0

Tables = Mapping[str, DataFrame]


def rep_line_revenue(m) -> Column:
    """Per-line revenue of the rep and telesales reports, rounded to
    cents before it is summed. The source subtracts IPI and ST and adds them
    again, so neither occurs here; a missing quantity counts as 0."""
    added = nvl0(m.vlfrete_rateio) + nvl0(m.vloutros) + nvl0(m.vloutrasdesp)
    return F.round(nvl0(m.qt) * (nvl0(m.punit) + added - nvl0(m.vlrepasse)), 2)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Result boundary: every decimal column leaves as a double (all arithmetic
    before this point is exact decimal)."""
    from pyspark.sql.types import DecimalType

    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.withColumns(casts) if casts else df


def money_out(col: Column) -> Column:
    """Exact decimal arithmetic inside the plan; a double in the result."""
    return col.cast("double")
