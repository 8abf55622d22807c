"""Grouping operators of the analysis layer as DataFrame functions.

All of them stay inside Spark's hash aggregation (partial aggregation on the
map side, final after the shuffle); none collects a group or a result.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

SUM_PREFIX = "Soma_de_"
COND_SUM_PREFIX = "Soma_condicional_de_"


def _as_list(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_sum(df: DataFrame, keys, value: str, keep_null_keys: bool = True,
              name: str | None = None) -> DataFrame:
    """A1/A2: sum of ``value`` per key. ``keep_null_keys=False`` drops rows with a
    null key first (pandas' default); an all-null group sums to 0."""
    keys = _as_list(keys)
    if not keep_null_keys:
        df = df.dropna(subset=keys)
    return df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0)).alias(name or SUM_PREFIX + value))


def filter_group_sum(df: DataFrame, filter_col: str, criterion, keys, value: str) -> DataFrame:
    """A3: rows where ``filter_col == criterion``, summed per key (null keys dropped)."""
    return group_sum(df.where(F.col(filter_col) == F.lit(criterion)), keys, value,
                     keep_null_keys=False, name=COND_SUM_PREFIX + value)


def safe_sum(df: DataFrame, column: str) -> Column:
    """A4: aggregate expression summing a column leniently: missing column -> 0,
    text -> number or NULL, empty input -> 0."""
    if column not in df.columns:
        return F.lit(0.0)
    dtype = df.schema[column].dataType
    col = F.col(column)
    if isinstance(dtype, StringType):
        col = col.try_cast("double")
    elif not isinstance(dtype, NumericType):
        col = col.cast("string").try_cast("double")
    return F.coalesce(F.sum(col), F.lit(0))


def conditional_sum(value: Column, condition: Column) -> Column:
    """SUM(CASE WHEN cond THEN value ELSE 0 END)."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def share_of_total(df: DataFrame, value: str, name: str = "share_pct", scale: float = 100.0) -> DataFrame:
    """Each row's share of the column total. The total is a scalar
    subquery (one partial+final aggregate), not an unpartitioned window, so no
    single task ever holds all rows."""
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value).cast("double") * scale, total.cast("double")))


def pivot_sum(df: DataFrame, index, pivot_col: str, values: Sequence, value: str,
              labels: Sequence[str] | None = None, fill=0, rest: str | None = None) -> DataFrame:
    """A10: pivot with an explicit value list (stable schema, no extra job to
    discover the values) and zero fill. ``rest`` names a column for the sum over
    the values that are not listed, NULL among them; without it they are left out."""
    index, values = _as_list(index), list(values)
    if rest is not None:
        df = df.withColumn(pivot_col, F.when(F.col(pivot_col).isin(*values), F.col(pivot_col)).otherwise(F.lit(rest)))
        values.append(rest)
    out = df.groupBy(*index).pivot(pivot_col, list(values)).agg(F.sum(value))
    names = [str(v) for v in values]
    if labels:
        out = out.withColumnsRenamed(dict(zip(names, labels)))
        names = list(labels)
    return out.na.fill(fill, subset=names) if fill is not None else out


def pivot_map(df: DataFrame, index, label: Column, order: Column, value: str, name: str = "celulas",
              total: str | None = None) -> DataFrame:
    """A10 over an open domain: per row key one map label -> sum of ``value``, with exactly the labels that occur
    in that row, in ``order``; no list of values, no rest column, a stable schema. ``total`` adds the row's sum.

    Two reductions: cells (row key, label), combined before the shuffle, then one row per key, which holds no more
    entries than there are labels."""
    index = _as_list(index)
    cells = df.groupBy(*index, order.alias("_order"), label.alias("_label")).agg(F.sum(value).alias("_value"))
    entries = F.array_sort(F.collect_list(F.struct("_order", "_label", "_value")))
    aggs = [F.map_from_entries(F.transform(entries, lambda e: F.struct(e["_label"], e["_value"]))).alias(name)]
    if total:
        aggs.append(F.sum("_value").alias(total))
    return cells.groupBy(*index).agg(*aggs)


def pivot_found(df: DataFrame, index, label: Column, order: Column, value: str, most: int = 2000) -> DataFrame:
    """A10 with a column for every label that occurs, in ``order``, zero filled.

    The labels are read from the data first (one small job; more than ``most`` of them is an error, as a table of so
    many columns is none), then pivoted by name."""
    index = _as_list(index)
    cells = df.groupBy(*index, order.alias("_order"), label.alias("_label")).agg(F.sum(value).alias("_value"))
    found = cells.select("_order", "_label").distinct().orderBy("_order").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} labels to pivot")
    return cells.groupBy(*index).agg(*[F.coalesce(F.sum(F.when(F.col("_order").eqNullSafe(r["_order"]) & F.col("_label").eqNullSafe(r["_label"]),
                                                              F.col("_value"))), F.lit(0)).alias(str(r["_label"])) for r in found])


def distinct_sketches(df: DataFrame, keys, value: str, lg_k: int = 12, name: str = "sketch") -> DataFrame:
    """Per key a mergeable sketch of the distinct values (HyperLogLog of 2^lg_k registers, a few KB) and the row count.

    Stored once, sketches of any keys are united later without reading the rows again."""
    return df.groupBy(*_as_list(keys)).agg(F.hll_sketch_agg(value, lg_k).alias(name), F.count(F.lit(1)).alias("n_rows"))


def distinct_of_sketches(sketches: DataFrame, keys, sketch: str = "sketch", name: str = "n_distinct") -> DataFrame:
    """Estimated distinct values of the union of all sketches of a key (relative error about 1.04 / sqrt(2^lg_k))."""
    return sketches.groupBy(*_as_list(keys)).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(name))


def unpivot(df: DataFrame, ids, value_cols: Sequence[str], var_name: str, value_name: str) -> DataFrame:
    """Wide measures -> (name, value) rows."""
    return df.unpivot(_as_list(ids), list(value_cols), var_name, value_name)


def rollup_sum(df: DataFrame, levels: Sequence[str], value: str, name: str | None = None,
               prefix: Sequence[str] = ()) -> DataFrame:
    """Hierarchical totals (e.g. category -> section) with a level column.

    ``prefix`` columns are fixed grouping keys placed before the hierarchy (for
    example the customer), so totals are computed per prefix value; the grand
    total row over all prefixes is dropped."""
    cols = list(prefix) + list(levels)
    # ROLLUP repeats its input once per level: it runs over one row per finest group
    finest = df.groupBy(*cols).agg(F.sum(value).alias("_sum"))
    out = finest.rollup(*cols).agg(F.sum("_sum").alias(name or value), F.grouping_id().alias("_gid"))
    if prefix:
        # keep only rows where every prefix column is a real grouping value
        max_gid = (1 << len(levels)) - 1
        out = out.where(F.col("_gid") <= max_gid)
    depth = F.lit(len(levels))
    for i in range(len(levels)):
        depth = depth - F.col("_gid").bitwiseAND(1 << i).cast("boolean").cast("int")
    return out.withColumn("nivel", depth).drop("_gid")


def top_n(df: DataFrame, n: int, order: Iterable[Column]) -> DataFrame:
    """O2: top-n with a total order (planned as TakeOrderedAndProject: each task
    keeps n rows, the driver merges n x tasks rows)."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, group, order: Sequence[Column], n: int = 1,
                  rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of each group under a deterministic order."""
    w = Window.partitionBy(*_as_list(group)).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def date_long_key(day: Column, number: Column) -> Column:
    """Exact order-preserving single key for (date, long): ``(days + 10^6) *
    10^20 + (number + 2^63)`` as decimal(38,0). Unlike a struct key it fits a
    mutable aggregation buffer, so ``max_by`` over it stays a HashAggregate."""
    big = lambda v: F.lit(str(v)).cast("decimal(38,0)")   # noqa: E731 (beyond the long range)
    days = F.unix_date(day).cast("decimal(38,0)") + big(10 ** 6)
    shifted = number.cast("decimal(38,0)") + big(2 ** 63)
    return (days * big(10 ** 20) + shifted).cast("decimal(38,0)")


def all_rows(condition: Column) -> Column:
    """TRUE when the condition holds on every row."""
    return F.every(condition)


def report_order(spec: Sequence[tuple[str, str]], nulls: str = "oracle") -> list[Column]:
    """Sort keys with the null placement of the engine that defined the
    report. ``oracle``: ASC puts NULLs last, DESC first; ``pandas``: NULLs
    always last. ``spec`` is a list of (column, "asc" | "desc")."""
    out = []
    for name, direction in spec:
        c = F.col(name)
        if direction == "asc":
            out.append(c.asc_nulls_last())
        elif nulls == "oracle":
            out.append(c.desc_nulls_first())
        else:
            out.append(c.desc_nulls_last())
    return out


def sorted_report(df: DataFrame, spec: Sequence[tuple[str, str]], nulls: str = "oracle") -> DataFrame:
    """O1: a report in its defined row order (a range-partitioned global sort;
    use for final, aggregated outputs and file sinks)."""
    return df.orderBy(*report_order(spec, nulls))
