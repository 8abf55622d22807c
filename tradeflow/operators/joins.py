"""Join helpers: keyed dedup, semi/anti joins, joins that split hot keys.

No broadcast hints but one: the hot keys of ``hot_keys``, whose number has a proven bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_PARTS = 1000            # a key is hot with more than one row in so many
SALTS = 64


def dedup_on_key(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """U2 keyed / T10: keep one row per key, chosen deterministically: the row
    that sorts first by ``order`` (column names, ascending, NULLs last; default:
    all other columns), so results never depend on file order.

    Written as an aggregation (minimum of a struct that encodes the order), not
    a window: rows are combined map-side before the shuffle, so a key holding a
    large share of the rows (e.g. many NULL ids mapped to 0) never lands whole
    in one task."""
    others = [c for c in df.columns if c != key]
    order = list(order or others)
    rest = [c for c in others if c not in order]
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"_o{i}_null"), F.col(c).alias(f"_o{i}")]
    fields += [F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)]
    first = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_first"))
    names = {c: f"_first._o{i}" for i, c in enumerate(order)}
    names.update({c: f"_first._r{i}" for i, c in enumerate(rest)})
    return first.select(*[F.col(key) if c == key else F.col(names[c]).alias(c) for c in df.columns])


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """NOT EXISTS / set difference as a left-anti join."""
    return left.join(right, on, "left_anti")


def exists_code_or_wildcard(df: DataFrame, key, codes: DataFrame, wildcard, flag_prefix: str = "_rel") -> DataFrame:
    """``EXISTS (SELECT 1 FROM codes WHERE code = COALESCE(key, code) OR code = wildcard)``
    as an equi-join, with no nested-loop join whatever the control table's size.

    A row passes when its key is one of the codes, or the codes contain the
    wildcard, or its key is NULL and there is at least one non-null code. The
    codes are made distinct before a left join (no fan-out); both flags come
    from one scalar subquery over the control table."""
    code_col = codes.columns[0]
    key_col = flag_prefix + "_code"
    distinct = codes.select(F.col(code_col).alias(key_col)).where(F.col(key_col).isNotNull()).distinct()
    flags = codes.select(F.struct(
        (F.count(F.col(code_col)) > 0).alias("any_code"),
        F.coalesce(F.max(F.col(code_col) == F.lit(wildcard)), F.lit(False)).alias("wildcard"))).scalar()
    joined = df.join(distinct, key == F.col(key_col), "left")
    keep = F.col(key_col).isNotNull() | flags.getField("wildcard") | (key.isNull() & flags.getField("any_code"))
    return joined.where(keep).drop(key_col)


def hot_keys(df: DataFrame, key: str, parts: int = HOT_PARTS) -> DataFrame:
    """Keys that hold more than one row in ``parts``; fewer than ``parts`` keys in a table of any size. NULL may be one."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.where(F.col("_n") * parts > total).select(key)


def salted_left_join(left: DataFrame, right: DataFrame, key: str, spread: Column, how: str = "left",
                     hot: DataFrame | None = None, salts: int = SALTS) -> DataFrame:
    """``left`` joined to ``right`` on column ``key`` without a task that holds a whole hot key.

    Left rows of a hot key are dealt to ``salts`` groups by the hash of ``spread``
    (columns that vary inside the key); the right rows of that key are repeated
    once per group. Left rows without a key match nothing and are dealt out
    alike, so the rows of a missing id never meet in one task either. ``hot``
    defaults to ``hot_keys(left, key)``; being fewer than HOT_PARTS rows, it is
    broadcast. Equal to the plain equality join for any content of the keys."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    hot = (hot if hot is not None else hot_keys(left, key)).where(F.col(key).isNotNull()).select(
        F.col(key).alias("_hot_key"), F.lit(True).alias("_hot")).distinct()
    dealt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    left = left.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    left = left.withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), dealt).otherwise(F.lit(0))).drop("_hot_key", "_hot")
    groups = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn("_salt", F.explode(groups)).drop("_hot_key", "_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def left_join_known(left: DataFrame, right: DataFrame, key: str, right_key: str, spread: Column, salts: int = SALTS) -> DataFrame:
    """Left join on ``key = right_key`` whose left rows without a key are spread over ``salts`` groups instead of one.

    They match nothing, so nothing of the right side is repeated."""
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    placed = left.withColumn("_salt", salt)
    named = right.withColumn("_right_salt", F.lit(0))
    on = (F.col(key) == F.col(right_key)) & (F.col("_salt") == F.col("_right_salt"))
    return placed.join(named, on, "left").drop("_salt", "_right_salt")
