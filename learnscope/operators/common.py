"""Small shared helpers: one-row attach, null-safe group join, column rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global (ungrouped) aggregate, which has exactly
    one row by construction, to every row (broadcast of one row)."""
    return df.crossJoin(F.broadcast(one_row))


def join_groups(left: DataFrame, right: DataFrame, groups: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group columns where null is a group like any other; without
    group columns ``right`` has one row."""
    if not groups:
        return attach_one_row(left, right)
    keys = {g: f"__g{i}" for i, g in enumerate(groups)}
    r = right.select(*[F.col(g).alias(k) for g, k in keys.items()], *[c for c in right.columns if c not in keys])
    cond = [F.col(g).eqNullSafe(F.col(k)) for g, k in keys.items()]
    return left.join(r, on=cond, how=how).drop(*keys.values())


def round_half_away(c, digits: int = 6):
    """Round like C's ``round(x * 10^d) / 10^d`` in binary floating point (the
    SQL oracle's rounding), not Spark's decimal-string HALF_UP: the two differ
    on values whose shortest decimal form ends in 5 at the cut. ``a - floor(a)``
    is exact for doubles, so the half test is exact."""
    m = float(10 ** digits)
    v = c * F.lit(m)
    a = F.abs(v)
    r = F.floor(a).cast("double")
    rounded = F.when(a - r >= 0.5, r + 1.0).otherwise(r) * F.signum(v)
    big = a >= F.lit(4.5e15)  # already integral
    res = F.when(big, v).otherwise(rounded) / F.lit(m)
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c).otherwise(res)


def round_floats(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float/double column (for engine-independent comparison)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_half_away(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def required_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SRC6: raise with the full list of the table's missing columns; returns
    ``df`` unchanged. (Raw CSV files are checked one by one in ``sources.io``.)"""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def is_finite(c) -> "F.Column":
    col = F.col(c) if isinstance(c, str) else c
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) != F.lit(float("inf")))
