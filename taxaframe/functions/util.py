"""Small column helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den, 0 when den is 0 or null (ANSI mode raises on 0/0)."""
    return F.coalesce(F.try_divide(as_col(num), as_col(den)), F.lit(0.0))


def round_doubles(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every floating column (sums differ in the last bits between engines).

    Rounds the binary product ``x * 10^d`` half away from zero, then divides: the
    same double arithmetic as SQL engines that round doubles natively, so exact
    decimal ties (e.g. 0.0080078125) land on the same side in both.
    """
    scale = float(10 ** digits)
    return df.select(
        *[
            (F.round(F.col(f.name) * scale) / scale).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
