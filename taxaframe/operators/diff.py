"""Tolerant table comparison (golden-table diff) on long tables.

Tables are compared as sets of cells ``(key, column, value)``: column order and
row order do not matter; numbers are compared after half-even rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_diff(a: DataFrame, b: DataFrame, key: str = "tax_id", column: str = "sample", value: str = "abundance",
               decimals: int = 2) -> DataFrame:
    """A27 (+U4): cells missing, extra or different after rounding; columns present on one side only.

    Output ``(kind, key, column, a, b)`` with kind in
    'column_only_a', 'column_only_b', 'only_a', 'only_b', 'differs'.
    """
    ca = a.select(column).distinct().withColumn("_a", F.lit(True))
    cb = b.select(column).distinct().withColumn("_b", F.lit(True))
    cols = ca.join(cb, column, "full")
    col_diff = cols.filter(F.col("_a").isNull() | F.col("_b").isNull()).select(
        F.when(F.col("_b").isNull(), "column_only_a").otherwise("column_only_b").alias("kind"),
        F.lit(None).cast("string").alias(key),
        column,
        F.lit(None).cast("double").alias("a"),
        F.lit(None).cast("double").alias("b"),
    )
    shared = cols.filter(F.col("_a") & F.col("_b")).select(column)
    va = a.join(shared, column, "left_semi").select(key, column, F.bround(F.col(value), decimals).alias("a"))
    vb = b.join(shared, column, "left_semi").select(key, column, F.bround(F.col(value), decimals).alias("b"))
    cells = va.join(vb, [key, column], "full")
    kind = (
        F.when(F.col("b").isNull() & F.col("a").isNotNull(), "only_a")
        .when(F.col("a").isNull() & F.col("b").isNotNull(), "only_b")
        .when(~F.col("a").eqNullSafe(F.col("b")), "differs")
    )
    cell_diff = cells.select(kind.alias("kind"), key, column, "a", "b").filter(F.col("kind").isNotNull())
    return col_diff.unionByName(cell_diff)


def compare_sets(diffs: dict[str, DataFrame]) -> DataFrame:
    """Per compared pair, number of differences and pass/fail."""
    parts = None
    for name, d in diffs.items():
        s = d.select(F.lit(name).alias("pair"), F.col("kind"))
        parts = s if parts is None else parts.unionByName(s)
    names = parts.sparkSession.createDataFrame([(n,) for n in diffs], "pair string")
    counts = parts.groupBy("pair").agg(F.count("kind").alias("n_diff"))
    out = names.join(counts, "pair", "left").select("pair", F.coalesce("n_diff", F.lit(0)).cast("bigint").alias("n_diff"))
    return out.withColumn("passed", F.col("n_diff") == 0)
