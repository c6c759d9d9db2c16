"""Ranking, top-N with 'Other', display labels, stacking and plot-ready data sets.

All operate on the long table ``(sample, tax_id, abundance)``; the wide form is
never materialised except where the output *is* a matrix (heat map, distances).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaframe.functions.lineage import deepest_label, finite_or_zero, has_pipe
from taxaframe.operators.pairs import TILE, pair_sums
from taxaframe.session import stored

OTHER = "Other"


def n_distinct(df: DataFrame, col: str):
    """Number of distinct values as a scalar subquery (planned once, never collected)."""
    return df.select(F.count_distinct(col)).scalar()


def mean_abundance(long: DataFrame, key: str = "tax_id", n_samples=None) -> DataFrame:
    """Arithmetic mean over all samples, absent = 0 (so sum / n, not avg)."""
    n = n_samples if n_samples is not None else n_distinct(long, "sample")
    return long.groupBy(key).agg((F.sum("abundance") / n).alias("mean_abundance"))


def top_n(long: DataFrame, n: int = 10, key: str = "tax_id") -> DataFrame:
    """The n taxa of highest mean abundance, ties by key ascending; columns (key, rank).

    A ``TakeOrderedAndProject``: each task keeps its n best, so the result is
    bounded by n and is safe to broadcast.
    """
    means = mean_abundance(long, key)
    best = means.orderBy(F.desc("mean_abundance"), F.asc(key)).limit(n)
    return best.select(key, F.row_number().over(Window.orderBy(F.desc("mean_abundance"), F.asc(key))).alias("rank"))


def top_n_other(long: DataFrame, n: int = 10) -> DataFrame:
    """Top-n taxa per sample plus one 'Other' row summing the rest.

    Output ``(sample, taxon, rank, abundance)``; 'Other' has rank n+1 and appears
    for a sample only when that sample has rest rows.
    """
    best = F.broadcast(top_n(long, n))  # at most n rows
    tagged = long.join(best, "tax_id", "left").select(
        "sample",
        F.coalesce(F.when(F.col("rank").isNotNull(), F.col("tax_id")), F.lit(OTHER)).alias("taxon"),
        F.coalesce(F.col("rank"), F.lit(n + 1)).alias("rank"),
        "abundance",
    )
    return tagged.groupBy("sample", "taxon", "rank").agg(F.sum("abundance").alias("abundance"))


def stack_offsets(bars: DataFrame, order: str = "rank", group: str = "sample") -> DataFrame:
    """Per sample, running sum of the segments below each segment ('bottom').

    The window is over one sample's segments, which top-N bounds to n+1 rows.
    """
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return bars.withColumn("bottom", F.coalesce(F.sum("abundance").over(w), F.lit(0.0)))


def bar_data(long: DataFrame, n: int = 10) -> DataFrame:
    """G1: bar-chart rows (sample, taxon, rank, abundance, bottom), 'Other' stacked last."""
    return stack_offsets(top_n_other(long, n))


def numbered_within(df: DataFrame, label: str, order: list[str]) -> DataFrame:
    """``df`` with ``_n``: the row's number from 1 among the rows of its label, by ``order``.

    Rows are range-partitioned by (label, order), so a label that a third of all rows share lies in several
    tasks. Each task numbers its own rows; the counts per (task, label) give the offset of a label's
    later tasks. The partitioned rows are stored, as their numbers count on the ranges' borders.
    """
    dealt = df.repartitionByRange(label, *order).sortWithinPartitions(label, *order)
    # the place of a row: its partition in the upper bits, its row there in the lower 33
    rows = stored(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "ranges")
    parts = rows.groupBy(F.col(label).alias("_label"), F.col("_part").alias("_p")).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_label").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    joined = rows.join(parts, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn("_n", F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_at", "_part", "_label", "_p", "_rows", "_first", "_before")


def labels(taxa: DataFrame, key: str = "tax_id", ordinal: str | None = None) -> DataFrame:
    """W3 + F6: display label per taxon; '_1', '_2'… on every row when any lineage has a pipe.

    The suffix counts rows of the same base label in input order (``ordinal``) or,
    without one, by ``key``.
    """
    base = taxa.withColumn("label", deepest_label(key))
    if not taxa.select(F.coalesce(F.bool_or(has_pipe(key)), F.lit(False))).first()[0]:
        return base
    order = [ordinal, key] if ordinal else [key]
    return numbered_within(base, "label", order).withColumn("label", F.concat_ws("_", "label", F.col("_n").cast("string"))).drop("_n")


def sample_order(samples: DataFrame, reference: str = "Reference") -> DataFrame:
    """W5: 'Reference' first, other samples by name; (sample, sample_rank)."""
    w = Window.orderBy((F.col("sample") != reference), F.col("sample"))
    return samples.select("sample").distinct().withColumn("sample_rank", F.row_number().over(w))


def check_listed(long: DataFrame, samples: list[str]) -> None:
    """Raises if ``long`` holds a sample that the listed columns lack."""
    unlisted = long.filter(F.col("sample").isNull() | ~F.col("sample").isin(samples)).select("sample").first()
    if unlisted:
        raise ValueError(f"sample {unlisted[0]!r} is not among the listed columns")


def heat_matrix(long: DataFrame, samples: list[str]) -> DataFrame:
    """Taxa x samples matrix with F9 cleaning and display labels; key stays tax_id.

    The columns are the listed samples; a sample outside the list is an error.
    """
    check_listed(long, samples)
    clean = long.withColumn("abundance", finite_or_zero("abundance"))
    wide = clean.groupBy("tax_id").pivot("sample", samples).agg(F.sum("abundance")).na.fill(0.0, subset=samples)
    lab = labels(clean.select("tax_id").distinct())
    return wide.join(lab, "tax_id", "left").select("tax_id", "label", *samples)


def cluster_flags(long: DataFrame) -> DataFrame:
    """Clustering eligibility of rows (taxa) and columns (samples) of the zero-filled matrix.

    A row is constant when every present value equals the others and, if some
    samples are absent (zeros), every present value is 0; likewise for columns.
    No grid is built: counts, min and max per taxon/sample decide.
    """
    clean = long.withColumn("v", finite_or_zero("abundance"))
    n_s = n_distinct(clean, "sample")
    n_t = n_distinct(clean, "tax_id")

    def non_constant(key: str, n_other):
        per = clean.groupBy(key).agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        const = ((F.col("c") == n_other) & (F.col("lo") == F.col("hi"))) | (
            (F.col("c") < n_other) & (F.col("lo") == 0) & (F.col("hi") == 0)
        )
        return per.select(F.coalesce(F.bool_or(~const), F.lit(False)).alias("x")).scalar()

    return long.sparkSession.range(1).select(
        n_t.cast("bigint").alias("n_taxa"),
        n_s.cast("bigint").alias("n_samples"),
        ((n_t > 1) & non_constant("tax_id", n_s)).alias("row_cluster"),
        ((n_s > 1) & non_constant("sample", n_t)).alias("col_cluster"),
    )


def sample_distance(long: DataFrame, tile: int = TILE) -> DataFrame:
    """Euclidean distance between sample vectors (input of column clustering), absent = 0.

    Squared differences are added up over tiles of samples (``pairs.py``), so near-equal
    samples lose no digits. Output (sample_a, sample_b, distance), a < b by name.
    """
    cells = long.groupBy("tax_id", "sample").agg(F.sum("abundance").alias("v"))

    def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.repeat((x**2).sum(0)[:, None], y.shape[1], 1)  # right where y is all 0
        for j in np.flatnonzero(y.any(0)):
            out[:, j] = ((x - y[:, j, None]) ** 2).sum(0)
        return out

    total = pair_sums(cells, ["tax_id"], [], "v", {"squares": squares}, fill=0, absent=True, tile=tile)
    return total.select("sample_a", "sample_b", F.sqrt("squares").alias("distance"))
