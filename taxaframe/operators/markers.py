"""Marker-based profiling on an alignment table: filters, per-marker counts, clade
presence, robust clade averages, relative abundance, marker tables, all-rank roll-up.

Alignments (T13): sample, read_id, marker_id, mapq, read_len, aln_len, pos, bases.
Catalogue (T14): marker_id, clade, lineage, len. Windows are per (sample, clade),
bounded by the clade's marker count; everything else is aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaframe.functions.lineage import kingdom_of, lineage_prefixes
from taxaframe.functions.util import safe_div
from taxaframe.operators.profiles import relative_abundance

STATS = ["avg_g", "avg_l", "tavg_g", "tavg_l", "wavg_g", "wavg_l", "med"]


def exclude_kingdoms(long: DataFrame, kingdoms: list[str]) -> DataFrame:
    """Drop lineages whose first rank is one of ``kingdoms`` and re-close each sample."""
    kept = long.filter(~kingdom_of("tax_id").isin(kingdoms))
    return relative_abundance(kept)


def filter_alignments(aln: DataFrame, min_mapq: int = 5, min_read_len: int = 70, min_aln_len: int | None = None) -> DataFrame:
    """Keep alignments with mapq >= 5 and read length >= 70 (and aln_len >= n if given).
    Plain column predicates: pushed into the Parquet scan."""
    cond = (F.col("mapq") >= min_mapq) & (F.col("read_len") >= min_read_len)
    if min_aln_len is not None:
        cond = cond & (F.col("aln_len") >= min_aln_len)
    return aln.filter(cond)


def ignore_markers(aln: DataFrame, ignored: DataFrame) -> DataFrame:
    """Drop alignments to markers on a user list (anti join; AQE broadcasts a short list)."""
    return aln.join(ignored.select("marker_id").distinct(), "marker_id", "left_anti")


def clade_markers(markers: DataFrame, clade: str, aln: DataFrame | None = None) -> DataFrame:
    """Catalogue rows of one clade, optionally only those with an alignment."""
    rows = markers.filter(F.col("clade") == clade)
    if aln is not None:
        rows = rows.join(aln.select("marker_id").distinct(), "marker_id", "left_semi")
    return rows


def marker_counts(aln: DataFrame, markers: DataFrame) -> DataFrame:
    """Distinct reads per (sample, marker); markers of a clade seen in the sample
    (>= 1 read on any of its markers) get explicit zeros. Output
    (sample, clade, marker_id, len, n)."""
    hits = aln.groupBy("sample", "marker_id").agg(F.count_distinct("read_id").alias("n"))
    cat = markers.select("marker_id", "clade", "len")
    seen = hits.join(cat, "marker_id").select("sample", "clade").distinct()
    grid = seen.join(cat, "clade")
    return grid.join(hits, ["sample", "marker_id"], "left").select(
        "sample", "clade", "marker_id", "len", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def clade_presence(counts: DataFrame, perc_nonzero: float = 0.33) -> DataFrame:
    """Share of a clade's markers with >= 1 read; present when >= ``perc_nonzero``."""
    agg = counts.groupBy("sample", "clade").agg(F.avg(F.when(F.col("n") > 0, 1.0).otherwise(0.0)).alias("nonzero"))
    return agg.withColumn("present", F.col("nonzero") >= perc_nonzero)


def clade_stats(counts: DataFrame, q: float = 0.2) -> DataFrame:
    """Robust clade averages over markers sorted by (n/len, marker_id).

    m markers, cut = floor(q*m) at both ends. avg_g = sum n / sum len, avg_l = mean(n/len);
    t* = the same over the kept middle; w* = cut markers take the nearest kept marker's
    values (winsorised); med = median(n/len) (linear interpolation).
    """
    v = F.col("n") / F.col("len")
    keys = ["sample", "clade"]
    w = Window.partitionBy(*keys).orderBy(v, F.col("marker_id"))
    wall = Window.partitionBy(*keys)
    r = counts.withColumn("v", v).withColumn("rk", F.row_number().over(w)).withColumn("m", F.count("*").over(wall))
    r = r.withColumn("cut", F.floor(F.col("m") * q).cast("int"))
    r = r.withColumn("lo", F.col("cut") + 1).withColumn("hi", F.col("m") - F.col("cut"))
    kept = (F.col("rk") >= F.col("lo")) & (F.col("rk") <= F.col("hi"))
    # the kept marker nearest to each cut marker: first / last of the kept range
    first_kept = F.first(F.when(F.col("rk") == F.col("lo"), F.struct("n", "len", "v")), ignorenulls=True).over(wall)
    last_kept = F.first(F.when(F.col("rk") == F.col("hi"), F.struct("n", "len", "v")), ignorenulls=True).over(wall)
    r = r.withColumn("_fk", first_kept).withColumn("_lk", last_kept)
    wn = F.when(F.col("rk") < F.col("lo"), F.col("_fk.n")).when(F.col("rk") > F.col("hi"), F.col("_lk.n")).otherwise(F.col("n"))
    wl = F.when(F.col("rk") < F.col("lo"), F.col("_fk.len")).when(F.col("rk") > F.col("hi"), F.col("_lk.len")).otherwise(F.col("len"))
    wv = F.when(F.col("rk") < F.col("lo"), F.col("_fk.v")).when(F.col("rk") > F.col("hi"), F.col("_lk.v")).otherwise(F.col("v"))
    return r.groupBy(*keys).agg(
        F.first("m").alias("markers"),
        safe_div(F.sum("n"), F.sum("len")).alias("avg_g"),
        F.avg("v").alias("avg_l"),
        safe_div(F.sum(F.when(kept, F.col("n"))), F.sum(F.when(kept, F.col("len")))).alias("tavg_g"),
        F.coalesce(F.avg(F.when(kept, F.col("v"))), F.lit(0.0)).alias("tavg_l"),
        safe_div(F.sum(wn), F.sum(wl)).alias("wavg_g"),
        F.avg(wv).alias("wavg_l"),
        F.percentile(F.col("v"), 0.5).alias("med"),
    )


def rel_ab(stats: DataFrame, presence: DataFrame, stat: str = "tavg_g") -> DataFrame:
    """The chosen clade statistic of present clades, closed to 100 per sample."""
    p = stats.join(presence.filter("present").select("sample", "clade"), ["sample", "clade"], "left_semi")
    long = p.select("sample", F.col("clade").alias("tax_id"), F.col(stat).alias("abundance"))
    return relative_abundance(long, scale=100.0).select("sample", F.col("tax_id").alias("clade"), F.col("abundance").alias("rel_ab"))


def rel_ab_w_read_stats(aln: DataFrame, counts: DataFrame, stats: DataFrame, presence: DataFrame,
                        total_reads: DataFrame, stat: str = "tavg_g") -> DataFrame:
    """A20 plus coverage (the statistic) and estimated reads (distinct reads on the
    clade's markers), scaled by the mapped share, and an UNCLASSIFIED row of unmapped reads.
    ``total_reads`` is (sample, reads)."""
    ra = rel_ab(stats, presence, stat)
    cm = counts.select("marker_id", "clade").distinct()
    est = aln.join(cm, "marker_id").groupBy("sample", "clade").agg(F.count_distinct("read_id").alias("est_reads"))
    mapped = aln.groupBy("sample").agg(F.count_distinct("read_id").alias("mapped"))
    frac = total_reads.join(mapped, "sample", "left").select(
        "sample", "reads", F.coalesce("mapped", F.lit(0)).alias("mapped")
    ).withColumn("unmapped", F.greatest(F.col("reads") - F.col("mapped"), F.lit(0)))
    body = ra.join(stats.select("sample", "clade", F.col(stat).alias("coverage")), ["sample", "clade"]) \
        .join(est, ["sample", "clade"], "left").join(frac, "sample") \
        .select("sample", "clade", (F.col("rel_ab") * F.col("mapped") / F.col("reads")).alias("rel_ab"), "coverage",
                F.coalesce("est_reads", F.lit(0)).cast("bigint").alias("est_reads"))
    unc = frac.filter(F.col("unmapped") > 0).select(
        "sample", F.lit("UNCLASSIFIED").alias("clade"), (F.col("unmapped") * 100.0 / F.col("reads")).alias("rel_ab"),
        F.lit(None).cast("double").alias("coverage"), F.col("unmapped").cast("bigint").alias("est_reads"),
    )
    return body.unionByName(unc)


def marker_ab(counts: DataFrame) -> DataFrame:
    """N / len per (sample, marker)."""
    return counts.select("sample", "marker_id", (F.col("n") / F.col("len")).alias("abundance"))


def marker_pres(counts: DataFrame, threshold: int = 1) -> DataFrame:
    """1 when the marker has at least ``threshold`` reads, else 0."""
    return counts.select("sample", "marker_id", F.when(F.col("n") >= threshold, 1).otherwise(0).alias("present"))


def clade_profiles(counts: DataFrame) -> DataFrame:
    """Per (sample, clade) the marker list 'marker:n,...' ordered by marker id
    (bounded by the clade's marker count)."""
    items = F.array_sort(F.collect_list(F.struct("marker_id", "n")))
    txt = F.transform(items, lambda e: F.concat(e["marker_id"].cast("string"), F.lit(":"), e["n"].cast("string")))
    return counts.groupBy("sample", "clade").agg(F.array_join(txt, ",").alias("profile"))


def lineage_rollup(long: DataFrame, level: str = "a") -> DataFrame:
    """Every rank's abundance as the sum of the lineages below it ('a' = all ranks,
    else the one-letter rank). Output (sample, tax_id, rank, abundance)."""
    ex = long.select("sample", "abundance", F.explode(lineage_prefixes("tax_id")).alias("tax_id"))
    ex = ex.withColumn("rank", F.substring(F.substring_index("tax_id", ";", -1), 1, 1))
    if level != "a":
        ex = ex.filter(F.col("rank") == level)
    return ex.groupBy("sample", "tax_id", "rank").agg(F.sum("abundance").alias("abundance"))
