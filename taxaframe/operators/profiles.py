"""Profile standardisation: filters, unclassified rows, closure, multi-sample merge.

Canonical table is long: ``(sample, tax_id, abundance)``. A column per sample
exists only at the sink (``taxaframe.sources.sinks.pivot_wide``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaframe.functions.lineage import (
    LEVEL_CODES,
    UNCLASSIFIED_LINEAGE,
    bracken_taxid,
    domain_to_kingdom,
    lineage_sep,
    unknown_species,
)
from taxaframe.functions.util import safe_div


# -- filters -----------------------------------------------------------------------------

def species_rows(df: DataFrame, col: str = "clade_name") -> DataFrame:
    """Lineage contains 's__' or 'clade' and does not contain 't__'."""
    c = F.col(col)
    return df.filter(c.rlike("s__|clade") & ~c.contains("t__"))


def level_rows(df: DataFrame, level: str, col: str = "taxonomy_lvl") -> DataFrame:
    """Keep one Bracken level ('species' -> 'S', ...)."""
    if level not in LEVEL_CODES:
        raise ValueError(f"level {level!r} not supported; choose from {sorted(LEVEL_CODES)}")
    return df.filter(F.col(col) == LEVEL_CODES[level])


def mark_unassigned(df: DataFrame, motu: str = "motu", taxonomy: str = "taxonomy") -> DataFrame:
    """Rows whose mOTU name contains 'unassigned' (any case) get the Unclassified lineage."""
    hit = F.coalesce(F.lower(F.col(motu)).contains("unassigned"), F.lit(False))
    return df.withColumn(taxonomy, F.when(hit, F.lit(UNCLASSIFIED_LINEAGE)).otherwise(F.col(taxonomy)))


# -- closure and merge -------------------------------------------------------------------

def sample_totals(long: DataFrame, value: str = "abundance", key: str = "sample") -> DataFrame:
    """One row per sample: partial aggregation before the shuffle, tiny result."""
    return long.groupBy(key).agg(F.sum(value).alias("_total"))


def relative_abundance(long: DataFrame, value: str = "abundance", key: str = "sample", scale: float = 1.0) -> DataFrame:
    """A1: value / sum of its sample (0 when the sample sums to 0).

    The per-sample totals are aggregated map-side and joined back; AQE broadcasts
    them when their measured size is under the threshold (one row per sample), so the
    long table is never shuffled by sample and a huge sample is never one task.
    """
    totals = sample_totals(long, value, key)
    out = long.join(totals, key, "left").withColumn(value, safe_div(F.col(value), F.col("_total")) * F.lit(scale))
    return out.drop("_total")


def merge_samples(*longs: DataFrame) -> DataFrame:
    """Outer merge of per-sample tables as one union + one aggregation.

    Repeated (sample, tax_id) keys are summed (quirk K5 fixed) rather than multiplied.
    """
    u = longs[0]
    for other in longs[1:]:
        u = u.unionByName(other)
    return u.groupBy("sample", "tax_id").agg(F.sum("abundance").alias("abundance"))


# -- per-tool standardisation ------------------------------------------------------------

def unclassified_rows(raw: DataFrame, truncate: bool = True, col: str = "clade_name", value: str = "relative_abundance") -> DataFrame:
    """A2: per sample, the UNCLASSIFIED row's value (truncated to an integer), kept if > 0.

    A sample without such a row contributes nothing (K2: treated as 0, not an error).
    """
    v = F.col(value)
    if truncate:
        v = v.cast("bigint").cast("double")
    rows = raw.filter(F.col(col) == "UNCLASSIFIED").groupBy("sample").agg(F.max(v).alias("abundance"))
    return rows.filter(F.col("abundance") > 0).select("sample", F.lit(UNCLASSIFIED_LINEAGE).alias("tax_id"), "abundance")


def standardize_marker(raw: DataFrame, truncate: bool = True, close: bool = True) -> DataFrame:
    """Marker-tool profile (sample, clade_name, relative_abundance) -> long standard table."""
    species = species_rows(raw).select(
        "sample", lineage_sep("clade_name").alias("tax_id"), F.col("relative_abundance").cast("double").alias("abundance")
    )
    long = merge_samples(species.unionByName(unclassified_rows(raw, truncate)))
    return relative_abundance(long) if close else long


def unclassified_remainder(long: DataFrame, eps: float = 1e-6) -> DataFrame:
    """A3: per sample 1 - sum(abundance), appended only when > eps."""
    rest = long.groupBy("sample").agg((F.lit(1.0) - F.sum("abundance")).alias("abundance"))
    return rest.filter(F.col("abundance") > eps).select("sample", F.lit(UNCLASSIFIED_LINEAGE).alias("tax_id"), "abundance")


def standardize_bracken(raw: DataFrame, level: str = "species", eps: float = 1e-6, lineage: DataFrame | None = None) -> DataFrame:
    """Bracken profile -> long standard table; fractions are not re-divided.

    With ``lineage`` (taxid, lineage) a row takes the full lineage of its ``taxonomy_id``, so that genus
    and other roll-ups work; a taxon without one keeps the name alone (K6).
    """
    rows, tax_id = level_rows(raw, level), bracken_taxid("name")
    if lineage is not None:
        rows = rows.join(lineage.hint("merge"), F.col("taxonomy_id").cast("bigint") == F.col("taxid"), "left")
        tax_id = F.coalesce("lineage", tax_id)
    rows = rows.select("sample", tax_id.alias("tax_id"), F.col("fraction_total_reads").cast("double").alias("abundance"))
    return merge_samples(rows.unionByName(unclassified_remainder(rows, eps)))


def motus_taxonomy(raw: DataFrame) -> DataFrame:
    """P3 + F2 + F4 on an mOTUs profile: (sample, tax_id, abundance) before closure."""
    marked = mark_unassigned(raw)
    return marked.select(
        "sample",
        unknown_species(domain_to_kingdom("taxonomy")).alias("tax_id"),
        F.col("value").cast("double").alias("abundance"),
    )


def standardize_motus(raw: DataFrame) -> DataFrame:
    """A4: mOTUs profile -> long standard table, repeated lineages summed."""
    return relative_abundance(merge_samples(motus_taxonomy(raw)))
