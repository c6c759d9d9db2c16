"""Mock-community evaluation: genus roll-ups, synonym mapping, metrics, composition.

Per-sample metrics come from sufficient statistics (sums, sums of squares, the
cross product over matched genera) instead of a reference x samples grid, so the
work is one aggregation of the observed table plus a join with the (small,
AQE-sized) reference.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaframe.functions.lineage import UNCLASSIFIED, genus_of
from taxaframe.functions.util import safe_div
from taxaframe.operators.rank import n_distinct

REFERENCE = "Reference"
DEFAULT_MOCK_PATTERN = r"Mock\d+"


# -- lookups -----------------------------------------------------------------------------

def dedup_synonyms(syn: DataFrame, order: str | None = None) -> DataFrame:
    """S10 semantics: trimmed names, last duplicate (by ``order``) wins."""
    t = syn.select(F.trim("name").alias("name"), F.trim("canonical_name").alias("canonical_name"), *([order] if order else []))
    if order is None:
        return t.groupBy("name").agg(F.max("canonical_name").alias("canonical_name"))
    return t.groupBy("name").agg(F.max_by("canonical_name", order).alias("canonical_name"))


def canonical(df: DataFrame, col: str, synonyms: DataFrame) -> DataFrame:
    """Exact match -> canonical name, otherwise unchanged (null stays null)."""
    s = synonyms.select(F.col("name").alias("_syn_name"), F.col("canonical_name").alias("_syn_canon"))
    joined = df.join(s, F.col(col) == F.col("_syn_name"), "left")
    return joined.withColumn(col, F.coalesce(F.col("_syn_canon"), F.col(col))).drop("_syn_name", "_syn_canon")


def reference_rows(abundance: DataFrame, taxa: DataFrame) -> DataFrame:
    """Each reference ASV with its taxonomy (left join on asv)."""
    return abundance.join(taxa, "asv", "left")


def reference_genus(abundance: DataFrame, taxa: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """Reference composition per canonical genus; null genus dropped, closed to 1.

    Output (genus, reference).
    """
    rows = reference_rows(abundance, taxa)
    if synonyms is not None:
        rows = canonical(rows, "genus", synonyms)
    g = rows.filter(F.col("genus").isNotNull()).groupBy("genus").agg(F.sum("mock_reference").alias("reference"))
    total = g.select(F.sum("reference")).scalar()
    return g.withColumn("reference", safe_div(F.col("reference"), total))


def mock_samples(long: DataFrame, pattern: str = DEFAULT_MOCK_PATTERN) -> DataFrame:
    """P5: rows of samples whose name matches ``pattern`` anywhere, ignoring case."""
    return long.filter(F.col("sample").rlike("(?i)" + pattern))


def genus_rollup(long: DataFrame, synonyms: DataFrame | None = None, close: bool = True) -> DataFrame:
    """A5: (sample, genus, abundance) summed by extracted, canonical genus, then closed per sample."""
    g = long.withColumn("genus", genus_of("tax_id"))
    if synonyms is not None:
        g = canonical(g, "genus", synonyms)
    out = g.groupBy("sample", "genus").agg(F.sum("abundance").alias("abundance"))
    if not close:
        return out
    totals = out.groupBy("sample").agg(F.sum("abundance").alias("_t"))
    return out.join(totals, "sample").withColumn("abundance", safe_div(F.col("abundance"), F.col("_t"))).drop("_t")


def observed_genus(long: DataFrame, pattern: str = DEFAULT_MOCK_PATTERN, synonyms: DataFrame | None = None) -> DataFrame:
    """Mock samples rolled up to genus (the observed side of the evaluation)."""
    return genus_rollup(mock_samples(long, pattern), synonyms)


def genus_universe(long: DataFrame, ref: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """Distinct genera of the whole table (every sample) and of the reference."""
    g = long.select(genus_of("tax_id").alias("genus"))
    if synonyms is not None:
        g = canonical(g, "genus", synonyms)
    return g.unionByName(ref.select("genus")).distinct()


# -- metrics -----------------------------------------------------------------------------

def pearson_p(r: Column, n: Column) -> Column:
    """A10: two-sided p of Pearson r with n points (Student t, nu = n - 2), closed form.

    With s = |r|, c = sqrt(1 - r^2) and theta = atan2(s, c), the t distribution gives
    A = s * sum_k prod_j (2j-1)/(2j) c^(2k) (nu even) or
    A = 2/pi * (theta + s*c * sum_k prod_j (2j)/(2j+1) c^(2k)) (nu odd), p = 1 - A.
    n = 2 gives p = 1; null r gives null.

    1 - A loses a small p in rounding. For r^2 >= 0.01, p is the incomplete beta function
    I_x(nu/2, 1/2) with x = 1 - r^2, as a sum of positive terms: x^a |r| g(nu) / a * sum_k
    prod_j (a + j - 1/2)/(a + j) x^k, a = nu/2, with g(1) = 1/pi, g(2) = 1/2 and
    g(nu + 2) = g(nu) (nu + 1)/nu. It keeps its relative accuracy however small p is.
    """
    nu = n - 2
    s = F.abs(r)
    c2 = F.greatest(F.lit(1.0) - r * r, F.lit(0.0))
    c = F.sqrt(c2)
    theta = F.atan2(s, c)
    even_terms = F.sequence(F.lit(1), F.greatest((nu - 2) / 2, F.lit(0)).cast("int"))
    odd_terms = F.sequence(F.lit(1), F.greatest((nu - 3) / 2, F.lit(0)).cast("int"))
    init = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def series(terms, num, den):
        acc = F.aggregate(
            terms,
            init,
            lambda a, k: F.struct(
                (a["t"] * num(k) / den(k) * c2).alias("t"),
                (a["s"] + a["t"] * num(k) / den(k) * c2).alias("s"),
            ),
        )
        return acc["s"]

    even_sum = F.when(nu >= 4, series(even_terms, lambda k: 2 * k - 1, lambda k: 2 * k)).otherwise(F.lit(1.0))
    odd_sum = F.when(nu >= 5, series(odd_terms, lambda k: 2 * k, lambda k: 2 * k + 1)).otherwise(F.lit(1.0))
    a_even = s * even_sum
    a_odd = F.when(nu == 1, 2 * theta / math.pi).otherwise(2 / math.pi * (theta + s * c * odd_sum))
    a = F.when(nu % 2 == 0, a_even).otherwise(a_odd)

    half = nu / 2.0
    x = F.greatest((1.0 - s) * (1.0 + s), F.lit(0.0))
    lead = F.aggregate(
        F.filter(F.sequence(F.lit(1), F.greatest(nu - 2, F.lit(1)).cast("int")), lambda k: (k <= nu - 2) & (k % 2 == nu % 2)),
        F.when(nu % 2 == 0, 0.5).otherwise(1 / math.pi),
        lambda g, k: g * (k + 1) / k,
    )
    n_terms = F.least(F.ceil(F.lit(-40.0) / F.log(F.greatest(x, F.lit(1e-300)))), F.lit(4000)).cast("int")  # x <= 0.99
    terms = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n_terms, F.lit(1))),
        init,
        lambda acc, k: F.struct(
            (acc["t"] * (half + k - 0.5) / (half + k) * x).alias("t"),
            (acc["s"] + acc["t"] * (half + k - 0.5) / (half + k) * x).alias("s"),
        ),
    )
    tail = F.pow(x, half) * s * lead / half * terms["s"]
    return F.when(r.isNull(), F.lit(None).cast("double")).when(nu <= 0, F.lit(1.0)).otherwise(
        F.when(s >= 0.1, tail).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - a))
    )


def mock_metrics(long: DataFrame, abundance: DataFrame, taxa: DataFrame, synonyms: DataFrame | None = None,
                 pattern: str = DEFAULT_MOCK_PATTERN) -> DataFrame:
    """Bray-Curtis, Pearson r and p, RMSE of each mock sample against the reference.

    Vectors are aligned over the union of reference genera and all genera of the
    table (absent = 0), as the reference does. Output
    (sample, bray_curtis, pearson_r, pearson_p, rmse).
    """
    ref = reference_genus(abundance, taxa, synonyms)
    obs = observed_genus(long, pattern, synonyms)
    n = n_distinct(genus_universe(long, ref, synonyms), "genus")
    su = ref.select(F.sum("reference")).scalar()
    suu = ref.select(F.sum(F.col("reference") * F.col("reference"))).scalar()
    ref_rows, ref_m2 = ref.select(F.count("reference")).scalar(), ref.select(F.var_pop("reference") * F.count("reference")).scalar()
    ref_low, ref_high = ref.select(F.min("reference")).scalar(), ref.select(F.max("reference")).scalar()

    matched = obs.join(ref, "genus", "left").withColumn("u", F.coalesce(F.col("reference"), F.lit(0.0)))
    v, u = F.col("abundance"), F.col("u")
    stats = matched.groupBy("sample").agg(
        F.sum(v).alias("sv"),
        F.count(v).alias("na"),
        (F.var_pop(v) * F.count(v)).alias("v_m2"),
        (F.covar_pop(u, v) * F.count(v)).alias("c_a"),
        F.sum(u).alias("su_a"),
        F.count("reference").alias("na_ref"),
        F.sum(u * u).alias("suu_a"),
        F.sum((u - v) * (u - v)).alias("dd"),
        F.min(v).alias("v_low"),
        F.max(v).alias("v_high"),
        F.sum(F.when(F.col("reference").isNotNull(), F.abs(u - v) - u - v).otherwise(F.lit(0.0))).alias("corr"),
    )
    # the universe size enters a higher-order function below: carry it as a column
    stats = stats.withColumn("n", n)
    n = F.col("n")
    sv, na = F.col("sv"), F.col("na")
    bc = F.try_divide(su + sv + F.col("corr"), su + sv)
    # centred moments over all n genera: those of the rows seen, joined with the absent ones (all 0)
    var_v = F.col("v_m2") + (sv / na) * (sv / na) * na * (n - na) / n
    var_u = ref_m2 + (su / ref_rows) * (su / ref_rows) * ref_rows * (n - ref_rows) / n
    rest = F.when(n > na, (su - F.col("su_a")) / F.greatest(n - na, F.lit(1))).otherwise(F.lit(0.0))
    cov = F.col("c_a") + (F.col("su_a") / na - rest) * (sv / na) * na * (n - na) / n
    low = lambda seen, least: F.when(seen < n, F.least(least, F.lit(0.0))).otherwise(least)
    high = lambda seen, most: F.when(seen < n, F.greatest(most, F.lit(0.0))).otherwise(most)
    varies = (low(na, F.col("v_low")) < high(na, F.col("v_high"))) & (low(ref_rows, ref_low) < high(ref_rows, ref_high))
    r = F.when(varies, F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cov / F.sqrt(var_u) / F.sqrt(var_v))))
    unseen = F.when(F.col("na_ref") < ref_rows, F.greatest(suu - F.col("suu_a"), F.lit(0.0))).otherwise(F.lit(0.0))
    rmse = F.sqrt((F.col("dd") + unseen) / n)
    out = stats.select("sample", "n", bc.alias("bray_curtis"), r.alias("pearson_r"), rmse.alias("rmse"))
    return out.select("sample", "bray_curtis", "pearson_r", pearson_p(F.col("pearson_r"), n).alias("pearson_p"), "rmse")


def align(obs: DataFrame, ref: DataFrame) -> DataFrame:
    """Per mock sample, reference and observed genera aligned, absent = 0: (sample, genus, u, v).

    Reference-only genera are emitted once per sample by exploding the (bounded)
    list of mock-sample names on the reference side; the metrics never need
    this materialised table (they use sufficient statistics).
    """
    names = obs.select(F.collect_set("sample")).scalar()
    ref_side = ref.select(F.explode(names).alias("sample"), "genus", F.col("reference").alias("u"))
    full = obs.select("sample", "genus", F.col("abundance").alias("v")).join(ref_side, ["sample", "genus"], "full")
    return full.select("sample", "genus", F.coalesce("u", F.lit(0.0)).alias("u"), F.coalesce("v", F.lit(0.0)).alias("v"))


def drop_zero_rows(long: DataFrame, key: str = "genus", value: str = "abundance") -> DataFrame:
    """Drop every row of a key whose value is 0 in all samples (left semi join on a per-key flag)."""
    keep = long.groupBy(key).agg(F.bool_or(F.col(value) != 0).alias("_nz")).filter("_nz").select(key)
    return long.join(keep, key, "left_semi")


# -- composition -------------------------------------------------------------------------

def attach_reference(obs: DataFrame, ref: DataFrame, keep_missing: bool = False) -> DataFrame:
    """Observed genera with a 'Reference' column added as one more sample (long).

    Reference values are looked up for observed genera only unless ``keep_missing``.
    """
    genera = obs.select("genus").distinct()
    how = "full" if keep_missing else "inner"
    r = genera.join(ref, "genus", how).select("genus", F.lit(REFERENCE).alias("sample"), F.col("reference").alias("abundance"))
    return obs.select("genus", "sample", "abundance").unionByName(r)


def mock_composition(long: DataFrame, abundance: DataFrame, taxa: DataFrame, synonyms: DataFrame | None = None,
                     n: int = 15, pattern: str = DEFAULT_MOCK_PATTERN) -> DataFrame:
    """W2 + P6: top-n genera by mean over mock samples and 'Reference'; 'Unclassified' reserved.

    If 'Unclassified' is among the n best it is removed without refill; the rest
    (not kept, not Unclassified) is summed as 'Other'. Long output of non-zero cells
    (genus, sample, abundance, row_order); all-zero rows vanish with it.
    """
    ref = reference_genus(abundance, taxa, synonyms)
    obs_all = genus_rollup(mock_samples(long, pattern), synonyms)
    # universe: genera of the whole table, observed values 0 outside mock samples
    universe = long.select(genus_of("tax_id").alias("genus"))
    if synonyms is not None:
        universe = canonical(universe, "genus", synonyms)
    universe = universe.distinct()
    cells = obs_all.select("genus", "sample", "abundance").unionByName(
        universe.join(ref, "genus").select("genus", F.lit(REFERENCE).alias("sample"), F.col("reference").alias("abundance"))
    )
    n_cols = n_distinct(obs_all, "sample") + 1
    means = universe.join(cells.groupBy("genus").agg(F.sum("abundance").alias("_s")), "genus", "left").select(
        "genus", (F.coalesce(F.col("_s"), F.lit(0.0)) / n_cols).alias("m")
    )
    best = means.orderBy(F.desc("m"), F.asc("genus")).limit(n).filter(F.col("genus") != UNCLASSIFIED)
    best = F.broadcast(best.select("genus", F.lit(True).alias("_top")))
    label = (
        F.when(F.col("_top"), F.col("genus"))
        .when(F.col("genus") == UNCLASSIFIED, F.lit(UNCLASSIFIED))
        .otherwise(F.lit("Other"))
    )
    out = (
        cells.join(best, "genus", "left")
        .select(label.alias("genus"), "sample", "abundance")
        .groupBy("genus", "sample")
        .agg(F.sum("abundance").alias("abundance"))
        .filter(F.col("abundance") != 0)
    )
    means_kept = means.join(best, "genus").select("genus", F.col("m").alias("mean_abundance"))
    order = out.join(means_kept, "genus", "left").withColumn(
        "row_group", F.when(F.col("genus") == "Other", 1).when(F.col("genus") == UNCLASSIFIED, 2).otherwise(0)
    )
    return order.select("genus", "sample", "abundance", "row_group", "mean_abundance")


def mock_bar_data(comp: DataFrame) -> DataFrame:
    """Composition bars with 'Reference' first and stack offsets (W2 + W4 + W5)."""
    from pyspark.sql import Window

    seg = Window.partitionBy("sample").orderBy("row_group", F.desc_nulls_last("mean_abundance"), "genus")
    ranked = comp.withColumn("seg", F.row_number().over(seg))
    below = Window.partitionBy("sample").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    bars = ranked.withColumn("bottom", F.coalesce(F.sum("abundance").over(below), F.lit(0.0)))
    return bars.select("sample", "genus", "seg", "abundance", "bottom")
