"""Queries over profile tables: sources, scalar functions, filters, closure, merge, top-N."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaframe.functions import lineage as L
from taxaframe.operators import profiles as P
from taxaframe.operators import rank as R
from taxaframe.plans.registry import query
from taxaframe.plans.snippets import STD_MARKER, U, deepest_label, genus
from taxaframe.sources import profiles as S

# the 25 sample names of the profile fixtures (rule of fx_base over the 25 nations)
FIXTURE_SAMPLES = ["Mock1", "Mock2", "mock3"] + [f"S{i:02d}" for i in range(3, 25)]


# -- scalar functions --------------------------------------------------------------------

@query("lineage_sep", "SELECT sample, clade_name, replace(clade_name,'|',';') AS tax_id FROM fx_profile_marker")
def q_lineage_sep(fx):
    return fx.profile_marker.select("sample", "clade_name", L.lineage_sep("clade_name").alias("tax_id"))


@query("domain_to_kingdom", "SELECT sample, motu, replace(taxonomy,'d__','k__') AS tax_id FROM fx_profile_motus")
def q_domain_to_kingdom(fx):
    return fx.profile_motus.select("sample", "motu", L.domain_to_kingdom("taxonomy").alias("tax_id"))


@query("bracken_taxid", "SELECT sample, name, taxonomy_lvl, 's__' || replace(name,' ','_') AS tax_id FROM fx_profile_bracken")
def q_bracken_taxid(fx):
    return fx.profile_bracken.select("sample", "name", "taxonomy_lvl", L.bracken_taxid("name").alias("tax_id"))


@query("unknown_species",
       "SELECT sample, motu, taxonomy, regexp_replace(taxonomy,'s__Unknown[^;]*','s__Unclassified','g') AS tax_id FROM fx_profile_motus")
def q_unknown_species(fx):
    return fx.profile_motus.select("sample", "motu", "taxonomy", L.unknown_species("taxonomy").alias("tax_id"))


@query("genus_extract", f"""
SELECT src, t, {genus('t')} AS genus FROM (
  SELECT DISTINCT 'marker' AS src, replace(clade_name,'|',';') AS t FROM fx_profile_marker
  UNION ALL SELECT DISTINCT 'motus', replace(taxonomy,'d__','k__') FROM fx_profile_motus
  UNION ALL SELECT DISTINCT 'edge', concat('k__A; g__ ', p_brand, ';g__Unclassified;g__ ', p_type) FROM part)""")
def q_genus_extract(fx):
    src = (
        fx.profile_marker.select(F.lit("marker").alias("src"), L.lineage_sep("clade_name").alias("t")).distinct()
        .unionByName(fx.profile_motus.select(F.lit("motus").alias("src"), L.domain_to_kingdom("taxonomy").alias("t")).distinct())
        .unionByName(fx.part.select(F.lit("edge").alias("src"),
                                    F.concat(F.lit("k__A; g__ "), "p_brand", F.lit(";g__Unclassified;g__ "), "p_type").alias("t")).distinct())
    )
    return src.select("src", "t", L.genus_of("t").alias("genus"))


_LABEL_SRC_SQL = """
  SELECT DISTINCT replace(clade_name,'|',';') AS t FROM fx_profile_marker
  UNION ALL SELECT DISTINCT replace(taxonomy,'d__','k__') FROM fx_profile_motus
  UNION ALL SELECT DISTINCT concat('d__Bac;p__ ',p_type,' ;g__Unclassified;g__',replace(p_brand,'#','_'),'|ACGT',cast(p_partkey as varchar)) FROM part
  UNION ALL SELECT DISTINCT concat('k__',p_type,';s__') FROM part"""


@query("deepest_label", f"SELECT t, {deepest_label('t')} AS label FROM ({_LABEL_SRC_SQL})")
def q_deepest_label(fx):
    return _label_src(fx).select("t", L.deepest_label("t").alias("label"))


def _label_src(fx):
    p = fx.part
    return (
        fx.profile_marker.select(L.lineage_sep("clade_name").alias("t")).distinct()
        .unionByName(fx.profile_motus.select(L.domain_to_kingdom("taxonomy").alias("t")).distinct())
        .unionByName(p.select(F.concat(F.lit("d__Bac;p__ "), "p_type", F.lit(" ;g__Unclassified;g__"), F.replace("p_brand", F.lit("#"), F.lit("_")),
                                       F.lit("|ACGT"), F.col("p_partkey").cast("string")).alias("t")).distinct())
        .unionByName(p.select(F.concat(F.lit("k__"), "p_type", F.lit(";s__")).alias("t")).distinct())
    )


@query("is_asv", """
SELECT 'marker' AS src, bool_or(contains(clade_name,'|')) AS is_asv FROM fx_profile_marker
UNION ALL SELECT 'motus', bool_or(coalesce(contains(taxonomy,'|'), false)) FROM fx_profile_motus""")
def q_is_asv(fx):
    a = fx.profile_marker.select(F.lit("marker").alias("src"), F.bool_or(L.has_pipe("clade_name")).alias("is_asv"))
    b = fx.profile_motus.select(F.lit("motus").alias("src"), F.bool_or(L.has_pipe("taxonomy")).alias("is_asv"))
    return a.unionByName(b)


_FINITE_SRC = (
    "CASE l_linenumber WHEN 1 THEN CAST('NaN' AS DOUBLE) WHEN 2 THEN CAST('Infinity' AS DOUBLE) "
    "WHEN 3 THEN CAST('-Infinity' AS DOUBLE) WHEN 4 THEN NULL ELSE l_quantity END"
)


@query("finite_clean", f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN v IS NULL OR isnan(v) OR isinf(v) THEN 0.0 ELSE v END AS v
FROM (SELECT l_orderkey, l_linenumber, {_FINITE_SRC} AS v FROM lineitem)""")
def q_finite_clean(fx):
    li = fx.lineitem
    v = (F.when(F.col("l_linenumber") == 1, F.lit(float("nan")))
         .when(F.col("l_linenumber") == 2, F.lit(float("inf")))
         .when(F.col("l_linenumber") == 3, F.lit(float("-inf")))
         .when(F.col("l_linenumber") == 4, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity")))
    return li.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), L.finite_or_zero(v).alias("v"))


_ROUND_SRC = (
    "concat(CASE WHEN l_linenumber=7 THEN '-' ELSE '' END, cast(l_partkey as varchar), "
    "CASE l_linenumber WHEN 1 THEN '.125' WHEN 2 THEN '.375' WHEN 3 THEN '.5' WHEN 4 THEN 'e-05' "
    "WHEN 5 THEN '.875' WHEN 6 THEN '.1' ELSE '.625' END)"
)


@query("round2", f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, s,
  CASE WHEN regexp_matches(s, '^-?[0-9]+(\\.[0-9]+)?$') THEN printf('%.2f', round_even(CAST(s AS DOUBLE), 2)) ELSE s END AS r
FROM (SELECT l_orderkey, l_linenumber, {_ROUND_SRC} AS s FROM lineitem)""")
def q_round2(fx):
    li = fx.lineitem
    ln = F.col("l_linenumber")
    frac = (F.when(ln == 1, ".125").when(ln == 2, ".375").when(ln == 3, ".5").when(ln == 4, "e-05")
            .when(ln == 5, ".875").when(ln == 6, ".1").otherwise(".625"))
    s = F.concat(F.when(ln == 7, "-").otherwise(""), F.col("l_partkey").cast("string"), frac)
    return li.select("l_orderkey", ln.cast("bigint").alias("l_linenumber"), s.alias("s")).withColumn("r", L.round2_text("s"))


# -- filters ----------------------------------------------------------------------------

@query("species_filter", """
SELECT sample, clade_name, relative_abundance FROM fx_profile_marker
WHERE regexp_matches(clade_name,'s__|clade') AND NOT contains(clade_name,'t__')""")
def q_species_filter(fx):
    return P.species_rows(fx.profile_marker)


@query("level_filter", "SELECT sample, name, taxonomy_lvl, fraction_total_reads FROM fx_profile_bracken WHERE taxonomy_lvl = 'S'")
def q_level_filter(fx):
    return P.level_rows(fx.profile_bracken, "species").select("sample", "name", "taxonomy_lvl", "fraction_total_reads")


@query("mark_unassigned", f"""
SELECT sample, motu, CASE WHEN coalesce(contains(lower(motu),'unassigned'), false) THEN '{U}' ELSE taxonomy END AS taxonomy, value
FROM fx_profile_motus""")
def q_mark_unassigned(fx):
    return P.mark_unassigned(fx.profile_motus).select("sample", "motu", "taxonomy", "value")


@query("mock_select", f"WITH {STD_MARKER} SELECT DISTINCT sample FROM std WHERE regexp_matches(sample,'Mock\\d+','i')")
def q_mock_select(fx):
    from taxaframe.operators.mock import mock_samples

    return mock_samples(fx.profiles_long).select("sample").distinct()


# -- closure, unclassified rows, merge ---------------------------------------------------

@query("rel_abundance", """
SELECT sample, name, taxonomy_lvl, round(coalesce(new_est_reads / nullif(sum(new_est_reads) OVER (PARTITION BY sample),0),0), 9) AS abundance
FROM fx_profile_bracken""")
def q_rel_abundance(fx):
    b = fx.profile_bracken.select("sample", "name", "taxonomy_lvl", F.col("new_est_reads").cast("double").alias("abundance"))
    return P.relative_abundance(b)


@query("unclassified_row", f"""
SELECT sample, '{U}' AS tax_id, max(CAST(trunc(relative_abundance) AS DOUBLE)) AS abundance FROM fx_profile_marker
WHERE clade_name='UNCLASSIFIED' GROUP BY sample HAVING max(CAST(trunc(relative_abundance) AS DOUBLE)) > 0""")
def q_unclassified_row(fx):
    return P.unclassified_rows(fx.profile_marker)


@query("unclassified_remainder", f"""
SELECT sample, '{U}' AS tax_id, round(1.0 - sum(fraction_total_reads), 9) AS abundance FROM fx_profile_bracken
WHERE taxonomy_lvl='S' GROUP BY sample HAVING 1.0 - sum(fraction_total_reads) > 1e-6""")
def q_unclassified_remainder(fx):
    rows = P.level_rows(fx.profile_bracken, "species").select("sample", F.col("fraction_total_reads").alias("abundance"))
    return P.unclassified_remainder(rows)


_BRACKEN_CTES = f"""b AS (SELECT sample, 's__' || replace(name,' ','_') AS tax_id, fraction_total_reads AS abundance FROM fx_profile_bracken WHERE taxonomy_lvl='S'),
 r AS (SELECT * FROM b UNION ALL SELECT sample, '{U}', 1.0 - sum(abundance) FROM b GROUP BY sample HAVING 1.0 - sum(abundance) > 1e-6),
 bs AS (SELECT sample, tax_id, sum(abundance) AS abundance FROM r GROUP BY 1,2)"""
_MOTUS_CTES = f"""t AS (SELECT sample, regexp_replace(replace(CASE WHEN coalesce(contains(lower(motu),'unassigned'),false) THEN '{U}' ELSE taxonomy END,'d__','k__'),
   's__Unknown[^;]*','s__Unclassified','g') AS tax_id, value FROM fx_profile_motus),
 g AS (SELECT sample, tax_id, sum(value) AS abundance FROM t GROUP BY 1,2),
 ms AS (SELECT sample, tax_id, coalesce(abundance / nullif(sum(abundance) OVER (PARTITION BY sample),0),0) AS abundance FROM g)"""


@query("bracken_standard", f"WITH {_BRACKEN_CTES} SELECT sample, tax_id, round(abundance, 9) AS abundance FROM bs")
def q_bracken_standard(fx):
    return P.standardize_bracken(fx.profile_bracken, "species")


@query("motus_standard", f"WITH {_MOTUS_CTES} SELECT sample, tax_id, round(abundance, 9) AS abundance FROM ms")
def q_motus_standard(fx):
    return P.standardize_motus(fx.profile_motus)


@query("marker_standard", f"WITH {STD_MARKER} SELECT sample, tax_id, round(abundance, 9) AS abundance FROM std")
def q_marker_standard(fx):
    return fx.profiles_long


# three tools' tables of the same samples, each tool's samples under its own names
@query("merge_samples", f"""
WITH {STD_MARKER}, {_BRACKEN_CTES}, {_MOTUS_CTES},
 u AS (SELECT sample || '_metaphlan4' AS sample, tax_id, abundance FROM std UNION ALL SELECT sample || '_bracken', tax_id, abundance FROM bs
   UNION ALL SELECT sample || '_motus', tax_id, abundance FROM ms UNION ALL SELECT sample || '_motus', '{U}', 0.0 FROM ms)
SELECT sample, tax_id, round(sum(abundance), 9) AS abundance FROM u GROUP BY 1, 2""")
def q_merge_samples(fx):
    named = lambda df, tool: df.withColumn("sample", F.concat("sample", F.lit(f"_{tool}")))
    motus = named(P.standardize_motus(fx.profile_motus), "motus")
    # every mOTUs sample also comes with an Unclassified row of 0, so keys repeat across the merged tables
    zero = named(fx.profile_motus.select("sample").distinct(), "motus").select("sample", F.lit(P.UNCLASSIFIED_LINEAGE).alias("tax_id"), F.lit(0.0).alias("abundance"))
    return P.merge_samples(named(fx.profiles_long, "metaphlan4"), named(P.standardize_bracken(fx.profile_bracken, "species"), "bracken"), motus, zero)


@query("mean_abundance", f"""
WITH {STD_MARKER}
SELECT tax_id, round(sum(abundance) / (SELECT count(DISTINCT sample) FROM std), 9) AS mean_abundance FROM std GROUP BY 1""")
def q_mean_abundance(fx):
    return R.mean_abundance(fx.profiles_long)


TOP_N_SQL = f"""
WITH {STD_MARKER},
 means AS (SELECT tax_id, sum(abundance) / (SELECT count(DISTINCT sample) FROM std) AS m FROM std GROUP BY 1),
 best AS (SELECT tax_id, row_number() OVER (ORDER BY m DESC, tax_id) AS rk FROM means ORDER BY m DESC, tax_id LIMIT 10),
 tagged AS (SELECT s.sample, CASE WHEN b.rk IS NOT NULL THEN s.tax_id ELSE 'Other' END AS taxon, coalesce(b.rk, 11) AS rank, s.abundance
   FROM std s LEFT JOIN best b ON s.tax_id = b.tax_id),
 bars AS (SELECT sample, taxon, CAST(rank AS INTEGER) AS rank, sum(abundance) AS abundance FROM tagged GROUP BY 1,2,3)
"""


@query("top_n_other", TOP_N_SQL + "SELECT sample, taxon, rank, round(abundance, 9) AS abundance FROM bars")
def q_top_n_other(fx):
    return R.top_n_other(fx.profiles_long, 10)


# -- sources / sinks over derived file names ---------------------------------------------

_PATHS_SQL = """
paths AS (SELECT n_regionkey AS run, n_nationkey AS k, concat('/data/run', cast(n_regionkey as varchar), '/', n_name,
   CASE n_nationkey % 5 WHEN 0 THEN '_MOTUS_profile.tsv' WHEN 1 THEN '_metaphlan4_profile.txt' WHEN 2 THEN '.bracken' WHEN 3 THEN '_kraken.report' ELSE '_Metaphlan4.txt' END) AS path
 FROM nation)"""


def _paths(fx):
    k = F.col("n_nationkey") % 5
    suffix = (F.when(k == 0, "_MOTUS_profile.tsv").when(k == 1, "_metaphlan4_profile.txt").when(k == 2, ".bracken")
              .when(k == 3, "_kraken.report").otherwise("_Metaphlan4.txt"))
    return fx.nation.select(
        F.col("n_regionkey").alias("run"), F.col("n_nationkey").alias("k"),
        F.concat(F.lit("/data/run"), F.col("n_regionkey").cast("string"), F.lit("/"), "n_name", suffix).alias("path"),
    )


@query("detect_tool", f"""
WITH {_PATHS_SQL}
SELECT run, CASE min(CASE WHEN contains(lower(path),'motus') THEN 1 WHEN contains(lower(path),'metaphlan4') THEN 2
  WHEN contains(lower(path),'bracken') THEN 3 ELSE 4 END) WHEN 1 THEN 'motus' WHEN 2 THEN 'metaphlan4' WHEN 3 THEN 'bracken' ELSE 'unknown' END AS tool
FROM paths GROUP BY run""")
def q_detect_tool(fx):
    return S.detect_tool(_paths(fx), group="run")


@query("sample_name", f"""
WITH {_PATHS_SQL}, b AS (SELECT k, path, split_part(path,'/',-1) AS base FROM paths)
SELECT CAST(k AS INTEGER) AS k, path, split_part(base,'.bracken',1) AS bracken, split_part(base,'_metaphlan4',1) AS metaphlan4,
  split_part(base,'_',1) AS motus FROM b""")
def q_sample_name(fx):
    p = _paths(fx)
    return p.select("k", "path", *[S.sample_name("path", t).alias(t) for t in ("bracken", "metaphlan4", "motus")])


@query("synonym_dedup", """
SELECT name, max_by(canonical_name, ord) AS canonical_name FROM (
  SELECT trim(concat(' ', replace(p_brand,'#','_'), ' ')) AS name, trim(concat(p_type, ' ')) AS canonical_name, p_partkey AS ord FROM part) GROUP BY 1""")
def q_synonym_dedup(fx):
    from taxaframe.operators.mock import dedup_synonyms

    raw = fx.part.select(
        F.concat(F.lit(" "), F.replace("p_brand", F.lit("#"), F.lit("_")), F.lit(" ")).alias("name"),
        F.concat("p_type", F.lit(" ")).alias("canonical_name"),
        F.col("p_partkey").alias("ord"),
    )
    return dedup_synonyms(raw, order="ord")


_WIDE_COLS = ", ".join(f'coalesce("{s}", 0) AS "{s}"' for s in FIXTURE_SAMPLES)
_WIDE_IN = ", ".join(f"'{s}'" for s in FIXTURE_SAMPLES)


@query("pivot_wide", f"""
WITH {STD_MARKER}, w AS (SELECT * FROM (PIVOT (SELECT tax_id, sample, round(abundance, 9) AS abundance FROM std) ON sample IN ({_WIDE_IN}) USING sum(abundance) GROUP BY tax_id))
SELECT tax_id, {_WIDE_COLS} FROM w""")
def q_pivot_wide(fx):
    from taxaframe.sources.sinks import pivot_wide

    return pivot_wide(fx.profiles_long.withColumn("abundance", F.round("abundance", 9)), FIXTURE_SAMPLES)


@query("unpivot_long", f"""
WITH {STD_MARKER}, w AS (SELECT * FROM (PIVOT (SELECT tax_id, sample, abundance FROM std) ON sample IN ({_WIDE_IN}) USING sum(abundance) GROUP BY tax_id)),
 z AS (SELECT tax_id, {_WIDE_COLS} FROM w)
SELECT tax_id, sample, round(abundance, 9) AS abundance FROM (UNPIVOT z ON COLUMNS(* EXCLUDE (tax_id)) INTO NAME sample VALUE abundance)""")
def q_unpivot_long(fx):
    from taxaframe.sources.sinks import pivot_wide

    wide = pivot_wide(fx.profiles_long, FIXTURE_SAMPLES)
    return S.unpivot_long(wide)
