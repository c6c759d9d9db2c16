"""Queries of plot-ready data sets, display labels and table comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaframe.functions import lineage as L
from taxaframe.operators import diff as D
from taxaframe.operators import rank as R
from taxaframe.plans.q_profiles import FIXTURE_SAMPLES, TOP_N_SQL
from taxaframe.plans.registry import query
from taxaframe.plans.snippets import STD_MARKER, deepest_label

_ASV_SQL = (
    "SELECT DISTINCT concat('d__Bac;p__ ',p_type,' ;g__Unclassified;g__',replace(p_brand,'#','_'),'|ACGT',cast(p_partkey as varchar)) AS tax_id FROM part"
)


def _asv_taxa(fx):
    return fx.part.select(
        F.concat(F.lit("d__Bac;p__ "), "p_type", F.lit(" ;g__Unclassified;g__"), F.replace("p_brand", F.lit("#"), F.lit("_")),
                 F.lit("|ACGT"), F.col("p_partkey").cast("string")).alias("tax_id")
    ).distinct()


@query("label_suffix", f"""
WITH a AS ({_ASV_SQL}), b AS (SELECT tax_id, {deepest_label('tax_id')} AS base FROM a)
SELECT tax_id, base || '_' || CAST(row_number() OVER (PARTITION BY base ORDER BY tax_id) AS VARCHAR) AS label FROM b""")
def q_label_suffix(fx):
    return R.labels(_asv_taxa(fx)).select("tax_id", "label")


@query("bar_data", TOP_N_SQL + """
SELECT sample, taxon, rank, round(abundance, 9) AS abundance,
  round(coalesce(sum(abundance) OVER (PARTITION BY sample ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 9) AS bottom
FROM bars""")
def q_bar_data(fx):
    return R.bar_data(fx.profiles_long, 10)


@query("stack_offsets", TOP_N_SQL.replace("LIMIT 10", "LIMIT 5").replace("coalesce(b.rk, 11)", "coalesce(b.rk, 6)") + """
SELECT sample, taxon, rank, round(abundance, 9) AS abundance,
  round(coalesce(sum(abundance) OVER (PARTITION BY sample ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 9) AS bottom
FROM bars""")
def q_stack_offsets(fx):
    return R.stack_offsets(R.top_n_other(fx.profiles_long, 5))


_WIDE_COLS = ", ".join(f'round(coalesce("{s}", 0), 9) AS "{s}"' for s in FIXTURE_SAMPLES)
_WIDE_IN = ", ".join(f"'{s}'" for s in FIXTURE_SAMPLES)


@query("heat_matrix", f"""
WITH {STD_MARKER}, w AS (SELECT * FROM (PIVOT (SELECT tax_id, sample, abundance FROM std) ON sample IN ({_WIDE_IN}) USING sum(abundance) GROUP BY tax_id))
SELECT tax_id, {deepest_label('tax_id')} AS label, {_WIDE_COLS} FROM w""")
def q_heat_matrix(fx):
    return R.heat_matrix(fx.profiles_long, FIXTURE_SAMPLES)


@query("cluster_flags", f"""
WITH {STD_MARKER},
 t AS (SELECT DISTINCT tax_id FROM std), s AS (SELECT DISTINCT sample FROM std),
 grid AS (SELECT t.tax_id, s.sample, coalesce(x.abundance, 0) AS v FROM t CROSS JOIN s LEFT JOIN std x ON x.tax_id = t.tax_id AND x.sample = s.sample),
 rc AS (SELECT tax_id, count(DISTINCT v) AS u FROM grid GROUP BY 1), cc AS (SELECT sample, count(DISTINCT v) AS u FROM grid GROUP BY 1)
SELECT (SELECT count(*) FROM t) AS n_taxa, (SELECT count(*) FROM s) AS n_samples,
  (SELECT count(*) FROM t) > 1 AND (SELECT bool_or(u > 1) FROM rc) AS row_cluster,
  (SELECT count(*) FROM s) > 1 AND (SELECT bool_or(u > 1) FROM cc) AS col_cluster""")
def q_cluster_flags(fx):
    return R.cluster_flags(fx.profiles_long)


@query("sample_distance", f"""
WITH {STD_MARKER},
 t AS (SELECT DISTINCT tax_id FROM std), s AS (SELECT DISTINCT sample FROM std),
 grid AS (SELECT t.tax_id, s.sample, coalesce(x.abundance, 0) AS v FROM t CROSS JOIN s LEFT JOIN std x ON x.tax_id = t.tax_id AND x.sample = s.sample)
SELECT a.sample AS sample_a, b.sample AS sample_b, round(sqrt(sum((a.v - b.v) * (a.v - b.v))), 9) AS distance
FROM grid a JOIN grid b ON a.tax_id = b.tax_id AND a.sample < b.sample GROUP BY 1, 2""", digits=9)
def q_sample_distance(fx):
    d = R.sample_distance(fx.profiles_long)
    return d.select(
        F.least("sample_a", "sample_b").alias("sample_a"), F.greatest("sample_a", "sample_b").alias("sample_b"), "distance"
    )


def _perturbed(fx):
    std = fx.profiles_long
    b = (
        std.filter(~F.col("tax_id").contains("Brand_2;") & (F.col("sample") != "S05"))
        .withColumn("abundance", F.when(F.col("tax_id").contains("Brand_1;"), F.col("abundance") * 1.5).otherwise(F.col("abundance")))
    )
    extra = std.filter(F.col("sample") == "S03").withColumn("sample", F.lit("S99"))
    return std, b.unionByName(extra)


_PERTURBED_SQL = f"""
WITH {STD_MARKER},
 a AS (SELECT tax_id, sample, abundance FROM std),
 b AS (SELECT tax_id, sample, CASE WHEN contains(tax_id, 'Brand_1;') THEN abundance * 1.5 ELSE abundance END AS abundance FROM std
        WHERE NOT contains(tax_id, 'Brand_2;') AND sample <> 'S05'
       UNION ALL SELECT tax_id, 'S99', abundance FROM std WHERE sample = 'S03'),
 ca AS (SELECT DISTINCT sample FROM a), cb AS (SELECT DISTINCT sample FROM b),
 coldiff AS (SELECT CASE WHEN cb.sample IS NULL THEN 'column_only_a' ELSE 'column_only_b' END AS kind, CAST(NULL AS VARCHAR) AS tax_id,
    coalesce(ca.sample, cb.sample) AS sample, CAST(NULL AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS b
   FROM ca FULL JOIN cb ON ca.sample = cb.sample WHERE ca.sample IS NULL OR cb.sample IS NULL),
 sh AS (SELECT ca.sample FROM ca JOIN cb ON ca.sample = cb.sample),
 va AS (SELECT tax_id, sample, round_even(abundance, 2) AS a FROM a WHERE sample IN (SELECT sample FROM sh)),
 vb AS (SELECT tax_id, sample, round_even(abundance, 2) AS b FROM b WHERE sample IN (SELECT sample FROM sh)),
 cells AS (SELECT coalesce(va.tax_id, vb.tax_id) AS tax_id, coalesce(va.sample, vb.sample) AS sample, va.a, vb.b
   FROM va FULL JOIN vb ON va.tax_id = vb.tax_id AND va.sample = vb.sample),
 celldiff AS (SELECT CASE WHEN b IS NULL AND a IS NOT NULL THEN 'only_a' WHEN a IS NULL AND b IS NOT NULL THEN 'only_b'
    WHEN a IS DISTINCT FROM b THEN 'differs' END AS kind, tax_id, sample, a, b FROM cells),
 diff AS (SELECT * FROM coldiff UNION ALL SELECT * FROM celldiff WHERE kind IS NOT NULL)
"""


@query("table_diff", _PERTURBED_SQL + "SELECT kind, tax_id, sample, a, b FROM diff")
def q_table_diff(fx):
    a, b = _perturbed(fx)
    return D.table_diff(a, b)


@query("compare_sets", _PERTURBED_SQL + """
SELECT pair, n_diff, n_diff = 0 AS passed FROM (
  SELECT 'marker_vs_perturbed' AS pair, (SELECT count(*) FROM diff) AS n_diff
  UNION ALL SELECT 'marker_vs_itself', 0)""")
def q_compare_sets(fx):
    a, b = _perturbed(fx)
    return D.compare_sets({"marker_vs_perturbed": D.table_diff(a, b), "marker_vs_itself": D.table_diff(a, a)})
