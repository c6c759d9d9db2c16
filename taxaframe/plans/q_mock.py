"""Queries of the mock-community evaluation (joins, genus roll-ups, metrics, composition)."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaframe.functions.lineage import genus_of
from taxaframe.operators import mock as M
from taxaframe.operators.rank import sample_order
from taxaframe.plans.registry import query
from taxaframe.plans.snippets import MOCK, STD_MARKER, genus


def _inputs(fx):
    return fx.profiles_long, fx.mock_abundance, fx.mock_taxa, M.dedup_synonyms(fx.synonyms)


@query("mock_left_join", """
SELECT a.asv, a.mock_reference, t.domain, t.genus FROM fx_mock_abundance a LEFT JOIN fx_mock_taxa t ON a.asv = t.asv""")
def q_mock_left_join(fx):
    return M.reference_rows(fx.mock_abundance, fx.mock_taxa).select("asv", "mock_reference", "domain", "genus")


@query("synonym_map", f"""
WITH {STD_MARKER}, {MOCK}
SELECT s.genus_raw, coalesce(y.canonical_name, s.genus_raw) AS genus
FROM (SELECT DISTINCT {genus('tax_id')} AS genus_raw FROM std) s LEFT JOIN syn y ON s.genus_raw = y.name""")
def q_synonym_map(fx):
    g = fx.profiles_long.select(genus_of("tax_id").alias("genus_raw")).distinct()
    return M.canonical(g.withColumn("genus", F.col("genus_raw")), "genus", M.dedup_synonyms(fx.synonyms))


@query("reference_genus", f"WITH {STD_MARKER}, {MOCK} SELECT genus, round(reference, 9) AS reference FROM ref")
def q_reference_genus(fx):
    return M.reference_genus(fx.mock_abundance, fx.mock_taxa, M.dedup_synonyms(fx.synonyms))


@query("genus_rollup", f"""
WITH {STD_MARKER}, {MOCK},
 g AS (SELECT sample, genus, sum(abundance) AS abundance FROM std_g GROUP BY 1,2)
SELECT sample, genus, round(coalesce(abundance / nullif(sum(abundance) OVER (PARTITION BY sample),0),0), 9) AS abundance FROM g""")
def q_genus_rollup(fx):
    return M.genus_rollup(fx.profiles_long, M.dedup_synonyms(fx.synonyms))


@query("key_union", f"WITH {STD_MARKER}, {MOCK} SELECT genus FROM uni UNION SELECT genus FROM ref")
def q_key_union(fx):
    long, ab, taxa, syn = _inputs(fx)
    return M.genus_universe(long, M.reference_genus(ab, taxa, syn), syn)


@query("attach_reference", f"""
WITH {STD_MARKER}, {MOCK}
SELECT genus, sample, round(abundance, 9) AS abundance FROM obs
UNION ALL SELECT r.genus, 'Reference', round(r.reference, 9) FROM ref r WHERE r.genus IN (SELECT genus FROM obs)""")
def q_attach_reference(fx):
    long, ab, taxa, syn = _inputs(fx)
    return M.attach_reference(M.observed_genus(long, synonyms=syn), M.reference_genus(ab, taxa, syn))


@query("align_full", f"""
WITH {STD_MARKER}, {MOCK},
 ms AS (SELECT DISTINCT sample FROM obs),
 grid AS (SELECT ms.sample, r.genus FROM ms, ref r UNION SELECT sample, genus FROM obs)
SELECT g.sample, g.genus, round(coalesce(r.reference, 0), 9) AS u, round(coalesce(o.abundance, 0), 9) AS v
FROM grid g LEFT JOIN ref r ON g.genus = r.genus LEFT JOIN obs o ON o.sample = g.sample AND o.genus = g.genus""")
def q_align_full(fx):
    long, ab, taxa, syn = _inputs(fx)
    return M.align(M.observed_genus(long, synonyms=syn), M.reference_genus(ab, taxa, syn))


_METRICS_SQL = f"""
WITH {STD_MARKER}, {MOCK},
 ms AS (SELECT DISTINCT sample FROM obs),
 gu AS (SELECT genus FROM uni UNION SELECT genus FROM ref),
 grid AS (SELECT ms.sample, gu.genus FROM ms CROSS JOIN gu),
 al AS (SELECT grid.sample, coalesce(r.reference, 0) AS u, coalesce(o.abundance, 0) AS v FROM grid
   LEFT JOIN ref r ON r.genus = grid.genus LEFT JOIN obs o ON o.sample = grid.sample AND o.genus = grid.genus),
 m AS (SELECT sample, sum(abs(u - v)) / sum(abs(u + v)) AS bray_curtis,
   CASE WHEN var_pop(u) > 0 AND var_pop(v) > 0 THEN greatest(-1.0, least(1.0, corr(u, v))) END AS pearson_r,
   sqrt(avg((u - v) * (u - v))) AS rmse, count(*) AS n FROM al GROUP BY sample),
 p AS (SELECT *, n - 2 AS nu, abs(pearson_r) AS s, greatest(1 - pearson_r * pearson_r, 0) AS c2 FROM m),
 q AS (SELECT *, sqrt(c2) AS c, atan2(s, sqrt(c2)) AS theta,
   CASE WHEN nu >= 4 THEN list_reduce(range(1, (nu - 2) // 2 + 1), lambda a, k: {{'t': a.t * (2*k-1) / (2*k) * c2, 's': a.s + a.t * (2*k-1) / (2*k) * c2}},
     {{'t': 1.0::DOUBLE, 's': 1.0::DOUBLE}}).s ELSE 1.0 END AS even_sum,
   CASE WHEN nu >= 5 THEN list_reduce(range(1, (nu - 3) // 2 + 1), lambda a, k: {{'t': a.t * (2*k) / (2*k+1) * c2, 's': a.s + a.t * (2*k) / (2*k+1) * c2}},
     {{'t': 1.0::DOUBLE, 's': 1.0::DOUBLE}}).s ELSE 1.0 END AS odd_sum FROM p),
 metrics AS (SELECT sample, round(bray_curtis, 9) AS bray_curtis, round(pearson_r, 9) AS pearson_r,
   round(CASE WHEN pearson_r IS NULL THEN NULL WHEN nu <= 0 THEN 1.0
     ELSE greatest(0.0, 1 - CASE WHEN nu % 2 = 0 THEN s * even_sum WHEN nu = 1 THEN 2 * theta / pi()
       ELSE 2 / pi() * (theta + s * c * odd_sum) END) END, 9) AS pearson_p,
   round(rmse, 9) AS rmse FROM q)
"""


def _metrics(fx):
    long, ab, taxa, syn = _inputs(fx)
    return M.mock_metrics(long, ab, taxa, syn)


@query("mock_metrics", _METRICS_SQL + "SELECT sample, bray_curtis, pearson_r, pearson_p, rmse FROM metrics")
def q_mock_metrics(fx):
    return _metrics(fx)


@query("bray_curtis", _METRICS_SQL + "SELECT sample, bray_curtis FROM metrics")
def q_bray_curtis(fx):
    return _metrics(fx).select("sample", "bray_curtis")


@query("pearson_r", _METRICS_SQL + "SELECT sample, pearson_r FROM metrics")
def q_pearson_r(fx):
    return _metrics(fx).select("sample", "pearson_r")


@query("pearson_p", _METRICS_SQL + "SELECT sample, pearson_p FROM metrics")
def q_pearson_p(fx):
    return _metrics(fx).select("sample", "pearson_p")


@query("rmse", _METRICS_SQL + "SELECT sample, rmse FROM metrics")
def q_rmse(fx):
    return _metrics(fx).select("sample", "rmse")


_COMPOSITION_SQL = f"""
WITH {STD_MARKER}, {MOCK},
 cells AS (SELECT genus, sample, abundance FROM obs
   UNION ALL SELECT u.genus, 'Reference', r.reference FROM uni u JOIN ref r ON u.genus = r.genus),
 ncols AS (SELECT count(DISTINCT sample) + 1 AS k FROM obs),
 means AS (SELECT u.genus, coalesce(sum(c.abundance), 0) / (SELECT k FROM ncols) AS m FROM uni u LEFT JOIN cells c ON u.genus = c.genus GROUP BY u.genus),
 best AS (SELECT genus, m FROM means ORDER BY m DESC, genus LIMIT 15),
 kept AS (SELECT genus, m FROM best WHERE genus <> 'Unclassified'),
 lab AS (SELECT CASE WHEN k.genus IS NOT NULL THEN c.genus WHEN c.genus = 'Unclassified' THEN 'Unclassified' ELSE 'Other' END AS genus,
   c.sample, c.abundance FROM cells c LEFT JOIN kept k ON c.genus = k.genus),
 comp AS (SELECT l.genus, l.sample, sum(l.abundance) AS abundance,
   CASE WHEN l.genus = 'Other' THEN 1 WHEN l.genus = 'Unclassified' THEN 2 ELSE 0 END AS row_group, max(k.m) AS mean_abundance
   FROM lab l LEFT JOIN kept k ON l.genus = k.genus GROUP BY l.genus, l.sample HAVING sum(l.abundance) <> 0)
"""


@query("mock_composition", _COMPOSITION_SQL + """
SELECT genus, sample, round(abundance, 9) AS abundance, CAST(row_group AS INTEGER) AS row_group, round(mean_abundance, 9) AS mean_abundance FROM comp""")
def q_mock_composition(fx):
    long, ab, taxa, syn = _inputs(fx)
    return M.mock_composition(long, ab, taxa, syn, n=15)


_MOCK_COLUMNS = ["Mock1", "Mock2", "Reference", "mock3"]


@query("mock_composition_wide", _COMPOSITION_SQL + "SELECT genus, " + ", ".join(
    f"round(coalesce(sum(abundance) FILTER (WHERE sample = '{s}'), 0), 9) AS \"{s}\"" for s in _MOCK_COLUMNS) + " FROM comp GROUP BY genus")
def q_mock_composition_wide(fx):
    from taxaframe.sources.sinks import composition_wide

    long, ab, taxa, syn = _inputs(fx)
    return composition_wide(M.mock_composition(long, ab, taxa, syn, n=15), _MOCK_COLUMNS)


@query("mock_bar_data", _COMPOSITION_SQL + """,
 bars AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY row_group, mean_abundance DESC NULLS LAST, genus) AS seg FROM comp),
 so AS (SELECT sample, row_number() OVER (ORDER BY sample <> 'Reference', sample) AS sample_rank FROM (SELECT DISTINCT sample FROM comp))
SELECT b.sample, b.genus, CAST(b.seg AS INTEGER) AS seg, round(b.abundance, 9) AS abundance,
  round(coalesce(sum(b.abundance) OVER (PARTITION BY b.sample ORDER BY b.seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 9) AS bottom,
  CAST(so.sample_rank AS INTEGER) AS sample_rank
FROM bars b JOIN so ON b.sample = so.sample""")
def q_mock_bar_data(fx):
    long, ab, taxa, syn = _inputs(fx)
    comp = M.mock_composition(long, ab, taxa, syn, n=15)
    bars = M.mock_bar_data(comp)
    return bars.join(sample_order(comp), "sample")


@query("drop_zero_taxa", f"""
WITH {STD_MARKER}, {MOCK},
 z AS (SELECT genus, sample, CASE WHEN genus LIKE '%1' THEN 0.0 ELSE abundance END AS abundance FROM obs)
SELECT genus, sample, round(abundance, 9) AS abundance FROM z WHERE genus IN (SELECT genus FROM z GROUP BY genus HAVING bool_or(abundance <> 0))""")
def q_drop_zero_taxa(fx):
    long, ab, taxa, syn = _inputs(fx)
    obs = M.observed_genus(long, synonyms=syn)
    z = obs.withColumn("abundance", F.when(F.col("genus").endswith("1"), F.lit(0.0)).otherwise(F.col("abundance")))
    return M.drop_zero_rows(z.select("genus", "sample", "abundance"), key="genus")
