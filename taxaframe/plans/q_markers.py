"""Queries of marker-based profiling and strain-level tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaframe.operators import markers as MK
from taxaframe.operators import strain as ST
from taxaframe.plans.registry import query
from taxaframe.plans.snippets import STD_MARKER

Q = 0.2
CLADE = "Brand_1"

FA = "fa AS (SELECT * FROM fx_alignment WHERE mapq >= 5 AND read_len >= 70)"
IGN = "ign AS (SELECT marker_id FROM fx_marker WHERE len = 110)"
AL = f"{FA}, {IGN}, al AS (SELECT * FROM fa WHERE marker_id NOT IN (SELECT marker_id FROM ign))"
MC = f"""{AL},
 hits AS (SELECT sample, marker_id, count(DISTINCT read_id) AS n FROM al GROUP BY 1, 2),
 seen AS (SELECT DISTINCT h.sample, m.clade FROM hits h JOIN fx_marker m ON m.marker_id = h.marker_id),
 mc AS (SELECT s.sample, s.clade, m.marker_id, m.len, CAST(coalesce(h.n, 0) AS BIGINT) AS n FROM seen s JOIN fx_marker m ON m.clade = s.clade
   LEFT JOIN hits h ON h.sample = s.sample AND h.marker_id = m.marker_id)"""
STATS = f"""{MC},
 r AS (SELECT *, n / len AS v, row_number() OVER (PARTITION BY sample, clade ORDER BY n / len, marker_id) AS rk,
   count(*) OVER (PARTITION BY sample, clade) AS m FROM mc),
 r2 AS (SELECT *, CAST(floor(m * {Q}::DOUBLE) AS BIGINT) AS cut FROM r),
 fk AS (SELECT sample, clade, n AS fn, len AS fl, v AS fv FROM r2 WHERE rk = cut + 1),
 lk AS (SELECT sample, clade, n AS hn, len AS hl, v AS hv FROM r2 WHERE rk = m - cut),
 stats AS (SELECT r2.sample, r2.clade, any_value(m) AS markers,
   coalesce(sum(n) / nullif(sum(len), 0), 0) AS avg_g, avg(v) AS avg_l,
   coalesce(sum(n) FILTER (WHERE rk BETWEEN cut + 1 AND m - cut) / nullif(sum(len) FILTER (WHERE rk BETWEEN cut + 1 AND m - cut), 0), 0) AS tavg_g,
   coalesce(avg(v) FILTER (WHERE rk BETWEEN cut + 1 AND m - cut), 0) AS tavg_l,
   coalesce(sum(CASE WHEN rk < cut + 1 THEN fn WHEN rk > m - cut THEN hn ELSE n END)
     / nullif(sum(CASE WHEN rk < cut + 1 THEN fl WHEN rk > m - cut THEN hl ELSE len END), 0), 0) AS wavg_g,
   avg(CASE WHEN rk < cut + 1 THEN fv WHEN rk > m - cut THEN hv ELSE v END) AS wavg_l,
   quantile_cont(v, 0.5) AS med
  FROM r2 JOIN fk ON fk.sample = r2.sample AND fk.clade = r2.clade JOIN lk ON lk.sample = r2.sample AND lk.clade = r2.clade GROUP BY 1, 2),
 pres AS (SELECT sample, clade, avg(CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS nonzero FROM mc GROUP BY 1, 2),
 ra AS (SELECT s.sample, s.clade, coalesce(s.tavg_g / nullif(sum(s.tavg_g) OVER (PARTITION BY s.sample), 0), 0) * 100 AS rel_ab
   FROM stats s JOIN pres p ON p.sample = s.sample AND p.clade = s.clade WHERE p.nonzero >= 0.33)"""


def _aln(fx):
    return MK.filter_alignments(fx.alignment)


def _ignored(fx):
    return fx.marker.filter(F.col("len") == 110).select("marker_id")


def _al(fx):
    return MK.ignore_markers(_aln(fx), _ignored(fx))


def _counts(fx):
    return MK.marker_counts(_al(fx), fx.marker)


def _stats(fx):
    return MK.clade_stats(_counts(fx), Q)


@query("kingdom_exclude", f"""
WITH {STD_MARKER}, k AS (SELECT * FROM std WHERE split_part(tax_id, ';', 1) NOT IN ('k__ECONOMY', 'k__PROMO'))
SELECT sample, tax_id, round(coalesce(abundance / nullif(sum(abundance) OVER (PARTITION BY sample), 0), 0), 9) AS abundance FROM k""")
def q_kingdom_exclude(fx):
    return MK.exclude_kingdoms(fx.profiles_long, ["k__ECONOMY", "k__PROMO"])


@query("aln_filter", f"WITH {FA} SELECT sample, read_id, marker_id, mapq, read_len FROM fa")
def q_aln_filter(fx):
    return _aln(fx).select("sample", "read_id", "marker_id", "mapq", "read_len")


@query("ignore_markers", f"WITH {AL} SELECT sample, read_id, marker_id FROM al")
def q_ignore_markers(fx):
    return _al(fx).select("sample", "read_id", "marker_id")


@query("clade_markers", f"""
WITH {FA} SELECT marker_id, clade, lineage, len FROM fx_marker WHERE clade = '{CLADE}' AND marker_id IN (SELECT marker_id FROM fa)""")
def q_clade_markers(fx):
    return MK.clade_markers(fx.marker, CLADE, _aln(fx)).select("marker_id", "clade", "lineage", "len")


@query("marker_counts", f"WITH {MC} SELECT sample, clade, marker_id, len, n FROM mc")
def q_marker_counts(fx):
    return _counts(fx)


@query("clade_presence", f"WITH {STATS} SELECT sample, clade, round(nonzero, 9) AS nonzero, nonzero >= 0.33 AS present FROM pres")
def q_clade_presence(fx):
    return MK.clade_presence(_counts(fx))


@query("clade_tavg_g", f"WITH {STATS} SELECT sample, clade, round(tavg_g, 9) AS tavg_g FROM stats")
def q_clade_tavg_g(fx):
    return _stats(fx).select("sample", "clade", "tavg_g")


@query("clade_stats_all", f"""
WITH {STATS} SELECT sample, clade, markers, {', '.join(f'round({s}, 9) AS {s}' for s in MK.STATS)} FROM stats""")
def q_clade_stats_all(fx):
    return _stats(fx)


@query("rel_ab", f"WITH {STATS} SELECT sample, clade, round(rel_ab, 9) AS rel_ab FROM ra")
def q_rel_ab(fx):
    c = _counts(fx)
    return MK.rel_ab(MK.clade_stats(c, Q), MK.clade_presence(c))


@query("rel_ab_reads", f"""
WITH {STATS},
 tr AS (SELECT sample, count(*) AS reads FROM fx_reads GROUP BY 1),
 mp AS (SELECT sample, count(DISTINCT read_id) AS mapped FROM al GROUP BY 1),
 fr AS (SELECT tr.sample, tr.reads, coalesce(mp.mapped, 0) AS mapped, greatest(tr.reads - coalesce(mp.mapped, 0), 0) AS unmapped FROM tr LEFT JOIN mp ON mp.sample = tr.sample),
 est AS (SELECT a.sample, m.clade, count(DISTINCT a.read_id) AS est_reads FROM al a JOIN fx_marker m ON m.marker_id = a.marker_id GROUP BY 1, 2)
SELECT ra.sample, ra.clade, round(ra.rel_ab * fr.mapped / fr.reads, 9) AS rel_ab, round(s.tavg_g, 9) AS coverage, CAST(coalesce(e.est_reads, 0) AS BIGINT) AS est_reads
FROM ra JOIN stats s ON s.sample = ra.sample AND s.clade = ra.clade LEFT JOIN est e ON e.sample = ra.sample AND e.clade = ra.clade JOIN fr ON fr.sample = ra.sample
UNION ALL SELECT sample, 'UNCLASSIFIED', round(unmapped * 100.0::DOUBLE / reads, 9), NULL, CAST(unmapped AS BIGINT) FROM fr WHERE unmapped > 0""")
def q_rel_ab_reads(fx):
    c = _counts(fx)
    stats, pres = MK.clade_stats(c, Q), MK.clade_presence(c)
    total = fx.reads.groupBy("sample").agg(F.count("*").alias("reads"))
    return MK.rel_ab_w_read_stats(_al(fx), c, stats, pres, total)


@query("marker_ab", f"WITH {MC} SELECT sample, marker_id, round(n / len, 9) AS abundance FROM mc")
def q_marker_ab(fx):
    return MK.marker_ab(_counts(fx))


@query("marker_pres", f"WITH {MC} SELECT sample, marker_id, CASE WHEN n >= 1 THEN 1 ELSE 0 END AS present FROM mc")
def q_marker_pres(fx):
    return MK.marker_pres(_counts(fx))


@query("clade_profiles", f"""
WITH {MC} SELECT sample, clade, string_agg(CAST(marker_id AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY marker_id, n) AS profile FROM mc GROUP BY 1, 2""")
def q_clade_profiles(fx):
    return MK.clade_profiles(_counts(fx))


@query("lineage_rollup", f"""
WITH {STD_MARKER},
 e AS (SELECT sample, abundance, unnest(list_transform(range(1, len(string_split(tax_id, ';')) + 1),
   lambda i: array_to_string(string_split(tax_id, ';')[1:i], ';'))) AS tax_id FROM std)
SELECT sample, tax_id, substr(split_part(tax_id, ';', -1), 1, 1) AS rank, round(sum(abundance), 9) AS abundance FROM e GROUP BY 1, 2, 3""")
def q_lineage_rollup(fx):
    return MK.lineage_rollup(fx.profiles_long, "a")


CONS = f"""{FA},
 ex AS (SELECT sample, marker_id, pos + j AS position, substr(bases, j, 1) AS base FROM (SELECT *, unnest(range(1, length(bases) + 1)) AS j FROM fa)),
 cnt AS (SELECT sample, marker_id, position, base, count(*) AS n FROM ex GROUP BY ALL),
 cons AS (SELECT sample, marker_id, position, base, n, CAST(depth AS BIGINT) AS depth FROM (
   SELECT *, sum(n) OVER (PARTITION BY sample, marker_id, position) AS depth,
   row_number() OVER (PARTITION BY sample, marker_id, position ORDER BY n DESC, base) AS rr FROM cnt) WHERE rr = 1)"""


def _cons(fx):
    return ST.consensus(_aln(fx))


@query("consensus_base", f"WITH {CONS} SELECT * FROM cons")
def q_consensus_base(fx):
    return _cons(fx)


@query("consensus_breadth", f"""
WITH {CONS}, dep AS (SELECT sample, marker_id, count(*) AS covered, CAST(sum(depth) AS BIGINT) AS bases FROM cons GROUP BY 1, 2)
SELECT sample, marker_id, covered, bases, round(covered::DOUBLE / len, 9) AS breadth, round(bases::DOUBLE / len, 9) AS mean_depth FROM dep JOIN fx_marker USING (marker_id)""")
def q_consensus_breadth(fx):
    return ST.coverage(_aln(fx), fx.marker)


@query("strain_retention", f"""
WITH {CONS},
 cm AS (SELECT marker_id FROM fx_marker WHERE clade = '{CLADE}'),
 per AS (SELECT sample, count(DISTINCT marker_id) AS n_markers FROM cons WHERE marker_id IN (SELECT marker_id FROM cm) GROUP BY 1)
SELECT sample, n_markers, round(n_markers * 100.0::DOUBLE / (SELECT count(*) FROM cm), 9) AS pct,
  n_markers >= 10 AND n_markers * 100.0::DOUBLE / (SELECT count(*) FROM cm) >= 10 AS kept FROM per""")
def q_strain_retention(fx):
    return ST.retain_samples(_cons(fx), fx.marker, CLADE, 10, 10.0)


@query("mutation_rates", f"""
WITH {CONS}, c AS (SELECT x.*, m.clade FROM cons x JOIN fx_marker m ON m.marker_id = x.marker_id)
SELECT a.clade, a.sample AS sample_a, b.sample AS sample_b, count(*) AS common,
  CAST(sum(CASE WHEN a.base <> b.base THEN 1 ELSE 0 END) AS BIGINT) AS differing,
  round(sum(CASE WHEN a.base <> b.base THEN 1 ELSE 0 END) / count(*), 9) AS rate
FROM c a JOIN c b ON a.marker_id = b.marker_id AND a.position = b.position AND a.sample < b.sample GROUP BY 1, 2, 3""")
def q_mutation_rates(fx):
    return ST.mutation_rates(_cons(fx), fx.marker)


@query("retained_mutation_rates", f"""
WITH {CONS},
 t AS (SELECT clade, count(*) AS total FROM fx_marker GROUP BY 1),
 x AS (SELECT c.*, m.clade FROM cons c JOIN fx_marker m ON m.marker_id = c.marker_id),
 r AS (SELECT clade, sample FROM x JOIN t USING (clade) GROUP BY clade, sample, total HAVING count(DISTINCT marker_id) >= 10 AND count(DISTINCT marker_id) * 100.0::DOUBLE / total >= 10),
 c AS (SELECT x.* FROM x JOIN r ON r.clade = x.clade AND r.sample = x.sample)
SELECT a.clade, a.sample AS sample_a, b.sample AS sample_b, count(*) AS common,
  CAST(sum(CASE WHEN a.base <> b.base THEN 1 ELSE 0 END) AS BIGINT) AS differing,
  round(sum(CASE WHEN a.base <> b.base THEN 1 ELSE 0 END) / count(*), 9) AS rate
FROM c a JOIN c b ON a.marker_id = b.marker_id AND a.position = b.position AND a.sample < b.sample GROUP BY 1, 2, 3""")
def q_retained_mutation_rates(fx):
    cons = _cons(fx)
    return ST.mutation_rates(cons, fx.marker, keep=ST.retained(cons, fx.marker, 10, 10.0))
