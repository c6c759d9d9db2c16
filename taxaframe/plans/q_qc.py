"""Queries of the read-quality aggregates (raw and clean stages) and the cross-sample report."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaframe.operators import kmer as KM
from taxaframe.operators import qc as QC
from taxaframe.operators import reads as RD
from taxaframe.plans import sql_reads as Q
from taxaframe.plans.q_reads import CLEAN_DEFAULT
from taxaframe.plans.registry import REGISTRY, query
from taxaframe.session import stored

K = "stage, sample, mate"


def _mates_sql(stage: str, src: str) -> str:
    return (f"SELECT '{stage}' AS stage, sample, 1 AS mate, read_id, seq1 AS seq, qual1 AS qual FROM {src} "
            f"UNION ALL SELECT '{stage}', sample, 2, read_id, seq2, qual2 FROM {src}")


# the clean stage: cleaned pairs that neither the host nor the spike-in catalogue claims, both mates long enough
_CLEAN_SQL = f"""{Q.cleaned(CLEAN_DEFAULT)},
 ok AS (SELECT * FROM cl WHERE reason = 'passed' AND length(seq1) >= 15 AND length(seq2) >= 15),
 okm AS (SELECT sample, read_id, 1 AS mate, seq1 AS seq FROM ok UNION ALL SELECT sample, read_id, 2, seq2 FROM ok),
 okk AS (SELECT sample, read_id, mate, least(km, reverse(translate(km, 'ACGT', 'TGCA'))) AS kmer FROM (
   SELECT sample, read_id, mate, unnest(list_transform(range(1, length(seq) - 31 + 2), lambda i: substr(seq, i, 31))) AS km FROM okm WHERE length(seq) >= 31) WHERE NOT contains(km, 'N')),
 known AS (SELECT DISTINCT kmer, CASE WHEN species % 20 = 0 THEN 'host' ELSE 'spike' END AS source FROM fx_kmer_windows WHERE species % 20 = 0 OR species = 1007),
 claims AS (SELECT sample, read_id, mate, source FROM okk JOIN known USING (kmer) GROUP BY ALL HAVING count(*) >= 5),
 claimed AS (SELECT DISTINCT sample, read_id FROM (SELECT sample, read_id, source FROM claims GROUP BY ALL HAVING count(*) = 2)),
 clean AS (SELECT ok.* FROM ok LEFT JOIN claimed USING (sample, read_id) WHERE claimed.read_id IS NULL)"""
BOTH = f"{_CLEAN_SQL}, m AS ({_mates_sql('raw', 'fx_reads')} UNION ALL {_mates_sql('clean', 'clean')})"


def _catalogues(fx):
    windows = fx.kmer_windows
    return {"host": windows.filter(F.col("species") % 20 == 0), "spike": windows.filter(F.col("species") == 1007)}


def _named_once(fx):
    # copies of a read are numbered in its name, so a name stands twice only where a genome does
    return fx.genome.groupBy("genome_id").count().filter("count > 1").isEmpty()


def _clean_reads(fx):
    kept = RD.clean_reads(fx.reads, CLEAN_DEFAULT).filter(F.col("reason") == RD.PASSED).drop("reason")
    return KM.decontaminate(kept, _catalogues(fx), named_once=_named_once(fx))


def _staged(fx):
    """Every read as it is and cleaned, with the stages that it belongs to. The raw and the clean stage are one pass over the reads."""
    def cleaned(reads):
        own = [F.col(c).alias(f"raw_{c}") for c in ("seq1", "qual1", "seq2", "qual2")]
        return RD.clean_reads(reads.select("*", *own), CLEAN_DEFAULT)

    return KM.decontaminate_marked(cleaned(fx.reads), F.col("reason") == RD.PASSED, lambda named: cleaned(fx.reads_where(named)), _catalogues(fx), named_once=_named_once(fx))


def _both(fx):
    return QC.staged_mates(_staged(fx))


BASIC = f"""SELECT {K}, count(*) AS reads, CAST(sum(length(seq)) AS BIGINT) AS bases, CAST(min(length(seq)) AS INTEGER) AS min_len,
  CAST(max(length(seq)) AS INTEGER) AS max_len, round(sum({Q.gc_count('seq')}) * 100.0::DOUBLE / sum(length(seq)), 9) AS gc_pct FROM m GROUP BY {K}"""


@query("qc_basic", f"WITH {BOTH} {BASIC}")
def q_qc_basic(fx):
    return QC.qc_basic(_both(fx))


POS = f"p AS (SELECT {K}, pos, substr(seq, pos, 1) AS base, ascii(substr(qual, pos, 1)) - 33 AS score FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS pos FROM m WHERE length(seq) > 0))"


@query("qc_pos_quality", f"""
WITH {BOTH}, {POS}, a AS (SELECT {K}, pos, avg(score) AS mean, quantile_cont(score, [0.1, 0.25, 0.5, 0.75, 0.9]) AS q FROM p GROUP BY {K}, pos)
SELECT {K}, CAST(pos AS INTEGER) AS pos, round(mean, 9) AS mean, round(q[1], 9) AS p10, round(q[2], 9) AS q25, round(q[3], 9) AS median,
  round(q[4], 9) AS q75, round(q[5], 9) AS p90 FROM a""")
def q_qc_pos_quality(fx):
    return QC.qc_pos_quality(_both(fx))


@query("qc_read_quality", f"""
WITH {BOTH} SELECT {K}, CAST(floor({Q.quality_sum('qual')} / length(qual)) AS INTEGER) AS mean_quality, count(*) AS reads
FROM m WHERE length(qual) > 0 GROUP BY ALL""")
def q_qc_read_quality(fx):
    return QC.qc_read_quality(_both(fx))


@query("qc_base_content", f"""
WITH {BOTH}, {POS} SELECT {K}, CAST(pos AS INTEGER) AS pos,
  {', '.join(f"round(sum(CASE WHEN base = '{b}' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 9) AS pct_{b.lower()}" for b in 'ACGTN')}
FROM p GROUP BY {K}, pos""")
def q_qc_base_content(fx):
    return QC.qc_base_content(_both(fx))


@query("qc_n_content", f"""
WITH {BOTH}, {POS} SELECT {K}, CAST(pos AS INTEGER) AS pos, round(sum(CASE WHEN base = 'N' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 9) AS pct_n
FROM p GROUP BY {K}, pos""")
def q_qc_n_content(fx):
    return QC.qc_n_content(_both(fx))


@query("qc_gc_hist", f"""
WITH {BOTH} SELECT {K}, CAST(round({Q.gc_count('seq')} * 100.0::DOUBLE / length(seq)) AS INTEGER) AS gc_pct, count(*) AS reads
FROM m WHERE length(seq) > 0 GROUP BY ALL""")
def q_qc_gc_hist(fx):
    return QC.qc_gc_hist(_both(fx))


@query("qc_length_hist", f"WITH {BOTH} SELECT {K}, CAST(length(seq) AS INTEGER) AS length, count(*) AS reads FROM m GROUP BY ALL")
def q_qc_length_hist(fx):
    return QC.qc_length_hist(_both(fx))


SEQC = f"c AS (SELECT {K}, seq, count(*) AS n FROM m GROUP BY {K}, seq)"


@query("qc_duplication", f"""
WITH {BOTH}, {SEQC},
 lv AS (SELECT {K}, n AS level, count(*) AS sequences, CAST(sum(n) AS BIGINT) AS reads FROM c GROUP BY {K}, n),
 t AS (SELECT {K}, round(count(*) * 100.0::DOUBLE / sum(n), 9) AS pct_remaining FROM c GROUP BY {K})
SELECT lv.*, t.pct_remaining FROM lv JOIN t USING (stage, sample, mate)""")
def q_qc_duplication(fx):
    return QC.qc_duplication(_both(fx))


@query("qc_overrepresented", f"""
WITH {BOTH}, {SEQC}, t AS (SELECT {K}, sum(n) AS total FROM c GROUP BY {K})
SELECT c.stage, c.sample, c.mate, c.seq, c.n AS count, round(c.n * 100.0::DOUBLE / t.total, 9) AS pct
FROM c JOIN t USING (stage, sample, mate) WHERE c.n * 100.0::DOUBLE / t.total > 0.1""")
def q_qc_overrepresented(fx):
    return QC.qc_overrepresented(_both(fx))


@query("qc_adapter", f"""
WITH {BOTH},
 s AS (SELECT {K}, instr(seq, '{RD.TRUSEQ_ADAPTER}') AS pos, count(*) AS n FROM m WHERE instr(seq, '{RD.TRUSEQ_ADAPTER}') > 0 GROUP BY ALL),
 b AS (SELECT {K}, count(*) AS reads, max(length(seq)) AS maxlen FROM m GROUP BY {K}),
 g AS (SELECT {K}, reads, unnest(range(1, greatest(maxlen, 1) + 1)) AS pos FROM b)
SELECT g.stage, g.sample, g.mate, CAST(g.pos AS INTEGER) AS pos,
  round(sum(coalesce(s.n, 0)) OVER (PARTITION BY g.stage, g.sample, g.mate ORDER BY g.pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0::DOUBLE / g.reads, 9) AS pct_adapter
FROM g LEFT JOIN s ON s.stage = g.stage AND s.sample = g.sample AND s.mate = g.mate AND s.pos = g.pos""")
def q_qc_adapter(fx):
    return QC.qc_adapter(_both(fx))


@query("qc_kmer", f"""
WITH {BOTH},
 k AS (SELECT {K}, pos, substr(seq, pos, 5) AS kmer FROM (SELECT *, unnest(range(1, length(seq) - 5 + 2)) AS pos FROM m WHERE length(seq) >= 5)),
 pp AS (SELECT {K}, kmer, pos, count(*) AS n FROM k WHERE NOT contains(kmer, 'N') GROUP BY ALL),
 tot AS (SELECT stage, sample, mate, kmer, sum(n) AS total FROM pp GROUP BY ALL),
 ap AS (SELECT stage, sample, mate, pos, sum(n) AS at_pos FROM pp GROUP BY ALL),
 al AS (SELECT stage, sample, mate, sum(n) AS in_all FROM pp GROUP BY ALL),
 r AS (SELECT pp.*, tot.total, pp.n::DOUBLE * al.in_all / (tot.total::DOUBLE * ap.at_pos) AS ratio FROM pp JOIN tot USING (stage, sample, mate, kmer)
   JOIN ap USING (stage, sample, mate, pos) JOIN al USING (stage, sample, mate)),
 one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stage, sample, mate, kmer ORDER BY ratio DESC, pos) AS rr FROM r) WHERE rr = 1),
 rk AS (SELECT *, row_number() OVER (PARTITION BY stage, sample, mate ORDER BY ratio DESC, kmer) AS rank FROM one)
SELECT {K}, kmer, CAST(total AS BIGINT) AS total, CAST(pos AS INTEGER) AS max_pos, round(ratio, 9) AS ratio, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 10""")
def q_qc_kmer(fx):
    return QC.qc_kmer(_both(fx), k=5, top=10)


@query("qc_delta", f"""
WITH {BOTH}, b AS ({BASIC}),
 r AS (SELECT sample, mate, reads AS reads_raw, gc_pct AS gc_raw FROM b WHERE stage = 'raw'),
 c AS (SELECT sample, mate, reads AS reads_clean, gc_pct AS gc_clean FROM b WHERE stage = 'clean')
SELECT r.sample, r.mate, r.reads_raw, coalesce(c.reads_clean, 0) AS reads_clean,
  round(coalesce(c.reads_clean, 0) * 100.0::DOUBLE / r.reads_raw, 9) AS pct_kept, round(c.gc_clean - r.gc_raw, 9) AS gc_delta
FROM r LEFT JOIN c ON r.sample = c.sample AND r.mate = c.mate""")
def q_qc_delta(fx):
    basic = QC.qc_basic(_both(fx)).withColumn("gc_pct", F.round("gc_pct", 9))
    return QC.qc_delta(basic)


TOTAL_KEYS = [f"{m}_{s}" for s in ("before", "after") for m in ("reads", "bases", "q20", "q30", "gc")]


def _clean_rows(fx):
    t = RD.clean_totals(fx.reads, CLEAN_DEFAULT)
    rows = QC.to_metrics(t.withColumn("stage", F.lit("clean")).withColumn("mate", F.lit(0)), "fastp", ["stage", "sample", "mate"], TOTAL_KEYS)
    return rows.select("stage", "sample", "mate", "module", "key", "value")


def _clean_rows_sql() -> str:
    from taxaframe.plans.q_reads import _TOTALS_SQL

    body = _TOTALS_SQL.strip()[len("WITH"):]
    sel = " UNION ALL ".join(
        f"SELECT 'clean' AS stage, sample, 0 AS mate, 'fastp' AS module, '{k}' AS key, CAST({k} AS DOUBLE) AS value FROM totals" for k in TOTAL_KEYS
    )
    return body, sel


_CR_BODY, _CR_SEL = _clean_rows_sql()


@query("qc_clean_rows", f"WITH {_CR_BODY} {_CR_SEL}")
def q_qc_clean_rows(fx):
    return _clean_rows(fx)


BASIC_KEYS = ["reads", "bases", "min_len", "max_len", "gc_pct"]
REPORT_METRICS = [f"{st}_basic_{k}_r{m}" for st in ("raw", "clean") for m in (1, 2) for k in BASIC_KEYS] + [f"clean_fastp_{k}" for k in TOTAL_KEYS]

#: module -> (its query, columns that tell its rows apart, values)
MODULES = {
    "basic": ("qc_basic", [], BASIC_KEYS),
    "pos_quality": ("qc_pos_quality", ["pos"], ["mean", "p10", "q25", "median", "q75", "p90"]),
    "read_quality": ("qc_read_quality", ["mean_quality"], ["reads"]),
    "base_content": ("qc_base_content", ["pos"], [f"pct_{b}" for b in "acgtn"]),
    "gc_hist": ("qc_gc_hist", ["gc_pct"], ["reads"]),
    "length_hist": ("qc_length_hist", ["length"], ["reads"]),
    "duplication": ("qc_duplication", ["level"], ["sequences", "reads", "pct_remaining"]),
    "overrepresented": ("qc_overrepresented", ["seq"], ["count", "pct"]),
    "adapter": ("qc_adapter", ["pos"], ["pct_adapter"]),
    "kmer": ("qc_kmer", ["kmer"], ["total", "max_pos", "ratio", "rank"]),
}


def _rows_sql(module: str) -> tuple[str, str]:
    """CTE of a module's table, and its T16 rows."""
    name, at, values = MODULES[module]
    body = REGISTRY[name].oracle.strip()[len(f"WITH {BOTH}"):].strip()
    table = f"m_{module} AS ({'WITH ' + body[1:] if body.startswith(',') else body})"
    place = " || ',' || ".join(f"'{c}=' || CAST({c} AS VARCHAR)" for c in at)
    rows = " UNION ALL ".join(
        f"SELECT {K}, '{module}' AS module, {place + f" || ':{v}'" if at else f"'{v}'"} AS key, CAST({v} AS DOUBLE) AS value FROM m_{module}" for v in values
    )
    return table, rows


_TABLES, _ROWS = zip(*[_rows_sql(m) for m in MODULES])
_FASTP = f"""b AS (SELECT sample, {Q.mate_totals('before')} FROM fx_reads GROUP BY sample),
 a AS (SELECT sample, {Q.mate_totals('after')} FROM cl WHERE reason = 'passed' GROUP BY sample),
 totals AS (SELECT b.*, coalesce(a.reads_after, 0) AS reads_after, coalesce(a.bases_after, 0) AS bases_after, coalesce(a.q20_after, 0) AS q20_after,
   coalesce(a.q30_after, 0) AS q30_after, coalesce(a.gc_after, 0) AS gc_after FROM b LEFT JOIN a ON a.sample = b.sample)"""


@query("qc_report", f"WITH {BOTH}, {_FASTP}, {', '.join(_TABLES)} {' UNION ALL '.join(_ROWS)} UNION ALL {_CR_SEL}")
def q_qc_report(fx):
    # the clean stage is a table, as ten modules read it
    both = QC.mates(fx.reads, "raw").unionByName(QC.mates(stored(_clean_reads(fx), "clean_reads"), "clean"))
    return QC.union_rows([QC.report_rows(both), _clean_rows(fx)])


_WIDE = ", ".join(f"round(max(value) FILTER (WHERE metric = '{m}'), 9) AS \"{m}\"" for m in REPORT_METRICS)


@query("qc_report_wide", f"""
WITH {BOTH}, {_FASTP}, {_TABLES[0]}, rows AS ({_ROWS[0]} UNION ALL {_CR_SEL}),
 named AS (SELECT *, stage || '_' || module || '_' || key || CASE WHEN mate > 0 THEN '_r' || CAST(mate AS VARCHAR) ELSE '' END AS metric FROM rows)
SELECT sample, {_WIDE} FROM named GROUP BY sample""")
def q_qc_report_wide(fx):
    rows = QC.to_metrics(QC.qc_basic(_both(fx)), "basic", QC.KEYS, BASIC_KEYS)
    return QC.qc_report([rows, _clean_rows(fx)], REPORT_METRICS).select("sample", *[F.col(f"`{m}`") for m in REPORT_METRICS])
