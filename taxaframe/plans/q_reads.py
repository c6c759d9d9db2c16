"""Queries of the read-cleaning job (trims, filters, dedup, subsample, mate sync)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from taxaframe.functions.sequence import revcomp
from taxaframe.operators import reads as RD
from taxaframe.plans import sql_reads as Q
from taxaframe.plans.registry import query

OUT = "sample, read_id, seq1, qual1, seq2, qual2"
OUT_COLS = ["sample", "read_id", "seq1", "qual1", "seq2", "qual2"]

# demo configuration of the whole job: everything the reference can switch on
CLEAN_ALL = RD.CleanConfig(adapter=RD.TRUSEQ_ADAPTER, trim_poly_g=True, dedup=True, low_complexity_filter=True,
                           cut_right=True, average_qual=20, length_limit=95)
CLEAN_DEFAULT = RD.CleanConfig(adapter=RD.TRUSEQ_ADAPTER)


def _step_sql(fn) -> str:
    return f"WITH {Q.step_cte('t1', 'fx_reads', fn)} SELECT {OUT} FROM t1"


@query("trim_fixed", _step_sql(Q.trim_fixed({1: (5, 3), 2: (2, 4)})))
def q_trim_fixed(fx):
    return RD.trim_fixed(fx.reads, 5, 3, 2, 4).select(*OUT_COLS)


@query("cut_front", _step_sql(Q.cut_front(4, 20)))
def q_cut_front(fx):
    return RD.cut_front(fx.reads, 4, 20).select(*OUT_COLS)


@query("cut_right", _step_sql(Q.cut_right(4, 20)))
def q_cut_right(fx):
    return RD.cut_right(fx.reads, 4, 20).select(*OUT_COLS)


@query("cut_tail", _step_sql(Q.cut_tail(4, 20)))
def q_cut_tail(fx):
    return RD.cut_tail(fx.reads, 4, 20).select(*OUT_COLS)


@query("trim_poly_g", _step_sql(Q.poly(Q.POLY_G)))
def q_trim_poly_g(fx):
    return RD.trim_poly_g(fx.reads).select(*OUT_COLS)


@query("trim_poly_x", _step_sql(Q.poly(Q.POLY_X)))
def q_trim_poly_x(fx):
    return RD.trim_poly_x(fx.reads).select(*OUT_COLS)


@query("trim_adapter", _step_sql(Q.adapter()))
def q_trim_adapter(fx):
    return RD.trim_adapter(fx.reads).select(*OUT_COLS)


def _filter_sql(cfg, src_ctes="", src="fx_reads") -> str:
    pre = f"WITH {src_ctes} " if src_ctes else ""
    return f"{pre}SELECT sample, read_id, CAST(length(seq1) AS INTEGER) AS len1, CAST(length(seq2) AS INTEGER) AS len2 FROM {src} WHERE {Q.pair_reason(cfg)} = 'passed'"


def _kept(df, cfg):
    return RD.filter_pairs(df, cfg).select("sample", "read_id", F.length("seq1").alias("len1"), F.length("seq2").alias("len2"))


@query("filter_quality", _filter_sql(RD.CleanConfig()))
def q_filter_quality(fx):
    return _kept(fx.reads, RD.CleanConfig())


@query("filter_avg_qual", _filter_sql(RD.CleanConfig(average_qual=25)))
def q_filter_avg_qual(fx):
    return _kept(fx.reads, RD.CleanConfig(average_qual=25))


@query("filter_n", _filter_sql(RD.CleanConfig(n_base_limit=2)))
def q_filter_n(fx):
    return _kept(fx.reads, RD.CleanConfig(n_base_limit=2))


_LEN_CFG = RD.CleanConfig(length_required=20, length_limit=95)


@query("filter_length", _filter_sql(_LEN_CFG, ", ".join([
    Q.step_cte("t1", "fx_reads", Q.poly(Q.POLY_G)), Q.step_cte("t2", "t1", Q.adapter()),
    Q.step_cte("t3", "t2", Q.trim_fixed({1: (0, 0), 2: (0, 5)}))]), "t3"))
def q_filter_length(fx):
    r = RD.trim_fixed(RD.trim_adapter(RD.trim_poly_g(fx.reads)), 0, 0, 0, 5)
    return _kept(r, _LEN_CFG)


_CPX_CFG = RD.CleanConfig(low_complexity_filter=True)


@query("filter_complexity", _filter_sql(_CPX_CFG))
def q_filter_complexity(fx):
    return _kept(fx.reads, _CPX_CFG)


@query("dedup_pairs", f"""
SELECT {OUT} FROM (SELECT *, row_number() OVER (PARTITION BY sample, seq1, seq2 ORDER BY ordinal, read_id) AS rn FROM fx_reads) WHERE rn = 1""")
def q_dedup_pairs(fx):
    return RD.dedup_keepers(fx.reads).select(*OUT_COLS)


@query("clean_summary", f"WITH {Q.cleaned(CLEAN_ALL)} SELECT sample, reason, count(*) AS pairs FROM cl GROUP BY 1, 2")
def q_clean_summary(fx):
    return RD.clean_summary(fx.reads, CLEAN_ALL)


def _totals_sql(cfg, src="fx_reads") -> str:
    return f"""
WITH {Q.cleaned(cfg, src)},
 b AS (SELECT sample, {Q.mate_totals('before')} FROM {src} GROUP BY sample),
 a AS (SELECT sample, {Q.mate_totals('after')} FROM cl WHERE reason = 'passed' GROUP BY sample),
 totals AS (SELECT b.*, coalesce(a.reads_after, 0) AS reads_after, coalesce(a.bases_after, 0) AS bases_after, coalesce(a.q20_after, 0) AS q20_after,
   coalesce(a.q30_after, 0) AS q30_after, coalesce(a.gc_after, 0) AS gc_after FROM b LEFT JOIN a ON a.sample = b.sample)
"""


_TOTALS_SQL = _totals_sql(CLEAN_DEFAULT)


@query("clean_totals", _TOTALS_SQL + "SELECT * FROM totals")
def q_clean_totals(fx):
    return RD.clean_totals(fx.reads, CLEAN_DEFAULT)


# the job with its overlap steps: read-through cut, adapters learned per sample, corrected bases; poly-G is switched off again
CLEAN_PE = RD.CleanConfig(detect_adapter_for_pe=True, correction=True, trim_poly_g=True, disable_trim_poly_g=True, cut_tail=True, trim_poly_x=True, dedup=True)
CLEAN_R2 = RD.CleanConfig(detect_adapter_for_pe=True, adapter="AGATCGGAAGAGC", adapter_r2="AGATCGGAAGAGC", length_limit=99)
_PE_CTES, _PE_LAST = Q.trim_chain(CLEAN_PE, "fx_reads_pe", until_overlap=True)


@query("detect_adapters", f"WITH {', '.join([*_PE_CTES, Q.learned_adapters(_PE_LAST, 10)])} SELECT * FROM learned")
def q_detect_adapters(fx):
    return RD.detect_adapters(fx.reads_pe, CLEAN_PE)


@query("clean_pe_reads", f"WITH {Q.cleaned(CLEAN_PE, 'fx_reads_pe')} SELECT {OUT}, reason FROM cl")
def q_clean_pe_reads(fx):
    return RD.clean_reads(fx.reads_pe, CLEAN_PE).select(*OUT_COLS, "reason")


@query("clean_pe_summary", f"WITH {Q.cleaned(CLEAN_PE, 'fx_reads_pe')} SELECT sample, reason, count(*) AS pairs FROM cl GROUP BY 1, 2")
def q_clean_pe_summary(fx):
    return RD.clean_summary(fx.reads_pe, CLEAN_PE)


@query("clean_pe_totals", _totals_sql(CLEAN_R2, "fx_reads_pe") + "SELECT * FROM totals")
def q_clean_pe_totals(fx):
    return RD.clean_totals(fx.reads_pe, CLEAN_R2)


@query("subsample", """
SELECT sample, read_id FROM (SELECT sample, read_id, row_number() OVER (PARTITION BY sample ORDER BY md5(read_id || ':100'), read_id) AS rn FROM fx_reads)
WHERE rn <= 2000""")
def q_subsample(fx):
    return RD.subsample(fx.reads, 2000, seed=100).select("sample", "read_id")


@query("sync_mates", f"""
WITH m1 AS (SELECT sample, read_id, seq1 AS seq, qual1 AS qual FROM fx_reads WHERE {Q.n_count('seq1')} <= 5),
 m2 AS (SELECT sample, read_id, seq2 AS seq, qual2 AS qual FROM fx_reads)
SELECT a.sample, a.read_id, a.seq AS seq1, a.qual AS qual1, b.seq AS seq2, b.qual AS qual2
FROM m1 a JOIN m2 b ON a.sample = b.sample AND a.read_id = b.read_id WHERE length(a.seq) >= 15 AND length(b.seq) >= 15""")
def q_sync_mates(fx):
    from taxaframe.functions.sequence import n_count

    r = fx.reads
    m1 = r.filter(n_count("seq1") <= 5).select("sample", "read_id", F.col("seq1").alias("seq"), F.col("qual1").alias("qual"))
    m2 = r.select("sample", "read_id", F.col("seq2").alias("seq"), F.col("qual2").alias("qual"))
    return RD.sync_mates(m1, m2, 15).select(*OUT_COLS)


@query("adapter_candidates", """
WITH s AS (SELECT sample, 1 AS mate, seq1 AS seq FROM fx_reads UNION ALL SELECT sample, 2, seq2 FROM fx_reads),
 t AS (SELECT sample, mate, substr(seq, greatest(length(seq) - 30 + 1, 1), 30) AS t FROM s),
 k AS (SELECT sample, mate, unnest(list_transform(range(1, length(t) - 10 + 2), lambda i: substr(t, i, 10))) AS kmer FROM t WHERE length(t) >= 10),
 c AS (SELECT sample, mate, kmer, count(*) AS n FROM k GROUP BY 1, 2, 3)
SELECT sample, mate, kmer, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY sample, mate ORDER BY n DESC, kmer) AS rank FROM c) WHERE rank <= 5""")
def q_adapter_candidates(fx):
    return RD.adapter_candidates(fx.reads, k=10, tail=30, top=5)


@query("revcomp", "SELECT read_id, reverse(translate(seq2, 'ACGTN', 'TGCAN')) AS rc2 FROM fx_reads")
def q_revcomp(fx):
    return fx.reads.select("read_id", revcomp("seq2").alias("rc2"))


_OVERLAP_SQL = Q.overlap_ctes("fx_reads")


@query("read_overlap", f"""
WITH {_OVERLAP_SQL}
SELECT sample, read_id, CAST(off AS INTEGER) AS overlap_offset, CAST(ov AS INTEGER) AS overlap_len, CAST(mm AS INTEGER) AS mismatches,
  CAST(off + length(seq2) AS INTEGER) AS insert_size FROM ro""")
def q_read_overlap(fx):
    from taxaframe.operators.overlap import overlap

    return overlap(fx.reads).select("sample", "read_id", "overlap_offset", "overlap_len", "mismatches", "insert_size")


@query("overlap_correction", f"""
WITH {_OVERLAP_SQL},
 c AS (SELECT *, {Q.CORRECTED} FROM ro WHERE mm > 0)
SELECT sample, read_id, seq1, qual1, seq2, qual2, CAST(0 AS INTEGER) AS corrected FROM ro WHERE coalesce(mm, 0) = 0
UNION ALL SELECT sample, read_id, s1, q1, reverse(translate(s2, 'ACGTN', 'TGCAN')), reverse(q2),
  CAST(hamming(seq1, s1) + hamming(rc, s2) AS INTEGER) FROM c""")
def q_overlap_correction(fx):
    from taxaframe.operators.overlap import correct_overlap

    return correct_overlap(fx.reads).select(*OUT_COLS, "corrected")


__all__ = ["CLEAN_ALL", "CLEAN_DEFAULT", "replace"]
