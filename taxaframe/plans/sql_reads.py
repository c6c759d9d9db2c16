"""DuckDB re-statements of the read-cleaning contracts, used only by oracle texts."""

from __future__ import annotations

from taxaframe.operators.reads import PASSED, TRUSEQ_ADAPTER, CleanConfig


def wsum(q: str, w: int) -> str:
    terms = " + ".join(f"ascii(substr({q}, i + {j}, 1))" for j in range(w))
    return f"({terms} - {33 * w})"


def windows(q: str, w: int, pred: str) -> str:
    return f"list_filter(range(1, length({q}) - {w} + 2), lambda i: {wsum(q, w)} {pred})"


def keep(s: str, q: str, start: str, length: str) -> tuple[str, str]:
    st, ln = f"greatest({start}, 1)", f"greatest({length}, 0)"
    return f"substr({s}, {st}, {ln})", f"substr({q}, {st}, {ln})"


def step_cte(name: str, prev: str, fn) -> str:
    parts = []
    for m in (1, 2):
        s, q = fn(f"seq{m}", f"qual{m}", m)
        parts += [f"{s} AS seq{m}", f"{q} AS qual{m}"]
    return f"{name} AS (SELECT * REPLACE ({', '.join(parts)}) FROM {prev})"


def trim_fixed(cut):
    def fn(s, q, m):
        f, t = cut[m]
        return keep(s, q, str(f + 1), f"length({s}) - {f} - {t}")
    return fn


def cut_front(w=4, qv=20):
    def fn(s, q, m):
        start = f"coalesce({windows(q, w, f'>= {qv * w}')}[1], length({s}) + 1)"
        return keep(s, q, start, f"length({s}) - {start} + 1")
    return fn


def cut_right(w=4, qv=20):
    def fn(s, q, m):
        k = f"coalesce({windows(q, w, f'< {qv * w}')}[1] - 1, length({s}))"
        return keep(s, q, "1", k)
    return fn


def cut_tail(w=4, qv=20):
    def fn(s, q, m):
        k = f"coalesce({windows(q, w, f'>= {qv * w}')}[-1] + {w - 1}, 0)"
        return keep(s, q, "1", k)
    return fn


def poly(pattern: str):
    def fn(s, q, m):
        return keep(s, q, "1", f"length(regexp_replace({s}, '{pattern}', ''))")
    return fn


POLY_G = "G{10,}$"
POLY_X = "(A{10,}|C{10,}|G{10,}|T{10,})$"


def adapter(ad: str = TRUSEQ_ADAPTER, min_len: int = 4):
    def fn(s, q, m):
        cases = " ".join(
            f"WHEN ends_with({s}, '{ad[:k]}') THEN length({s}) - {k}" for k in range(len(ad) - 1, min_len - 1, -1)
        )
        k = f"CASE WHEN instr({s}, '{ad}') > 0 THEN instr({s}, '{ad}') - 1 {cases} ELSE length({s}) END"
        return keep(s, q, "1", k)
    return fn


def count_below(q: str, t: int) -> str:
    hi = chr(33 + t - 1)
    return f"(length({q}) - length(regexp_replace({q}, '[!-{hi}]', '', 'g')))"


def n_count(s: str) -> str:
    return f"(length({s}) - length(replace({s}, 'N', '')))"


def gc_count(s: str) -> str:
    return f"(length({s}) - length(regexp_replace({s}, '[GC]', '', 'g')))"


def quality_sum(q: str) -> str:
    return f"coalesce(list_sum(list_transform(range(1, length({q}) + 1), lambda i: ascii(substr({q}, i, 1)) - 33)), 0)"


def complexity_diffs(s: str) -> str:
    return f"length(list_filter(range(1, length({s})), lambda i: substr({s}, i, 1) <> substr({s}, i + 1, 1)))"


def mate_reason(s: str, q: str, cfg: CleanConfig) -> str:
    low = f"{count_below(q, cfg.qualified_quality_phred)} * 100 > length({s}) * {cfg.unqualified_percent_limit}"
    if cfg.average_qual > 0:
        low = f"({low} OR {quality_sum(q)} < length({s}) * {cfg.average_qual})"
    parts = [f"WHEN {low} THEN 'low_quality'", f"WHEN {n_count(s)} > {cfg.n_base_limit} THEN 'too_many_n'",
             f"WHEN length({s}) < {cfg.length_required} THEN 'too_short'"]
    if cfg.length_limit > 0:
        parts.append(f"WHEN length({s}) > {cfg.length_limit} THEN 'too_long'")
    if cfg.low_complexity_filter:
        parts.append(f"WHEN {complexity_diffs(s)} * 100 < (length({s}) - 1) * {cfg.complexity_threshold} THEN 'low_complexity'")
    return f"CASE {' '.join(parts)} ELSE '{PASSED}' END"


def pair_reason(cfg: CleanConfig) -> str:
    r1, r2 = mate_reason("seq1", "qual1", cfg), mate_reason("seq2", "qual2", cfg)
    return f"CASE WHEN {r1} <> '{PASSED}' THEN {r1} ELSE {r2} END"


# every offset of every pair by its Hamming distance; the first that qualifies is taken
def overlap_ctes(src: str) -> str:
    """CTEs ending in ``ro`` = ``src`` with off, ov and mm of the overlap (nulls when none)."""
    return f"""
 r AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, reverse(translate(seq2, 'ACGTN', 'TGCAN')) AS rc, reverse(qual2) AS rq FROM {src}),
 o AS (SELECT rid, seq1, rc, unnest(list_concat(range(0, length(seq1) - 29), list_transform(range(1, length(rc) - 29), lambda k: -k))) AS off
   FROM r WHERE length(seq1) >= 30 AND length(rc) >= 30),
 v AS (SELECT *, least(length(seq1) - greatest(off, 0), length(rc) - greatest(-off, 0)) AS ov FROM o),
 h AS (SELECT rid, off, ov, hamming(substr(seq1, greatest(off, 0) + 1, ov), substr(rc, greatest(-off, 0) + 1, ov)) AS mm FROM v),
 hit AS (SELECT rid, arg_min({{'off': off, 'ov': ov, 'mm': mm}}, CASE WHEN off >= 0 THEN off ELSE 1000000 - off END) AS b FROM h WHERE mm <= 5 GROUP BY rid),
 ro AS (SELECT r.*, hit.b.off AS off, hit.b.ov AS ov, hit.b.mm AS mm FROM r LEFT JOIN hit ON r.rid = hit.rid)"""


def corrected(own: str, own_q: str, other: str, other_q: str, sign: str, value: str) -> str:
    """Text of a mate whose weak bases (or their qualities) are taken from the place that faces them."""
    there = f"i {sign} off"
    return (f"array_to_string(list_transform(range(1, length({own}) + 1), lambda i: CASE WHEN {there} BETWEEN 1 AND length({other}) "
            f"AND {own}[i] <> {other}[{there}] AND ascii({own_q}[i]) - 33 <= 14 AND ascii({other_q}[{there}]) - 33 >= 30 "
            f"THEN {value}[{there}] ELSE {own if value == other else own_q}[i] END), '')")


#: s1, q1, s2, q2 of ``ro``: mate 1 and reversed mate 2 after correction
CORRECTED = (f"{corrected('seq1', 'qual1', 'rc', 'rq', '-', 'rc')} AS s1, {corrected('seq1', 'qual1', 'rc', 'rq', '-', 'rq')} AS q1, "
             f"{corrected('rc', 'rq', 'seq1', 'qual1', '+', 'seq1')} AS s2, {corrected('rc', 'rq', 'seq1', 'qual1', '+', 'qual1')} AS q2")


def learned_adapters(src: str, min_pairs: int) -> str:
    """CTE ``learned`` (sample, mate, adapter, pairs, tails) from ``src`` with off."""
    return f"""tails AS (SELECT sample, 1 AS mate, substr(seq1, off + length(seq2) + 1, 13) AS adapter FROM {src} WHERE off < 0
   UNION ALL SELECT sample, 2, substr(seq2, off + length(seq2) + 1, 13) FROM {src} WHERE off < 0),
 counted AS (SELECT sample, mate, adapter, count(*) AS pairs FROM tails WHERE length(adapter) = 13 AND NOT contains(adapter, 'N') GROUP BY ALL),
 learned AS (SELECT sample, mate, adapter, pairs, CAST(tails AS BIGINT) AS tails FROM (SELECT *, sum(pairs) OVER (PARTITION BY sample, mate) AS tails,
   row_number() OVER (PARTITION BY sample, mate ORDER BY pairs DESC, adapter) AS rn FROM counted) WHERE rn = 1 AND pairs >= {min_pairs} AND pairs * 2 >= tails)"""


def trim_chain(cfg: CleanConfig, src: str = "fx_reads", until_overlap: bool = False) -> tuple[list[str], str]:
    """CTEs for R1-R7 and the overlap steps under ``cfg``; returns (ctes, last name)."""
    ctes, prev, i = [], src, 0

    def add(fn):
        nonlocal prev, i
        i += 1
        name = f"t{i}"
        ctes.append(step_cte(name, prev, fn))
        prev = name

    if any((cfg.trim_front1, cfg.trim_tail1, cfg.trim_front2, cfg.trim_tail2)):
        add(trim_fixed({1: (cfg.trim_front1, cfg.trim_tail1), 2: (cfg.trim_front2, cfg.trim_tail2)}))
    if cfg.cut_front:
        add(cut_front(cfg.cut_window_size, cfg.cut_mean_quality))
    if cfg.cut_right:
        add(cut_right(cfg.cut_window_size, cfg.cut_mean_quality))
    elif cfg.cut_tail:
        add(cut_tail(cfg.cut_window_size, cfg.cut_mean_quality))
    if cfg.trim_poly_g and not cfg.disable_trim_poly_g:
        add(poly(POLY_G))
    if cfg.detect_adapter_for_pe or cfg.correction:
        ctes.append(overlap_ctes(prev))
        prev = "ro"
        if cfg.correction:
            ctes.append(f"fixed AS (SELECT *, {CORRECTED} FROM ro WHERE mm > 0)")
            ctes.append("oc AS (SELECT * EXCLUDE (rid, rc, rq, ov, mm) FROM ro WHERE coalesce(mm, 0) = 0 UNION ALL "
                        "SELECT * EXCLUDE (rid, rc, rq, ov, mm, s1, q1, s2, q2) REPLACE (s1 AS seq1, q1 AS qual1, reverse(translate(s2, 'ACGTN', 'TGCAN')) AS seq2, reverse(q2) AS qual2) FROM fixed)")
            prev = "oc"
    if until_overlap:
        return ctes, prev
    given = {1: cfg.adapter, 2: cfg.adapter_r2 or cfg.adapter}
    if cfg.detect_adapter_for_pe:
        ctes.append(learned_adapters(prev, cfg.adapter_pairs))
        ctes.append(f"wide AS (SELECT x.*, x.off + length(x.seq2) AS ins, coalesce(x.off < 0, false) AS through, a.adapter AS ad1, b.adapter AS ad2 FROM {prev} x "
                    "LEFT JOIN learned a ON a.sample = x.sample AND a.mate = 1 LEFT JOIN learned b ON b.sample = x.sample AND b.mate = 2)")
        cols = []
        for m in (1, 2):
            s, q = f"seq{m}", f"qual{m}"
            ad = f"'{given[m]}'" if given[m] else f"ad{m}"
            cases = " ".join(f"WHEN ends_with({s}, substr({ad}, 1, {k})) THEN length({s}) - {k}" for k in range(12, cfg.adapter_min - 1, -1))
            left = f"CASE WHEN through THEN least(length({s}), ins) WHEN {ad} IS NULL THEN length({s}) WHEN instr({s}, {ad}) > 0 THEN instr({s}, {ad}) - 1 {cases} ELSE length({s}) END"
            cols += [f"substr({s}, 1, {left}) AS {s}", f"substr({q}, 1, {left}) AS {q}"]
        ctes.append(f"ad AS (SELECT * EXCLUDE (off, ins, through, ad1, ad2) REPLACE ({', '.join(cols)}) FROM wide)")
        prev = "ad"
    elif given[1]:
        add(lambda s, q, m: adapter(given[m], cfg.adapter_min)(s, q, m))
    if cfg.trim_poly_x:
        add(poly(POLY_X))
    return ctes, prev


def cleaned(cfg: CleanConfig, src: str = "fx_reads") -> str:
    """CTE list ending in ``cl`` = trimmed reads with ``reason``."""
    ctes, last = trim_chain(cfg, src)
    ctes.append(f"cl0 AS (SELECT *, {pair_reason(cfg)} AS reason FROM {last})")
    if cfg.dedup:
        ctes.append(
            "keep AS (SELECT sample, ordinal, read_id FROM (SELECT sample, ordinal, read_id, row_number() OVER (PARTITION BY sample, seq1, seq2 ORDER BY ordinal, read_id) AS rn "
            f"FROM {src}) WHERE rn = 1)"
        )
        ctes.append(
            "cl AS (SELECT * REPLACE (CASE WHEN reason = 'passed' AND (sample, ordinal, read_id) NOT IN (SELECT (sample, ordinal, read_id) FROM keep) THEN 'duplicate' ELSE reason END AS reason) FROM cl0)"
        )
    else:
        ctes.append("cl AS (SELECT * FROM cl0)")
    return ", ".join(ctes)


def mate_totals(prefix: str) -> str:
    def both(f):
        return f"{f('seq1', 'qual1')} + {f('seq2', 'qual2')}"

    return ", ".join([
        f"count(*) * 2 AS reads_{prefix}",
        f"CAST(sum({both(lambda s, q: f'length({s})')}) AS BIGINT) AS bases_{prefix}",
        f"CAST(sum({both(lambda s, q: f'(length({q}) - {count_below(q, 20)})')}) AS BIGINT) AS q20_{prefix}",
        f"CAST(sum({both(lambda s, q: f'(length({q}) - {count_below(q, 30)})')}) AS BIGINT) AS q30_{prefix}",
        f"CAST(sum({both(lambda s, q: gc_count(s))}) AS BIGINT) AS gc_{prefix}",
    ])
