"""Paired-read cleaning as one Spark job: trims, filters, dedup, subsample, mate sync.

Reads table (T2): ``sample, ordinal, read_id, seq1, qual1, seq2, qual2``.
Every step is a column expression applied to both mates; a pair fails when
either mate fails. Steps never look across rows except deduplication, subsample
and mate sync, which are aggregations / joins keyed so that a hot sequence or a
deep sample is combined map-side instead of landing in one task.

Contracts here are this engine's own (the reference delegates the algorithm):

* window cuts use integer window sums: mean >= q  <=>  sum >= q * w;
* ``cut_front``: drop bases before the first window (5'->3') with mean >= q; none -> empty;
* ``cut_right``: drop the first window with mean < q and everything after it;
* ``cut_tail``: keep up to the end of the last window (3'->5') with mean >= q; none -> empty;
* adapter: cut at the first exact occurrence, else at the longest 3' suffix equal to an
  adapter prefix of at least ``adapter_min`` bases;
* poly-G / poly-X: exact 3' runs of at least ``poly_min`` bases;
* read-through: where mate 2 (reverse complement) starts before mate 1, the insert is shorter than the
  reads, and both mates are cut to the insert; such a pair needs no adapter cut by sequence;
* a sample's adapter of a mate is the most frequent start of what lies behind the inserts of its
  read-through pairs, if that is at least half of those starts and occurs ``adapter_pairs`` times.

The whole job runs R1-R5, overlap (correction, read-through), adapters, R7, then the filters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaframe.functions.bloom import may_match
from taxaframe.functions.kernels import base_changes, before_adapter, phred_sum, window_index
from taxaframe.functions.sequence import count_below, gc_count, n_count
from taxaframe.session import stored

# Reason codes of the cleaning outcome, in the order they are tested.
PASSED = "passed"
LOW_QUALITY = "low_quality"
TOO_MANY_N = "too_many_n"
TOO_SHORT = "too_short"
TOO_LONG = "too_long"
LOW_COMPLEXITY = "low_complexity"
DUPLICATE = "duplicate"
REASONS = [PASSED, LOW_QUALITY, TOO_MANY_N, TOO_SHORT, TOO_LONG, LOW_COMPLEXITY, DUPLICATE]
# Illumina TruSeq adapter prefix (public, used when adapters are "detected")
TRUSEQ_ADAPTER = "AGATCGGAAGAGC"


@dataclass
class CleanConfig:
    """Defaults follow the reference's parameter file."""

    qualified_quality_phred: int = 15
    unqualified_percent_limit: int = 40
    n_base_limit: int = 5
    average_qual: int = 0
    length_required: int = 15
    length_limit: int = 0
    adapter: str | None = None
    adapter_r2: str | None = None  # mate 2; None: as mate 1
    adapter_min: int = 4
    detect_adapter_for_pe: bool = False  # cut read-through by overlap, learn adapters that are not given
    adapter_pairs: int = 10
    correction: bool = False
    trim_front1: int = 0
    trim_tail1: int = 0
    trim_front2: int = 0
    trim_tail2: int = 0
    cut_front: bool = False
    cut_tail: bool = False
    cut_right: bool = False
    cut_window_size: int = 4
    cut_mean_quality: int = 20
    trim_poly_g: bool = False
    disable_trim_poly_g: bool = False  # wins over trim_poly_g
    trim_poly_x: bool = False
    poly_min: int = 10
    dedup: bool = False
    low_complexity_filter: bool = False
    complexity_threshold: int = 30


MATES = (1, 2)


# Trims are tracked as an integer window (start, length) over the untouched
# sequence and applied by one substr at the end. Each step reads the current
# window once, so expression size grows linearly with the number of steps even
# when Catalyst inlines the chain into a pushed-down filter.

def _begin(df: DataFrame) -> DataFrame:
    for m in MATES:
        df = df.withColumn(f"_st{m}", F.lit(1)).withColumn(f"_ln{m}", F.length(f"seq{m}"))
    return df


def _cur(m: int, what: str = "seq") -> Column:
    return F.col(f"{what}{m}").substr(F.col(f"_st{m}"), F.col(f"_ln{m}"))


def _finish(df: DataFrame) -> DataFrame:
    for m in MATES:
        df = df.withColumn(f"seq{m}", _cur(m, "seq")).withColumn(f"qual{m}", _cur(m, "qual"))
    return df.drop(*[f"_{x}{m}" for x in ("st", "ln") for m in MATES])


def _set(df: DataFrame, m: int, start: Column | None, length: Column) -> DataFrame:
    if start is not None:
        df = df.withColumn(f"_st{m}", start)
    return df.withColumn(f"_ln{m}", F.greatest(length, F.lit(0)))


def _fixed(df: DataFrame, cut: dict) -> DataFrame:
    for m in MATES:
        f, t = cut[m]
        if f or t:
            df = _set(df, m, F.col(f"_st{m}") + f, F.col(f"_ln{m}") - f - t)
    return df


def before_run(bases: str, min_len: int):
    """Function of a sequence: bases left without a 3' run of at least ``min_len`` of one of ``bases``."""
    def left(s: Column) -> Column:
        ends = [F.length(F.rtrim(s, F.lit(b))) for b in bases]
        end = F.least(*ends) if len(ends) > 1 else ends[0]
        return F.when(F.length(s) - end >= min_len, end).otherwise(F.length(s))

    return left


def _keep(df: DataFrame, left: dict) -> DataFrame:
    """Keep the prefix whose length is what ``left`` of each mate finds: both mates in one step, so that kernels are one, too."""
    return df.withColumns({f"_ln{m}": F.greatest(left[m](_cur(m)), F.lit(0)) for m in left})


def _window(df: DataFrame, w: int, q: int, mode: str) -> DataFrame:
    """Window cuts: the window start is found by a vectorised Arrow kernel over the
    current quality window (see ``functions.kernels``)."""
    idx = window_index(w, q * w, mode)
    df = df.withColumns({f"_w{m}": idx(_cur(m, "qual")) for m in MATES})
    for m in MATES:
        st, ln, i = F.col(f"_st{m}"), F.col(f"_ln{m}"), F.col(f"_w{m}")
        if mode == "front":  # drop bases before the first good window; none -> empty
            drop = F.coalesce(i - 1, ln)
            df = _set(df, m, st + drop, ln - drop)
        elif mode == "right":  # keep bases before the first bad window
            df = _set(df, m, None, F.coalesce(i - 1, ln))
        else:  # tail: keep up to the end of the last good window
            df = _set(df, m, None, F.coalesce(i + (w - 1), F.lit(0)))
        df = df.drop(f"_w{m}")
    return df


def adapter_pattern(adapter: str, min_len: int = 4) -> str:
    """The contract of the adapter cut as a regex (the kernel ``before_adapter`` is tested against it), removing the adapter from its first exact occurrence to the 3' end, or else
    the longest 3' suffix that equals an adapter prefix of at least ``min_len`` bases.

    Leftmost-match semantics give exactly that: an exact hit always starts before
    any partial suffix, and among suffixes the leftmost is the longest.
    """
    nested = ""
    for ch in reversed(adapter[min_len:-1]):
        nested = f"(?:{ch}{nested})?"
    return f"{adapter}.*$|{adapter[:min_len]}{nested}$"


# -- trims ------------------------------------------------------------------------------

def trim_fixed(reads: DataFrame, front1=0, tail1=0, front2=0, tail2=0) -> DataFrame:
    """Drop a fixed number of bases at the 5' and 3' ends of each mate."""
    return _finish(_fixed(_begin(reads), {1: (front1, tail1), 2: (front2, tail2)}))


def cut_front(reads: DataFrame, w: int = 4, q: int = 20) -> DataFrame:
    """R2: from 5', drop bases before the first window with mean >= q (none -> empty)."""
    return _finish(_window(_begin(reads), w, q, "front"))


def cut_right(reads: DataFrame, w: int = 4, q: int = 20) -> DataFrame:
    """The first window with mean < q is cut with everything to its right."""
    return _finish(_window(_begin(reads), w, q, "right"))


def cut_tail(reads: DataFrame, w: int = 4, q: int = 20) -> DataFrame:
    """From 3', keep up to the end of the last window with mean >= q (none -> empty)."""
    return _finish(_window(_begin(reads), w, q, "tail"))


def trim_poly_g(reads: DataFrame, min_len: int = 10) -> DataFrame:
    """Cut a 3' run of at least ``min_len`` G."""
    left = before_run("G", min_len)
    return _finish(_keep(_begin(reads), {1: left, 2: left}))


def trim_poly_x(reads: DataFrame, min_len: int = 10) -> DataFrame:
    """Cut a 3' run of at least ``min_len`` of any one base."""
    left = before_run("ACGT", min_len)
    return _finish(_keep(_begin(reads), {1: left, 2: left}))


def trim_adapter(reads: DataFrame, adapter: str = TRUSEQ_ADAPTER, adapter_r2: str | None = None, min_len: int = 4) -> DataFrame:
    """Cut each mate at its adapter (mate 2 uses ``adapter_r2`` or the same sequence)."""
    return _finish(_keep(_begin(reads), {1: before_adapter(adapter, min_len), 2: before_adapter(adapter_r2 or adapter, min_len)}))


# -- per-mate filters -------------------------------------------------------------------

def complexity_diffs(s: Column) -> Column:
    """Number of positions whose base differs from the next one."""
    return base_changes(s)


def mate_reason(s: Column, q: Column, cfg: CleanConfig) -> Column:
    """Reason a single mate fails (or 'passed'); tests in the order of ``REASONS``."""
    ln = F.length(s)
    low = count_below(q, cfg.qualified_quality_phred) * 100 > ln * cfg.unqualified_percent_limit
    if cfg.average_qual > 0:
        low = low | (phred_sum(q) < ln * cfg.average_qual)
    reason = (
        F.when(low, LOW_QUALITY)
        .when(n_count(s) > cfg.n_base_limit, TOO_MANY_N)
        .when(ln < cfg.length_required, TOO_SHORT)
    )
    if cfg.length_limit > 0:
        reason = reason.when(ln > cfg.length_limit, TOO_LONG)
    if cfg.low_complexity_filter:
        reason = reason.when(complexity_diffs(s) * 100 < (ln - 1) * cfg.complexity_threshold, LOW_COMPLEXITY)
    return reason.otherwise(PASSED)


def pair_reason(cfg: CleanConfig) -> Column:
    r1 = mate_reason(F.col("seq1"), F.col("qual1"), cfg)
    r2 = mate_reason(F.col("seq2"), F.col("qual2"), cfg)
    return F.when(r1 != PASSED, r1).otherwise(r2)


def filter_pairs(reads: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Keep pairs whose two mates pass every enabled filter."""
    return reads.filter(pair_reason(cfg) == PASSED)


# -- whole job --------------------------------------------------------------------------

#: bases behind an insert by which an adapter is learned (the length of the common adapter prefix)
ADAPTER_START = len(TRUSEQ_ADAPTER)


def _trim_ends(df: DataFrame, cfg: CleanConfig) -> DataFrame:
    """R1-R5 on tracked windows."""
    df = _fixed(df, {1: (cfg.trim_front1, cfg.trim_tail1), 2: (cfg.trim_front2, cfg.trim_tail2)})
    if cfg.cut_front:
        df = _window(df, cfg.cut_window_size, cfg.cut_mean_quality, "front")
    if cfg.cut_right:
        df = _window(df, cfg.cut_window_size, cfg.cut_mean_quality, "right")
    elif cfg.cut_tail:
        df = _window(df, cfg.cut_window_size, cfg.cut_mean_quality, "tail")
    if cfg.trim_poly_g and not cfg.disable_trim_poly_g:
        left = before_run("G", cfg.poly_min)
        df = _keep(df, {1: left, 2: left})
    return df


def _overlapped(reads: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Reads after R1-R5 with the place of their overlap, corrected if asked."""
    from taxaframe.operators.overlap import locate_overlap

    return locate_overlap(_finish(_trim_ends(_begin(reads), cfg)), cfg.correction)


def adapter_starts(overlapped: DataFrame, min_pairs: int = 10) -> DataFrame:
    """Learned adapters (sample, mate, adapter, pairs, tails) from reads with ``overlap_offset`` and ``insert_size``.

    Tails are counted per text map-side; a sample's list of distinct tails is ranked by a partial top-1.
    """
    from pyspark.sql import Window

    start = F.col("insert_size") + 1
    tails = F.explode(F.array(*[F.struct(F.lit(m).alias("mate"), F.col(f"seq{m}").substr(start, F.lit(ADAPTER_START)).alias("adapter")) for m in MATES]))
    through = overlapped.filter(F.col("overlap_offset") < 0).select("sample", tails.alias("t")).select("sample", "t.*")
    counts = through.filter((F.length("adapter") == ADAPTER_START) & ~F.col("adapter").contains("N")).groupBy("sample", "mate", "adapter").agg(F.count("*").alias("pairs"))
    total = counts.groupBy("sample", "mate").agg(F.sum("pairs").alias("tails"))
    first = Window.partitionBy("sample", "mate").orderBy(F.desc("pairs"), "adapter")
    best = counts.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")
    return best.join(total, ["sample", "mate"]).filter((F.col("pairs") >= min_pairs) & (F.col("pairs") * 2 >= F.col("tails"))).select("sample", "mate", "adapter", "pairs", "tails")


def detect_adapters(reads: DataFrame, cfg: CleanConfig) -> DataFrame:
    """R8 for pairs: adapters of every sample and mate, learned from all its read-through pairs.

    Corrections are made inside overlaps and tails lie behind them, so this search needs none, nor qualities and names.
    """
    from taxaframe.operators.overlap import locate_overlap

    trimmed = _finish(_trim_ends(_begin(reads), cfg)).select("sample", "seq1", "seq2")
    return adapter_starts(locate_overlap(trimmed), cfg.adapter_pairs)


def _adapter_length(s: Column, adapter: Column, min_len: int) -> Column:
    """Length left of ``s`` at an adapter that is a column (null: whole): first exact place, else the longest 3' suffix that is its prefix."""
    at, out = F.instr(s, adapter), None
    out = F.when(at > 0, at - 1)
    for n in range(ADAPTER_START - 1, min_len - 1, -1):
        out = out.when(F.endswith(s, F.substring(adapter, 1, n)), F.length(s) - n)
    return F.when(adapter.isNull(), F.length(s)).otherwise(out.otherwise(F.length(s)))


def _given(cfg: CleanConfig) -> dict:
    return {1: cfg.adapter, 2: cfg.adapter_r2 or cfg.adapter}


def learned_adapters(reads: DataFrame, cfg: CleanConfig) -> DataFrame | None:
    """(sample, _ad1, _ad2): the adapters that a job on ``reads`` learns, a row per sample, kept as a table; None if all are given."""
    if not cfg.detect_adapter_for_pe or all(_given(cfg).values()):
        return None
    by_mate = [F.max(F.when(F.col("mate") == m, F.col("adapter"))).alias(f"_ad{m}") for m in MATES]
    return stored(detect_adapters(reads, cfg).groupBy("sample").agg(*by_mate), "adapters")


def trim_all(reads: DataFrame, cfg: CleanConfig, learned: DataFrame | None = None) -> DataFrame:
    """R1-R7 with the overlap steps R9 and R10 where asked; substrings are taken before the overlap search and at the end.
    ``learned`` are the adapters of the whole job where ``reads`` is a part of it."""
    given = _given(cfg)
    through = F.lit(False)
    if cfg.detect_adapter_for_pe or cfg.correction:
        located = _overlapped(reads, cfg)
        df = _begin(located)
        if cfg.detect_adapter_for_pe:
            through = F.coalesce(F.col("overlap_offset") < 0, F.lit(False))
            for m in MATES:
                df = _set(df, m, None, F.when(through, F.least(F.col(f"_ln{m}"), "insert_size")).otherwise(F.col(f"_ln{m}")))
            if not all(given.values()):
                df = df.join(learned if learned is not None else learned_adapters(reads, cfg), "sample", "left")  # a row per sample: broadcast by its size
    else:
        df = _trim_ends(_begin(reads), cfg)
    cuts = {}
    for m in MATES:
        if given[m]:
            cuts[m] = before_adapter(given[m], cfg.adapter_min)
        elif cfg.detect_adapter_for_pe:
            cuts[m] = lambda s, m=m: _adapter_length(s, F.col(f"_ad{m}"), cfg.adapter_min)
    if cfg.detect_adapter_for_pe:
        cuts = {m: lambda s, m=m, cut=cut: F.when(through, F.col(f"_ln{m}")).otherwise(cut(s)) for m, cut in cuts.items()}
    df = _keep(df, cuts) if cuts else df
    if cfg.trim_poly_x:
        kept = before_run("ACGT", cfg.poly_min)
        df = _keep(df, {1: kept, 2: kept})
    return _finish(df).drop("corrected", "overlap_offset", "insert_size", "_ad1", "_ad2")


def _pair_key() -> Column:
    """SHA-256 of both sequences (a null mate differs from an empty one): what identical pairs share, without carrying their bases."""
    mate = [F.coalesce(F.concat(F.length(f"seq{m}").cast("string"), F.lit(":"), F.col(f"seq{m}")), F.lit("-")) for m in MATES]
    return F.unhex(F.sha2(F.concat(*mate).cast("binary"), 256))


def _first_pairs(reads: DataFrame) -> DataFrame:
    """(sample, _key, ordinal, read_id) of the smallest (ordinal, read_id) of every identical (seq1, seq2) in a sample.

    Partial aggregation collapses a hot sequence map-side, to a row of ids and a digest per task.
    """
    best = reads.groupBy("sample", _pair_key().alias("_key")).agg(F.min(F.struct("ordinal", "read_id")).alias("k"))
    return best.select("sample", "_key", "k.ordinal", "k.read_id")


PAIR = ["sample", "ordinal", "read_id"]


def _may_repeat(reads: DataFrame) -> Column | None:
    """Condition that holds for every pair whose (sample, seq1, seq2) occurs again, and for few others; None if too many occur again.

    The shuffle carries a 64-bit hash a pair; hashes that occur again go into a Bloom filter.
    """
    on = [F.col(c) for c in ("sample", "seq1", "seq2")]
    again = reads.select(F.xxhash64(*on).alias("h")).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    return may_match(stored(again, "repeated"), on)


def _named(named: bool = True) -> Column:
    """Whether all parts of a pair's name are there: a join on names finds no other pair."""
    there = F.lit(True)
    for c in PAIR:
        there = there & F.col(c).isNotNull()
    return there if named else ~there


def dedup_keepers(reads: DataFrame) -> DataFrame:
    """One pair per identical (seq1, seq2) in a sample: the smallest (ordinal, read_id, qualities).

    Only pairs that may occur again are shuffled, the others are kept where they are.
    """
    may = _may_repeat(reads)
    if may is None:
        return _keepers(reads)
    columns = ["sample", "ordinal", "read_id", "seq1", "qual1", "seq2", "qual2"]
    return reads.filter(~may & _named()).select(*columns).unionByName(_keepers(reads.filter(may)))


def _keepers(reads: DataFrame) -> DataFrame:
    """The aggregation sees ids and digests; only kept pairs bring their sequences, by a join on their names."""
    key = ["sample", "_key", "ordinal", "read_id"]
    named = reads.select("sample", "ordinal", "read_id", "seq1", "qual1", "seq2", "qual2", _pair_key().alias("_key"))
    kept = named.join(_first_pairs(reads), key, "left_semi")
    # repeated rows of one name are one pair; the join has brought them together
    one = kept.groupBy(*key).agg(F.min(F.struct("qual1", "qual2")).alias("q"), F.first("seq1").alias("seq1"), F.first("seq2").alias("seq2"))
    return one.select("sample", "ordinal", "read_id", "seq1", "q.qual1", "seq2", "q.qual2")


def clean_reads(reads: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Trim and classify every pair: the reads with a ``reason`` column ('passed' = kept)."""
    learned = learned_adapters(reads, cfg)

    def classified(part: DataFrame) -> DataFrame:
        return trim_all(part, cfg, learned).withColumn("reason", pair_reason(cfg))

    def marked(out: DataFrame, again: Column) -> DataFrame:
        return out.withColumn("reason", F.when((F.col("reason") == PASSED) & again, DUPLICATE).otherwise(F.col("reason")))

    def without_repeats(part: DataFrame) -> DataFrame:
        # read ids repeat across samples: a pair is named by sample, ordinal and id
        keepers = _first_pairs(part).select(*PAIR).distinct().withColumn("_keeper", F.lit(True))
        return marked(classified(part).join(keepers, PAIR, "left"), F.col("_keeper").isNull()).drop("_keeper")

    if not cfg.dedup:
        return classified(reads)
    may = _may_repeat(reads)
    if may is None:
        return without_repeats(reads)
    return marked(classified(reads.filter(~may)), _named(False)).unionByName(without_repeats(reads.filter(may)))


def clean_summary(reads: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Pairs per (sample, reason)."""
    return clean_reads(reads, cfg).groupBy("sample", "reason").agg(F.count("*").alias("pairs"))


def _pair_totals() -> dict[str, Column]:
    """Bases, Q20/Q30 bases and GC bases of a pair."""
    def both(f):
        return f(F.col("seq1"), F.col("qual1")) + f(F.col("seq2"), F.col("qual2"))

    return {
        "bases": both(lambda s, q: F.length(s)),
        "q20": both(lambda s, q: F.length(q) - count_below(q, 20)),
        "q30": both(lambda s, q: F.length(q) - count_below(q, 30)),
        "gc": both(lambda s, q: gc_count(s)),
    }


def clean_totals(reads: DataFrame, cfg: CleanConfig) -> DataFrame:
    """R17 totals: reads, bases, Q20/Q30 bases and GC bases before and after cleaning, per sample.

    One pass: a pair brings its numbers from before into the cleaning job, which keeps every pair.
    """
    names = ["bases", "q20", "q30", "gc"]
    counted = reads.select("*", *[c.alias(f"_{n}") for n, c in _pair_totals().items()])
    cleaned = clean_reads(counted, cfg)
    # conditional sums instead of a filter: nothing for Catalyst to push into the trim chain
    passed = (F.col("reason") == PASSED) & F.col("sample").isNotNull()  # pairs without a sample are summed up before only
    before = [F.sum(F.lit(2)).cast("bigint").alias("reads_before")] + [F.sum(f"_{n}").cast("bigint").alias(f"{n}_before") for n in names]
    own = {"reads": F.lit(2), **_pair_totals()}
    after = [F.sum(F.when(passed, c).otherwise(F.lit(0))).cast("bigint").alias(f"{n}_after") for n, c in own.items()]
    return cleaned.groupBy("sample").agg(*before, *after).na.fill(0)


# -- sampling, sync, discovery ----------------------------------------------------------

def subsample(reads: DataFrame, n: int, seed: int = 100, margin_sigma: float = 10.0) -> DataFrame:
    """Exactly min(n, size) pairs per sample: the n smallest by a seeded hash of the
    read id (both mates together; ties by read id).

    Skew-safe: every pair gets a uniform key u in [0, 1) from the hash; a per-sample
    threshold t = (n + margin*sqrt(n) + 100) / size keeps ~n candidates, so a deep
    sample ranks about n rows, not its whole depth. u is monotone in the hash order,
    so when a sample keeps at least min(n, size) candidates its n smallest are among
    them; samples short of that (vanishingly rare) are ranked from all their pairs.
    The rank is a ``row_number() <= n`` (WindowGroupLimit, partial before the shuffle).
    """
    from pyspark.sql import Window

    h = F.md5(F.concat(F.col("read_id"), F.lit(f":{seed}")))
    u = F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / float(16 ** 12)
    sizes = reads.groupBy("sample").agg(F.count("*").alias("_size"))
    thr = F.least(F.lit(1.0), (F.lit(n + margin_sigma * n ** 0.5 + 100)) / F.col("_size"))
    tagged = reads.join(sizes, "sample").withColumn("_h", h)
    cand = tagged.filter(u <= thr)
    counts = cand.groupBy("sample").agg(F.count("*").alias("_c"))
    short = sizes.join(counts, "sample", "left").filter(F.coalesce("_c", F.lit(0)) < F.least(F.lit(n), F.col("_size"))).select("sample")
    w = Window.partitionBy("sample").orderBy(F.col("_h"), F.col("read_id"))

    def top(df):
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn", "_h", "_size")

    return top(cand.join(short, "sample", "left_anti")).unionByName(top(tagged.join(short, "sample", "left_semi")))


def sync_mates(mate1: DataFrame, mate2: DataFrame, min_len: int = 15) -> DataFrame:
    """Pairs whose read id is in both mate tables and both mates are long enough."""
    a = mate1.filter(F.length("seq") >= min_len).select("sample", "read_id", F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    b = mate2.filter(F.length("seq") >= min_len).select("sample", "read_id", F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    return a.join(b, ["sample", "read_id"], "inner")


def adapter_candidates(reads: DataFrame, k: int = 10, tail: int = 30, top: int = 5) -> DataFrame:
    """Most frequent k-mers among the last ``tail`` bases of each mate, per sample and mate (top ``top``).

    Counts are combined map-side; the top list of a sample's mate is a WindowGroupLimit.
    """
    from pyspark.sql import Window

    s = F.col("s")
    t = s.substr(F.greatest(F.length(s) - tail + 1, F.lit(1)), F.lit(tail))
    starts = F.sequence(F.lit(1), F.greatest(F.length("t") - k + 1, F.lit(1)))
    mates = reads.select("sample", F.posexplode(F.array("seq1", "seq2")).alias("m", "s"))
    km = mates.select("sample", (F.col("m") + 1).alias("mate"), t.alias("t")).filter(F.length("t") >= k).select(
        "sample", "mate", F.explode(F.transform(starts, lambda i: F.col("t").substr(i, F.lit(k)))).alias("kmer")
    )
    counts = km.groupBy("sample", "mate", "kmer").agg(F.count("*").alias("n"))
    w = Window.partitionBy("sample", "mate").orderBy(F.desc("n"), F.asc("kmer"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
