"""Nucleotide and quality-string functions (native column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaframe.functions.kernels import count_between
from taxaframe.functions.util import as_col

# Phred+33: the quality character of score q is chr(q + 33).
PHRED_OFFSET = 33


def revcomp(c) -> Column:
    """reverse complement; N stays N."""
    return F.reverse(F.translate(as_col(c), "ACGTN", "TGCAN"))


def phred_scores(qual) -> Column:
    """Quality string -> array<int> of Phred scores."""
    q = as_col(qual)
    idx = F.when(F.length(q) > 0, F.sequence(F.lit(1), F.length(q))).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.ascii(F.substr(q, i, F.lit(1))) - PHRED_OFFSET)


def count_below(qual, threshold: int) -> Column:
    """Number of bases whose Phred score is < threshold (counted by a kernel: a regex took most of a filter's time)."""
    # characters with score < t are chr(33) .. chr(33 + t - 1)
    return count_between(PHRED_OFFSET, PHRED_OFFSET + threshold - 1)(as_col(qual))


def quality_sum(qual) -> Column:
    """Sum of Phred scores of a quality string."""
    return F.aggregate(phred_scores(qual), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def gc_count(seq) -> Column:
    without = F.replace(F.replace(as_col(seq), F.lit("G"), F.lit("")), F.lit("C"), F.lit(""))
    return F.length(as_col(seq)) - F.length(without)


def n_count(seq) -> Column:
    return F.length(as_col(seq)) - F.length(F.replace(as_col(seq), F.lit("N"), F.lit("")))
