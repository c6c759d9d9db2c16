"""Read-level operators against naive pure-Python versions on a few pairs."""

import random

import pytest
from pyspark.sql import functions as F

from taxaframe.operators import overlap as OV
from taxaframe.operators import reads as RD

COMP = str.maketrans("ACGTN", "TGCAN")


def rc(s):
    return s.translate(COMP)[::-1]


def naive_overlap(s1, s2, min_ov=30, max_mm=5):
    r = rc(s2)
    for o in range(0, len(s1) - min_ov + 1):
        ov = min(len(s1) - o, len(r))
        mm = sum(1 for j in range(ov) if s1[o + j] != r[j])
        if ov >= min_ov and mm <= max_mm:
            return o, ov, mm
    for k in range(1, len(r) - min_ov + 1):
        ov = min(len(r) - k, len(s1))
        mm = sum(1 for j in range(ov) if s1[j] != r[k + j])
        if ov >= min_ov and mm <= max_mm:
            return -k, ov, mm
    return None


def _pairs():
    rnd = random.Random(7)
    out = []
    for i in range(40):
        frag = "".join(rnd.choice("ACGT") for _ in range(rnd.choice([80, 120, 160, 200])))
        s1 = frag[:100]
        s2 = rc(frag[-100:])
        if i % 5 == 0:
            s2 = "".join(rnd.choice("ACGT") for _ in range(100))
        out.append((f"r{i}", s1, s2))
    return out


def test_overlap_matches_naive(spark):
    rows = [("s", i, rid, a, "I" * len(a), b, "I" * len(b)) for i, (rid, a, b) in enumerate(_pairs())]
    df = spark.createDataFrame(rows, "sample string, ordinal long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string")
    got = {r.read_id: (r.overlap_offset, r.overlap_len, r.mismatches) for r in OV.overlap(df).collect()}
    for rid, a, b in _pairs():
        want = naive_overlap(a, b)
        assert got[rid] == (want if want else (None, None, None)), rid


def test_overlap_correction_fixes_low_quality_base(spark):
    frag = "ACGTTGCAAGGCTTACCGATGCATGCAAGTCCGATCGATGGCAT" * 3
    s1, s2 = frag[:100], rc(frag[-100:])
    offset = len(frag) - 100  # mate 2 starts here in mate-1 coordinates
    bad = 70  # inside the overlap
    s1x = s1[:bad] + ("A" if s1[bad] != "A" else "C") + s1[bad + 1:]
    q1 = "I" * bad + "#" + "I" * (99 - bad)
    df = spark.createDataFrame([("s", 0, "r", s1x, q1, s2, "I" * 100)],
                               "sample string, ordinal long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string")
    r = OV.correct_overlap(df).first()
    assert offset < bad and r.seq1 == s1 and r.corrected == 1


@pytest.mark.parametrize("seq,keep", [
    ("ACGTACGTAGATCGGAAGAGCTTT", 8), ("ACGTACGTAGATCG", 8), ("ACGTACGTAGA", 11), ("ACGTAGATCGGAAGAGCAGATCGG", 4),
])
def test_adapter_regex_equals_rule(spark, seq, keep):
    df = spark.createDataFrame([(seq,)], "s string")
    got = df.select(F.length(F.regexp_replace("s", RD.adapter_pattern(RD.TRUSEQ_ADAPTER), ""))).first()[0]
    assert got == keep


def test_window_cuts_match_rule(spark):
    q = "IIII####IIII##"  # scores 40 and 2
    reads = spark.createDataFrame([("s", 0, "r", "ACGTACGTACGTAC", q, "ACGTACGTACGTAC", q)],
                                  "sample string, ordinal long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string")

    def naive(mode, w=4, t=20):
        sums = [sum(ord(c) - 33 for c in q[i:i + w]) for i in range(len(q) - w + 1)]
        good = [i for i, s in enumerate(sums) if s >= t * w]
        bad = [i for i, s in enumerate(sums) if s < t * w]
        if mode == "front":
            return q[good[0]:] if good else ""
        if mode == "right":
            return q[:bad[0]] if bad else q
        return q[:good[-1] + w] if good else ""

    assert RD.cut_front(reads).first().qual1 == naive("front")
    assert RD.cut_right(reads).first().qual1 == naive("right")
    assert RD.cut_tail(reads).first().qual1 == naive("tail")
