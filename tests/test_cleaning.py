"""Cleaning job with its overlap steps, decontamination chain, reports, numbering and coverage, against plain loops."""

import random
from collections import Counter, defaultdict

import pytest

from taxaframe.operators import kmer as KM
from taxaframe.operators import qc as QC
from taxaframe.operators import rank, strain
from taxaframe.operators import reads as RD

READS = "sample string, ordinal long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string"
A1, A2 = "AGATCGGAAGAGCACACGTC", "GATCGTCGGACTGTAGAACT"


def rc(s):
    return s.translate(str.maketrans("ACGTN", "TGCAN"))[::-1]


def pairs(draw, n, length=80):
    """Pairs of inserts of 35 to 140 bases; those shorter than the reads run into the adapters."""
    rows = []
    for i in range(n):
        insert = "".join(draw.choices("ACGT", k=draw.randrange(35, 140)))
        fill = "".join(draw.choices("ACGT", k=length))
        a, b = (insert + A1 + fill)[:length], (rc(insert) + A2 + fill)[:length]
        rows.append((f"S{i % 2}", i, f"r{i}", a, "I" * length, b, "I" * length, len(insert)))
    return rows


def test_read_through_is_cut_to_the_insert(spark):
    rows = pairs(random.Random(1), 300)
    df = spark.createDataFrame([r[:7] for r in rows], READS)
    cfg = RD.CleanConfig(detect_adapter_for_pe=True)
    learned = {(r["sample"], r["mate"]): r["adapter"] for r in RD.detect_adapters(df, cfg).collect()}
    assert learned == {(s, m): a[: RD.ADAPTER_START] for s in ("S0", "S1") for m, a in ((1, A1), (2, A2))}
    got = {r["read_id"]: r for r in RD.trim_all(df, cfg).collect()}
    for _, _, rid, a, _, b, _, insert in rows:
        want = min(80, insert)
        r = got[rid]
        if insert <= 80 or insert > 80 + 9:  # beyond the reads' end an adapter-like suffix of 4 bases may go, by contract
            assert len(r["seq1"]) in (want, *range(76 if insert > 80 else want, want + 1)) and a.startswith(r["seq1"]) and b.startswith(r["seq2"])
        assert len(r["qual1"]) == len(r["seq1"]) and len(r["qual2"]) == len(r["seq2"])
    assert got[rows[0][2]].asDict().keys() == {"sample", "ordinal", "read_id", "seq1", "qual1", "seq2", "qual2"}


def test_given_adapters_per_mate_and_poly_g_switch(spark):
    seq = "ACGTACGTAC" * 4
    df = spark.createDataFrame([("S", 0, "r", seq + A1, "I" * 60, seq + A2, "I" * 60), ("S", 1, "g", seq + "G" * 20, "I" * 60, seq, "I" * 40), ("S", 2, "n", None, None, "", "")], READS)
    one = {r["read_id"]: r for r in RD.trim_all(df, RD.CleanConfig(adapter=A1)).collect()}
    two = {r["read_id"]: r for r in RD.trim_all(df, RD.CleanConfig(adapter=A1, adapter_r2=A2, trim_poly_g=True)).collect()}
    off = {r["read_id"]: r for r in RD.trim_all(df, RD.CleanConfig(trim_poly_g=True, disable_trim_poly_g=True)).collect()}
    assert (one["r"]["seq1"], one["r"]["seq2"]) == (seq, seq + A2) and two["r"]["seq2"] == seq
    assert two["g"]["seq1"] == seq and off["g"]["seq1"] == seq + "G" * 20
    assert RD.clean_reads(df, RD.CleanConfig(detect_adapter_for_pe=True, correction=True)).count() == 3


def test_correction_in_the_job(spark):
    insert = "".join(random.Random(3).choices("ACGT", k=60))
    wrong = insert[:20] + ("A" if insert[20] != "A" else "C") + insert[21:]
    weak = "I" * 20 + "#" + "I" * 39
    df = spark.createDataFrame([("S", 0, "r", wrong, weak, rc(insert), "I" * 60)], READS)
    assert RD.trim_all(df, RD.CleanConfig(correction=True)).first()["seq1"] == insert
    assert RD.trim_all(df, RD.CleanConfig(detect_adapter_for_pe=True)).first()["seq1"] == wrong


def test_dedup_by_digest(spark):
    rows = [("S", 5, "b", "AC", "II", "GT", "II"), ("S", 5, "a", "AC", "##", "GT", "II"), ("S", 7, "c", "ACG", "III", "T", "I"), ("T", 9, "d", "AC", "II", "GT", "II"), ("S", 9, "e", None, None, "GT", "II"),
            ("S", 8, "f", "", "", "GT", "II"), ("S", 5, "a", "AC", "##", "GT", "II")]
    kept = RD.dedup_keepers(spark.createDataFrame(rows, READS)).collect()
    assert sorted(r["read_id"] for r in kept) == ["a", "c", "d", "e", "f"]


def test_decontamination_chain(spark):
    draw = random.Random(8)
    host, spike, own = ("".join(draw.choices("ACGT", k=400)) for _ in range(3))
    def kmers(g):
        return spark.createDataFrame([(min(g[i : i + 31], rc(g[i : i + 31])),) for i in range(len(g) - 30)], "kmer string")
    rows = []
    for i in range(200):
        mates = [draw.choice([host, spike, own]) for _ in "12"]
        at = draw.randrange(300)
        seqs = [m[at : at + 80] for m in mates]
        if i % 20 == 0:
            seqs[0] = seqs[0][:10]
        rows.append(("S", i, str(i), seqs[0], "I" * len(seqs[0]), rc(seqs[1]), "I" * 80, mates))
    df = spark.createDataFrame([r[:7] for r in rows], READS)
    for mode in ("both", "any"):
        rule = all if mode == "both" else any
        want = {r[2] for r in rows if len(r[3]) >= 15 and not any(rule(m is g for m in r[7]) for g in (host, spike))}
        got = {r["read_id"] for r in KM.decontaminate(df, {"host": kmers(host), "spike": kmers(spike)}, mode=mode).collect()}
        assert got == want
    assert {r["read_id"] for r in KM.remove_host(df, kmers(host), mode="any").collect()} == {r[2] for r in rows if not any(m is host and len(s) >= 35 for m, s in zip(r[7], (r[3], r[5])))}


def test_report_finds_metrics_and_raises_on_unlisted(spark):
    df = spark.createDataFrame([("S", i, str(i), "ACGTA", "IIIII", "GGGTA", "##III") for i in range(4)], READS)
    rows = QC.report_rows(QC.mates(df, "raw"))
    found = {r["metric"] for r in QC.metrics_of(rows).collect()}
    assert {"raw_basic_reads_r1", "raw_pos_quality_pos=2:mean_r2", "raw_duplication_level=4:reads_r1", "raw_gc_hist_gc_pct=40:reads_r1"} <= found
    wide = QC.qc_report([rows], sorted(found)).first().asDict()
    assert wide["raw_basic_reads_r1"] == 4 and wide["raw_base_content_pos=1:pct_g_r2"] == 100
    with pytest.raises(ValueError, match="not among the listed"):
        QC.qc_report([rows], ["raw_basic_reads_r1"])


def test_unlisted_samples_raise(spark):
    long = spark.createDataFrame([("a", "t", 1.0), ("b", "t", 1.0)], "sample string, tax_id string, abundance double")
    assert rank.heat_matrix(long, ["a", "b"]).columns == ["tax_id", "label", "a", "b"]
    with pytest.raises(ValueError, match="'b' is not among"):
        rank.heat_matrix(long, ["a"])


def test_numbers_within_a_hot_label(spark):
    draw = random.Random(6)
    rows = [(draw.choice(["hot", "hot", "b", "c", None]), draw.randrange(500), i) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = rank.numbered_within(spark.createDataFrame(rows, "label string, o int, id int"), "label", ["o", "id"]).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, seen = {}, Counter()
    for label, o, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        seen[label] += 1
        want[i] = seen[label]
    assert {r["id"]: r["_n"] for r in got} == want


def test_coverage_by_events(spark):
    draw = random.Random(7)
    aln = [(f"S{draw.randrange(2)}", draw.randrange(3), draw.randrange(40), "A" * draw.randrange(0, 12)) for _ in range(60)]
    depth = defaultdict(Counter)
    for s, m, p, b in aln:
        for j in range(len(b)):
            depth[s, m][p + 1 + j] += 1
    got = strain.coverage(spark.createDataFrame(aln, "sample string, marker_id int, pos int, bases string"), spark.createDataFrame([(0, 50), (1, 60), (2, 70)], "marker_id int, len int")).collect()
    assert {(r["sample"], r["marker_id"]): (r["covered"], r["bases"]) for r in got} == {k: (len(c), sum(c.values())) for k, c in depth.items()}
    assert all(r["breadth"] == r["covered"] / (50 + 10 * r["marker_id"]) for r in got)
