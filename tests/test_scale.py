"""Steps that must not write or shuffle what they need not: reads planned in place, repeats and claimed pairs found by a filter."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from taxaframe.functions import bloom as B
from taxaframe.functions.kernels import map_ascii
from taxaframe.operators import reads as RD
from taxaframe.plans.fixtures import PLANNED, Fixtures

READS = "sample string, ordinal long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_reads_and_windows_are_planned_not_written(spark):
    fx = Fixtures(spark, SF_SMALL, PLANNED)
    assert any("lineitem.parquet" in f for f in fx.reads.inputFiles())
    assert any("lineitem.parquet" in f for f in fx.reads_pe.inputFiles())
    assert any("lineitem.parquet" in f for f in fx.alignment.inputFiles())
    # a filter of the species reaches the genomes, before any window is made
    hosts = fx.kmer_windows.filter("species % 20 = 0")
    assert _plan(hosts).index("Generate") < _plan(hosts).index("% 20")


def test_map_ascii_is_translate_and_keeps_nulls(spark):
    df = spark.createDataFrame([("ACGTN",), (None,), ("",), ("GGA",)], "s string").coalesce(1)
    assert [r[0] for r in df.select(map_ascii("ACGT", "TGCA")("s")).collect()] == ["TGCAN", None, "", "CCT"]
    assert [r[0] for r in df.select(map_ascii("ACGT", "TGCA", backwards=True)("s")).collect()] == ["NACGT", None, "", "TCC"]


def test_dedup_shuffles_only_pairs_that_may_repeat(spark):
    rows = [("S", i, f"r{i}", f"ACGT{i}", "I", "T", "I") for i in range(40)]
    rows += [("S", 100 + i, f"d{i}", "AAAA", "I", "CC", "I") for i in range(5)]
    rows += [("S", 200, "n", None, None, "CC", "I"), ("S", 201, "n2", None, None, "CC", "I"), ("S", 202, "e", "", "", "CC", "I")]
    rows += [("S", 203, "same", "TT", "I", "T", "I"), ("S", 203, "same", "TT", "#", "T", "I"), ("S", 204, None, "TTT", "I", "T", "I")]
    df = spark.createDataFrame(rows, READS)
    kept = RD.dedup_keepers(df)
    assert "Union" in _plan(kept)
    got = sorted((r["read_id"], r["qual1"] or "") for r in kept.collect())
    assert got == sorted([(f"r{i}", "I") for i in range(40)] + [("d0", "I"), ("n", ""), ("e", ""), ("same", "#")])
    marked = RD.clean_reads(df.filter("seq1 IS NOT NULL"), RD.CleanConfig(length_required=0, dedup=True))
    assert "Union" in _plan(marked)
    reasons = [(r["read_id"], r["reason"]) for r in marked.collect()]
    assert len(reasons) == 49 and sorted(n for n, r in reasons if r == RD.DUPLICATE and n) == ["d1", "d2", "d3", "d4"]


def test_anti_join_equals_a_plain_one(spark):
    rows = spark.createDataFrame([("S", f"r{i % 30}") for i in range(60)] + [("S", None), (None, "r1")], "sample string, read_id string")
    keys = spark.createDataFrame([("S", f"r{i}") for i in range(0, 30, 3)] + [("S", None)], "sample string, read_id string")
    got = B.anti_join(rows, keys, ["sample", "read_id"])
    assert "Union" in _plan(got)
    want = rows.join(keys, ["sample", "read_id"], "left_anti")
    order = lambda df: sorted(df.collect(), key=str)
    assert order(got) == order(want) and len(order(got)) == 42


def test_taxonomy_joins_do_not_go_through_the_driver(spark):
    from taxaframe.operators import kmer as KM

    names = spark.createDataFrame([(1, 0, "R", "root"), (2, 1, "G", "g__a b"), (3, 2, "S", "c")], "taxid int, parent int, rank string, name string")
    lines = KM.lineages(KM.index_tree(names), names)
    assert "BroadcastHashJoin" not in lines._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in lines.collect()} == {(2, "g__a_b"), (3, "g__a_b;s__c")}


def test_reads_are_shuffled_once(spark):
    plan = Fixtures(spark, SF_SMALL, PLANNED).reads._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(lines) == 2 and "l_partkey" in lines[0] + lines[1]  # the table's rows, and the genomes
    assert "SortMergeJoin" not in plan


def test_a_filter_evaluates_the_bases_once(spark):
    plan = _plan(RD.filter_pairs(Fixtures(spark, SF_SMALL, PLANNED).reads, RD.CleanConfig(low_complexity_filter=True)))
    assert plan.count("AGATCGGAAGAGC") == 1


def test_a_filter_above_trims_does_not_repeat_them(spark):
    reads = Fixtures(spark, SF_SMALL, PLANNED).reads
    chain = RD.trim_fixed(RD.trim_adapter(RD.trim_poly_g(reads)), 0, 0, 0, 5)
    plan = _plan(RD.filter_pairs(chain, RD.CleanConfig(length_required=20, length_limit=95)))
    assert "regexp" not in plan and max(map(len, plan.splitlines())) < 20_000


def test_cuts_equal_their_regexes(spark):
    from pyspark.sql import functions as F

    from taxaframe.functions.kernels import before_adapter

    ad = RD.TRUSEQ_ADAPTER
    texts = ["", None, "A", "G" * 9, "G" * 10, "AC" + "G" * 12, "GGGGGGGGGGGGN", "T" * 11, "ACGT" + "A" * 10, ad, "TT" + ad + "CC", ad + ad, "C" + ad[:4], "C" + ad[:3], ad[:12], "AGATAGAT"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").coalesce(1)
    cut = lambda p: F.length(F.regexp_replace("s", p, ""))
    got = df.select(
        RD.before_run("G", 10)(F.col("s")), cut("G{10,}$"), RD.before_run("ACGT", 10)(F.col("s")), cut("(A{10,}|C{10,}|G{10,}|T{10,})$"),
        before_adapter(ad, 4)("s"), cut(RD.adapter_pattern(ad)), RD.complexity_diffs(F.col("s")), F.greatest(F.regexp_count("s", F.lit(r"(.)(?!\1)")) - 1, F.lit(0)),
    ).collect()
    for row in got:
        assert row[0::2] == row[1::2] or row[0] is None and row[6] is None, row


def test_totals_read_the_table_once(spark):
    rows = [("S", i, f"r{i}", "ACGT" * 10, "I" * 40, "GGCC" * 10, "#" * 20 + "I" * 20) for i in range(3)] + [(None, 9, "n", "ACGT" * 10, "I" * 40, "GGCC" * 10, "I" * 40)]
    totals = RD.clean_totals(spark.createDataFrame(rows, READS), RD.CleanConfig())
    assert _plan(totals).count("LogicalRDD") == 1
    got = {r["sample"]: r.asDict() for r in totals.collect()}
    assert (got["S"]["reads_before"], got["S"]["reads_after"], got["S"]["gc_before"], got["S"]["q20_before"]) == (6, 0, 180, 180)
    assert (got[None]["reads_before"], got[None]["reads_after"], got[None]["bases_after"]) == (2, 0, 0)


def test_a_filter_without_room_takes_fewer_bits(spark):
    import numpy as np

    keys = spark.range(50_000)
    held = B.build_bloom(keys, 300_000, max_bytes=256 << 10)
    assert held is not None and held.holds(np.arange(50_000)).all()
    assert B.build_bloom(keys, 400_000, max_bytes=256 << 10) is None


def test_overlap_search_equals_a_plain_one():
    import numpy as np

    from taxaframe.operators.overlap import _find, _matrix

    rng = np.random.default_rng(7)
    pairs = []
    for i in range(300):
        base = rng.choice(list(b"ACGT"), 140).astype(np.uint8)
        a, r, o = base[:100].copy(), base[30 : 30 + rng.integers(20, 101)].copy(), 0
        if i % 3 == 0:
            a, r = r, a
        for _ in range(rng.integers(0, 8)):
            a[rng.integers(0, len(a))] = 65
        pairs.append((a.tobytes(), r.tobytes()))
    (a, la), (r, lr) = _matrix([p[0] for p in pairs], 1), _matrix([p[1] for p in pairs], 2)
    found, at, ov, mm = _find(a, la, r, lr, 30, 5)
    for i, (x, y) in enumerate(pairs):
        want = None
        for o in [*range(0, 101), *range(-1, -101, -1)]:
            p, q = (x[o:], y) if o >= 0 else (x, y[-o:])
            n = min(len(p), len(q))
            if n >= 30 and sum(c != d for c, d in zip(p, q)) <= 5:
                want = (o, n, sum(c != d for c, d in zip(p, q)))
                break
        assert (want is not None) == found[i] and (want is None or want == (at[i], ov[i], mm[i]))
    assert 50 < found.sum() < 300


def test_cleaned_reads_of_the_qc_stage_are_not_written(spark, monkeypatch):
    from taxaframe.plans import q_qc

    monkeypatch.setattr(q_qc, "stored", None)  # nothing is stored here; only ids are, by the anti join
    assert q_qc._clean_reads(Fixtures(spark, SF_SMALL, PLANNED)).columns[:2] == ["sample", "ordinal"]


def test_decontamination_of_named_reads_is_one_plan(spark, monkeypatch):
    import random

    from taxaframe.operators import kmer as KM
    from taxaframe.plans import q_qc

    draw = random.Random(11)
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    host, spike, own = ("".join(draw.choices("ACGT", k=400)) for _ in range(3))
    kmers = {n: spark.createDataFrame([(min(g[i : i + 31], rc(g[i : i + 31])),) for i in range(370)], "kmer string") for n, g in (("host", host), ("spike", spike))}
    rows = []
    for i in range(240):
        at = draw.randrange(300)
        a, b = (draw.choice([host, spike, own])[at : at + draw.choice([10, 33, 35, 80])] for _ in "12")
        rows.append((None if i % 17 == 0 else f"S{i % 3}", i, None if i % 19 == 0 else str(i), a, "I" * len(a), rc(b), "I" * len(b)))
    rows += [("S", 300, "empty", None, None, rc(host[:80]), "I" * 80), ("S", 301, "ns", "N" * 80, "I" * 80, rc(host[:80]), "I" * 80)]
    df = spark.createDataFrame(rows, READS)
    order = lambda d: sorted(d.collect(), key=str)
    for mode in ("both", "any"):
        want = order(KM.decontaminate(df, kmers, mode=mode))
        with monkeypatch.context() as m:
            m.setattr(KM, "anti_join", None)  # no job of its own that finds the claimed names
            got = KM.decontaminate(df, kmers, mode=mode, named_once=True)
        assert got.columns == df.columns and order(got) == want and 30 < len(want) < len(rows)
    assert order(KM.decontaminate(df, kmers, min_hits=0, named_once=True)) == order(KM.decontaminate(df, kmers, min_hits=0))
    with monkeypatch.context() as m:
        m.setattr(KM, "anti_join", None)
        clean = q_qc._clean_reads(Fixtures(spark, SF_SMALL, PLANNED))
    # one plan reads the table: to keep what the filter clears, to look up the others and to bring back what was cleared
    assert _plan(clean).count("MapInArrow") >= 2 and clean.count() > 0


def test_pairs_that_agree_with_a_cleared_name(spark):
    from taxaframe.operators import kmer as KM

    names = spark.createDataFrame([("S", f"r{i}") for i in range(0, 4000, 100)], "sample string, read_id string")
    rows = spark.createDataFrame([("S", f"r{i}") for i in range(4000)], "sample string, read_id string")
    got = {r["read_id"] for r in rows.filter(KM._agrees(names)).collect()}
    assert {f"r{i}" for i in range(0, 4000, 100)} <= got and len(got) < 50
    assert rows.filter(KM._agrees(names.filter("false"))).count() == 0


def test_held_windows_are_counted(spark):
    import numpy as np
    import pyarrow as pa

    from taxaframe.functions.superkmer import held_windows, windows

    seqs = pa.array(["ACGTTGCAAC", None, "", "ACGNTGCAACG", "TTGCAAC", "AC"])
    row, kmer, _ = windows(seqs, 5, 3)
    bloom = B.build_bloom(spark.createDataFrame([(int(x),) for x in set(kmer.tolist())], "k long"), 20, bits_per_key=24)
    assert held_windows(seqs, 5, bloom).tolist() == np.bincount(row, minlength=6).tolist()
    assert held_windows(pa.array(["AC", None]), 5, bloom).tolist() == [0, 0]


def test_names_that_stand_twice_are_judged_together(spark):
    import random
    from types import SimpleNamespace

    from taxaframe.plans import q_qc

    host = "".join(random.Random(5).choices("ACGT", k=64))
    rc = host[::-1].translate(str.maketrans("ACGT", "TGCA"))
    windows = [(min(host[i : i + 31], rc[64 - 31 - i : 64 - i]), 20) for i in range(34)]
    mate = ("C" * 20 + "ACGTAGTC" + host[:33], "I" * 61, "C" * 20 + "ACGTAGTC" + host[31:], "I" * 61)  # three windows each
    reads = spark.createDataFrame([("S", 1, "r", *mate), ("S", 1, "r", *mate), ("S", 2, "q", *mate)], READS)
    kmers = spark.createDataFrame(windows, "kmer string, species int")
    fx = SimpleNamespace(reads=reads, kmer_windows=kmers, genome=spark.createDataFrame([(7,), (7,), (8,)], "genome_id long"))
    assert [r["read_id"] for r in q_qc._clean_reads(fx).collect()] == ["q"]


def test_raw_and_clean_stage_are_one_pass(spark, monkeypatch):
    import random

    from taxaframe.operators import kmer as KM
    from taxaframe.operators import qc as QC
    from taxaframe.plans import q_qc

    draw = random.Random(12)
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    host, own = ("".join(draw.choices("ACGT", k=400)) for _ in range(2))
    kmers = {"host": spark.createDataFrame([(min(host[i : i + 31], rc(host[i : i + 31])),) for i in range(370)], "kmer string")}
    rows = []
    for i in range(200):
        at, size = draw.randrange(300), draw.choice([10, 33, 35, 80])
        a, b = (draw.choice([host, own])[at : at + size] for _ in "12")
        rows.append((None if i % 17 == 0 else "S", i, None if i % 19 == 0 else str(i), a, "I" * len(a), rc(b), "I" * len(b)))
    df = spark.createDataFrame([*rows, ("S", 300, "empty", None, None, rc(host[:80]), "I" * 80)], READS)
    raw = df.select("*", *[F.col(c).alias(f"raw_{c}") for c in ("seq1", "qual1", "seq2", "qual2")])
    passed = F.col("ordinal") % 3 != 0
    order = lambda d: sorted(map(tuple, d.collect()), key=str)
    clean = KM.decontaminate(df.filter(passed), kmers)
    want = order(QC.mates(df, "raw").unionByName(QC.mates(clean, "clean")))
    for once in (True, False):
        got = QC.staged_mates(KM.decontaminate_marked(raw, passed, lambda named: raw.filter(named), kmers, named_once=once))
        assert order(got) == want and clean.count() > 20
    # the raw stage has no branch of its own: what is not brought back by name is one scan of the table
    whole = q_qc._both(Fixtures(spark, SF_SMALL, PLANNED))._jdf.queryExecution().optimizedPlan().toString()
    assert whole.count("Union") == 1 and "stages" in whole
