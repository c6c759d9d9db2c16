"""Super-k-mers as packed bases: hits against brute force on odd reads, and what the shuffles carry."""

import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from conftest import SF_SMALL

from taxaframe.functions import packed as PK
from taxaframe.functions.kernels import _canonical_kmers, pack_bases, unpack_bases
from taxaframe.functions.superkmer import Prefilter
from taxaframe.operators import kmer as KM
from taxaframe.operators import qc as QC
from taxaframe.plans.fixtures import Fixtures

READS = "sample string, ordinal long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string"


def test_hits_of_long_repeated_and_nameless_reads(spark):
    draw = random.Random(4)
    genome = "".join(draw.choices("ACGT", k=900))
    kmers = _canonical_kmers(pa.array([genome]), 31).to_pylist()[0]
    cat = [(q, t) for i, q in enumerate(kmers) for t in ([None] if i % 50 == 0 else [i // 300, 7] if i % 3 else [i // 300])]
    seqs = [genome, genome[100:160] + "N" + genome[300:700], "A" * 700, "", None, genome[5:40].lower(), genome[::-1].translate(str.maketrans("ACGT", "TGCA"))]
    rows = [(draw.choice(["S", "T", None]), i, draw.choice(["a", "b", None]), draw.choice(seqs), None, draw.choice(seqs), None) for i in range(80)]
    got = KM.kmer_hits(spark.createDataFrame(rows, READS), spark.createDataFrame(cat, "kmer long, taxid int"))
    assert dict(got.dtypes)["taxid"] == "int"
    taxa, want = {}, Counter()
    for q, t in cat:
        taxa.setdefault(q, []).append(t)
    for sample, _, name, s1, _, s2, _ in rows:
        for s in (s1, s2):
            for q in (_canonical_kmers(pa.array([s], pa.string()), 31).to_pylist()[0] or []) if s else []:
                for t in taxa.get(q, ()):
                    want[sample, name, t] += 1
    assert {(r.sample, r.read_id, r.taxid): r.hits for r in got.collect()} == dict(want)


def test_blocks_are_kept_apart():
    draw = random.Random(6)
    seqs = ["".join(draw.choices("ACGT", k=80)) for _ in range(40)]
    rows = [(1 << PK.BLOCK_BITS) - 20 + i for i in range(40)]

    class Known:
        value = Prefilter(None, None)

    batch = pa.RecordBatch.from_arrays([pa.array(rows), pa.array(seqs), pa.array([None] * 40, pa.string())], names=["row", "seq1", "seq2"])
    cat = pa.RecordBatch.from_arrays([pa.array([q for s in seqs for q in _canonical_kmers(pa.array([s]), 31).to_pylist()[0]]), pa.array([r for r in rows for _ in range(50)])], names=["kmer", "tag"])
    met = [x for run, b in ((PK.pack_catalogue(31, 15, 5), cat), (PK.pack_reads(31, 15, 5, Known, most=300), batch)) for x in run(iter([b]))]
    table = pa.Table.from_batches([x.cast(met[-1].schema) for x in met]).sort_by([("bucket", "ascending"), ("block", "ascending")])
    found = pa.Table.from_batches(list(PK.look_up(31)(table.to_batches(max_chunksize=3))))
    got = Counter()
    for block in (0, 1):
        own = pa.table({"row": [r for r in rows if r >> PK.BLOCK_BITS == block]})
        names = own.append_column("sample", own["row"].cast(pa.string())).append_column("read_id", own["row"].cast(pa.string()))
        for r in PK.named_hits(names, found.filter(pa.compute.equal(found["block"], block))).to_pylist():
            got[r["read_id"], r["tag"]] += r["hits"]
    assert got == {(str(r), r): 50 for r in rows}


def test_runs_are_small(spark):
    # a window takes less than half of a packed k-mer, with the read's place; no name goes along
    fx = Fixtures(spark, SF_SMALL)
    known = spark.sparkContext.broadcast(Prefilter(None, None))
    reads = KM.number_reads(fx.reads)
    runs = reads.select("row", "seq1", "seq2").mapInArrow(PK.pack_reads(31, 15, 64, known), PK.ROW)
    used, windows = runs.select(F.sum(F.length("a") + F.length("b") + F.length("c")), F.sum(F.aggregate(F.split(F.hex("b"), "(?<=\\G..)"), F.lit(0), lambda n, x: n + F.coalesce(F.conv(x, 16, 10).cast("int"), F.lit(0))))).first()
    assert windows > 100_000 and used < 3 * windows
    plan = KM.kmer_hits(reads, fx.kmer)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(sample") == 1 and "array_contains" not in plan


def test_packed_bases_are_a_key_of_the_text(spark):
    draw = random.Random(8)
    texts = ["".join(draw.choices("ACGT", k=n)) for n in range(1, 60)] + ["A" * n for n in range(9)] + [None, "acgt", "ACGN", "ACG T", "\u00e4ACGT", "NNNN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    rows = df.select("t", pack_bases("t").alias("p"), unpack_bases(pack_bases("t")).alias("back")).collect()
    assert [r.back for r in rows] == texts
    assert len({bytes(r.p) for r in rows if r.p is not None}) == len({t for t in texts if t is not None})
    assert all(len(r.p) == 1 + -(-len(r.t) // 4) for r in rows if r.t and set(r.t) <= set("ACGT"))


def test_sequences_are_counted_by_their_packed_bases(spark):
    rows = [("raw", "S", 1, str(i), s, None) for i, s in enumerate(["ACGT", "ACGT", "ACGTA", "ACGN", "ACGN", "", "", None, "acgt"])]
    m = spark.createDataFrame(rows, "stage string, sample string, mate int, read_id string, seq string, qual string")
    assert {(r.seq, r["count"]) for r in QC.qc_overrepresented(m).collect()} == {("ACGT", 2), ("ACGTA", 1), ("ACGN", 2), ("", 2), (None, 1), ("acgt", 1)}
    assert {(r.level, r.sequences, r.reads) for r in QC.qc_duplication(m).collect()} == {(1, 3, 3), (2, 3, 6)}
    for query in (QC.qc_duplication(m), QC.qc_overrepresented(m)):
        shuffles = [x for x in query._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]
        assert shuffles and not any("seq#" in x for x in shuffles)
    # a sample's sequences are not brought together for its total
    assert "BroadcastHashJoin" in QC.qc_overrepresented(m)._jdf.queryExecution().executedPlan().toString()


def test_index_and_windows_of_packed_bases():
    import numpy as np

    from taxaframe.functions import packed as P
    from taxaframe.functions.superkmer import _spans

    draw = np.random.default_rng(1)
    for k in (1, 5, 16, 30, 31):
        code = draw.integers(0, 4, 400).astype(np.uint8)
        raw = code[0::4] << 6 | code[1::4] << 4 | code[2::4] << 2 | code[3::4]
        every = np.minimum(*_spans(code, k)).view(np.int64)
        at = draw.permutation(len(every))
        assert P._unpacked_kmers(raw, at, k).tolist() == every[at].tolist()
        rows = np.concatenate([every[::3], every[::9]])  # some k-mers stand several times
        index = P._Index(rows, np.arange(len(rows)))
        known = np.unique(rows)
        assert index.rows(every).tolist() == np.where(np.isin(every, known), np.searchsorted(known, every), -1).tolist()
        assert index.many.sum() == len(rows) and not index.once and sorted(index.tag.tolist()) == list(range(len(rows)))


def test_catalogue_fixtures_use_all_tasks_and_no_broadcast(spark):
    from conftest import SF_SMALL

    from taxaframe.operators import kmer as KM
    from taxaframe.plans import fixtures as FX

    fx = FX.Fixtures(spark, SF_SMALL, FX.PLANNED)
    assert fx.kmer_windows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    plan = FX._spark_kmer_distrib(fx)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    report = spark.createDataFrame([("S", 5, "S", 20, 20)], "sample string, taxid long, rank string, clade_reads long, direct_reads long")
    pairs = spark.createDataFrame([(5, 5, 1.0), (2, 5, 0.5)], "node long, species long, p double")
    est = KM.reestimate(report, pairs)
    assert "BroadcastHashJoin" not in est._jdf.queryExecution().executedPlan().toString() and est.first()["kraken_assigned_reads"] == 20
