"""k-mer path: windows, Bloom filter, super-k-mers, numbered taxonomy, plan shape."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from taxaframe.functions import superkmer as sk
from taxaframe.functions.bloom import build_bloom
from taxaframe.functions.kernels import _canonical_kmers
from taxaframe.operators import kmer as KM
from taxaframe.plans.fixtures import Fixtures

READS = "sample string, ordinal long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string"


def reads_of(spark, seqs):
    return spark.createDataFrame([("S", i, str(i), a, a, b, b) for i, (a, b) in enumerate(seqs)], READS)


@pytest.mark.parametrize("k,m", [(31, 15), (5, 3), (7, 7), (4, 1), (31, 31), (21, 8)])
def test_windows_and_minimisers(k, m):
    draw = random.Random(k)
    seqs = ["".join(draw.choices("ACGTN", weights=[10, 10, 10, 10, 1], k=draw.randrange(0, 120))) for _ in range(200)] + ["", "A" * 80, "ACGT" * 20, "acgtt" * 9]
    row, kmer, mini = sk.windows(pa.array(seqs), k, m)
    plain = _canonical_kmers(pa.array(seqs), k)
    assert kmer.tolist() == plain.flatten().to_pylist()
    assert row.tolist() == [i for i, x in enumerate(plain.to_pylist()) for _ in x]
    assert (sk.minimisers(kmer, k, m) == mini).all()


@pytest.mark.parametrize("heavy_share", [0, 3])
def test_super_kmers_keep_every_window(spark, heavy_share):
    draw = random.Random(1)
    repeat = "".join(draw.choices("ACGT", k=60))
    seqs = ["".join(draw.choices("ACGTN", weights=[50, 50, 50, 50, 1], k=draw.randrange(90))) for _ in range(300)] + ["A" * 90, "ACGT" * 20, repeat + "GATTACA" + repeat, ""]
    row, kmer, mini = sk.windows(pa.array(seqs), 31, 15)
    heavy = np.unique(mini)[::heavy_share] if heavy_share else np.zeros(0, np.uint64)

    class Known:
        value = sk.Prefilter(heavy, None)

    batch = pa.RecordBatch.from_arrays(
        [pa.array(["s"] * len(seqs)), pa.array(list(map(str, range(len(seqs))))), pa.array([1] * len(seqs), pa.int32()), pa.array(seqs)], names=["sample", "read_id", "mate", "seq"]
    )
    got, rows = Counter(), 0
    for x in next(sk.super_kmers(31, 15, Known)([batch])).to_pylist():
        assert len(set(x["kmers"])) == len(x["kmers"])
        rows += 1
        for i, q in enumerate(x["kmers"]):
            got[int(x["read_id"]), q] += x["counts"][i] if x["counts"] else 1
    assert got == Counter(zip(row.tolist(), kmer.tolist()))
    if not heavy_share:
        assert rows * 5 <= len(row)  # at most a fifth of the windows are rows


def test_bloom_filter(spark):
    keys = spark.range(50_000).select((F.col("id") * 3).alias("k")).union(spark.range(1000).select(F.lit(7).alias("k"))).union(spark.sql("SELECT cast(null AS long)"))
    held = build_bloom(keys, 51_001)
    assert held.holds(np.arange(0, 150_000, 3)).all() and held.holds(np.array([7])).all()
    assert held.holds(np.arange(1, 150_001, 3)).mean() < 0.05
    assert build_bloom(keys, 10**12) is None
    assert not build_bloom(spark.range(0), 0).holds(np.arange(100)).any()


def brute_hits(reads, cat):
    out = Counter()
    for i, pair in enumerate(reads):
        for seq in pair:
            for q in _canonical_kmers(pa.array([seq]), 31).to_pylist()[0] or []:
                for t in cat.get(q, ()):
                    out[str(i), t] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"bloom": False}, {"heavy_bucket": 0}, {"heavy_bucket": 1, "max_heavy": 3}, {"m": 31}, {"m": 5}])
def test_hits_against_brute_force(spark, options):
    draw = random.Random(9)
    genomes = ["".join(draw.choices("ACGT", k=300)) for _ in range(6)] + ["A" * 60 + "C" * 60, "ACG" * 40]
    cat = {}
    for t, g in enumerate(genomes):
        for q in _canonical_kmers(pa.array([g]), 31).to_pylist()[0]:
            cat.setdefault(q, set()).add(t)
    def piece(n):
        g = draw.choice(genomes)
        at = draw.randrange(max(1, len(g) - n))
        return g[at : at + n]
    reads = [(piece(draw.randrange(100)), draw.choice([piece(90), "A" * 100, "", "N" * 50, "".join(draw.choices("ACGTN", k=100))])) for _ in range(150)]
    table = spark.createDataFrame([(q, t) for q, ts in cat.items() for t in ts], "kmer long, taxid long")
    got = KM.kmer_hits(reads_of(spark, reads), KM.build_index(table, **options)).collect()
    assert {(r.read_id, r.taxid): r.hits for r in got} == dict(brute_hits(reads, cat))


def test_empty_catalogue_and_reads(spark):
    none = spark.createDataFrame([], "kmer long, taxid long")
    assert KM.kmer_hits(reads_of(spark, [("A" * 50, "C" * 50)]), none).count() == 0
    assert KM.kmer_hits(spark.createDataFrame([], READS), spark.createDataFrame([(1, 1)], "kmer long, taxid long")).count() == 0


def random_tree(draw, n):
    ids = draw.sample(range(1, 10 * n), n)
    parent = {t: (draw.choice(ids[:i]) if i and draw.random() < 0.95 else draw.choice([0, t])) for i, t in enumerate(ids)}
    for t in ids[n // 2 : n // 2 + 3]:
        parent[t] = 999_000 + t % 2  # parents that the table does not list
    return parent


def lineage(parent, t):
    out = [t]
    while parent.get(out[0], 0) not in (0, out[0]):
        out.insert(0, parent[out[0]])
    return out


def test_numbered_tree(spark):
    parent = random_tree(random.Random(3), 60)
    rows = KM.index_tree(spark.createDataFrame(list(parent.items()), "taxid long, parent long")).collect()
    numbers = {r.taxid: (r.enter, r.leave) for r in rows}
    assert set(parent) <= set(numbers)
    paths = {t: lineage(parent, t) for t in numbers}
    for r in rows:
        assert [a.node for a in r.path] == paths[r.taxid]
        assert [(a.enter, a.leave) for a in r.path] == [numbers[a.node] for a in r.path]
    for a in numbers:
        for b in numbers:
            assert (a in paths[b]) == (numbers[a][0] <= numbers[b][0] <= numbers[a][1])
    assert sorted(e for e, _ in numbers.values()) == list(range(1, len(numbers) + 1))


def test_classification_against_brute_force(spark):
    draw = random.Random(5)
    parent = random_tree(draw, 40)
    taxa = list(parent) + [5_000_001, 5_000_002]  # two that the tree lacks
    hits = {}
    for i in range(400):
        for t in draw.sample(taxa, draw.randrange(1, 5)):
            hits[str(i), t] = draw.randrange(1, 4)
    def brute(i):
        own = {t: n for (r, t), n in hits.items() if r == i}
        score = {t: sum(own.get(a, 0) for a in lineage(parent, t)) for t in own}
        tied = [t for t in own if score[t] == max(score.values())]
        shared = [a for a in lineage(parent, tied[0]) if all(a in lineage(parent, t) for t in tied)]
        return shared[-1] if shared else 0
    index = KM.index_tree(spark.createDataFrame(list(parent.items()), "taxid long, parent long"))
    table = spark.createDataFrame([("S", i, t, n) for (i, t), n in hits.items()] + [("S", "none", None, None)], "sample string, read_id string, taxid long, hits long")
    got = {r.read_id: r.taxid for r in KM.classify(table, index).collect()}
    assert got == {i: brute(i) for i, _ in hits} | {"none": 0}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_prefilter_stands_before_the_shuffle(spark, no_broadcast):
    fx = Fixtures(spark, SF_SMALL)
    sparse = fx.kmer.filter(F.pmod(F.xxhash64("kmer"), F.lit(100)) == 0).select("kmer")  # 1 % of the catalogue
    own = fx.reads.select("sample", "read_id", F.lit(1).alias("mate"), F.col("seq1").alias("seq"))
    moved = {}
    for bloom in (True, False):
        index = KM.build_index(sparse, bloom=bloom)
        left = _plan(KM.match_kmers(fx.reads, index)).split("Sort [_key")[0]
        above, below = left.split("MapInArrow run(sample")
        assert "Exchange hashpartitioning(key" in above and "Exchange" not in below and "FileScan parquet" in below and "qual1" not in below
        runs = own.mapInArrow(sk.super_kmers(31, 15, index.prefilter), "sample string, read_id string, mate int, key long, kmers array<long>, counts array<int>")
        moved[bloom] = runs.selectExpr("sum(size(kmers))").first()[0]
    assert moved[True] * 10 < moved[False]


def test_exchanges_of_classification(spark):
    fx = Fixtures(spark, SF_SMALL)
    plan = _plan(KM.classify_reads(fx.reads, fx.kmer, fx.tree_index))
    # runs and catalogue by minimiser, hits by (read, taxon), taxa by read
    assert plan.count("Exchange hashpartitioning(key") + plan.count("Exchange hashpartitioning(_key") <= 2
    assert plan.count("Exchange hashpartitioning(sample") <= 2 and "Checkpoint" not in plan
