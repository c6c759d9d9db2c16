"""Property tests (hypothesis) on small random inputs."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxaframe.functions.sequence import revcomp
from taxaframe.operators import profiles as P
from taxaframe.operators import rank as R
from taxaframe.operators import reads as RD

cells = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["t1", "t2", "t3", "t4", "t5"]),
              st.floats(min_value=0.001, max_value=100)),
    min_size=1, max_size=25,
)


@settings(max_examples=8, deadline=None)
@given(cells)
def test_closure_sums_to_one_and_merge_order_free(spark, rows):
    df = spark.createDataFrame(rows, "sample string, tax_id string, abundance double")
    closed = P.relative_abundance(P.merge_samples(df))
    sums = {r[0]: r[1] for r in closed.groupBy("sample").agg(F.sum("abundance")).collect()}
    assert all(math.isclose(v, 1.0, rel_tol=1e-9) for v in sums.values())
    rev = spark.createDataFrame(list(reversed(rows)), "sample string, tax_id string, abundance double")
    a = sorted((r.sample, r.tax_id, round(r.abundance, 9)) for r in P.merge_samples(df).collect())
    b = sorted((r.sample, r.tax_id, round(r.abundance, 9)) for r in P.merge_samples(rev).collect())
    assert a == b


@settings(max_examples=8, deadline=None)
@given(cells, st.integers(min_value=1, max_value=4))
def test_top_n_other_preserves_sample_sums(spark, rows, n):
    df = P.merge_samples(spark.createDataFrame(rows, "sample string, tax_id string, abundance double"))
    before = {r[0]: r[1] for r in df.groupBy("sample").agg(F.sum("abundance")).collect()}
    after = {r[0]: r[1] for r in R.top_n_other(df, n).groupBy("sample").agg(F.sum("abundance")).collect()}
    assert before.keys() == after.keys()
    assert all(math.isclose(before[k], after[k], rel_tol=1e-9) for k in before)


@settings(max_examples=10, deadline=None)
@given(st.text(alphabet="ACGTN", min_size=0, max_size=60))
def test_revcomp_involution(spark, s):
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(revcomp(revcomp(F.col("s")))).first()[0] == s


def test_subsample_exact_and_nested(spark):
    reads = spark.createDataFrame(
        [(f"s{i % 3}", i, f"r{i}", "A", "I", "C", "I") for i in range(300)],
        "sample string, ordinal long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string",
    )
    small = {r.read_id for r in RD.subsample(reads, 20).collect()}
    large = {r.read_id for r in RD.subsample(reads, 50).collect()}
    counts = {r[0]: r[1] for r in RD.subsample(reads, 20).groupBy("sample").count().collect()}
    assert counts == {"s0": 20, "s1": 20, "s2": 20}
    assert small <= large
    assert RD.subsample(reads, 1000).count() == 300


def test_subsample_fallback_is_exact(spark):
    reads = spark.createDataFrame(
        [(f"s{i % 2}", i, f"r{i}", "A", "I", "C", "I") for i in range(200)],
        "sample string, ordinal long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string",
    )
    normal = {r.read_id for r in RD.subsample(reads, 15).collect()}
    forced = {r.read_id for r in RD.subsample(reads, 15, margin_sigma=-100.0).collect()}  # no candidates -> fallback
    assert normal == forced and len(normal) == 30


def test_small_p_keeps_relative_accuracy(spark):
    """Against the closed form for even nu in 400 decimal digits."""
    from decimal import Decimal as D
    from decimal import localcontext

    from taxaframe.operators.mock import pearson_p

    cases = [(r, n) for n in (4, 6, 30, 60, 202) for r in (0.1, 0.3, 0.5, -0.9, 0.99, 0.999)]
    got = spark.createDataFrame(cases, "r double, n long").select("r", "n", pearson_p(F.col("r"), F.col("n")).alias("p")).collect()
    with localcontext() as ctx:
        ctx.prec = 400  # 1 - A cancels down to p
        for row in got:
            s = abs(D(row.r))
            c2, term, total = 1 - s * s, D(1), D(1)
            for k in range(1, (row.n - 2 - 2) // 2 + 1):
                term *= D(2 * k - 1) / D(2 * k) * c2
                total += term
            assert math.isclose(row.p, float(1 - s * total), rel_tol=1e-9), row
    odd = spark.createDataFrame([(0.5, 3), (0.8, 5)], "r double, n long").select(pearson_p(F.col("r"), F.col("n"))).collect()
    assert math.isclose(odd[0][0], 1 - 2 / math.pi * math.asin(0.5), rel_tol=1e-9)
    assert math.isclose(odd[1][0], 1 - 2 / math.pi * (math.asin(0.8) + 0.8 * 0.6), rel_tol=1e-9)


def test_kmer_kernel_against_brute_force():
    import random

    import pyarrow as pa

    from taxaframe.functions.kernels import _canonical_kmers

    draw = random.Random(5)
    reads = ["".join(draw.choices("ACGTNacgt", [9, 9, 9, 9, 1, 1, 1, 1, 1], k=n)) for n in (0, 3, 31, 40, 200)] + [None]
    pair = dict(zip("ACGT", "TGCA"))
    code = lambda w: int(w.translate(str.maketrans("ACGT", "0123")), 4)
    for k in (3, 31):
        want = []
        for read in reads:
            s = (read or "").upper()
            windows = [s[i : i + k] for i in range(len(s) - k + 1)]
            want.append(None if read is None else [min(code(w), code("".join(pair[b] for b in reversed(w)))) for w in windows if "N" not in w])
        assert _canonical_kmers(pa.array(reads, pa.string()), k).to_pylist() == want


def test_fixed_barcode_is_enriched(spark):
    import random

    from taxaframe.operators.qc import qc_kmer

    draw = random.Random(3)
    rows = [("raw", "s", 1, str(i), "GATTACA" + "".join(draw.choices("ACGT", k=60)), "I" * 67) for i in range(300)]
    m = spark.createDataFrame(rows, "stage string, sample string, mate int, read_id string, seq string, qual string")
    top = {r.kmer: (r.max_pos, r.ratio) for r in qc_kmer(m, k=5, top=3).collect()}
    assert set(top) == {"GATTA", "ATTAC", "TTACA"}
    assert all(pos <= 3 and ratio > 20 for pos, ratio in top.values())
