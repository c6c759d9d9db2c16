"""Hand-made edge cases for the reference's quirks (K1-K13) and operator contracts."""

import math

import pytest
from pyspark.sql import functions as F

from taxaframe.functions import lineage as L
from taxaframe.operators import mock as M
from taxaframe.operators import profiles as P
from taxaframe.operators import rank as R

U = L.UNCLASSIFIED_LINEAGE


def long_df(spark, rows):
    return spark.createDataFrame(rows, "sample string, tax_id string, abundance double")


def test_closure_zero_sum_sample_is_zero(spark):
    df = P.relative_abundance(long_df(spark, [("a", "x", 0.0), ("b", "x", 2.0), ("b", "y", 2.0)]))
    got = {(r.sample, r.tax_id): r.abundance for r in df.collect()}
    assert got == {("a", "x"): 0.0, ("b", "x"): 0.5, ("b", "y"): 0.5}


def test_marker_unclassified_truncated_and_k2_missing_row(spark):
    raw = spark.createDataFrame(
        [("s1", "k__A|g__B|s__C", 60.0), ("s1", "UNCLASSIFIED", 17.9), ("s2", "k__A|g__B|s__C", 5.0),
         ("s3", "k__A|g__B|s__C", 5.0), ("s3", "UNCLASSIFIED", 0.4)],
        "sample string, clade_name string, relative_abundance double",
    )
    got = {(r.sample, r.tax_id): round(r.abundance, 9) for r in P.standardize_marker(raw).collect()}
    # K1: 17.9 -> 17; K2: no row -> nothing appended; 0.4 -> 0 -> not appended
    assert got[("s1", U)] == round(17 / 77, 9)
    assert ("s2", U) not in got and ("s3", U) not in got
    assert got[("s2", "k__A;g__B;s__C")] == 1.0


def test_species_filter_substring_rules(spark):
    raw = spark.createDataFrame(
        [("s", "k__A|s__B", 1.0), ("s", "k__A|s__B|t__C", 1.0), ("s", "clade_x", 1.0), ("s", "k__A|g__B", 1.0)],
        "sample string, clade_name string, relative_abundance double",
    )
    assert sorted(r.clade_name for r in P.species_rows(raw).collect()) == ["clade_x", "k__A|s__B"]


def test_repeated_lineage_is_summed_k5(spark):
    raw = spark.createDataFrame(
        [("s", "m1", "d__A;s__Unknown x", 1.0), ("s", "m2", "d__A;s__Unknown y", 3.0), ("s", "unassigned_x", None, 4.0)],
        "sample string, motu string, taxonomy string, value double",
    )
    got = {r.tax_id: r.abundance for r in P.standardize_motus(raw).collect()}
    assert got == {"k__A;s__Unclassified": 0.5, U: 0.5}


def test_bracken_level_error_and_remainder(spark):
    raw = spark.createDataFrame([("s", "Foo bar", "S", 0.5), ("s", "Baz", "G", 0.3)],
                                "sample string, name string, taxonomy_lvl string, fraction_total_reads double")
    with pytest.raises(ValueError):
        P.standardize_bracken(raw, "strain")
    got = {r.tax_id: round(r.abundance, 9) for r in P.standardize_bracken(raw).collect()}
    assert got == {"s__Foo_bar": 0.5, U: 0.5}


@pytest.mark.parametrize("lineage,genus", [
    (None, "Unclassified"), ("k__A;g__ Foo ;s__x", "Foo"), ("k__A;g__Unclassified;g__Bar", "Bar"),
    ("k__A;g__;s__x", "Unclassified"), ("k__A", "Unclassified"), ("g__g__Baz", "Baz"),
])
def test_genus_of(spark, lineage, genus):
    df = spark.createDataFrame([(lineage,)], "t string")
    assert df.select(L.genus_of("t")).first()[0] == genus


@pytest.mark.parametrize("lineage,label", [
    ("k__A;p__B;g__C;s__Unclassified", "g__C"), ("k__OnlyKingdom", "d__Unclassified"),
    ("d__X;g__Y|ACGT", "g__Y"), ("d__X;g__Y;g__Unclassified", "d__X"), (" d__X ; p__ Y ", "p__Y"),
])
def test_deepest_label_k7(spark, lineage, label):
    df = spark.createDataFrame([(lineage,)], "t string")
    assert df.select(L.deepest_label("t")).first()[0] == label


def test_top_n_ties_and_other(spark):
    df = long_df(spark, [("a", "t1", 0.5), ("a", "t2", 0.25), ("a", "t3", 0.25), ("b", "t2", 0.5), ("b", "t3", 0.5)])
    got = sorted((r.sample, r.taxon, r.rank, r.abundance) for r in R.top_n_other(df, 1).collect())
    # means: t2 = t3 = 0.375 > t1 = 0.25; tie broken by tax_id -> t2
    assert got == [("a", "Other", 2, 0.75), ("a", "t2", 1, 0.25), ("b", "Other", 2, 0.5), ("b", "t2", 1, 0.5)]


def _mock_inputs(spark, obs_rows, ref_rows, taxa_rows):
    long = long_df(spark, obs_rows)
    ab = spark.createDataFrame(ref_rows, "asv string, mock_reference double")
    taxa = spark.createDataFrame(taxa_rows, "asv string, domain string, genus string")
    return long, ab, taxa


def test_mock_metrics_identical_and_n2(spark):
    long, ab, taxa = _mock_inputs(
        spark, [("Mock1", "k__A;g__X;s__1", 0.5), ("Mock1", "k__A;g__Y;s__2", 0.5)],
        [("a1", 1.0), ("a2", 1.0)], [("a1", "D", "X"), ("a2", "D", "Y")])
    r = M.mock_metrics(long, ab, taxa).first()
    assert r.bray_curtis == 0.0 and r.rmse == 0.0
    assert r.pearson_r is None  # constant vectors: r undefined


def test_mock_no_mock_sample_is_empty(spark):
    long, ab, taxa = _mock_inputs(spark, [("S1", "k__A;g__X;s__1", 1.0)], [("a1", 1.0)], [("a1", "D", "X")])
    assert M.mock_metrics(long, ab, taxa).count() == 0


def test_reference_null_genus_dropped_and_k8(spark):
    long, ab, taxa = _mock_inputs(
        spark, [("Mock1", "k__A;g__X;s__1", 1.0)], [("a1", 1.0), ("a2", 1.0), ("a3", 2.0)],
        [("a1", "D", "X"), ("a2", "D", None), ("a3", "D", "OnlyRef")])
    ref = {r.genus: r.reference for r in M.reference_genus(ab, taxa).collect()}
    assert ref == {"X": 1 / 3, "OnlyRef": 2 / 3}
    comp = M.mock_composition(long, ab, taxa, n=15)
    assert "OnlyRef" not in {r.genus for r in comp.collect()}  # K8: reference-only genera vanish


def test_pearson_p_against_numeric_integration(spark):
    import numpy as np

    def t_pdf(x, nu):
        return math.gamma((nu + 1) / 2) / (math.sqrt(nu * math.pi) * math.gamma(nu / 2)) * (1 + x * x / nu) ** (-(nu + 1) / 2)

    def two_sided(r, n):
        nu = n - 2
        t = abs(r) * math.sqrt(nu / (1 - r * r))
        if nu == 1:  # Cauchy: closed form
            return 1 - 2 * math.atan(t) / math.pi
        if nu == 2:
            return 1 - t / math.sqrt(2 + t * t)
        xs = np.linspace(0.0, t, 400001)  # central part, then p = 1 - 2 * integral
        return 1 - 2 * np.trapezoid(t_pdf(xs, nu), xs)

    cases = [(0.3, 7), (0.5, 10), (-0.8, 12), (0.9, 25), (0.2, 30), (0.6, 3), (0.4, 4)]
    df = spark.createDataFrame(cases, "r double, n int")
    got = [row[0] for row in df.select(M.pearson_p(F.col("r"), F.col("n"))).collect()]
    for (r, n), p in zip(cases, got):
        want = two_sided(r, n)
        assert abs(p - want) < 1e-8, (r, n, p, want)


def test_pearson_p_n2_is_one(spark):
    df = spark.createDataFrame([(0.5, 2)], "r double, n int")
    assert df.select(M.pearson_p(F.col("r"), F.col("n"))).first()[0] == 1.0
