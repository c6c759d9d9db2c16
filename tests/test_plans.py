"""Plan shape: partial top-k, pushed filters, no Cartesian products in key queries."""

import os
import tempfile

from conftest import SF_SMALL

from __spark_entry__ import queries
from taxaframe.operators import markers as MK
from taxaframe.operators import reads as RD


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_subsample_uses_window_group_limit(spark):
    reads = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").selectExpr(
        "cast(l_suppkey % 3 as string) AS sample", "l_orderkey AS ordinal", "cast(l_orderkey as string) AS read_id")
    assert "WindowGroupLimit" in _plan(RD.subsample(reads, 5))


def test_alignment_filter_reaches_parquet_scan(spark):
    d = tempfile.mkdtemp(prefix="taxaframe-plan-")
    spark.range(100).selectExpr("'S' AS sample", "cast(id as string) AS read_id", "id AS marker_id",
                                "cast(id % 11 as int) AS mapq", "cast(id as int) AS read_len", "cast(id as int) AS aln_len") \
        .write.mode("overwrite").parquet(os.path.join(d, "aln"))
    aln = spark.read.parquet(os.path.join(d, "aln"))
    q = MK.filter_alignments(aln).select("sample", "marker_id")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "mapq" in plan and "GreaterThanOrEqual(read_len,70)" in plan


def test_no_cartesian_products(spark):
    for name in ["mock_metrics", "top_n_other", "cluster_flags", "mutation_rates", "sample_distance", "classify_reads"]:
        p = _plan(queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_no_row_python_udf_in_profile_path(spark):
    p = _plan(queries()["merge_samples"](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
