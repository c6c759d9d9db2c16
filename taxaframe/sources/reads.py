"""Samplesheet, paired FASTQ, mock-reference and synonym sources.

``read_fastq_pairs`` reads pairs in byte ranges (``sources.fastq``). The Python Data Source
(``spark.read.format("fastq_pairs")``) is the serial form for local files: one input partition per
file pair, records parsed four lines at a time from both mates in lockstep.
"""

from __future__ import annotations

import gzip
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

SAMPLESHEET_SCHEMA = StructType([
    StructField("sample", StringType()),
    StructField("read1", StringType()),
    StructField("read2", StringType()),
])
READS_SCHEMA = StructType([
    StructField("sample", StringType()),
    StructField("ordinal", LongType()),
    StructField("read_id", StringType()),
    StructField("seq1", StringType()),
    StructField("qual1", StringType()),
    StructField("seq2", StringType()),
    StructField("qual2", StringType()),
])


def read_samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header ``sample,read1,read2``."""
    return spark.read.schema(SAMPLESHEET_SCHEMA).option("header", True).csv(path)


def check_samplesheet(sheet: DataFrame, files: DataFrame) -> DataFrame:
    """Rows whose mate file is missing from ``files`` (column ``path``), and duplicate
    sample names. Output (sample, problem); the caller raises when it is not empty."""
    have = files.select(F.col("path").alias("_p"))
    miss1 = sheet.join(have, sheet["read1"] == have["_p"], "left_anti").select("sample", F.lit("missing read1").alias("problem"))
    miss2 = sheet.join(have, sheet["read2"] == have["_p"], "left_anti").select("sample", F.lit("missing read2").alias("problem"))
    dup = sheet.groupBy("sample").count().filter("count > 1").select("sample", F.lit("duplicate sample").alias("problem"))
    return miss1.unionByName(miss2).unionByName(dup)


def _open(path: str):
    return gzip.open(path, "rt") if path.endswith(".gz") else open(path, "rt")


class _Pair(InputPartition):
    def __init__(self, sample: str, read1: str, read2: str):
        super().__init__((sample, read1, read2))
        self.sample, self.read1, self.read2 = sample, read1, read2


class FastqPairsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        import csv

        sheet = self.options.get("samplesheet") or self.options.get("path")
        with open(sheet, newline="") as fh:
            rows = list(csv.DictReader(fh))
        base = os.path.dirname(os.path.abspath(sheet))
        return [
            _Pair(r["sample"], os.path.join(base, r["read1"]), os.path.join(base, r["read2"])) for r in rows
        ]

    def read(self, partition: _Pair):
        with _open(partition.read1) as a, _open(partition.read2) as b:
            n = 0
            while True:
                h1, h2 = a.readline(), b.readline()
                if not h1 and not h2:
                    return
                if not h1 or not h2:
                    raise ValueError(f"mate files of {partition.sample} have different record counts")
                s1, _, q1 = a.readline().rstrip("\n"), a.readline(), a.readline().rstrip("\n")
                s2, _, q2 = b.readline().rstrip("\n"), b.readline(), b.readline().rstrip("\n")
                if not h1.startswith("@") or not h2.startswith("@"):
                    raise ValueError(f"malformed FASTQ record in {partition.sample} at record {n}")
                if len(s1) != len(q1) or len(s2) != len(q2) or not s1 or not s2:
                    raise ValueError(f"truncated FASTQ record in {partition.sample} at record {n}")
                rid, mate = h1[1:].split()[0].removesuffix("/1"), h2[1:].split()[0].removesuffix("/2")
                if rid != mate:
                    raise ValueError(f"mates of {partition.sample} disagree at record {n}: {rid}, {mate}")
                yield (partition.sample, n, rid, s1, q1, s2, q2)
                n += 1


class FastqPairsDataSource(DataSource):
    """S3: ``spark.read.format("fastq_pairs").option("samplesheet", path).load()`` -> T2."""

    @classmethod
    def name(cls):
        return "fastq_pairs"

    def schema(self):
        return READS_SCHEMA

    def reader(self, schema):
        return FastqPairsReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastqPairsDataSource)


def read_fastq_pairs(spark: SparkSession, samplesheet: str, split_bytes: int = 64 << 20) -> DataFrame:
    """S3: all pairs of a samplesheet, read in byte ranges (see ``sources.fastq``). Relative paths start at the sheet's folder."""
    from taxaframe.sources.fastq import read_pairs

    base = samplesheet.rsplit("/", 1)[0] if "/" in samplesheet else "."
    full = [F.when(F.col(c).rlike("^(/|[a-z0-9]+:)"), F.col(c)).otherwise(F.concat(F.lit(f"{base}/"), F.col(c))).alias(c) for c in ("read1", "read2")]
    return read_pairs(read_samplesheet(spark, samplesheet).select("sample", *full), split_bytes)


def read_mock(spark: SparkSession, abundance_path: str, taxa_path: str) -> tuple[DataFrame, DataFrame]:
    """Mock abundance (``ASV, Mock Reference``) and taxonomy (``ASV, Domain … Species``)."""
    ab = spark.read.option("header", True).csv(abundance_path)
    ab = ab.select(F.col("ASV").alias("asv"), F.col("`Mock Reference`").cast(DoubleType()).alias("mock_reference"))
    tx = spark.read.option("header", True).csv(taxa_path)
    tx = tx.select(*[F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in tx.columns])
    return ab, tx


def read_synonyms(spark: SparkSession, path: str | None) -> DataFrame:
    """``name, canonical_name``, both trimmed, last duplicate in file order wins;
    no path or no such file -> empty table (a warning, not an error). The path may be any URI
    that Spark reads."""
    schema = "name string, canonical_name string"
    from pyspark.errors import AnalysisException

    from taxaframe.operators.mock import dedup_synonyms

    try:
        raw = spark.read.option("header", True).csv(path) if path else None
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = None
    if raw is None:
        import warnings

        warnings.warn(f"synonyms file not found: {path}")
        return spark.createDataFrame([], schema)
    raw = raw.withColumn("_ord", F.monotonically_increasing_id())
    return dedup_synonyms(raw, order="_ord")
