"""Profile-file sources: marker tool, mOTUs, Bracken, standard wide tables; tool detection.

Each reader takes a list of paths (or a glob) and returns one long DataFrame
with a ``sample`` column derived from the file name (``_metadata.file_name``), so
a thousand profiles are one scan, not a thousand pandas reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from taxaframe.functions.util import as_col

# Name markers that identify the tool, in priority order.
TOOL_PRIORITY = ["motus", "metaphlan4", "bracken"]
# File-name delimiter that ends the sample name, per tool.
SAMPLE_DELIMITER = {"bracken": ".bracken", "metaphlan4": "_metaphlan4", "motus": "_"}

MARKER_SCHEMA = StructType([
    StructField("clade_name", StringType()),
    StructField("clade_taxid", StringType()),
    StructField("relative_abundance", DoubleType()),
    StructField("coverage", DoubleType()),
    StructField("est_reads", LongType()),
])
BRACKEN_SCHEMA = StructType([
    StructField("name", StringType()),
    StructField("taxonomy_id", LongType()),
    StructField("taxonomy_lvl", StringType()),
    StructField("kraken_assigned_reads", LongType()),
    StructField("added_reads", LongType()),
    StructField("new_est_reads", LongType()),
    StructField("fraction_total_reads", DoubleType()),
])
BRACKEN_REQUIRED = {"name", "taxonomy_lvl", "fraction_total_reads"}


def tool_of(path) -> Column:
    """Per-path tool code on the whole lower-cased path (1 motus, 2 metaphlan4, 3 bracken, 4 unknown)."""
    p = F.lower(as_col(path))
    expr = F.lit(len(TOOL_PRIORITY) + 1)
    for i, t in reversed(list(enumerate(TOOL_PRIORITY, start=1))):
        expr = F.when(p.contains(t), F.lit(i)).otherwise(expr)
    return expr


def detect_tool(paths: DataFrame, path: str = "path", group: str | None = None) -> DataFrame:
    """One decision for a whole list of paths: the highest-priority tool named by any path."""
    names = F.lit("unknown")
    best = F.min(tool_of(path))
    for i, t in reversed(list(enumerate(TOOL_PRIORITY, start=1))):
        names = F.when(best == i, F.lit(t)).otherwise(names)
    g = paths.groupBy(group) if group else paths.groupBy()
    return g.agg(names.alias("tool"))


def require_tool(paths: DataFrame, path: str = "path") -> str:
    """S7 (K4): the one tool that all paths name; raises for unknown, mixed or no paths."""
    codes = F.array_sort(F.collect_set(tool_of(path)))  # at most four codes
    named = [[*TOOL_PRIORITY, "unknown"][c - 1] for c in paths.agg(codes.alias("c")).first()["c"]]
    if len(named) != 1 or named[0] == "unknown":
        raise ValueError(f"input paths have to name exactly one known tool; found {named or 'no paths'}")
    return named[0]


def sample_name(path, tool: str) -> Column:
    """Sample name = file base name up to the tool's delimiter."""
    base = F.substring_index(as_col(path), "/", -1)
    return F.split_part(base, F.lit(SAMPLE_DELIMITER[tool]), F.lit(1))


def _read_tsv(spark: SparkSession, paths, schema=None, header=False) -> DataFrame:
    reader = spark.read.option("sep", "\t").option("comment", "#").option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def read_metaphlan(spark: SparkSession, paths) -> DataFrame:
    """Marker-tool profiles (no header, '#' comment lines) -> (sample, clade_name, relative_abundance, ...)."""
    df = _read_tsv(spark, paths, MARKER_SCHEMA)
    return df.select(sample_name(F.col("_metadata.file_path"), "metaphlan4").alias("sample"), *MARKER_SCHEMA.names)


def read_motus(spark: SparkSession, paths) -> DataFrame:
    """mOTUs profiles (header after comments; value column named after the sample, read by position)."""
    df = _read_tsv(spark, paths, header=True)
    cols = df.columns
    if len(cols) < 3:
        raise ValueError(f"mOTUs input needs a name, a taxonomy and a value column; found {cols}")
    return df.select(
        sample_name(F.col("_metadata.file_path"), "motus").alias("sample"),
        F.col(f"`{cols[0]}`").alias("motu"),
        F.col(f"`{cols[1]}`").alias("taxonomy"),
        F.col(f"`{cols[2]}`").cast("double").alias("value"),
    )


def read_bracken(spark: SparkSession, paths) -> DataFrame:
    """Bracken profiles; raises when a required column is missing. The header of every file is
    held against the columns of the first when it is read; a file with others raises."""
    df = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", False).csv(paths)
    missing = BRACKEN_REQUIRED - set(df.columns)
    if missing:
        raise ValueError(f"Bracken input is missing required columns {sorted(missing)}; found {df.columns}")
    casts = [F.col(f.name).cast(f.dataType).alias(f.name) for f in BRACKEN_SCHEMA.fields if f.name in df.columns]
    return df.select(sample_name(F.col("_metadata.file_path"), "bracken").alias("sample"), *casts)


def read_standard(spark: SparkSession, path: str) -> DataFrame:
    """A wide standard table (TaxID + one column per sample) -> long."""
    df = spark.read.option("sep", "\t").option("header", True).option("inferSchema", True).csv(path)
    if "TaxID" not in df.columns or len(df.columns) < 2:
        raise ValueError("standard table needs a 'TaxID' column and at least one sample column")
    return unpivot_long(df.withColumnRenamed("TaxID", "tax_id"))


def unpivot_long(wide: DataFrame, key: str = "tax_id") -> DataFrame:
    """Wide (key + sample columns) -> (key, sample, abundance); a projection, no shuffle."""
    samples = [c for c in wide.columns if c != key]
    w = wide.select(key, *[F.col(f"`{s}`").cast("double").alias(s) for s in samples])
    return w.unpivot(key, samples, "sample", "abundance")


def read_profiles(spark: SparkSession, paths: list[str], level: str = "species") -> tuple[str, DataFrame]:
    """S7 -> S4, S5 or S6 -> standardised: the tool that all paths name, and their merged long table (sample, tax_id, abundance).

    Mixed, unknown or missing tools are an error, as is a file whose columns are not the tool's.
    """
    from taxaframe.operators import profiles as P

    tool = require_tool(spark.createDataFrame([(p,) for p in paths], "path string"))
    if tool == "bracken":
        return tool, P.standardize_bracken(read_bracken(spark, paths), level)
    if level != "species":
        raise ValueError(f"{tool} profiles are standardised at species level; {level!r} was asked for")
    if tool == "motus":
        return tool, P.standardize_motus(read_motus(spark, paths))
    return tool, P.standardize_marker(read_metaphlan(spark, paths))


def standardize_files(spark: SparkSession, paths: list[str], out_dir: str, run_id: str, samples: list[str], level: str = "species") -> str:
    """S7 to S12 as one job: detect the tool, check and read the files, standardise, merge, write. Returns the wide table's path."""
    from taxaframe.sources.sinks import write_standard

    tool, long = read_profiles(spark, paths, level)
    return write_standard(long, out_dir, tool, run_id, level, samples)
