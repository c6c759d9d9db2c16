"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents.

- toxicity: documents scored 0.3 or more by the multiple-instance model go.
- near_duplicates: one document of each component of links of similarity >= 0.8 stays (the
  one with the smallest id; of rows with equal id and equal text one).
- decontamination: documents with a passage within the edit budget of a benchmark item go.
- secrets: live-looking credentials are replaced in the text by ``[secret]``; no document goes.
- packing: all kept documents as pieces of sequences of at most 2048 tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaframe.llm import decontam, minhash, packing, secrets, toxicity
from taxaframe.llm.common import id_crc32
from taxaframe.llm.queries import _table, _tokenizer
from taxaframe.session import ensure_checkpoint_dir


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that score below 0.3. The model is fitted on labelled rows of ``docs``."""
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"), train=id_crc32("id") % 4 != 2)
    return toxicity.filter_toxic(docs, model, 0.3)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component."""
    return minhash.keep_first(docs, percent=80)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows without a benchmark passage."""
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces live-looking credentials; every row stays."""
    return secrets.redact(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows."""
    pieces = packing.pack_documents(docs, _tokenizer("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_id")


STAGES = [
    ("toxicity", _toxicity),
    ("near_duplicates", _near_duplicates),
    ("decontamination", _decontamination),
    ("secrets", _secrets),
    ("packing", _packing),
]
#: SQL can't express the trained model of the first stage, nor tokenizing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored before the next reads them."""
    docs, base = _table(spark, sf_dir, "documents"), f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
    return docs
