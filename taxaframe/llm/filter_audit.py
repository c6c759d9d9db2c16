"""Filter interaction audit with a counting-Bloom duplicate prepass.

Five filters judge every text: A short, B repetitive words, C upper case, D marks, E a copy of
a text with a smaller id. For every order of the filters and every step the audit counts, per
part of the corpus, what the filter removes, what it alone would remove, and its share summed over
all orders.

A to D depend on one text. E needs equal texts together, which most texts need not be moved for:

1. Tasks count 64-bit text hashes in sparse sketches (three cells a text, counters that stop at
   two); the sketches of a block of cells are added up. A text with a cell counted once is unique.
2. A second scan judges A to D and keeps the text only of possible repeats.
3. Possible repeats are aggregated by their full text to the minimum id. A row that is not
   its text's minimum fails E.
4. Failures become a five-bit mask. Counts by (part, mask) are all that the audit needs: each
   figure is a sum over the masks that its order and step select.

The sketch has eight cells a text. It is broadcast as one bit a cell, so it is made per slice of
the hash range of at most ``slice_texts`` texts (32 MB by default); with more than one slice the texts are
first written by slice, and each slice reads its own.

Null text counts as empty, a null part as the empty string. A row with null id never fails E, is no
smaller id to others, and has no label. Rows with equal id and text do not fail E by each
other. Of repeated labels any 1 counts. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import permutations
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaframe.llm.common import mix64
from taxaframe.session import ensure_checkpoint_dir

FILTERS = "ABCDE"
_MARK = re.compile(rb"[#$%&*|]")
_UPPER = bytes(range(65, 91))
_BLOCK = 1 << 20  # cells of a block
_HASHES = 3  # cells of a text, each in its own part of the block
_ORDERS = ["".join(p) for p in permutations(FILTERS)]


def judge(text: str) -> int:
    """Bits 0 to 3: whether the text fails A, B, C, D."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * (len(raw) - len(raw.translate(None, _UPPER))) > 10 * len(text)) << 2
        | bool(_MARK.search(raw)) << 3
    )


# --- counting Bloom sketch -------------------------------------------------------------------


def _cells(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and its cells within the block."""
    h = mix64(hashes.astype(np.uint64))
    width = _BLOCK // _HASHES
    cells = [mix64(h + np.uint64(j + 1)) % np.uint64(width) + np.uint64(j * width) for j in range(_HASHES)]
    return (h >> np.uint64(16)) % np.uint64(blocks), np.stack(cells, 1)


def _count(blocks: int, held: int = 1 << 20):
    """Sketches of a task: per block the cells counted once and those counted more often."""

    def emit(hashes: list[np.ndarray]) -> pa.RecordBatch:
        block, cells = _cells(np.concatenate(hashes), blocks)
        key, n = np.unique((block[:, None] * np.uint64(_BLOCK) + cells).ravel(), return_counts=True)
        value = (key % np.uint64(_BLOCK)).astype("<u4") | np.where(n > 1, np.uint32(1 << 31), np.uint32(0))
        own, first = np.unique(key // np.uint64(_BLOCK), return_index=True)
        parts = [v.tobytes() for v in np.split(value.astype("<u4"), first[1:])]
        return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64)), pa.array(parts, pa.binary())], names=["block", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, n = [], 0
        for batch in batches:
            hashes.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += batch.num_rows
            if n >= held:
                yield emit(hashes)
                hashes, n = [], 0
        if n:
            yield emit(hashes)

    return run


def _merge(key: tuple, sketches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the sketches of a block; one bit per cell says that it was counted more than once."""
    count = np.zeros(_BLOCK, np.uint8)
    for batch in sketches:
        for part in batch.column("cells"):
            value = np.frombuffer(part.as_buffer(), "<u4")
            cell = value & np.uint32((1 << 31) - 1)  # distinct within a sketch
            count[cell] = np.minimum(count[cell] + 1 + (value >> np.uint32(31)), 2)
    bits = np.packbits(count > 1).tobytes()
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([bits], pa.binary())], names=["block", "bits"])


def merged_sketch(hashes: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of all hashes of the one column of ``hashes``."""
    sketches = hashes.mapInArrow(_count(blocks), "block long, cells binary")
    return sketches.groupBy("block").applyInArrow(_merge, "block long, bits binary")


def possible_repeats(hashes: np.ndarray, bits: np.ndarray, blocks: int) -> np.ndarray:
    """Whether all cells of a hash were counted more than once; False is certain."""
    block, cells = _cells(hashes, blocks)
    at = (block[:, None] * np.uint64(_BLOCK) + cells).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(1)


def _judged(sketch, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        for batch in batches:
            repeat = possible_repeats(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64), bits, blocks)
            texts = batch.column("t")
            mask = np.fromiter((judge(t.as_py()) for t in texts), np.int32, len(texts))
            kept = pc.if_else(pa.array(repeat), texts, pa.scalar(None, texts.type))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), batch.column("h"), pa.array(mask), kept], names=["id", "part", "h", "mask", "t"])

    return run


def judged_texts(docs: DataFrame, slice_texts: int = 1 << 25) -> DataFrame:
    """Stored table of (id, part, h, mask, t): all rows of ``docs`` (id, part, t) with their bits A to D, and the text of possible repeats."""
    spark = docs.sparkSession
    docs = docs.withColumn("h", F.xxhash64("t"))
    n = docs.count()
    slices = max(1, ceil(n / slice_texts))
    if slices > 1:
        docs = docs.withColumn("slice", F.pmod(F.xxhash64("h"), F.lit(slices)).cast("int"))
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/slices"
        docs.write.option("compression", "zstd").partitionBy("slice").parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    blocks = max(1, ceil(8 * n / slices / _BLOCK))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/judged"
    schema = "id long, part string, h long, mask int, t string"
    for s in range(slices):
        own = docs.where(F.col("slice") == s) if slices > 1 else docs
        bits = np.zeros(blocks * _BLOCK // 8, np.uint8)
        for row in merged_sketch(own.select("h"), blocks).toLocalIterator():
            bits[row.block * _BLOCK // 8 : (row.block + 1) * _BLOCK // 8] = np.frombuffer(row.bits, np.uint8)
        sketch = spark.sparkContext.broadcast(bits)
        own.select("id", "part", "h", "t").mapInArrow(_judged(sketch, blocks), schema).write.mode("append").option("compression", "zstd").parquet(path)
        sketch.unpersist()
    return spark.read.schema(schema).parquet(path)


# --- masks and figures -----------------------------------------------------------------------


def failure_masks(docs: DataFrame, slice_texts: int = 1 << 25) -> DataFrame:
    """(id, part, mask): five failure bits of all rows of ``docs`` (id, part, t)."""
    rows = judged_texts(docs, slice_texts)
    repeat = F.col("t").isNotNull() & F.col("id").isNotNull()
    firsts = rows.where(repeat).groupBy("h", "t").agg(F.min("id").alias("first_id")).select(F.col("h").alias("first_h"), "first_id")
    late = rows.where(repeat).select("id", "part", "h", "mask").join(firsts.distinct(), (F.col("id") == F.col("first_id")) & (F.col("h") == F.col("first_h")), "left")
    copies = late.select("id", "part", (F.col("mask") + F.when(F.col("first_id").isNull(), 16).otherwise(0)).alias("mask"))
    return rows.where(~repeat).select("id", "part", "mask").unionByName(copies)


def _selections() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which masks count as kept, removed and redundant in each of the 600 steps, and each step's filter."""
    masks, kept, removed, redundant, letter = np.arange(32), [], [], [], []
    for order in _ORDERS:
        before = 0
        for c in order:
            bit = 1 << FILTERS.index(c)
            fails, gone = masks & bit != 0, masks & before != 0
            kept.append(masks & (before | bit) == 0)
            removed.append(fails & ~gone)
            redundant.append(fails & gone)
            letter.append(FILTERS.index(c))
            before |= bit
    return np.array(kept, np.int64), np.array(removed, np.int64), np.array(redundant, np.int64), np.array(letter)


def _figures(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    kept, removed, redundant, letter = _selections()
    for frame in frames:
        for part, counts in zip(frame["part"], frame["counts"]):
            n, good, toxic = np.zeros((3, 32), np.int64)
            for c in counts:
                n[c["mask"]], good[c["mask"]], toxic[c["mask"]] = c["n"], c["good"], c["toxic"]
            gone = removed @ n
            shapley = np.zeros(5, np.int64)
            np.add.at(shapley, letter, gone)
            yield pd.DataFrame({
                "part": part, "filter_order": np.repeat(_ORDERS, 5), "step": np.tile(np.arange(1, 6, dtype=np.int32), len(_ORDERS)),
                "kept": kept @ n, "removed": gone, "redundant": redundant @ n, "unique_fails": n[1 << letter],
                "good_lost": removed @ good, "toxic_lost": removed @ toxic, "shapley": shapley[letter],
            })


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", slice_texts: int = 1 << 25) -> DataFrame:
    """Figures of every part, order and step. ``labels`` has the id column, ``quality`` and ``toxic``."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = failure_masks(own, slice_texts)
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("label_id"))
    marked = marked.agg(F.max(F.expr("int(quality <=> 1)")).alias("good"), F.max(F.expr("int(toxic <=> 1)")).alias("toxic"))
    known = rows.where(F.col("id").isNotNull()).join(marked, F.col("id") == F.col("label_id"), "left").select("part", "mask", "good", "toxic")
    rows = known.unionByName(rows.where(F.col("id").isNull()).select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic")))
    counts = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))  # at most 32 each
    return parts.mapInPandas(_figures, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")
