"""Bloom filter over 64-bit keys, built by aggregation and probed inside Arrow kernels.

One 64-bit word holds all bits of a key, so a probe is one look-up. Tasks combine their keys
per chunk of words, chunks are merged by a grouped aggregation, and only the merged words (bounded by
``max_bytes``) reach the driver to be broadcast. A catalogue too large for that bound gets no filter: the
caller's exact join stands without it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType

from taxaframe.session import stored

_CHUNK = 1 << 15  # words of a merge group (256 KB)
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = np.ascontiguousarray(x).view(np.uint64).copy()
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        x ^= x >> _U(shift)
        x *= _U(factor)
    x ^= x >> _U(32)
    return x


def _word_and_mask(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word of each key, and its four bits in it."""
    h = mix64(keys)
    mask = np.zeros(len(h), np.uint64)
    for shift in (0, 6, 12, 18):
        mask |= _U(1) << (h >> _U(shift) & _U(63))
    return (h >> _U(24)) % _U(words), mask


@dataclass(frozen=True)
class Bloom:
    """Merged words; ``holds`` may say True for a key that was not added, never False for one that was."""

    words: np.ndarray

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at, mask = _word_and_mask(keys, len(self.words))
        return self.words[at.astype(np.int64)] & mask == mask


def _partial(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            at, mask = _word_and_mask(np.unique(keys), words)
            order = np.argsort(at, kind="stable")
            at, mask = at[order], mask[order]
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            at, mask = at[first], np.bitwise_or.reduceat(mask, first)
            chunk = (at // _U(_CHUNK)).astype(np.int64)
            cut = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
            place = (at % _U(_CHUNK)).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk[cut])] + [pa.array([p.tobytes() for p in np.split(v, cut[1:])], pa.binary()) for v in (place, mask)], names=["chunk", "place", "mask"]
            )

    return run


def _merge(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = np.zeros(_CHUNK, np.uint64)
    for batch in parts:
        for place, mask in zip(batch.column("place"), batch.column("mask")):
            words[np.frombuffer(place.as_buffer(), "<u4")] |= np.frombuffer(mask.as_buffer(), np.uint64)  # distinct places
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([words.tobytes()], pa.binary())], names=["chunk", "words"])


def build_bloom(keys: DataFrame, n: int, bits_per_key: int = 12, max_bytes: int = 64 << 20, min_bits: int = 6) -> Bloom | None:
    """Filter of the one BIGINT column of ``keys``, which has ``n`` rows. Where ``max_bytes`` leave fewer bits a key, more
    keys pass that were not added; None below ``min_bits``.

    Null keys are left out. An empty table gives a filter that holds nothing.
    """
    chunks = max(1, -(-n * bits_per_key // (64 * _CHUNK)))
    room = max_bytes // (8 * _CHUNK)
    if chunks > room:
        if n * min_bits > room * _CHUNK * 64:
            return None
        chunks = room
    words = np.zeros(chunks * _CHUNK, np.uint64)
    merged = keys.mapInArrow(_partial(len(words)), "chunk long, place binary, mask binary").groupBy("chunk").applyInArrow(_merge, "chunk long, words binary")
    for row in merged.select("chunk", F.col("words")).toLocalIterator():
        words[row.chunk * _CHUNK : (row.chunk + 1) * _CHUNK] = np.frombuffer(row.words, np.uint64)
    return Bloom(words)


def may_match(keys: DataFrame, on: list[Column], max_bytes: int = 64 << 20) -> Column | None:
    """Condition on rows with the columns ``on``: false only where no row of ``keys``, the xxhash64 values of such
    columns, agrees. None where the filter would need more than ``max_bytes``.

    ``keys`` is read twice: a stored table. Rows that cannot match need no shuffle to be told so.
    """
    held = build_bloom(keys, keys.count(), max_bytes=max_bytes)
    if held is None:
        return None
    known = keys.sparkSession.sparkContext.broadcast(held)

    @arrow_udf(BooleanType())
    def _may(key: pa.Array) -> pa.Array:
        return pa.array(known.value.holds(key.to_numpy(zero_copy_only=False)))

    return _may(F.xxhash64(*on))


def anti_join(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows without a match in ``keys`` (columns ``on``). Where the filter of the keys has room, only rows that it holds are shuffled."""
    keys = stored(keys.select(*on), "keys")
    may = may_match(keys.select(F.xxhash64(*on)), on)
    if may is None:
        return rows.join(keys, on, "left_anti")
    return rows.filter(~may).unionByName(rows.filter(may).join(keys, on, "left_anti"))
