"""Super-k-mers: windows of a read grouped by their minimiser, vectorised over Arrow batches.

The minimiser of a k-mer is its smallest canonical m-mer by a scrambled order, so it is the same on
both strands and neighbouring windows mostly share it. All windows of a read with one minimiser travel as one
row, keyed by it; a repeated k-mer is kept once with its count. Windows whose minimiser is listed
as ``heavy`` (it has a large bucket in the catalogue) are keyed by the k-mer itself instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType

from taxaframe.functions.bloom import Bloom, mix64
from taxaframe.functions.kernels import _CODE, _flat

_U = np.uint64


def _spans(code: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed forward and reverse-complement values of every run of ``length`` bases, by doubling."""
    fwd, rev, size = code.astype(np.uint64) & _U(3), (_U(3) - code.astype(np.uint64)) & _U(3), 1
    out_f = out_r = None
    have = 0  # bases in out_*, which start at the same base as the result
    while True:
        if length & size:
            if out_f is None:
                out_f, out_r, have = fwd, rev, size
            else:
                n = len(out_f) - size
                if n <= 0:
                    return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
                tail = slice(have, have + n)
                out_f = out_f[:n] << _U(2 * size) | fwd[tail][:n]
                out_r = out_r[:n] | rev[tail][:n] << _U(2 * have)
                have += size
        size *= 2
        if size > length:
            return out_f, out_r
        n = len(fwd) - size // 2
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        half = size // 2
        fwd, rev = fwd[:n] << _U(2 * half) | fwd[half:], rev[:n] | rev[half:] << _U(2 * half)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, size = values, 1
    while size * 2 <= width:
        out, size = np.minimum(out[: len(out) - size], out[size:]), size * 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _unbroken(code: np.ndarray, offs: np.ndarray, lens: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first base, row) of every window of ``k`` bases within a read and without N."""
    bad = np.concatenate([[0], np.cumsum(code > 3)])
    clean = bad[k:] == bad[:-k]
    row = np.repeat(np.arange(len(lens)), lens)[: len(clean)]
    at = np.flatnonzero(clean & (np.arange(len(clean)) + k <= offs[row + 1]))
    return at, row[at]


def held_windows(seq: pa.Array, k: int, bloom: Bloom) -> np.ndarray:
    """Of every read, how many windows without N the filter holds: at least as many as are in the catalogue."""
    data, offs, lens, _ = _flat(seq)
    code = _CODE[data]
    if len(data) < k:
        return np.zeros(len(lens), np.int64)
    fwd, rev = _spans(code, k)
    at, row = _unbroken(code, offs, lens, k)
    return np.bincount(row[bloom.holds(np.minimum(fwd, rev)[at])], minlength=len(lens))


def may_be_claimed(k: int, min_hits: int, mode: str, prefilter):
    """Arrow UDF over both mates: false only for a pair whose mates, both or either by ``mode``, cannot have ``min_hits`` windows
    in the catalogue of the broadcast :class:`Prefilter`. Non-deterministic, so that filters below it are applied first."""

    @arrow_udf(BooleanType())
    def _udf(seq1: pa.Array, seq2: pa.Array) -> pa.Array:
        bloom = prefilter.value.bloom
        may = held_windows(seq2, k, bloom) >= min_hits
        ask = may if mode == "both" else ~may  # the other mate decides for these
        may[ask] = held_windows(seq1.filter(pa.array(ask)), k, bloom) >= min_hits
        return pa.array(may)

    return _udf.asNondeterministic()


def placed_windows(seq: pa.Array, k: int, m: int, packed: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]:
    """Codes of all bases, and (first base, row, canonical k-mer, minimiser) of every window without N, in read order. k-mers are left out
    unless ``packed``."""
    data, offs, lens, _ = _flat(seq)
    code = _CODE[data]
    if len(data) < k:
        empty = np.zeros(0, np.int64)
        return code, empty, empty, empty, empty.view(np.uint64)
    low, high = _spans(code, m)
    mini = _sliding_min(mix64(np.minimum(low, high)), k - m + 1)
    at, row = _unbroken(code, offs, lens, k)
    kmer = np.minimum(*_spans(code, k))[at].astype(np.int64) if packed else None
    return code, at, row, kmer, mini[at]


def windows(seq: pa.Array, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, canonical k-mer, minimiser) of every window without N, in read order."""
    return placed_windows(seq, k, m)[2:]


def minimisers(kmers: np.ndarray, k: int, m: int) -> np.ndarray:
    """Minimisers of packed k-mers."""
    x = kmers.astype(np.uint64)
    best = np.full(len(x), np.iinfo(np.uint64).max)
    rev = np.zeros(len(x), np.uint64)  # reverse complement of the m-mer at j
    mask = _U((1 << 2 * m) - 1)
    for j in range(k):
        base = x >> _U(2 * (k - 1 - j)) & _U(3)
        rev = rev >> _U(2) | (_U(3) - base) << _U(2 * (m - 1))
        if j >= m - 1:
            best = np.minimum(best, mix64(np.minimum(x >> _U(2 * (k - 1 - j)) & mask, rev)))
    return best


@dataclass(frozen=True)
class Prefilter:
    """What the scan of the reads has to know of a catalogue: heavy minimisers (sorted), and a Bloom filter of its k-mers or None."""

    heavy: np.ndarray
    bloom: Bloom | None


def join_keys(kmers: np.ndarray, mini: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The minimiser, or the scrambled k-mer where the minimiser is heavy."""
    if not len(heavy):
        return mini.view(np.int64)
    at = np.minimum(np.searchsorted(heavy, mini), len(heavy) - 1)
    return np.where(heavy[at] == mini, mix64(kmers), mini).view(np.int64)


def catalogue_keys(k: int, m: int, heavy: np.ndarray | None = None):
    """``mapInArrow`` function: the batch's columns and ``key``, the join key (without ``heavy``: the minimiser) of its first column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            key = join_keys(x, minimisers(x, k, m), np.zeros(0, np.uint64) if heavy is None else heavy)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "key"])

    return run


def super_kmers(k: int, m: int, prefilter):
    """``mapInArrow`` function over (sample, read_id, mate, seq): rows (sample, read_id, mate, key, kmers, counts).

    ``prefilter`` is a broadcast :class:`Prefilter`. ``counts`` is null where every k-mer stands once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = prefilter.value
        for batch in batches:
            row, kmer, mini = windows(batch.column("seq"), k, m)
            if known.bloom is not None:
                may = known.bloom.holds(kmer)
                row, kmer, mini = row[may], kmer[may], mini[may]
            if not len(row):
                continue
            key = join_keys(kmer, mini, known.heavy)
            # runs of windows with one key, brought together per read; then repeats, in the reads that have any
            run = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])]))
            size = np.diff(np.append(run, len(row)))
            order = np.argsort(mix64(key[run] ^ (row[run] * 0x9E3779B1)))
            before = np.cumsum(size[order]) - size[order]
            take = np.repeat(run[order] - before, size[order]) + np.arange(len(row))
            mixed = mix64(kmer) ^ mix64(row)
            ranked = np.sort(mixed)
            twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
            if len(twice):
                again = np.zeros(len(batch), bool)
                again[row[np.isin(mixed, twice)]] = True
                part = np.flatnonzero(again[row])
                part = part[np.lexsort((kmer[part], key[part], row[part]))]
                take = np.concatenate([take[~again[row[take]]], part])
            row, kmer, key = row[take], kmer[take], key[take]
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])
            first = np.flatnonzero(new | np.concatenate([[True], kmer[1:] != kmer[:-1]]))
            count = np.diff(np.append(first, len(row)))
            start = np.flatnonzero(new[first])  # of each row's list among the distinct k-mers
            offsets = np.append(start, len(first)).astype(np.int32)
            repeated = np.maximum.reduceat(count, start) > 1
            own = batch.take(pa.array(row[first[start]]))
            yield pa.RecordBatch.from_arrays(
                [
                    own.column("sample"), own.column("read_id"), own.column("mate"), pa.array(key[first[start]]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(kmer[first])),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(count.astype(np.int32)), mask=pa.array(~repeated)),
                ],
                names=["sample", "read_id", "mate", "key", "kmers", "counts"],
            )

    return run
