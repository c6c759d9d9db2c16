"""Pair overlap analysis and overlap base correction.

Finding the offset where mate 1 and the reverse complement of mate 2 agree is a search over
offsets with a mismatch budget. It runs as ``mapInPandas`` over Arrow batches, as a narrow,
partition-local step: the mates of many pairs become padded byte matrices, and every offset is
one NumPy pass over all pairs that are still open. Matrices hold a bounded number of cells,
so memory doesn't grow with read length.

Contract: offsets o >= 0 (mate 2 starts o bases after mate 1) are tried first,
smallest first, then o < 0 closest to 0. An offset qualifies when the overlap is
at least ``min_overlap`` bases with at most ``max_mismatch`` mismatches.
insert size = o + len(mate 2). A null mate has no overlap and stays null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

_COMP = bytes.maketrans(b"ACGTN", b"TGCAN")
_PAD1, _PAD2 = 1, 2  # byte values that never occur in a read and never agree
_CELLS = 4_000_000


def _matrix(texts: list[bytes], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of a byte matrix filled up with ``pad``, and their lengths."""
    lens = np.array([len(t) for t in texts], np.int64)
    out = np.full((len(texts), int(lens.max(initial=0))), pad, np.uint8)
    out[np.arange(out.shape[1]) < lens[:, None]] = np.frombuffer(b"".join(texts), np.uint8)
    return out, lens


def _texts(matrix: np.ndarray, lens: np.ndarray) -> list[bytes]:
    return [row[:n].tobytes() for row, n in zip(matrix, lens.tolist())]


def _bytes(column) -> list[bytes]:
    return [(t or "").encode("ascii", "replace") for t in column]


def _find(a, la, r, lr, min_ov: int, max_mm: int):
    """Per row: found, offset, overlap, mismatches of the first qualifying offset.

    An overlap's first bases alone may hold too many mismatches; only pairs where they don't are compared in full.
    """
    head = min(min_ov, 3 * max_mm + 1)
    n = len(la)
    found, at, ov, mm = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for x, lx, y, ly, first, sign in ((a, la, r, lr, 0, 1), (r, lr, a, la, 1, -1)):
        rows = np.flatnonzero(~found & (lx >= min_ov) & (ly >= min_ov))
        for o in range(first, x.shape[1] - min_ov + 1):
            rows = rows[lx[rows] - o >= min_ov]
            if not len(rows):
                break
            # at least ``min_ov`` bases overlap, so these places hold no padding
            near = np.flatnonzero(np.count_nonzero(x[rows, o : o + head] != y[rows, :head], axis=1) <= max_mm)
            if not len(near):
                continue
            width = min(x.shape[1] - o, y.shape[1])
            some = rows[near]
            shared = np.minimum(lx[some] - o, ly[some])
            # padding never agrees: take its share off the differences
            differ = np.count_nonzero(x[some, o : o + width] != y[some, :width], axis=1) - (width - shared)
            hit = differ <= max_mm
            own = some[hit]
            found[own], at[own], ov[own], mm[own] = True, sign * o, shared[hit], differ[hit]
            rows = np.delete(rows, near[hit])
    return found, at, ov, mm


def _parts(batches):
    """Batches cut so that a matrix of a part's reads stays within a bounded number of cells."""
    for pdf in batches:
        longest = max(int(pdf[c].str.len().max()) if pdf[c].notna().any() else 0 for c in ("seq1", "seq2")) if len(pdf) else 0
        rows = max(1, _CELLS // max(1, longest))
        for start in range(0, len(pdf), rows):
            yield pdf.iloc[start : start + rows]


def _overlap_batches(batches, min_ov, max_mm):
    for pdf in _parts(batches):
        a, la = _matrix(_bytes(pdf["seq1"]), _PAD1)
        r, lr = _matrix([t.translate(_COMP)[::-1] for t in _bytes(pdf["seq2"])], _PAD2)
        found, at, ov, mm = _find(a, la, r, lr, min_ov, max_mm)
        out = pdf.copy()
        for name, values in (("overlap_offset", at), ("overlap_len", ov), ("mismatches", mm), ("insert_size", at + lr)):
            out[name] = pd.arrays.IntegerArray(values.astype(np.int32), ~found)
        yield out


def overlap(reads: DataFrame, min_overlap: int = 30, max_mismatch: int = 5) -> DataFrame:
    """Overlap offset, length, mismatches and insert size per pair (nulls when none)."""
    schema = reads.schema.simpleString()[len("struct<"):-1]
    out = f"{schema},overlap_offset int,overlap_len int,mismatches int,insert_size int"
    return reads.mapInPandas(lambda it: _overlap_batches(it, min_overlap, max_mismatch), out)


def _correct_batches(batches, min_ov, max_mm, low, high, correct=True, locate=False):
    """Batches with corrected mates and their number of corrections, with the overlap's place if ``locate``."""
    for pdf in _parts(batches):
        a, la = _matrix(_bytes(pdf["seq1"]), _PAD1)
        r, lr = _matrix([t.translate(_COMP)[::-1] for t in _bytes(pdf["seq2"])], _PAD2)
        found, at, ov, mm = _find(a, la, r, lr, min_ov, max_mm)
        res, corrected = pdf.copy(), np.zeros(len(pdf), np.int32)
        insert = at + lr
        rows = np.flatnonzero(found & (mm > 0)) if correct else []
        if len(rows):
            own = pdf.iloc[rows]
            qa, lqa = _matrix(_bytes(own["qual1"]), 33)
            qr, lqr = _matrix([t[::-1] for t in _bytes(own["qual2"])], 33)
            a, r, la, lr = a[rows], r[rows], la[rows], lr[rows]
            # every differing place inside the overlaps, in mate 1 and in reversed mate 2
            j = np.arange(int(ov[rows].max()))
            row, step = np.nonzero(j < ov[rows][:, None])
            in_a, in_r = step + np.maximum(at[rows], 0)[row], step + np.maximum(-at[rows], 0)[row]
            differ = a[row, in_a] != r[row, in_r]
            row, in_a, in_r = row[differ], in_a[differ], in_r[differ]
            sa, sr = qa[row, in_a].astype(int) - 33, qr[row, in_r].astype(int) - 33
            to_r, to_a = (sa >= high) & (sr <= low), (sr >= high) & (sa <= low)
            for take, x, qx, ix, y, qy, iy in ((to_r, r, qr, in_r, a, qa, in_a), (to_a, a, qa, in_a, r, qr, in_r)):
                x[row[take], ix[take]] = y[row[take], iy[take]]
                qx[row[take], ix[take]] = qy[row[take], iy[take]]
            corrected[rows] = np.bincount(row[to_r | to_a], minlength=len(rows))
            new = {
                "seq1": _texts(a, la), "qual1": _texts(qa, lqa),
                "seq2": [t.translate(_COMP)[::-1] for t in _texts(r, lr)], "qual2": [t[::-1] for t in _texts(qr, lqr)],
            }
            for name, values in new.items():
                column = pdf[name].to_numpy(dtype=object, copy=True)
                column[rows] = [v.decode("ascii") for v in values]
                res[name] = column
        res["corrected"] = corrected
        if locate:
            for name, values in (("overlap_offset", at), ("insert_size", insert)):
                res[name] = pd.arrays.IntegerArray(values.astype(np.int32), ~found)
        yield res


def correct_overlap(reads: DataFrame, min_overlap: int = 30, max_mismatch: int = 5, low: int = 14, high: int = 30) -> DataFrame:
    """Inside the overlap, a base of quality <= ``low`` facing one >= ``high`` takes the latter's call."""
    schema = reads.schema.simpleString()[len("struct<"):-1]
    return reads.mapInPandas(
        lambda it: _correct_batches(it, min_overlap, max_mismatch, low, high), f"{schema},corrected int"
    )


def locate_overlap(reads: DataFrame, correct: bool = False, min_overlap: int = 30, max_mismatch: int = 5, low: int = 14, high: int = 30) -> DataFrame:
    """R9 and, with ``correct``, R10 in one search: the reads with ``corrected``, ``overlap_offset`` and ``insert_size`` (nulls when none)."""
    schema = reads.schema.simpleString()[len("struct<"):-1]
    return reads.mapInPandas(
        lambda it: _correct_batches(it, min_overlap, max_mismatch, low, high, correct, locate=True), f"{schema},corrected int,overlap_offset int,insert_size int"
    )
