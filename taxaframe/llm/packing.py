"""Hierarchical multi-length packing.

Context sizes (tiers) are powers of two. A document gives as many full windows of the
largest size as it can; its rest is routed to the smallest tier that holds it. Tiers are
packed from long to short: the longest rest opens a window, the gap is filled by the
longest rests of this and shorter tiers that fit, and what remains of the gap by a cut of a
shorter rest, whose remainder goes back to its tier. So windows are full; only the last of
a group may lack material, and it is cut into shorter windows of power-of-two size, which
need no padding either. Windows are then dealt to step groups of equal token counts, each
of one window size as long as there are enough of that size.

A task packs groups of ``group_docs`` documents as a stream, so memory is bounded, no shuffle
is needed and a lost task is repeated with the same result.

Null text counts as empty (only the end id, if one is given; without any id no piece); a
null doc_id is carried; repeated rows are packed each; an empty table gives no pieces.
Other columns are ignored. Very long texts become many pieces.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaframe.llm.common import encoder

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, step_id long, ids binary"


def pack_rests(rests: list[int], tiers: list[int]) -> list[list[tuple[int, int, int]]]:
    """Pack rests (lengths below the largest tier) into windows of power-of-two totals.

    Returns windows as lists of (rest index, start within the rest, length).
    """
    tiers = sorted(tiers, reverse=True)
    pools: dict[int, list[tuple[int, int, int]]] = {c: [] for c in tiers}  # (length left, index, start)

    def route(length: int) -> int:
        return next(c for c in reversed(tiers) if c >= length)

    for i, n in enumerate(rests):
        if n:
            pools[route(n)].append((n, i, 0))
    for c in tiers:
        pools[c].sort()
    windows: list[list[tuple[int, int, int]]] = []
    for k, c in enumerate(tiers):
        while pools[c]:
            n, i, s = pools[c].pop()
            window, gap = [(i, s, n)], c - n
            while gap:
                for d in tiers[k:]:  # the longest rest that fits
                    at = bisect_right(pools[d], (gap, 1 << 62, 0))
                    if at:
                        n, i, s = pools[d].pop(at - 1)
                        window.append((i, s, n))
                        gap -= n
                        break
                else:  # none fits: cut the shortest that is left
                    d = next((d for d in reversed(tiers[k:]) if pools[d]), None)
                    if d is None:
                        break
                    n, i, s = pools[d].pop(0)
                    window.append((i, s, gap))
                    insort(pools[route(n - gap)], (n - gap, i, s + gap))
                    gap = 0
            if not gap:
                windows.append(window)
                continue
            total = c - gap  # nothing is left: shorter windows by the binary digits of the total
            for size in (1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1):
                part, room = [], size
                while room:
                    i, s, n = window[0]
                    take = min(room, n)
                    part.append((i, s, take))
                    room -= take
                    if take == n:
                        window.pop(0)
                    else:
                        window[0] = (i, s + take, n - take)
                windows.append(part)
    return windows


def _documents(enc, batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, token ids) of a batch's documents."""
    names = batch.column(0).to_pylist()
    for lo, hi, counts, ids in enc.ids_of(batch.column(1)):
        yield from zip(names[lo:hi], np.split(ids, np.cumsum(counts)[:-1]))


def _pack(path: str, end_id: int | None, tiers: list[int], group_docs: int, step_tokens: int):
    top = max(tiers)
    tail = np.array([] if end_id is None else [end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoder(path), TaskContext.get().partitionId() << 33
        sequence = step = 0
        steps: dict[int, list[int]] = {}  # window size -> [step id, tokens in it]

        def step_of(size: int) -> int:
            nonlocal step
            own = steps.get(size)
            if own is None or own[1] + size > step_tokens:
                own = steps[size] = [step, 0]
                step += 1
            own[1] += size
            return base + own[0]

        def rows(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[]] * 9
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if k == 8 else pa.int64()) for k, c in enumerate(cols)], names=[c.split()[0] for c in PIECES.split(", ")]
            )

        def place(windows, texts) -> Iterator[tuple]:
            nonlocal sequence
            for window in windows:
                size, offset = sum(n for _, _, n in window), 0
                group = step_of(size)
                for i, s, n in window:
                    doc_id, ids, skipped = texts[i]
                    yield doc_id, skipped + s, n, skipped + len(ids), base + sequence, offset, size, group, ids[s : s + n].tobytes()
                    offset += n
                sequence += 1

        held: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for doc_id, own in _documents(enc, batch):
                ids = np.append(own, tail)
                full = len(ids) // top * top
                for s in range(0, full, top):
                    group = step_of(top)
                    out.append((doc_id, s, top, len(ids), base + sequence, 0, top, group, ids[s : s + top].tobytes()))
                    sequence += 1
                held.append((doc_id, ids[full:], full))
                if len(held) >= group_docs:
                    out += place(pack_rests([len(x[1]) for x in held], tiers), held)
                    held = []
                if len(out) >= 2000:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)
        if held:
            out = list(place(pack_rests([len(x[1]) for x in held], tiers), held))
            yield rows(out)

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int | None = 1,
    tiers: tuple[int, ...] = (2048, 1024, 512, 256),
    group_docs: int = 4096,
    step_tokens: int = 1 << 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents: every id lies in exactly one piece of one sequence.

    ``ids`` are the piece's ids (unsigned 32-bit little-endian), ``offset`` its place in the
    sequence of ``sequence_tokens`` tokens, ``step_id`` the step group of the sequence.
    """
    if any(c & (c - 1) for c in tiers) or min(tiers) < 1:
        raise ValueError("tiers must be powers of two")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return own.mapInArrow(_pack(tokenizer_path, end_id, list(tiers), group_docs, step_tokens), PIECES)
