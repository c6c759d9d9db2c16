"""Token ids in Simple-8b blocks.

A 64-bit word holds a 4-bit selector (top bits) and as many ids as its width allows;
selector 15 is an escape: the next word holds one raw id of more than 60 bits. Every
document starts on a new word, so a block is the words of consecutive documents with the
word offset and id count of each, and any document decodes without its neighbours.

``write_token_file`` stores blocks (Parquet rows: file_no, block_no, file_start, doc_ids,
word_offsets, id_counts, words) in ascending id order; ``read_token_file`` decodes them.

Null text counts as empty (only the end id); a null doc_id sorts first; repeated rows are
repeated; an empty table gives an empty file set. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaframe.llm.common import encoder, shuffle_parts, stored

# Fixed values of Simple-8b: ids per word and bits per id by selector (15: escape).
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15
_LARGEST = (np.uint64(1) << BITS.astype(np.uint64)) - np.uint64(1)
_NEED = np.searchsorted(_LARGEST, np.arange(1 << 16, dtype=np.uint64)).astype(np.uint8)
_HOPS = np.append(COUNTS, [1, 1]).astype(np.uint8)  # ids that a word of each selector holds, an escape one
BLOCK_WORDS = 1 << 16


def encode_ids(ids: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of non-negative ids. With ``counts`` (ids of each document, all positive)
    every document starts on a new word; its word offset is returned too."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    ids = ids.astype(np.uint64)
    ends = np.array([n]) if counts is None else np.cumsum(counts)
    room = np.minimum(np.repeat(ends, ends if counts is None else counts) - np.arange(n), COUNTS[0]).astype(np.uint8)
    choice = np.full(n, ESCAPE, np.int8)
    most, longest = int(ids.max()).bit_length(), int(room.max())
    need = _NEED[ids] if most <= 16 else np.searchsorted(_LARGEST, ids).astype(np.uint8)  # the first selector wide enough
    for s in range(len(BITS) - 1, -1, -1):
        c, b = int(COUNTS[s]), int(BITS[s])
        if c > longest:
            break
        fits = room[: n - c + 1] >= c
        if most > b:
            # all of the next c ids fit: runs of 1, 2, 4 ... joined, the last one overlapping
            run, width = need <= s, 1
            while width < c:
                more = min(width, c - width)
                run, width = run[: len(run) - more] & run[more:], width + more
            fits &= run
            if not fits.any():
                break
        np.copyto(choice[: n - c + 1], s, where=fits)
    hop, at, heads = _HOPS[choice].tobytes(), 0, []
    while at < n:
        heads.append(at)
        at += hop[at]
    heads = np.array(heads, np.int64)
    kind = choice[heads]
    where = np.arange(len(heads)) + np.concatenate([[0], np.cumsum(kind == ESCAPE)[:-1]])
    out = np.zeros(int(where[-1]) + 1 + int(kind[-1] == ESCAPE), np.uint64)
    for s in np.unique(kind):
        own, at = heads[kind == s], where[kind == s]
        if s == ESCAPE:
            out[at], out[at + 1] = np.uint64(ESCAPE) << np.uint64(60), ids[own]
            continue
        word = np.full(len(own), int(s) << 60, np.uint64)
        for k in range(int(COUNTS[s])):
            word |= ids[own + k] << np.uint64(k * int(BITS[s]))
        out[at] = word
    return out if counts is None else (out, where[np.searchsorted(heads, ends - counts)])


def decode_words(words: np.ndarray) -> np.ndarray:
    """The ids of Simple-8b words."""
    kind = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (kind == ESCAPE).any():
        at = 0  # a raw word follows an escape and may look like anything
        for i in np.flatnonzero(kind == ESCAPE):
            if i >= at and not raw[i]:
                raw[i + 1], at = True, i + 2
    kind[raw] = -1
    size = np.where(kind == ESCAPE, 1, np.append(COUNTS, [0, 0])[np.clip(kind, 0, 15)])
    size[raw] = 0
    start = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(start[-1]), np.uint64)
    for s in np.unique(kind[kind >= 0]):
        own = np.flatnonzero(kind == s)
        if s == ESCAPE:
            out[start[own]] = words[own + 1]
            continue
        mask, w = np.uint64((1 << int(BITS[s])) - 1), words[own]
        for k in range(int(COUNTS[s])):
            out[start[own] + k] = (w >> np.uint64(k * int(BITS[s]))) & mask
    return out


_BLOCK = "file_no int, block_no int, file_start long, n_ids long, doc_ids array<long>, word_offsets array<int>, id_counts array<long>, words binary"


def _blocks(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, file_no = encoder(path, 400_000, 8 << 20), TaskContext.get().partitionId()
        tail = np.array([end_id], "<u4")
        block_no = file_start = size = held_ids = 0
        ids, offsets, counts, words, held = [], [], [], [], []

        def code():
            nonlocal size, held_ids, held
            own = np.array([len(x) + 1 for x in held[::2]], np.int64)
            coded, at = encode_ids(np.concatenate(held), own)
            offsets.extend((at + size).tolist())
            counts.extend(own.tolist())
            words.append(coded.astype("<u8").tobytes())
            size, held_ids, held = size + len(coded), 0, []

        def flush():
            nonlocal block_no, file_start, size, ids, offsets, counts, words
            n = int(sum(counts))
            row = pa.RecordBatch.from_arrays([
                pa.array([file_no], pa.int32()), pa.array([block_no], pa.int32()), pa.array([file_start], pa.int64()), pa.array([n], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())), pa.array([offsets], pa.list_(pa.int32())), pa.array([counts], pa.list_(pa.int64())),
                pa.array([b"".join(words)], pa.binary()),
            ], names=[c.split()[0] for c in _BLOCK.split(", ")])
            block_no, file_start, size, ids, offsets, counts, words = block_no + 1, file_start + n, 0, [], [], [], []
            return row

        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, hi, sizes, found in enc.ids_of(batch.column(1)):
                for doc_id, own in zip(names[lo:hi], np.split(found, np.cumsum(sizes)[:-1])):
                    ids.append(doc_id)
                    held += [own, tail]
                    held_ids += len(own) + 1
                    if held_ids >= BLOCK_WORDS:  # documents are coded in groups
                        code()
                        if size >= BLOCK_WORDS:
                            yield flush()
        if held:
            code()
        if ids:
            yield flush()

    return run


def write_token_file(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and store its blocks, ascending in ``id_col``; returns the blocks.

    One range shuffle of the texts; each partition is then encoded and written as a stream.
    Equal ids are told apart by a hash of the text, so one repeated id spreads over tasks.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    tie = F.xxhash64("t")
    dealt = own.repartitionByRange(shuffle_parts(spark), F.col("id"), tie).sortWithinPartitions("id", tie)
    return stored(dealt.mapInArrow(_blocks(tokenizer_path, end_id), _BLOCK), "blocks")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            file_no, _, start, _, ids, offsets, counts, words = (batch.column(k)[row].as_py() for k in range(8))
            words = np.frombuffer(words, "<u8").astype(np.uint64)
            # whole documents in groups, so that the decoded ids of a block are never held at once
            bounds, at = [*offsets, len(words)], 0
            while at < len(ids):
                to = at + 1
                while to < len(ids) and bounds[to + 1] - bounds[at] <= BLOCK_WORDS // 4:
                    to += 1
                got = decode_words(words[bounds[at] : bounds[to]])
                cut = np.concatenate([[0], np.cumsum(counts[at:to])])
                if cut[-1] != len(got):
                    raise ValueError(f"block of file {file_no} is damaged: {cut[-1]} ids expected, {len(got)} found")
                as32 = got.astype("<u4")
                starts = start + cut[:-1]
                yield pa.RecordBatch.from_arrays([
                    pa.array([file_no] * (to - at), pa.int32()), pa.array(ids[at:to], pa.int64()), pa.array(starts, pa.int64()),
                    pa.array(counts[at:to], pa.int64()), pa.array([as32[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                ], names=["file_no", "doc_id", "file_offset", "n_tokens", "ids"])
                start, at = start + int(cut[-1]), to


def read_token_file(blocks: DataFrame) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens and ids (unsigned
    32-bit little-endian), decoded from the stored blocks."""
    files = blocks.groupBy("file_no").agg(F.sum("n_ids").alias("n"))
    # one row per file, never per document
    before = files.select("file_no", (F.sum("n").over(Window.orderBy("file_no")) - F.col("n")).alias("before"))
    docs = blocks.mapInArrow(_decode, "file_no int, doc_id long, file_offset long, n_tokens long, ids binary")
    return docs.join(F.broadcast(before), "file_no").select("doc_id", (F.col("before") + F.col("file_offset")).alias("start"), "n_tokens", "ids")
