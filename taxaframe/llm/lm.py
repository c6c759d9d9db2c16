"""Bigram language model by deleted interpolation.

p(w | h) = a[b] * c(h w)/c(h) + u[b] * c(w)/N + z[b] / (V + 1), where b is the bucket of the
context's frequency c(h) (powers of two; bucket 0: never seen, where a is 0) and the weights of a
bucket are learned by expectation-maximisation on held-out counts: every training occurrence
is scored with the counts that remain when it is deleted from the training data.

Counts are looked up by a request and its answer. Texts are stored in blocks; each block sends
its distinct word and bigram hashes, sorted and cut by hash range, to the task of that range,
which adds up the training counts and answers in the same order. A frequent word costs one
entry per block, so no range is hot; keys are delta-coded, so the shuffle is a few
bytes per distinct bigram. The statistics of the weights are a histogram of rounded
(c(h), c(h w), c(w)) classes over all training tokens, read by the driver: 16 bytes a class and far fewer classes
than tokens (68,240 at 3.4 million), as counts are rounded to eighths of a doubling.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased and one end per text. Null and empty
texts have the end alone; null ids belong to the fold of the empty text; repeated rows count and are
scored each; empty tables give no rows; without training rows every count is 0. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaframe.llm.common import mix64, pieces_by_bytes, space_word_hashes, stored

_U = np.uint64
_END, _START = _U(0x454E44), _U(0x5354)
_KEY = _U(8)  # keys keep 56 bits
BLOCK_CHARS = 6_000_000
RANGE_CHARS = 12_000_000  # characters of text whose hashes one range task takes
BUCKETS = 24


# --- coding of sorted keys and of counts -----------------------------------------------------


def _planes(x: np.ndarray) -> bytes:
    """Byte planes of unsigned integers, as many as the largest needs; first byte: their number."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    raw = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(raw.T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.view("<u8").ravel().astype(np.uint64)


def _pack_keys(keys: np.ndarray) -> bytes:
    return _planes(np.diff(keys, prepend=_U(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data), dtype=np.uint64)


# --- blocks of texts -------------------------------------------------------------------------

_BLOCKS = "block long, ids array<long>, train array<boolean>, sizes array<int>, data binary"


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's texts are held once, as the bytes that are compressed."""
    block = TaskContext.get().partitionId() << 32
    ids, train, sizes, raw, chars = [], [], [], bytearray(), 0

    def flush():
        data = zstandard.ZstdCompressor(level=5).compress(raw)
        return pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.bool_())),
            pa.array([sizes], pa.list_(pa.int32())), pa.array([data], pa.binary()),
        ], names=["block", "ids", "train", "sizes", "data"])

    for batch in batches:
        texts = batch.column(2)
        for i, t, x, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, pc.utf8_length(texts).to_pylist()):
            text = x.as_buffer()
            ids.append(i)
            train.append(t)
            sizes.append(text.size)
            raw += text
            chars += n + 1
            if chars >= BLOCK_CHARS:
                yield flush()
                block, ids, train, sizes, raw, chars = block + 1, [], [], [], bytearray(), 0
    if ids:
        yield flush()


def _texts(sizes: list[int], data: bytes) -> list[str]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for n in sizes:
        out.append(raw[at : at + n].decode("utf-8", "surrogatepass"))
        at += n
    return out


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all tokens (words, then an end, per text), keys of their bigrams, and the number of
    tokens of each text."""
    hashes, counts = [], []
    for a, b in pieces_by_bytes(texts):
        h, c = space_word_hashes(texts[a:b])
        hashes.append(h)
        counts.append(c)
    words, counts = np.concatenate(hashes), np.concatenate(counts)
    n = counts + 1
    last = np.cumsum(n) - 1
    tokens = np.empty(len(words) + len(n), np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[last] = True
    tokens[is_end] = mix64(np.array([_END], np.uint64))[0]
    tokens[~is_end] = words
    first = np.zeros(len(tokens), bool)
    first[last - n + 1] = True
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[first] = mix64(np.array([_START], np.uint64))[0]
    return tokens >> _KEY, mix64(context * _U(0x9E3779B97F4A7C15) + tokens) >> _KEY, n


def _lookups(train: np.ndarray, uni: np.ndarray, bi: np.ndarray):
    """Distinct keys, inverse and training counts of unigrams and bigrams."""
    for keys in (uni, bi):
        distinct, inverse = np.unique(keys, return_inverse=True)
        yield distinct, inverse, np.bincount(inverse, train, len(distinct)).astype(np.uint64)


def _requests(ranges: int):
    edges = (np.arange(1, ranges, dtype=np.float64) / ranges * 2.0**56).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, train, sizes, data = (batch.column(c)[row].as_py() for c in (0, 2, 3, 4))
                uni, bi, n = _tokens(_texts(sizes, data))
                token_train = np.repeat(np.array(train, bool), n)
                cols: tuple[list, ...] = ([], [], [], [])
                for kind, (distinct, _, counts) in enumerate(_lookups(token_train, uni, bi)):
                    cuts = np.concatenate([[0], np.searchsorted(distinct, edges), [len(distinct)]])
                    for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        if b > a:
                            for c, v in zip(cols, (kind * ranges + r, block, _pack_keys(distinct[a:b]), _planes(counts[a:b]))):
                                c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())], names=["range", "block", "keys", "counts"])

    return run


def _answer(part: pa.Table) -> pa.Table:
    """Total training counts of the keys of one range, in the order each block asked for them."""
    keys = [_unpack_keys(k.as_py()) for k in part.column("keys")]
    counts = np.concatenate([_unplanes(c.as_py()) for c in part.column("counts")])
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    head = np.ones(len(ranked), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    total = np.empty(len(flat), np.uint64)
    total[order] = np.add.reduceat(counts[order], np.flatnonzero(head))[np.cumsum(head) - 1]
    at = np.cumsum([0] + [len(k) for k in keys])
    return pa.table([part.column("range"), part.column("block"), pa.array([_planes(total[a:b]) for a, b in zip(at, at[1:])], pa.binary())], names=["range", "block", "totals"])


_COUNTED = "doc_id long, train boolean, n long, types double, c binary, cc binary"


def _counted(ranges: int):
    """Per text the training counts of its tokens (c) and bigrams (cc), as byte planes; types: the sum
    of 1/c over the tokens of a training text (over all texts: the distinct training tokens)."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        got = sorted(zip(answers.column("range").to_pylist(), answers.column("totals").to_pylist()))
        totals = [np.concatenate([_unplanes(t) for r, t in got if r // ranges == kind]) for kind in (0, 1)]
        out = []
        for row in range(blocks.num_rows):
            ids, train, sizes, data = (blocks.column(c)[row].as_py() for c in ("ids", "train", "sizes", "data"))
            uni, bi, n = _tokens(_texts(sizes, data))
            c, cc = (t[np.unique(k, return_inverse=True)[1]] for t, k in zip(totals, (uni, bi)))
            at = np.concatenate([[0], np.cumsum(n)])
            types = np.where(train, np.add.reduceat(1.0 / np.maximum(c, 1), at[:-1]), 0.0)
            out.append(pa.table([
                pa.array(ids, pa.int64()), pa.array(train, pa.bool_()), pa.array(n), pa.array(types),
                pa.array([_planes(c[a:b]) for a, b in zip(at, at[1:])], pa.binary()), pa.array([_planes(cc[a:b]) for a, b in zip(at, at[1:])], pa.binary()),
            ], names=[x.split()[0] for x in _COUNTED.split(", ")]))
        return pa.concat_tables(out)

    return run


# --- weights and scores ----------------------------------------------------------------------


def _bucket(c: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 c), at most BUCKETS - 1."""
    return np.where(c > 0, np.minimum(1 + np.log2(np.maximum(c, 1)).astype(np.int64), BUCKETS - 1), 0)


def _classes(batches: Iterator[pa.RecordBatch], docs_train: int) -> Iterator[pa.RecordBatch]:
    """Histogram of training tokens, each deleted from the counts it is scored with."""
    code = np.zeros(0, np.int64)
    for batch in batches:
        parts = []
        for train, c, cc in zip(*(batch.column(i).to_pylist() for i in (1, 4, 5))):
            if not train:
                continue
            c, cc = _unplanes(c).astype(np.int64), _unplanes(cc).astype(np.int64)
            context = np.concatenate([[docs_train], c[:-1]]) - 1
            level = lambda x: np.where(x > 0, 1 + np.round(8 * np.log2(np.maximum(x, 1))).astype(np.int64), 0)  # noqa: E731  # eighths of a doubling
            parts.append((level(context) << 40) | (level(cc - 1) << 20) | level(c - 1))
        if parts:
            values, number = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(number)], names=["code", "n"])


def learn_weights(code: np.ndarray, number: np.ndarray, tokens: int, distinct: int, rounds: int = 60) -> np.ndarray:
    """(BUCKETS, 3) weights of bigram, unigram and uniform estimates by EM on the histogram."""
    size = lambda x: np.where(x > 0, 2.0 ** ((x - 1) / 8), 0.0)
    context, cc, c = (size((code >> s) & 0xFFFFF) for s in (40, 20, 0))
    bucket = _bucket(np.round(context, 6))
    p = np.stack([cc / np.maximum(context, 1), c / max(1, tokens - 1), np.full(len(code), 1 / (distinct + 1))], 1)
    weight = np.full((BUCKETS, 3), 1 / 3)
    weight[0] = [0, 0.5, 0.5]
    for _ in range(rounds):
        share = weight[bucket] * p
        share *= (number / share.sum(1))[:, None]
        for k in range(3):
            weight[:, k] = np.bincount(bucket, share[:, k], BUCKETS) + 1e-3  # a bucket without data keeps its sum
        weight[0, 0] = 0
        weight /= weight.sum(1, keepdims=True)
    return weight


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(weight: np.ndarray, tokens: int, distinct: int, docs_train: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, train, n, _, c, cc in zip(*(batch.column(i).to_pylist() for i in range(6))):
                c, cc = _unplanes(c).astype(float), _unplanes(cc).astype(float)
                context = np.concatenate([[docs_train], c[:-1]])
                w = weight[_bucket(context)]
                p = w[:, 0] * cc / np.maximum(context, 1) + w[:, 1] * c / max(1, tokens) + w[:, 2] / (distinct + 1)
                base = np.log10(c + 1).sum() - n * np.log10(tokens + distinct + 1)
                rows.append((doc_id, not train, n, int((c > 0).sum()), tokens, float(base), float(np.log10(p).sum())))
            cols = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], names=[x.split()[0] for x in SCORES.split(", ")])

    return run


def interpolated_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents by a model of those for which ``train`` holds."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    blocks = stored(own.mapInArrow(_to_blocks, _BLOCKS), "blocks")
    size = blocks.select(F.aggregate("sizes", F.lit(0).cast("long"), lambda n, x: n + x).alias("n"), F.size(F.filter("train", lambda x: x)).alias("t")).agg(F.sum("n"), F.sum("t")).first()
    ranges, docs_train = max(2, -(-(size[0] or 0) // RANGE_CHARS)), int(size[1] or 0)
    requests = blocks.mapInArrow(_requests(ranges), "range int, block long, keys binary, counts binary")
    answers = requests.groupBy("range").applyInArrow(_answer, "range int, block long, totals binary")
    pairs = blocks.groupBy("block").cogroup(answers.groupBy("block"))
    counted = stored(pairs.applyInArrow(_counted(ranges), _COUNTED), "counted")
    totals = counted.filter("train").agg(F.sum("types"), F.sum("n")).first()
    distinct, tokens = round(totals[0] or 0), int(totals[1] or 0)
    classes = counted.mapInArrow(lambda b: _classes(b, docs_train), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    histogram = classes.toPandas()  # at most the cube of eight levels a doubling of the largest count
    weight = learn_weights(histogram["code"].to_numpy(np.int64), histogram["n"].to_numpy(float), tokens, distinct)
    return counted.mapInArrow(_score(weight, tokens, distinct, docs_train), SCORES)
