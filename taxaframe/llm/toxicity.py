"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores sigmoid(bias + sum of the weights of its
words), a word's weight being the sum over its hashed features (whole word and character
prefixes); the sentence scores are combined by noisy-or, 1 - prod(1 - p). The
weights are trained from document labels alone, by gradient steps through the noisy-or; the
sentence scores then say where the offence is.

Training uses at most ``sample_docs`` labelled rows (those with the smallest hashes of the id),
so the fit on the driver has a fixed size; everything else covers all rows.

Null and empty texts have no sentence and score 0; null ids count as training rows without a
label; repeated rows score alike; without any label all scores are those of zero weights;
empty tables give no rows. Other columns are ignored; very long texts are scored whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaframe.llm.common import _Memo

BITS = 18
_SENTENCE = re.compile(r"[^.!?\n\r]+")
_WORD = re.compile(r"\w+")


def word_features(word: str) -> list[int]:
    mask = (1 << BITS) - 1
    out = [zlib.crc32(word.encode("utf-8", "surrogatepass")) & mask]
    out += [zlib.crc32(f"{n}^{word[:n]}".encode("utf-8", "surrogatepass")) & mask for n in (4, 5, 6) if len(word) > n]
    return out


def sentences(text: str | None) -> list[tuple[int, int, list[str]]]:
    """(start, end, lower-cased words) of every sentence with a word."""
    out = []
    for m in _SENTENCE.finditer(text or ""):
        words = _WORD.findall(m.group().lower())
        if words:
            out.append((m.start(), m.end(), words))
    return out


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = _Memo(word_features)
    for batch in batches:
        rows = []
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            bags = [[f for w in set(words) for f in memo[w]] for _, _, words in sentences(text.as_py())]
            rows.append({"y": label, "sizes": np.array([len(b) for b in bags], "<i4").tobytes(), "features": np.array([f for b in bags for f in b], "<i4").tobytes()})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("y", pa.int32()), ("sizes", pa.binary()), ("features", pa.binary())]))


def train_noisy_or(
    bags: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 20, batch: int = 64, rate: float = 0.3, start: float = 1e-4, shrink: float = 3e-4, least_docs: int = 4
) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, sentence sizes, features of all sentences).

    Features of fewer than ``least_docs`` documents keep weight 0; the others are pulled towards 0
    by ``shrink`` a step (lasso), so that words without a part in the labels fall out.
    """
    size = 1 << BITS
    weight, bias = np.zeros(size), -4.0
    square, bias_square = np.full(size, start), start
    bags = [b for b in bags if len(b[1])]
    docs = np.zeros(size, np.int64)
    for _, _, features in bags:
        docs[np.unique(features)] += 1
    used = docs >= least_docs
    draw = np.random.default_rng(3)
    for _ in range(epochs if bags else 0):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), batch):
            part = [bags[i] for i in order[at : at + batch]]
            y = np.array([b[0] for b in part], float)
            per_doc = np.array([len(b[1]) for b in part])
            sizes, features = np.concatenate([b[1] for b in part]), np.concatenate([b[2] for b in part])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            z = np.clip(bias + np.add.reduceat(weight[features], starts), -30, 30)
            p = 1 / (1 + np.exp(-z))
            doc_starts = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
            clean = np.exp(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-12)), doc_starts))
            pull = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0)  # d loss / d z = pull * p
            g = np.repeat(pull, per_doc) * p
            grad = np.bincount(features, np.repeat(g, sizes), size) / len(part)
            hit = np.flatnonzero((grad != 0) & used)
            square[hit] += grad[hit] ** 2
            pace = rate / np.sqrt(square[hit])
            moved = weight[hit] - pace * grad[hit]
            weight[hit] = np.sign(moved) * np.maximum(np.abs(moved) - pace * shrink, 0)
            b = g.sum() / len(part)
            bias_square += b * b
            bias -= rate * b / np.sqrt(bias_square)
    return weight, bias


SCORES = "doc_id long, score double, offences array<struct<start:long,end:long,score:double>>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("offences", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column | None = None, sample_docs: int = 10_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """(weights, bias) from at most ``sample_docs`` labelled rows; ``train`` may restrict the ids."""
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("y").isNotNull())
    if train is not None:
        rows = rows.filter(train)
    chosen = rows.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # at most sample_docs rows of two numbers: a proven bound; of the texts of a repeated id one is used
    found = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("y").alias("y"), F.min("t").alias("t"))
    data = found.select("y", "t").mapInArrow(_featurize, "y int, sizes binary, features binary")
    bags = [(r["y"], np.frombuffer(r["sizes"], "<i4"), np.frombuffer(r["features"], "<i4")) for r in data.toLocalIterator()]
    return train_noisy_or(bags)


class _Scorer:
    """(score, offending sentences) of a text; the weights of repeated words are remembered."""

    def __init__(self, weight: np.ndarray, bias: float, offence: float = 0.3):
        self.bias, self.offence = bias, offence
        self.word = _Memo(lambda w: float(weight[word_features(w)].sum(dtype=float)))

    def __call__(self, text: str | None) -> tuple[float, list[dict]]:
        clean, bad = 0.0, []
        for start, end, words in sentences(text):
            z = self.bias + sum(map(self.word.__getitem__, dict.fromkeys(words)))
            p = 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))
            clean += math.log1p(-min(p, 1 - 1e-12))
            if p >= self.offence:
                bad.append({"start": start, "end": end, "score": p})
        return -math.expm1(clean), bad


def _held(docs: DataFrame, model):
    return docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), float(model[1])))


def score_toxicity(docs: DataFrame, model, offence: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and the offending sentences (score >= ``offence``) of every row."""
    held = _held(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _Scorer(*held.value, offence)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                value, bad = score(text.as_py())
                rows.append({"doc_id": doc_id, "score": value, "offences": bad})
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(run, SCORES)


def filter_toxic(docs: DataFrame, model, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that score below ``least``."""
    held = _held(docs, model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _Scorer(*held.value)
        for batch in batches:
            yield batch.filter(pa.array([score(t.as_py())[0] < least for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
