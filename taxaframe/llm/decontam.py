"""Benchmark decontamination by pigeonhole edit matching.

An item of n words has an error budget of e = floor(``error_rate`` * n) word edits, lowered so
that its e + 1 pieces keep at least ``min_piece`` words. Any passage within e edits of the
item holds one of the pieces unchanged. Pieces are looked up exactly in every document, and
the text around each hit is verified with Myers' bit-parallel edit distance over words
(whole item against the best place of the window).

Items are read in blocks of bounded number (``block_items``); each block is looked up in all
documents, so any size of benchmark is handled alike.

Words are lower-cased runs of digits, ASCII letters and non-ASCII characters. Items and documents without a
word match nothing; null text counts as empty; null ids are carried; repeated rows match
each; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaframe.llm.common import alnum_words

MATCHES = "doc_id long, item_id long, start long, end long, distance int, budget int"


def myers_best(pattern: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """(least edit distance of the whole pattern to any stretch of text, end of the first such
    stretch), by Myers' bit vectors."""
    m = len(pattern)
    peq: dict[bytes, int] = defaultdict(int)
    for i, w in enumerate(pattern):
        peq[w] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text):
        x = peq.get(w, 0) | vn
        d0 = (((x & vp) + vp) ^ vp) | x
        hn, hp = vp & d0, vn | (full & ~(vp | d0))
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1, hn << 1
        vp, vn = (hn | ~(d0 | hp)) & full, hp & d0 & full
        if score < best:
            best, end = score, j + 1
    return best, end


class Pieces:
    """The pieces of one block of items, by their first two words."""

    def __init__(self, items, error_rate: float, min_piece: int):
        self.items, self.heads = [], defaultdict(list)
        for item_id, text in items:
            words = alnum_words((text or "").lower())
            if not words:
                continue
            budget = max(0, min(int(error_rate * len(words)), len(words) // min_piece - 1))
            cuts = [len(words) * k // (budget + 1) for k in range(budget + 2)]
            number = len(self.items)
            self.items.append((item_id, words, budget))
            for a, b in zip(cuts, cuts[1:]):
                self.heads[tuple(words[a : a + 2]) if b - a > 1 else words[a]].append((number, a, words[a:b]))
        self.first = {k if isinstance(k, bytes) else k[0] for k in self.heads}

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
        """(item id, start, end, distance, budget): best verified places, one per stretch of text."""
        hits: dict[int, set[int]] = defaultdict(set)
        first, heads = self.first, self.heads
        for p in [i for i, w in enumerate(words) if w in first]:
            for number, at, piece in (*heads.get(tuple(words[p : p + 2]), ()), *heads.get(words[p], ())):
                if words[p : p + len(piece)] == piece:
                    hits[number].add(p - at)
        for number, diagonals in hits.items():
            item_id, own, budget = self.items[number]
            reach = -budget - 1  # a passage at the start of a document can have lost up to budget words before its piece
            for diagonal in sorted(diagonals):
                if diagonal <= reach:  # within the window that has been verified
                    continue
                lo, hi = max(0, diagonal - budget), diagonal + len(own) + 2 * budget
                distance, end = myers_best(own, words[lo:hi])
                if distance <= budget:
                    back, length = myers_best(own[::-1], words[lo : lo + end][::-1])
                    yield item_id, lo + end - (length if back == distance else min(end, len(own))), lo + end, distance, budget
                    reach = diagonal + budget


def _doc_words(text: str | None) -> list[bytes]:
    return alnum_words((text or "").lower())


def _item_blocks(spark: SparkSession, items: DataFrame, error_rate: float = 0.2, min_piece: int = 3, block_items: int = 20_000, item_id_col: str = "item_id", item_text_col: str = "text"):
    """For each block of about ``block_items`` items a function that makes its ``Pieces`` in a task."""
    own = items.select(F.col(item_id_col).cast("long").alias("i"), F.col(item_text_col).alias("t"))
    blocks = max(1, -(-own.count() // block_items))
    for b in range(blocks):
        block = own.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()  # about block_items rows
        held = spark.sparkContext.broadcast([(r["i"], r["t"]) for r in block])
        yield lambda held=held: Pieces(held.value, error_rate, min_piece)


def match_benchmark(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every place (words, end exclusive) of every document within the budget of a benchmark item:
    doc_id, item_id, start, end, distance, budget. Options: those of ``_item_blocks``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))

    def scan(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces = held()
            for batch in batches:
                rows = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1)) for m in pieces.matches(_doc_words(t.as_py()))]
                cols = list(zip(*rows)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k > 3 else pa.int64()) for k, c in enumerate(cols)], names=[c.split()[0] for c in MATCHES.split(", ")])

        return run

    return reduce(DataFrame.unionAll, [texts.mapInArrow(scan(held), MATCHES) for held in _item_blocks(docs.sparkSession, items, **options)])


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) without a passage within the budget of an item."""
    at = docs.columns.index(text_col)

    def clean(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces = held()
            for batch in batches:
                yield batch.filter(pa.array([next(pieces.matches(_doc_words(t.as_py())), None) is None for t in batch.column(at)], pa.bool_()))

        return run

    out = docs
    for held in _item_blocks(docs.sparkSession, items, **options):
        out = out.mapInArrow(clean(held), docs.schema)
    return out
