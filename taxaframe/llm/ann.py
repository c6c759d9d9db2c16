"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell floor((a_i . v + b_i) / width), i < ``hashes``, with Gaussian
a_i. Vectors are scaled to length 1 first, where the Euclidean order is the cosine order. A
query visits the ``probes`` cells of each table most likely to hold its neighbours:
perturbations of its own cell by ascending sum of squared distances to the crossed borders.
Cells are joined to probes; a large cell is split into blocks of ``block`` vectors, each its
own task group, so no cell is capped. A block scores its queries against its
vectors exactly (double precision, original vectors) and sends the best ``k`` per query;
the candidates of all tables and blocks are merged by query.

A query that gets fewer than ``k`` rows this way although its length has more is scored exactly
against all entries of its length, in blocks of ``block`` queries by ``block`` entries.

Equal vectors are one entry (with their smallest ids), so copies of a vector fill no cell.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do null
ids; vectors of another length than most are compared only with their like. Ties go to
the smaller id; repeated rows (equal ids) are one candidate; empty tables give no rows. Other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaframe.llm.common import stored


def projections(dim: int, tables: int, hashes: int, width: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng((seed, dim))
    return draw.standard_normal((tables, hashes, dim)), draw.uniform(0, width, (tables, hashes))


def perturbations(place: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
    """Sets of (hash, step) in ascending score: the own cell first. ``place`` is the position of the
    query in its cell, from 0 to 1 along each hash."""
    n = len(place)
    borders = sorted([(float(x) ** 2, i, -1) for i, x in enumerate(place)] + [((1 - float(x)) ** 2, i, 1) for i, x in enumerate(place)])
    # two further cells on either side, for neighbours more than one cell away
    borders = sorted(borders + [((float(x) + 1) ** 2, i, -2) for i, x in enumerate(place)] + [((2 - float(x)) ** 2, i, 2) for i, x in enumerate(place)])
    out, heap = [[]], [(borders[0][0], (0,))]
    while heap and len(out) < probes:
        score, chosen = heapq.heappop(heap)
        if len({borders[c][1] for c in chosen}) == len(chosen):
            out.append([(borders[c][1], borders[c][2]) for c in chosen])
        last = chosen[-1]
        if last + 1 < len(borders):
            heapq.heappush(heap, (score - borders[last][0] + borders[last + 1][0], (*chosen[:-1], last + 1)))
            if len(chosen) < n:
                heapq.heappush(heap, (score + borders[last + 1][0], (*chosen, last + 1)))
    return out


def _cells(tables: int, hashes: int, width: float, probes: int):
    def name(table: int, cell: np.ndarray) -> np.ndarray:
        h = np.full(len(cell), (table + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for c in cell.T:
            h = (h ^ c.astype(np.int64).view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        return h.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, vectors = batch.column(0).to_numpy(), [np.asarray(v, np.float64) for v in batch.column(1).to_pylist()]
            for dim in sorted({len(v) for v in vectors}):
                own = np.array([i for i, v in enumerate(vectors) if len(v) == dim])
                x = np.stack([vectors[i] for i in own])
                x /= np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                a, b = projections(dim, tables, hashes, width)
                for t in range(tables):
                    at = (x @ a[t].T + b[t]) / width
                    cell = np.floor(at).astype(np.int64)
                    if not probes:
                        yield pa.RecordBatch.from_arrays([pa.array(keys[own]), pa.array(name(t, cell))], names=["v", "cell"])
                        continue
                    for i in range(len(own)):
                        sets = perturbations(at[i] - cell[i], probes)
                        many = np.repeat(cell[i][None], len(sets), 0)
                        for s, moves in enumerate(sets):
                            for h, step in moves:
                                many[s, h] += step
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sets), keys[own[i]])), pa.array(name(t, many))], names=["v", "cell"])

    return run


def _best(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k + 1 best scores of each row, and of all equal to the last."""
    n = score.shape[1]
    if n <= k + 1:
        return np.nonzero(np.ones(score.shape, bool))
    cut = np.partition(score, n - k - 1, axis=1)[:, n - k - 1]
    return np.nonzero(score >= cut[:, None])


def _rank(k: int):
    """Exact scores of a task group: each query against the vectors of the cells that it visits."""

    def run(asked: pa.Table, index: pa.Table) -> pa.Table:
        rows, cols, scores = [], [], []
        ask_v, index_v = asked.column("v").to_numpy(), index.column("v").to_numpy()
        ask_vec, vec = (t.column("vec").to_pylist() for t in (asked, index))
        at: dict[int, list[int]] = {}
        for i, c in enumerate(index.column("cell").to_pylist()):
            at.setdefault(c, []).append(i)
        askers: dict[int, list[int]] = {}
        for i, cells in enumerate(asked.column("cells").to_pylist()):
            for c in cells:
                if c in at:
                    askers.setdefault(c, []).append(i)
        for c, qs in askers.items():
            for dim in {len(vec[i]) for i in at[c]}:
                q, v = [i for i in qs if len(ask_vec[i]) == dim], [i for i in at[c] if len(vec[i]) == dim]
                if not q:
                    continue
                x, y = np.array([ask_vec[i] for i in q]), np.array([vec[i] for i in v])
                score = (x @ y.T) / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((y * y).sum(1))
                r, s = _best(score, k)
                rows.append(ask_v[np.array(q)[r]])
                cols.append(index_v[np.array(v)[s]])
                scores.append(score[r, s])
        if not rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["q", "v", "score"])
        q, v, score = np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)
        order = np.lexsort((v, q))  # several tables find the same vector
        q, v, score = q[order], v[order], score[order]
        new = np.concatenate([[True], (q[1:] != q[:-1]) | (v[1:] != v[:-1])])
        q, v, score = q[new], v[new], score[new]
        order = np.lexsort((-score, q))
        q, v, score = q[order], v[order], score[order]
        first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        group = np.repeat(first, np.diff(np.append(first, len(q))))
        last = np.minimum(group + k, np.repeat(np.append(first[1:], len(q)) - 1, np.diff(np.append(first, len(q)))))
        keep = score >= score[last]  # the k + 1 best of each query, and ties
        return pa.table([q[keep], v[keep], score[keep]], names=["q", "v", "score"])

    return run


def nearest_neighbours(
    vectors: DataFrame, queries: Column, k: int = 5, tables: int = 4, hashes: int = 8, width: float = 2.4, probes: int = 160, block: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest rows found for each row where ``queries``
    (a condition on the id) holds."""
    good = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"), queries.alias("is_query"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    good = good.filter(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
    # -0.0 and 0.0 are equal components
    good = good.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0))).withColumn("v", F.xxhash64("vec"))
    ids = good.groupBy("v", "id").agg(F.max(F.coalesce("is_query", F.lit(False))).alias("is_query"))
    ranked = ids.groupBy("v").agg(F.min("id").alias("least"), F.max("is_query").alias("is_query"), F.count("*").alias("n"))
    entries = stored(good.select("v", "vec").dropDuplicates(["v"]).join(ranked, "v").withColumn("dim", F.size("vec")), "entries")
    members = stored(ids, "members")
    cells = stored(entries.select("v", "vec").mapInArrow(_cells(tables, hashes, width, 0), "v long, cell long"), "cells")
    probe = entries.filter("is_query").select("v", "vec").mapInArrow(_cells(tables, hashes, width, probes), "v long, cell long")
    # cells are dealt to task groups of about ``block`` entries; a group with a large cell has parts
    groups = max(1, -(-cells.count() // block))
    group = F.pmod("cell", F.lit(groups))
    cells = cells.withColumn("g", group)
    sizes = cells.groupBy("g").agg(F.ceil(F.count("*") / (2 * block)).cast("int").alias("parts"))
    index = cells.join(sizes, "g").withColumn("part", F.pmod("v", F.col("parts")).cast("int")).join(entries.select("v", "vec"), "v")
    asked = probe.withColumn("g", group).groupBy("g", "v").agg(F.collect_list("cell").alias("cells"))  # at most ``probes`` per table
    asked = asked.join(sizes, "g").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(entries.select("v", "vec"), "v")
    pairs = asked.select("g", "part", "v", "cells", "vec").groupBy("g", "part").cogroup(index.select("g", "part", "v", "cell", "vec").groupBy("g", "part"))
    found = pairs.applyInArrow(_rank(k), "q long, v long, score double")
    # row_number() <= n is cut before the shuffle, so an entry with very many ids costs k + 1 a task
    smallest = members.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("r") <= k + 1).select("v", "id")

    def nearest_ids(found: DataFrame) -> DataFrame:
        """The k + 1 best rows of each query entry: its distinct entries merged, then their ids."""
        merged = found.groupBy("q", "v").agg(F.max("score").alias("score"))
        best = merged.join(entries.select("v", "least"), "v").select("q", "v", "score", "least")
        order = Window.partitionBy("q").orderBy(F.desc("score"), "least")
        near = best.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).select("q", "v", "score")
        rows = near.join(smallest, "v").withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id")))
        return rows.filter(F.col("r") <= k + 1).select("q", "id", "score")

    probed = stored(nearest_ids(found), "probed")
    # entries whose cells held too few: k + 1 rows, as an entry finds itself, or all of its length
    dims = entries.groupBy("dim").agg(F.sum("n").alias("ids"), F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    held = probed.groupBy(F.col("q").alias("v")).agg(F.count("*").alias("held"))
    few = entries.filter("is_query").select("v", "dim").join(held, "v", "left").join(dims, "dim").filter(F.coalesce("held", F.lit(0)) < F.least(F.lit(k + 1), "ids"))
    few = stored(few.select("v", "dim", "blocks"), "few")
    parts = few.groupBy("dim", "blocks").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = few.join(parts, ["dim", "blocks"]).withColumn("part", F.pmod("v", F.col("parts")).cast("int")).withColumn("g", all_of("blocks"))
    asked = asked.withColumn("cells", F.array(F.lit(0).cast("long"))).join(entries.select("v", "vec"), "v").select("dim", "g", "part", "v", "cells", "vec")
    index = entries.join(parts, "dim").withColumn("g", F.pmod("v", F.col("blocks")).cast("int")).withColumn("part", all_of("parts"))
    index = index.withColumn("cell", F.lit(0).cast("long")).select("dim", "g", "part", "v", "cell", F.col("vec").alias("vec"))
    exact = asked.groupBy("dim", "g", "part").cogroup(index.groupBy("dim", "g", "part")).applyInArrow(_rank(k), "q long, v long, score double")
    merged_ids = probed.join(few.select(F.col("v").alias("q")), "q", "left_anti").unionByName(nearest_ids(exact))
    asked_ids = members.filter("is_query").select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    pairs = merged_ids.select("q", "id", "score").join(asked_ids, "q").filter("id != query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
