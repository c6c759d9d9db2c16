"""Centroid clustering over Hilbert-ordered zone maps, in exact integers.

Vectors become integers floor(scale * x). They are ordered along a Hilbert curve over all
components and stored in blocks of ``block_rows`` with their per-component minima and maxima (zone maps). In
an assignment, the distance from a block's box to a centroid is bounded from below by the box's
nearest point and from above by its farthest one: only centroids whose lower bound does not exceed
the smallest upper bound are candidates. The block is then compared exactly with its candidates,
vectorised; a block with one candidate needs no comparison to be assigned. Tasks emit sums and counts
per cluster, so a round moves a few rows a task.

The order only decides how many candidates are left; results do not depend on it. Equal vectors
are dealt over blocks by id and place, so copies of one vector do not meet in one task.

Vectors that are null, of another size, or hold a null or non-finite component are not kept. Null ids
are carried and are the last choice as starting centroids. Repeated rows are kept each; of equal ids
the smaller vector (by its components) starts first. Fewer vectors than centroids give fewer centroids, an empty
table no rows. Distances are longs, so integers beyond 2**27 in size raise an error. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaframe.llm.common import stored

_LIMIT = 1 << 27
_BITS = 4  # of the Hilbert curve, per component


def _quantised(batches: Iterator[pa.RecordBatch], size: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, integers) of the kept vectors of each batch of (id, vector)."""
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        right = pc.fill_null(pc.equal(pc.list_value_length(vectors), size), False)
        ids, vectors = ids.filter(right), vectors.filter(right)
        flat = vectors.flatten()
        x = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
        fine = np.isfinite(x).all(1)
        y = np.floor(x[fine] * scale)
        if len(y) and np.abs(y).max() > _LIMIT:
            raise ValueError(f"a component times {scale} is beyond 2**27; exact distances would not fit in a long")
        yield ids.filter(pa.array(fine)), y.astype("<i4")


def _rows_of(values: np.ndarray) -> pa.Array:
    """Each row's bytes as binary."""
    raw = np.ascontiguousarray(values)
    width = raw.shape[1] * raw.itemsize
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, size)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid points (rows of integers below ``1 << bits``) on the Hilbert curve, as rows of
    big-endian bytes. Gray-code exchange of the axes, all points at once."""
    x = cells.astype(np.uint8).T.copy()
    for level in range(bits - 1, 0, -1):
        low = np.uint8((1 << level) - 1)
        for axis in x:
            turned = (axis >> np.uint8(level) & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ axis) & low).astype(np.uint8)
            x[0] ^= np.where(turned, low, swap).astype(np.uint8)
            axis ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip = np.zeros(x.shape[1], np.uint8)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> np.uint8(level) & 1, (1 << level) - 1, 0).astype(np.uint8)
    x ^= flip
    digits = [x[i] >> np.uint8(b) & np.uint8(1) for b in range(bits - 1, -1, -1) for i in range(len(x))]
    return np.packbits(np.stack(digits, 1), axis=1)


def _moments(size: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(size), np.zeros(size)
        for _, y in _quantised(batches, size, scale):
            z = y.astype(float)
            n, sums, squares = n + len(z), sums + z.sum(0), squares + (z * z).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.tolist()]), pa.array([squares.tolist()])], names=["n", "sums", "squares"])

    return run


def _keyed(size: int, scale: int, low: np.ndarray, step: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y in _quantised(batches, size, scale):
            cells = np.clip((y - low) / step, 0, (1 << _BITS) - 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([_rows_of(hilbert_keys(cells, _BITS)), ids, _rows_of(y)], names=["key", "id", "v"])

    return run


def _blocked(size: int, block_rows: int):
    """Blocks of consecutive rows: ids, vectors, and the box's minima and maxima."""

    def emit(ids: list[pa.Array], parts: list[np.ndarray]) -> pa.RecordBatch:
        y = np.concatenate(parts)
        whole = pa.concat_arrays(ids)
        lists = pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)
        return pa.RecordBatch.from_arrays(
            [lists, pa.array([y.tobytes()], pa.binary()), pa.array([y.min(0).tobytes()], pa.binary()), pa.array([y.max(0).tobytes()], pa.binary())], names=["ids", "v", "low", "high"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, n = [], [], 0
        for batch in batches:
            y, at = _vectors(batch.column("v"), size), 0
            while at < len(y):
                take = min(len(y) - at, block_rows - n)
                ids.append(batch.column("id").slice(at, take))
                parts.append(y[at : at + take])
                at, n = at + take, n + take
                if n == block_rows:
                    yield emit(ids, parts)
                    ids, parts, n = [], [], 0
        if n:
            yield emit(ids, parts)

    return run


def hilbert_blocks(vectors: DataFrame, id_col: str, vector_col: str, size: int = 64, scale: int = 64, block_rows: int = 512) -> DataFrame:
    """Zone-mapped blocks (ids, v, low, high) of the kept vectors, in Hilbert order."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x"))
    per_task = rows.mapInArrow(_moments(size, scale), "n long, sums array<double>, squares array<double>")
    both = per_task.select("n", F.posexplode(F.arrays_zip("sums", "squares")).alias("pos", "s"))
    sums = {r.pos: r for r in both.groupBy("pos").agg(F.sum("n").alias("n"), F.sum("s.sums").alias("a"), F.sum("s.squares").alias("b")).collect()}  # a row per component
    n = max(1, max((r.n for r in sums.values()), default=0))
    mean = np.array([sums[i].a / n if i in sums else 0.0 for i in range(size)])
    spread = np.sqrt(np.maximum(np.array([sums[i].b / n if i in sums else 0.0 for i in range(size)]) - mean * mean, 0)) + 1e-9
    keyed = rows.mapInArrow(_keyed(size, scale, mean - 2 * spread, 4 * spread / (1 << _BITS)), "key binary, id long, v binary")
    # the place deals out repeated rows, which would otherwise have one range
    dealt = keyed.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange("key", "id", "_at").sortWithinPartitions("key")
    return dealt.select("id", "v").mapInArrow(_blocked(size, block_rows), "ids array<long>, v binary, low binary, high binary")


def starting_centroids(vectors: DataFrame, id_col: str, vector_col: str, k: int, size: int, scale: int) -> np.ndarray:
    """The kept vectors with the smallest sha256 of ``1:<id>``, at most ``k``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y in _quantised(batches, size, scale):
            yield pa.RecordBatch.from_arrays([ids, pa.array(y.tolist(), pa.list_(pa.int32()))], names=["id", "v"])

    kept = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x")).mapInArrow(run, "id long, v array<int>")
    first = kept.orderBy(F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")).cast("binary"), 256).asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in first], np.int64).reshape(-1, size)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a point of the box."""
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    across = np.maximum(np.abs(centroids - low), np.abs(high - centroids))
    return np.flatnonzero((outside * outside).sum(1) <= (across * across).sum(1).min())


def nearest(y: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray, distances: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Nearest centroid (ties: the smaller number) of every vector of a block, and its squared distance."""
    own = candidates(low.astype(np.int64), high.astype(np.int64), centroids)
    if len(own) == 1 and not distances:
        return np.full(len(y), own[0]), None
    d = np.empty((len(y), len(own)), np.int64)
    for j, c in enumerate(own):
        gap = y - centroids[c]
        d[:, j] = np.einsum("ij,ij->i", gap, gap)
    best = d.argmin(1)
    return own[best], d[np.arange(len(y)), best]


def _each(batches: Iterator[pa.RecordBatch], size: int):
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch.column("ids")[row].values, *(np.frombuffer(batch.column(c)[row].as_buffer(), "<i4").reshape(-1, size) for c in ("v", "low", "high"))


def _sums(size: int, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), size), np.int64)
        for _, y, low, high in _each(batches, size):
            own, _ = nearest(y, low[0], high[0], centroids, distances=False)
            for c in np.unique(own):
                mine = y[own == c]
                n[c] += len(mine)
                sums[c] += mine.sum(0, dtype=np.int64)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run


def _assigned(size: int, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y, low, high in _each(batches, size):
            own, d = nearest(y, low[0], high[0], centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(own.astype(np.int32)), pa.array(d)], names=["id", "cluster", "distance"])

    return run


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64, scale: int = 64, block_rows: int = 512) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every kept vector, as a stored table, and the final centroids."""
    centroids = starting_centroids(vectors, id_col, vector_col, k, size, scale)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "id long, cluster int, distance long"), centroids
    blocks = stored(hilbert_blocks(vectors, id_col, vector_col, size, scale, block_rows), "blocks")
    for _ in range(rounds):
        found = blocks.select("ids", "v", "low", "high").mapInArrow(_sums(size, centroids), "cluster int, n long, sums array<long>")
        total = found.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(size)]).alias("sums"))
        after = centroids.copy()
        for row in total.collect():  # a row per centroid
            after[row.cluster] = [s // row.n for s in row.sums]
        centroids = after
    return stored(blocks.mapInArrow(_assigned(size, centroids), "id long, cluster int, distance long"), "assigned"), centroids


def cluster_report(assigned: DataFrame, centroids: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """Every vector with its cluster's and all vectors' inertia and its centroid's digest."""
    spark = assigned.sparkSession
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per centroid
    rows = [(c, s, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in inertia.items()]
    figures = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(figures), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
