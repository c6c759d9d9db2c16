"""Near duplicates by a chosen-path set similarity join.

Documents with equal shingle sets form a class at once. Classes are then joined: each holds
``positions`` minwise tokens; in every one of ``trees`` independent trees a node picks about
1/threshold of the positions by a hash of the node and passes each class on to the child
named by its token there. Nodes of at most ``leaf`` classes are compared exhaustively, larger
ones branch again; what is still large after ``depth`` levels is compared in pairs of blocks, so
no node is capped. Equal minwise tokens have the probability of the Jaccard similarity, so a
pair at the threshold shares a child with probability near it per tree, and independent
trees bring the recall to its target (16 trees: a miss below 1e-6 for pairs in small nodes).

Comparison is in two steps: sketches (a pair must agree in all but five standard deviations
of the positions expected at the threshold) name clusters of classes, equal clusters of several
trees are folded to one, and full shingle sets confirm every link exactly, in tiles of about ``tile_bytes``
of a cluster's shingles, so long texts in a large cluster need no more memory. A cluster sends
star edges of its confirmed components, not all pairs. Components come from alternating
large-star and small-star rounds over stored edge tables; nothing is collected.

Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, sets of 5-word shingles; shorter texts are one
shingle of all words; null, empty and blank texts have no shingles and link with nothing.
Rows with a null id keep a null component and are kept. Repeated rows share a class. Empty
tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaframe.llm.common import mix64, pieces_by_bytes, space_word_hashes, stored

_U = np.uint64
_FOLD = _U(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = space_word_hashes(texts)
    ends = np.cumsum(counts)
    text_of = np.repeat(np.arange(len(texts)), counts)
    n = max(0, len(words) - width + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled = rolled * _FOLD + words[k : n + k]
    rolled = mix64(rolled)
    inside = text_of[:n] == text_of[width - 1 :] if n else np.zeros(0, bool)
    out = []
    for count, end in zip(counts.tolist(), ends.tolist()):
        if count >= width:
            out.append(np.unique(rolled[end - count : end - width + 1]))
        elif count:
            whole = _U(count)
            with np.errstate(over="ignore"):
                for w in words[end - count : end]:
                    whole = whole * _FOLD + w
            out.append(mix64(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    assert not n or int(inside.sum()) == int(np.maximum(counts - width + 1, 0).sum())
    return out


def _sketches(positions: int, width: int):
    seed = np.random.default_rng(20240607)
    mul = seed.integers(1, 1 << 63, positions, dtype=np.uint64) | _U(1)
    add = seed.integers(0, 1 << 63, positions, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in pieces_by_bytes(texts):
                sets = shingle_sets(texts[a:b], width)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                sketch = np.zeros((len(sets), positions), np.int32)
                one, two = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    for p in range(positions):
                        sketch[full, p] = (np.minimum.reduceat(flat * mul[p] + add[p], starts) >> _U(32)).astype(np.uint32).view(np.int32)
                    one[full] = mix64(np.add.reduceat(flat, starts))
                    two[full] = mix64(np.add.reduceat(mix64(flat), starts))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), pa.array(sizes), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * positions), pa.array(sketch.ravel())),
                ], names=["doc_id", "n", "k", "k2", "mh"])

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups of equal first columns, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        if last or (held and held[-1].column(0)[-1].as_py() != key[0]):
            if last == 0:
                yield pa.Table.from_batches(held)
                held = [batch]
            else:
                yield pa.Table.from_batches([*held, batch.slice(0, last)])
                held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _bounds(keys: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.diff(keys)) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(keys)]))


def _components(linked: np.ndarray) -> np.ndarray:
    """The smallest reachable index of each row of a symmetric boolean matrix."""
    label = np.full(len(linked), -1)
    for start in range(len(linked)):
        if label[start] < 0:
            new = np.array([start])
            while len(new):
                label[new] = start
                new = np.flatnonzero(linked[new].any(0) & (label < 0))
    return label


def _clusters(percent: int, positions: int):
    level = percent / 100
    least = max(1, math.floor(positions * (level - 5 * math.sqrt(level * (1 - level) / positions))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            leaf, k, n = (table.column(c).to_numpy() for c in range(3))
            sketch = np.ascontiguousarray(table.column(3).combine_chunks().flatten().to_numpy().reshape(len(k), positions))
            keys, members, ids = [], [], []
            for a, b in _bounds(leaf):
                order = a + np.argsort(k[a:b], kind="stable")
                own, size = sketch[order], n[order]
                linked = np.zeros((b - a, b - a), bool)
                for r in range(0, b - a, 256):  # bounded memory
                    agree = np.zeros((len(own[r : r + 256]), b - a), np.uint8 if positions < 256 else np.int16)
                    for p in range(positions):
                        agree += own[r : r + 256, p, None] == own[None, :, p]
                    few, many = np.minimum(size[r : r + 256, None], size), np.maximum(size[r : r + 256, None], size)
                    linked[r : r + 256] = (agree >= least) & (100 * few >= percent * many)
                np.fill_diagonal(linked, True)
                if linked.sum() == b - a:
                    continue
                label = _components(linked)
                for root in np.flatnonzero(np.bincount(label) > 1):
                    part = k[order[label == root]]
                    with np.errstate(over="ignore"):
                        name = mix64(np.array([np.add.reduce(mix64(part.view(np.uint64)) * _FOLD)], np.uint64)).view(np.int64)[0]
                    keys.append(np.full(len(part), name))
                    members.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)), pa.array(np.concatenate(members) if members else np.zeros(0, np.int64))], names=["cluster", "k"])

    return run


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(cluster, k, parts of sets) of each tile of batches sorted by cluster and tile; one tile is held at a time."""
    name, k, parts = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        cluster, tile, own, blobs = *(batch.column(c).to_numpy() for c in range(3)), batch.column(3)
        cut = (np.flatnonzero((np.diff(cluster) != 0) | (np.diff(tile) != 0)) + 1).tolist()
        for a, b in zip([0, *cut], [*cut, len(own)]):
            if (cluster[a], tile[a]) != name:
                if name:
                    yield name[0], np.concatenate(k), parts
                name, k, parts = (cluster[a], tile[a]), [], []
            k.append(own[a:b].copy())
            parts += [np.frombuffer(blobs[i].as_py(), np.uint64) for i in range(a, b)]
    if name:
        yield name[0], np.concatenate(k), parts


def _add_shared(common: np.ndarray, row: np.ndarray, parts: list[np.ndarray]) -> None:
    """Adds to ``common`` the sizes of the intersections of the rows' parts."""
    _, column, uses = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    row = np.repeat(row, [len(s) for s in parts])
    twice = uses[column] > 1  # what one set alone holds is in no intersection
    column, row = (np.cumsum(uses > 1) - 1)[column[twice]], row[twice]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    width = min(4096, max(1, int((uses > 1).sum())))
    edges = np.searchsorted(column, np.arange(0, int((uses > 1).sum()) + width, width))
    for c, (a, b) in enumerate(zip(edges, edges[1:])):
        block = np.zeros((len(common), width), np.float32)
        block[row[a:b], column[a:b] - c * width] = 1
        common += block @ block.T


def _confirm(percent: int):
    """Star edges of each cluster's components by full sets. A cluster comes as tiles (ranges of shingle hashes, every member in
    each); intersections are summed tile by tile, so a task holds one tile and one matrix of members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tiles in groupby(_tiles(batches), key=lambda tile: tile[0]):
            members = None
            for _, k, parts in tiles:
                if members is None:
                    members = np.unique(k)
                    common, size = np.zeros((len(members), len(members)), np.float64), np.zeros(len(members), np.int64)
                row = np.searchsorted(members, k)
                np.add.at(size, row, [len(s) for s in parts])
                _add_shared(common, row, parts)
            linked = np.zeros(common.shape, bool)
            for r in range(0, len(members), 256):  # bounded memory
                linked[r : r + 256] = 100 * common[r : r + 256] >= percent * (size[r : r + 256, None] + size - common[r : r + 256])
            np.fill_diagonal(linked, True)
            label = _components(linked)
            far = np.flatnonzero(label != np.arange(len(members)))
            yield pa.RecordBatch.from_arrays([pa.array(members[label[far]]), pa.array(members[far])], names=["a", "b"])

    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(k, root): the smallest reachable k of every k in the undirected edges (a, b)."""
    state, edges = None, stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        # every row has a > b: the small-star of a takes its smallest b
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.greatest("b", "m").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = stored(small.filter("a != b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("k"), F.col("b").alias("root"))
        state = now


def near_duplicates(
    docs: DataFrame, percent: int = 80, width: int = 5, trees: int = 16, positions: int = 64, leaf: int = 2048, depth: int = 5, tile_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links
    of Jaccard similarity >= ``percent``/100, its own included) and kept (doc_id = component_id)."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = stored(own.mapInArrow(_sketches(positions, width), "doc_id long, n long, k long, k2 long, mh array<int>"), "sketches")
    classes = stored(rows.filter("n > 0").groupBy("k", "k2", "n").agg(F.min("doc_id").alias("first_id"), F.first("mh").alias("mh")), "classes")

    # the roots of all trees: chosen positions, the same for all classes
    draw = np.random.default_rng(7)
    fan = 100 / percent
    roots = [(t, int(p)) for t in range(trees) for p in draw.choice(positions, 1 + int(draw.random() < fan - 1), replace=False)]
    nodes = classes.select("k", F.explode(F.array(*[F.xxhash64(F.lit(t), F.lit(p), F.col("mh")[p]) for t, p in roots])).alias("node"))
    leaves = []
    for level in range(depth + 1):
        size = nodes.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        nodes = stored(nodes.join(size, "node"), "nodes")
        leaves.append(nodes.filter(F.col("size") <= leaf).select("node", "k"))
        large = nodes.filter(F.col("size") > leaf)
        if large.isEmpty():
            break
        if level == depth:
            blocks = F.ceil(F.col("size") * 2 / leaf).cast("int")
            at = large.withColumn("at", F.pmod(F.xxhash64("k"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            leaves.append(at.select(F.xxhash64("node", F.least("at", "other"), F.greatest("at", "other")).alias("node"), "k"))
            break
        p = [F.pmod(F.xxhash64("node", F.lit(level), F.lit(i)), F.lit(positions)).cast("int") for i in (1, 2)]
        second = F.pmod(F.xxhash64("node", F.lit(level), F.lit(3)), F.lit(1000)) < int(1000 * (fan - 1))
        child = lambda at: F.xxhash64("node", at, F.get("mh", at))
        nodes = large.select("node", "k").join(classes.select("k", "mh"), "k").select("k", F.explode(F.when(second & (p[0] != p[1]), F.array(child(p[0]), child(p[1]))).otherwise(F.array(child(p[0])))).alias("node"))
    members = leaves[0]
    for more in leaves[1:]:
        members = members.unionAll(more)

    sorted_by = lambda df, key: df.repartition(key).sortWithinPartitions(key)
    compared = members.join(classes.select("k", "n", "mh"), "k").select("node", "k", "n", "mh")
    clusters = stored(sorted_by(compared, "node").mapInArrow(_clusters(percent, positions), "cluster long, k long").distinct(), "clusters")
    # a cluster is confirmed in ``tiles`` ranges of shingle hashes (a power of two), each of about ``tile_bytes``;
    # a class's set is cut into as many parts as its largest cluster has tiles
    bytes_of = clusters.join(classes.select("k", "n"), "k").groupBy("cluster").agg((F.sum("n") * 8).alias("bytes"))
    tiles = F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("bytes") / F.lit(tile_bytes))))
    tiled = stored(clusters.join(bytes_of.select("cluster", F.pow(F.lit(2.0), F.least(tiles, F.lit(30.0))).cast("long").alias("tiles")), "cluster"), "tiled")
    wanted = tiled.groupBy("k").agg(F.max("tiles").alias("parts")).join(classes.select("k", "first_id"), "k")
    wanted = stored(wanted.select("k", "first_id", "parts"), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a, b in pieces_by_bytes(texts):
                rows = []
                for i, own_set in zip(range(a, b), shingle_sets(texts[a:b], width)):
                    name = int(mix64(np.array([np.add.reduce(own_set)], np.uint64)).view(np.int64)[0]) if len(own_set) else 0
                    # part p: hashes whose highest bits are p; the set is sorted
                    cuts = np.searchsorted(own_set >> _U(34), np.arange(1, parts[i]).astype(np.uint64) * _U((1 << 30) // parts[i]))
                    rows += [(name, ids[i], parts[i], p, x.tobytes()) for p, x in enumerate(np.split(own_set, cuts))]
                k, doc_id, of, part, found = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(of, pa.int64()), pa.array(part, pa.int64()), pa.array(found, pa.binary())], names=["k", "id", "of", "part", "set"]
                )

    texts = own.join(wanted.filter("first_id IS NOT NULL").groupBy(F.col("first_id").alias("doc_id")).agg(F.max("parts").alias("parts")), "doc_id").select("doc_id", "parts", "t")
    # classes of null ids alone may still link others
    of_null = wanted.filter("first_id IS NULL").agg(F.max("parts")).first()[0]
    if of_null:
        texts = texts.unionAll(own.filter("doc_id IS NULL").select("doc_id", F.lit(of_null).alias("parts"), "t"))
    full = texts.mapInArrow(sets, "k long, id long, of long, part long, set binary")
    named = wanted.select(F.col("k").alias("__k"), "first_id")
    full = full.join(named, (full["k"] == named["__k"]) & full["id"].eqNullSafe(named["first_id"]), "left_semi").dropDuplicates(["k", "part"])
    tile = F.expr("part * tiles div of")
    dealt = tiled.join(full, "k").select("cluster", tile.alias("tile"), "k", "set").repartition("cluster").sortWithinPartitions("cluster", "tile")
    links = dealt.mapInArrow(_confirm(percent), "a long, b long")

    roots_of = connected_components(links)
    labelled = classes.select("k", "k2", "n", "first_id").join(roots_of, "k", "left").withColumn("root", F.coalesce("root", "k"))
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(smallest, "root").select("k", "k2", "n", "component_id")
    joined = rows.select("doc_id", "n", "k", "k2").filter("n > 0").join(named, ["k", "k2", "n"])
    alone = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return (
        joined.select("doc_id", "n", "component_id")
        .unionByName(alone)
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
    )


def keep_first(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) whose id is the smallest of its component; of rows with
    equal id and equal text one stays. Rows with a null id stay."""
    kept = near_duplicates(docs, percent=percent, id_col=id_col, text_col=text_col, **options).filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    own = docs.join(kept, docs[id_col].eqNullSafe(kept["__kept"]), "left_semi")
    copy = Window.partitionBy(F.col(id_col), F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()), F.xxhash64(F.col(text_col))).orderBy(F.lit(0))
    return own.withColumn("__copy", F.row_number().over(copy)).filter("__copy = 1").drop("__copy")
