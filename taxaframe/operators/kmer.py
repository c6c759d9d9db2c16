"""k-mer joins: read classification against a taxonomy, host / spike-in removal,
clade-count reports and species re-estimation.

For removal, reads meet a catalogue as super-k-mers: an Arrow kernel packs canonical k-mers into 2-bit BIGINTs,
groups the windows of a mate by minimiser, and emits one row per group, so the shuffle carries a
row for about nine windows. Catalogue rows are keyed by the minimiser of their k-mer; rows that meet are
verified k-mer by k-mer inside the join. Minimisers with large buckets are keyed by k-mer on
both sides instead. A Bloom filter of the catalogue, built by aggregation, drops windows without a match
in the scan of the reads. A hot minimiser is left to the adaptive skew join.

Hits of all taxa, where most windows match, are looked up by numbered reads whose runs of windows are shuffled as packed bases
(``functions.packed``).

The taxonomy is numbered once (:func:`index_tree`): a node's descendants have enter numbers within its
(enter, leave) range, so ancestor tests are comparisons of integers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from taxaframe.functions.bloom import anti_join, build_bloom
from taxaframe.functions.kernels import canonical_kmers
from taxaframe.functions.packed import BLOCK_BITS, ROW, look_up, named_hits, pack_catalogue, pack_reads
from taxaframe.functions.superkmer import Prefilter, catalogue_keys, may_be_claimed, super_kmers
from taxaframe.session import stored


def pack_kmer(c) -> F.Column:
    """Canonical k-mer text (ACGT) -> 2-bit packed BIGINT (same order as the text)."""
    return F.conv(F.translate(F.upper(c), "ACGT", "0123"), 4, 10).cast("bigint")


def mate_sequences(reads: DataFrame, k: int) -> DataFrame:
    """(sample, read_id, mate, seq) of mates with at least ``k`` bases; qualities are not read."""
    pair = F.array(*[F.struct(F.lit(i).alias("mate"), F.col(f"seq{i}").alias("seq")) for i in (1, 2)])
    return reads.select("sample", "read_id", F.explode(pair).alias("m")).select("sample", "read_id", "m.mate", "m.seq").filter(F.length("seq") >= k)


def read_kmers(reads: DataFrame, k: int = 31) -> DataFrame:
    """(sample, read_id, mate, kmer BIGINT): every canonical k-mer without N, both mates."""
    return mate_sequences(reads, k).select("sample", "read_id", "mate", F.explode(canonical_kmers(k)(F.col("seq"))).alias("kmer"))


def catalogue(kmers: DataFrame, col: str = "kmer") -> DataFrame:
    """A catalogue keyed by packed k-mers; text k-mers are packed, BIGINT ones kept."""
    if dict(kmers.dtypes)[col] == "string":
        return kmers.withColumn(col, pack_kmer(F.col(col)))
    return kmers


@dataclass(frozen=True)
class KmerIndex:
    """A catalogue ready to be joined: (kmer, its other columns, key), and what the scan of the reads needs of it."""

    table: DataFrame
    prefilter: Broadcast
    k: int
    m: int
    rows: DataFrame  # the table without its key


def build_index(kmers: DataFrame, k: int = 31, m: int = 15, bloom: bool = True, max_bloom_bytes: int = 64 << 20, heavy_bucket: int | None = 256, max_heavy: int = 1 << 17, bits_per_key: int = 12) -> KmerIndex:
    """Index of a catalogue with a ``kmer`` column and any others.

    A minimiser with more than ``heavy_bucket`` catalogue rows is heavy (None: none is looked for); of these the ``max_heavy``
    largest are listed (1 MB), any others keep their bucket. A filter larger than ``max_bloom_bytes`` is left out.
    Neither changes a result.
    """
    if not 1 <= m <= k <= 31:
        raise ValueError("need 1 <= m <= k <= 31")
    cat = catalogue(kmers)
    cat = cat.select("kmer", *[c for c in cat.columns if c != "kmer"]).filter(F.col("kmer").isNotNull())
    fields = ", ".join(f"`{name}` {kind}" for name, kind in cat.dtypes) + ", key bigint"
    listed = []
    if heavy_bucket is not None:
        sizes = cat.select("kmer").mapInArrow(catalogue_keys(k, m), "kmer bigint, key bigint").groupBy("key").count()
        listed = sizes.filter(F.col("count") > heavy_bucket).orderBy(F.desc("count"), "key").limit(max_heavy).collect()
    heavy = np.sort(np.array([r.key for r in listed], np.int64).view(np.uint64))
    held = build_bloom(cat.select("kmer"), cat.count(), bits_per_key, max_bloom_bytes) if bloom else None
    prefilter = kmers.sparkSession.sparkContext.broadcast(Prefilter(heavy, held))
    return KmerIndex(cat.mapInArrow(catalogue_keys(k, m, heavy), fields), prefilter, k, m, cat)


def match_kmers(reads: DataFrame, index: KmerIndex, how: str = "inner") -> DataFrame:
    """(sample, read_id, mate, n, the catalogue's columns): per mate and catalogue row, how often its k-mer occurs in the mate.
    A left join also names mates of which the filter holds windows that the catalogue has not."""
    schema = "sample string, read_id string, mate int, key bigint, kmers array<bigint>, counts array<int>"
    runs = mate_sequences(reads, index.k).mapInArrow(super_kmers(index.k, index.m, index.prefilter), schema)
    met = runs.join(index.table.withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & F.expr("array_contains(kmers, kmer)"), how)
    n = F.coalesce(F.expr("counts[int(array_position(kmers, kmer)) - 1]"), F.lit(1)).cast("bigint")
    return met.select("sample", "read_id", "mate", n.alias("n"), *[c for c in index.table.columns if c != "key"])


def number_reads(reads: DataFrame) -> DataFrame:
    """(row, sample, read_id, seq1, seq2): a table of the reads with numbers, consecutive within a partition."""
    return stored(reads.select(F.monotonically_increasing_id().alias("row"), "sample", "read_id", "seq1", "seq2"), "numbered")


#: stands for a null taxon while hits are packed
_NO_TAXON = -(1 << 63)


def _numbered_hits(reads: DataFrame, index: KmerIndex, kmers_per_bucket: int = 100_000, max_buckets: int = 4096) -> DataFrame:
    """:func:`kmer_hits` of :func:`number_reads`. Shuffled are the reads' bases, 2 bits each and in runs of one bucket, the catalogue
    by bucket, the found taxa by block of reads, and the sums by read: no names with the runs or the taxa."""
    kind = dict(index.rows.dtypes)["taxid"]
    buckets = min(max_buckets, max(64, index.rows.count() // kmers_per_bucket))
    runs = reads.select("row", "seq1", "seq2").mapInArrow(pack_reads(index.k, index.m, buckets, index.prefilter), ROW)
    taxon = F.coalesce(F.col("taxid").cast("bigint"), F.lit(_NO_TAXON).cast("bigint"))
    known = index.rows.select("kmer", taxon.alias("tag")).mapInArrow(pack_catalogue(index.k, index.m, buckets), ROW)
    met = known.unionByName(runs).repartition("bucket").sortWithinPartitions("bucket", "block")
    found = met.mapInArrow(look_up(index.k), "block bigint, a binary, b binary, c binary")
    names = reads.select(F.shiftright("row", BLOCK_BITS).alias("block"), "row", "sample", "read_id")
    own = names.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(named_hits, "sample string, read_id string, tag bigint, hits bigint")
    # names may repeat; all rows of a name are brought together, whatever their taxa
    sums = own.repartition("sample", "read_id").groupBy("sample", "read_id", "tag").agg(F.sum("hits").alias("hits"))
    return sums.select("sample", "read_id", F.when(F.col("tag") != _NO_TAXON, F.col("tag")).cast(kind).alias("taxid"), "hits")


def kmer_hits(reads: DataFrame, kmers: DataFrame | KmerIndex, k: int = 31) -> DataFrame:
    """(sample, read_id, taxid, hits): k-mers of a pair found in the catalogue, per taxon (an integer).
    ``reads`` is a table of reads or its :func:`number_reads`. Most windows are in a catalogue of all taxa, so no filter is built of it."""
    index = kmers if isinstance(kmers, KmerIndex) else build_index(kmers.select("kmer", "taxid"), k, bloom=False, heavy_bucket=None)
    return _numbered_hits(reads if "row" in reads.columns else number_reads(reads), index)


# -- taxonomy ----------------------------------------------------------------------------

def ancestors(tree: DataFrame) -> DataFrame:
    """(taxid, ancestor, depth): every node with itself and all its ancestors, with the
    ancestor's depth (root = 0). Recursive CTE over the edge table (taxid, parent; a root's parent is
    0 or itself), without a row limit; a longer cycle ends in the recursion level limit's error.
    Here and below, joins with a taxonomy are merge joins: its compressed files look small enough to broadcast
    long before its rows are.
    """
    spark: SparkSession = tree.sparkSession
    edges = tree.select(F.col("taxid").cast("bigint").alias("taxid"), F.col("parent").cast("bigint").alias("parent"))
    anc = spark.sql(
        "WITH RECURSIVE anc(taxid, ancestor, up) AS ("
        " SELECT taxid, taxid, 0 FROM {e}"
        " UNION ALL SELECT /*+ MERGE(x) */ a.taxid, x.parent, a.up + 1 FROM anc a JOIN {e} x ON a.ancestor = x.taxid WHERE x.parent <> 0 AND x.parent <> x.taxid)"
        " SELECT taxid, ancestor, up FROM anc LIMIT ALL",
        e=edges,
    )
    # levels of one node are numbered from its root, which is the ancestor farthest up
    return anc.select("taxid", "ancestor", (F.max("up").over(Window.partitionBy("taxid")) - F.col("up")).cast("bigint").alias("depth"))


def index_tree(tree: DataFrame) -> DataFrame:
    """(taxid, enter, leave, path) of every node: numbers of an Euler tour, and ``path``, the (enter, leave, node) of its
    ancestors and itself from the root down.

    The tour visits children by taxid. A node's number is the sum, over its ancestors and itself, of one
    plus the sizes of the earlier siblings' subtrees; it leaves after as many numbers as its subtree has nodes.
    A parent that the table does not list is a root. Made once per taxonomy: store it for several uses.
    """
    up = ancestors(tree)
    size = up.groupBy(F.col("ancestor").alias("node")).agg(F.count("*").alias("own"), F.max("depth").alias("depth"))
    # the parent is the path's last node but one
    above = up.select(F.col("taxid").alias("_t"), F.col("ancestor").alias("parent"), (F.col("depth") + 1).alias("_d"))
    listed = tree.select(F.col("taxid").cast("bigint").alias("node")).distinct().withColumn("listed", F.lit(1))
    nodes = size.join(above.hint("merge"), (F.col("node") == F.col("_t")) & (F.col("depth") == F.col("_d")), "left").join(listed.hint("merge"), "node", "left")
    # an unlisted parent is counted by its descendants, not by itself
    nodes = nodes.select("node", F.coalesce("parent", F.lit(0)).alias("parent"), (F.col("own") + F.when(F.col("listed").isNull(), 1).otherwise(0)).alias("size"))
    earlier = Window.partitionBy("parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    step = nodes.withColumn("step", 1 + F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    both = up.unionByName(nodes.filter(F.col("parent") == 0).select(F.col("node").alias("taxid"), F.col("node").alias("ancestor"), F.lit(0).cast("bigint").alias("depth"))).distinct()
    path = both.join(step.hint("merge"), F.col("ancestor") == F.col("node")).groupBy("taxid").agg(F.array_sort(F.collect_list(F.struct("depth", "step", "size", "node"))).alias("p"))
    # running sums of the steps are the numbers of the path's nodes (bounded by the tree's depth)
    tour = F.transform("p", lambda e, i: F.aggregate(F.slice("p", 1, i + 1), F.lit(0).cast("bigint"), lambda a, x: a + x["step"]))
    numbered = path.select("taxid", F.transform(F.arrays_zip("p", tour.alias("enter")), lambda z: F.struct(
        z["enter"].alias("enter"), (z["enter"] + z["p"]["size"] - 1).alias("leave"), z["p"]["node"].alias("node"))).alias("path"))
    last = F.element_at("path", -1)
    return numbered.select("taxid", last["enter"].alias("enter"), last["leave"].alias("leave"), "path")


@arrow_udf(StructType([StructField(c, LongType()) for c in ("taxid", "low", "high")]))
def _best_taxa(hits: pa.Array) -> pa.Array:
    """Of each read's (enter, leave, taxid, n): the taxon with the highest sum over itself and its
    ancestors; where several have it, the first of them in the tour (``low``) and the enter number of the last (``high``)."""
    flat = hits.flatten()
    enter, leave, taxid, n = (np.asarray(flat.field(i)) for i in range(4))
    size = np.asarray(hits.value_lengths().fill_null(0))
    rows = len(size)
    row = np.repeat(np.arange(rows), size)
    best, low, high = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    some, one = size > 0, np.zeros(rows, bool)
    if len(row):
        order = np.lexsort((enter, row))
        enter, leave, taxid, n = enter[order], leave[order], taxid[order], n[order]
        base = int(enter.min())
        span = int(max(enter.max(), leave.max())) - base + 2
        end = np.searchsorted(row * span + enter - base, row * span + leave - base, "right")
        # a taxon's hits count for all later taxa up to its leave number
        change = np.zeros(len(row) + 1, np.int64)
        change[:-1] = n
        np.subtract.at(change, end, n)
        score = np.cumsum(change[:-1])
        starts = (np.cumsum(size) - size)[some]
        tied = np.flatnonzero(score == np.maximum.reduceat(score, starts)[np.cumsum(some)[row] - 1])
        first, place, many = np.unique(row[tied], return_index=True, return_counts=True)
        one[first] = many == 1
        best[first], low[first], high[first] = taxid[tied[place]], taxid[tied[place]], enter[tied[place + many - 1]]
    several = some & ~one
    return pa.StructArray.from_arrays(
        [pa.array(best, mask=~one), pa.array(low, mask=~several), pa.array(high, mask=~several)], names=["taxid", "low", "high"]
    )


def lineages(index: DataFrame, names: DataFrame, root_rank: str = "R") -> DataFrame:
    """K6: (taxid, lineage) of every node: the names on its path from below the root, joined by ';'. A name without a
    rank prefix gets its rank's (``g__`` for rank G), blanks become underscores."""
    text = F.when(F.col("name").rlike("^[a-z]__"), F.col("name")).otherwise(F.concat(F.lower(F.substring("rank", 1, 1)), F.lit("__"), F.col("name")))
    known = names.filter(F.col("rank") != root_rank).select(F.col("taxid").cast("bigint").alias("node"), F.replace(text, F.lit(" "), F.lit("_")).alias("name"))
    steps = index.select("taxid", F.posexplode(F.transform("path", lambda a: a["node"])).alias("depth", "node")).join(known.hint("merge"), "node")
    ordered = F.array_sort(F.collect_list(F.struct("depth", "name")))  # as long as the tree is deep
    return steps.groupBy("taxid").agg(F.concat_ws(";", F.transform(ordered, lambda x: x["name"])).alias("lineage"))


def classify(hits: DataFrame, index: DataFrame) -> DataFrame:
    """Per read, the hit taxon with the highest root-to-taxon score (hits on it and its
    ancestors); ties -> lowest common ancestor of the tied taxa, 0 if they have none. A hit taxon that the tree
    lacks stands alone, as a root of its own. A row with null taxid is a read without hits: taxid 0.
    Output (sample, read_id, taxid).

    One gathering by read: its hits (a row per taxon) with the taxa's numbers. Only tied reads look up a path.
    """
    numbers = index.select(F.col("taxid").alias("_t"), "enter", "leave")
    known = hits.join(numbers, F.col("taxid") == F.col("_t"), "left")
    # taxa outside the tree get numbers of their own below all others
    own = -F.lit(1) - F.col("taxid").cast("bigint")
    entry = F.struct(F.coalesce("enter", own).alias("enter"), F.coalesce("leave", own).alias("leave"), F.col("taxid").cast("bigint").alias("taxid"), F.col("hits").cast("bigint").alias("hits"))
    per_read = known.groupBy("sample", "read_id").agg(F.collect_list(F.when(F.col("taxid").isNotNull(), entry)).alias("h"))
    found = per_read.select("sample", "read_id", _best_taxa("h").alias("b")).select("sample", "read_id", "b.*")
    # untied reads look up nothing; their keys are spread, as a shuffle would send all nulls to one task
    look = F.coalesce("low", -F.lit(2) - F.pmod(F.xxhash64("read_id"), F.lit(1 << 20)))
    paths = index.select(F.col("taxid").alias("_low"), "path")
    joint = F.element_at(F.filter("path", lambda a: a["leave"] >= F.col("high")), -1)["node"]
    tied = found.withColumn("_look", look).join(paths, F.col("_look") == F.col("_low"), "left")
    joint = F.when(F.col("path").isNotNull() & F.exists("path", lambda a: a["leave"] >= F.col("high")), joint)
    return tied.select("sample", "read_id", F.coalesce("taxid", joint, F.lit(0).cast("bigint")).alias("taxid"))


def classify_reads(reads: DataFrame, kmers: DataFrame | KmerIndex, tree: DataFrame, k: int = 31) -> DataFrame:
    """Every pair with its taxon; 0 = unclassified (no k-mer hit). ``tree`` is an edge table or its :func:`index_tree`."""
    index = tree if "path" in tree.columns else index_tree(tree)
    reads = number_reads(reads)
    none = reads.select("sample", "read_id", F.lit(None).cast("bigint").alias("taxid"), F.lit(None).cast("bigint").alias("hits"))
    hits = kmer_hits(reads, kmers, k).select("sample", "read_id", F.col("taxid").cast("bigint").alias("taxid"), "hits")
    return classify(hits.unionByName(none), index)


def tree_report(assign: DataFrame, tree: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Per sample and taxon: direct reads, clade reads (self + descendants), percent
    of all reads; taxid 0 is the unclassified row. Output
    (sample, taxid, rank, name, direct_reads, clade_reads, pct).

    Single pass over the assignments: direct counts are spread to every ancestor by
    the taxon's path (unclassified reads have no ancestors and stay on 0);
    the per-sample total is the roots' clades plus the unclassified row, taken by a
    window over that sample's report rows (bounded by the taxa it contains).
    """
    index = index if index is not None else index_tree(tree)
    direct = assign.groupBy("sample", "taxid").agg(F.count("*").alias("n"))
    paths = index.select(F.col("taxid").alias("_t"), F.transform("path", lambda a: a["node"]).alias("path"))
    line = F.coalesce("path", F.array(F.col("taxid").cast("bigint")))
    spread = direct.join(paths, F.col("taxid") == F.col("_t"), "left").select("sample", "taxid", "n", F.posexplode(line).alias("depth", "node"))
    rows = spread.groupBy("sample", "node", "depth").agg(
        F.sum("n").alias("clade_reads"), F.sum(F.when(F.col("node") == F.col("taxid"), F.col("n")).otherwise(0)).alias("direct_reads")
    )
    total = F.sum(F.when(F.col("depth") == 0, F.col("clade_reads")).otherwise(0)).over(Window.partitionBy("sample"))
    names = tree.select(F.col("taxid").cast("bigint").alias("node"), "rank", "name")
    return rows.withColumn("_total", total).join(names, "node", "left").select(
        "sample", F.col("node").alias("taxid"),
        F.coalesce("rank", F.lit("U")).alias("rank"),
        F.coalesce("name", F.lit("unclassified")).alias("name"),
        F.col("direct_reads").cast("bigint").alias("direct_reads"),
        F.col("clade_reads").cast("bigint").alias("clade_reads"),
        (F.col("clade_reads") * 100.0 / F.col("_total")).alias("pct"),
    )


def reestimate(report: DataFrame, distrib: DataFrame, level: str = "S", threshold: int = 10) -> DataFrame:
    """Species abundance re-estimation from a tree report and a k-mer distribution.

    N_j = clade reads of species j; species with N_j < threshold are dropped. The
    direct reads r_i of every node i above species level are shared among kept
    species j with P(i|j) > 0, in proportion to w_ij = P(i|j) * N_j / P(j|j).
    new_est_j = N_j + sum_i r_i * w_ij / sum_j' w_ij'; fraction = new_est_j / sum new_est.
    Output (sample, species, kraken_assigned_reads, added_reads, new_est_reads, fraction).

    The report is read once: a species row and a node row both spread to the (node, species)
    pairs of the distribution that name them, and meet there in one aggregation.
    """
    self_p = F.max(F.when(F.col("node") == F.col("species"), F.col("p"))).over(Window.partitionBy("species"))
    pairs = distrib.select(F.col("node").cast("bigint").alias("node"), F.col("species").cast("bigint").alias("species"), "p").withColumn("p_jj", self_p)
    sides = F.explode(F.array(F.struct(F.col("species").alias("key"), F.lit(True).alias("as_species")), F.struct(F.col("node").alias("key"), F.lit(False).alias("as_species"))))
    named = pairs.select("node", "species", "p", "p_jj", sides.alias("s")).select("node", "species", "p", "p_jj", "s.*").filter(F.col("as_species") | (F.col("node") != F.col("species")))
    kept = (F.col("rank") == level) & (F.col("clade_reads") >= threshold)
    shared = (F.col("rank") != level) & (F.col("taxid") != 0) & (F.col("direct_reads") > 0)
    rows = report.filter(kept | shared).select(
        "sample", "taxid", kept.alias("is_species"), F.when(kept, F.col("clade_reads")).alias("n_j"), F.when(~kept, F.col("direct_reads")).alias("r_i")
    )
    met = rows.join(named.hint("merge"), (F.col("taxid") == F.col("key")) & (F.col("is_species") == F.col("as_species")), "left")
    met = met.filter(F.col("is_species") | F.col("key").isNotNull())  # a species stays, whatever the distribution lists
    pair = met.groupBy("sample", F.coalesce("species", "taxid").alias("species"), F.coalesce("node", "taxid").alias("node")).agg(
        F.max("n_j").alias("n_j"), F.max("r_i").alias("r_i"), F.max("p").alias("p"), F.max("p_jj").alias("p_jj")
    )
    weight = F.when(F.col("node") != F.col("species"), F.when(F.col("r_i").isNotNull(), F.col("p") * F.col("n_j") / F.col("p_jj")))
    share = pair.filter(F.col("n_j").isNotNull()).withColumn("w", weight).withColumn("ws", F.sum("w").over(Window.partitionBy("sample", "node")))
    est = share.groupBy("sample", "species").agg(
        F.max("n_j").alias("kraken_assigned_reads"), F.coalesce(F.sum(F.col("r_i") * F.col("w") / F.col("ws")), F.lit(0.0)).alias("added_reads")
    ).withColumn("new_est_reads", F.col("kraken_assigned_reads") + F.col("added_reads"))
    return est.withColumn("fraction", F.col("new_est_reads") / F.sum("new_est_reads").over(Window.partitionBy("sample")))


# -- removal -----------------------------------------------------------------------------

PAIR = ["sample", "read_id"]
#: bits of a ``bitmap_construct_agg``
_BITMAP = 1 << 15


def host_pairs(reads: DataFrame, host_kmers: DataFrame | KmerIndex, k: int = 31, min_hits: int = 5, mode: str = "both") -> DataFrame:
    """(sample, read_id) of pairs of which both mates (``mode='both'``) or either one (``'any'``) has at least ``min_hits`` windows in the catalogue."""
    if mode not in ("both", "any"):
        raise ValueError("mode must be 'both' or 'any'")
    index = host_kmers if isinstance(host_kmers, KmerIndex) else build_index(catalogue(host_kmers.select("kmer")).distinct(), k)
    per_mate = [F.coalesce(F.sum(F.when(F.col("mate") == i, F.col("n"))), F.lit(0)) >= min_hits for i in (1, 2)]
    flagged = match_kmers(reads, index).groupBy("sample", "read_id").agg(per_mate[0].alias("m1"), per_mate[1].alias("m2"))
    return flagged.filter(F.col("m1") & F.col("m2") if mode == "both" else F.col("m1") | F.col("m2")).select("sample", "read_id")


def remove_host(reads: DataFrame, host_kmers: DataFrame | KmerIndex, k: int = 31, min_hits: int = 5, mode: str = "both") -> DataFrame:
    """Drop a pair when both mates (``mode='both'``, concordant) or either mate
    (``mode='any'``) is host by k-mer evidence; the rest is kept."""
    return anti_join(reads, host_pairs(reads, host_kmers, k, min_hits, mode), ["sample", "read_id"])


def _joint_index(catalogues: dict[str, DataFrame], k: int) -> KmerIndex:
    """One index of all catalogues, of distinct (kmer, source). It is read several times: a stored table. With 24 bits a k-mer, hardly a
    pair that is not claimed has several windows that the filter holds."""
    named = None
    for name, kmers in catalogues.items():
        own = catalogue(kmers.select("kmer")).select("kmer", F.lit(name).alias("source"))
        named = own if named is None else named.unionByName(own)
    return build_index(stored(named.distinct(), "catalogue"), k, bits_per_key=24)


def _claims(reads: DataFrame, index: KmerIndex, names: list[str], min_hits: int, mode: str, how: str = "inner") -> DataFrame:
    """(sample, read_id, claimed) of the pairs that :func:`match_kmers` finds in the catalogues ``names``."""
    if mode not in ("both", "any"):
        raise ValueError("mode must be 'both' or 'any'")
    claims = []
    for name in names:
        mate = [F.coalesce(F.sum(F.when((F.col("mate") == i) & (F.col("source") == name), F.col("n"))), F.lit(0)) >= min_hits for i in (1, 2)]
        claims.append(mate[0] & mate[1] if mode == "both" else mate[0] | mate[1])
    claimed = claims[0]
    for c in claims[1:]:
        claimed = claimed | c
    return match_kmers(reads, index, how).groupBy(*PAIR).agg(claimed.alias("claimed"))


def contaminated_pairs(reads: DataFrame, catalogues: dict[str, DataFrame], k: int = 31, min_hits: int = 5, mode: str = "both") -> DataFrame:
    """J6 and J7 in one pass: (sample, read_id) of the pairs that any of the catalogues claims (host, spike-in, ...).

    The catalogues share one index, so reads are cut into k-mers and shuffled once. Only ids come out.
    """
    return _claims(reads, _joint_index(catalogues, k), list(catalogues), min_hits, mode).filter("claimed").select(*PAIR)


def _agrees(names: DataFrame, buckets: int = 256) -> Column:
    """Condition that holds for every row with a name of ``names`` and few others: a bit of the name's hash, in bitmaps (1 MB at most)
    that a subquery of the plan makes."""
    h = F.xxhash64(*PAIR)
    bucket, bit = F.pmod(h, F.lit(buckets)).cast("int"), F.pmod(F.shiftright(h, 16), F.lit(_BITMAP))
    maps = names.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    bits = F.element_at(maps.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bits")))).scalar(), bucket)
    byte = F.conv(F.hex(F.substr(bits, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))


def decontaminate(reads: DataFrame, catalogues: dict[str, DataFrame], k: int = 31, min_hits: int = 5, mode: str = "both", min_len: int = 15, named_once: bool = False) -> DataFrame:
    """J6 -> J7 -> J8: pairs that no catalogue claims and whose mates both have at least ``min_len`` bases.

    Hits are summed by (sample, read_id). Where the caller's table gives no such name to two rows (``named_once``), a pair that
    the catalogues' filter clears by itself is kept in the scan, and what the others hold is looked up in the plan of the result:
    no job of its own reads the table. Nearly all that are looked up are claimed, so bases are shuffled only of pairs
    that agree with a cleared one in a bit of the name. Without ``named_once``, or a filter, claimed names are found first.
    """
    kept = reads.filter((F.length("seq1") >= min_len) & (F.length("seq2") >= min_len))
    index, names = _joint_index(catalogues, k), list(catalogues)
    if not named_once or min_hits < 1 or index.prefilter.value.bloom is None:
        return anti_join(kept, _claims(kept, index, names, min_hits, mode).filter("claimed"), PAIR)
    # a pair without a full name is found by no join
    named = F.col("sample").isNotNull() & F.col("read_id").isNotNull()
    may = may_be_claimed(k, min_hits, mode, index.prefilter)("seq1", "seq2") & named
    asked = kept.filter(may)
    # the join would add this filter to one of the two uses, which then would not be one stage
    cleared = _claims(asked, index, names, min_hits, mode, "left").filter(~F.col("claimed") & named).select(*PAIR)
    return kept.filter(~may).unionByName(asked.filter(_agrees(cleared)).join(cleared, PAIR, "left_semi"))


def decontaminate_marked(reads: DataFrame, passed: Column, again: Callable[[Column], DataFrame], catalogues: dict[str, DataFrame], k: int = 31, min_hits: int = 5, mode: str = "both", min_len: int = 15, named_once: bool = False) -> DataFrame:
    """:func:`decontaminate` of the rows that ``passed`` holds for, in one pass with all others: the reads with ``stages``, which names the
    stages that a row belongs to ('raw' every read once, 'clean' what decontamination keeps).

    Where names are given once, the few claims that the exact catalogue takes back come by a second, narrow plan: ``again`` gives the
    reads of a condition on the names, applied before bases and qualities are derived.
    """
    kept = F.coalesce(passed & (F.length("seq1") >= min_len) & (F.length("seq2") >= min_len), F.lit(False))
    raw, clean = F.array(F.lit("raw")), F.array(F.lit("clean"))
    index, names = _joint_index(catalogues, k), list(catalogues)
    if not named_once or min_hits < 1 or index.prefilter.value.bloom is None:
        chosen = reads.filter(kept)
        chosen = anti_join(chosen, _claims(chosen, index, names, min_hits, mode).filter("claimed"), PAIR)
        return reads.withColumn("stages", raw).unionByName(chosen.withColumn("stages", clean))
    named = F.col("sample").isNotNull() & F.col("read_id").isNotNull()
    held = may_be_claimed(k, min_hits, mode, index.prefilter)
    asked = reads.filter(kept).filter(held("seq1", "seq2") & named)
    cleared = _claims(asked, index, names, min_hits, mode, "left").filter(~F.col("claimed") & named).select(*PAIR)
    back = again(_agrees(cleared)).filter(kept).join(cleared, PAIR, "left_semi")
    may = held(F.when(kept, F.col("seq1")), F.when(kept, F.col("seq2"))) & named
    marked = reads.withColumn("_kept", kept).withColumn("_may", may)
    both = F.when(F.col("_kept") & ~F.col("_may"), F.array(F.lit("raw"), F.lit("clean"))).otherwise(raw)
    return marked.withColumn("stages", both).drop("_kept", "_may").unionByName(back.withColumn("stages", clean))


def remove_aligned(reads: DataFrame, aln: DataFrame, key=None) -> DataFrame:
    """Drop pairs that a user's alignment table reports as properly paired."""
    bad = aln.filter(F.col("proper_pair")).select("sample", F.col("read_id").alias("_rid")).distinct()
    k = key if key is not None else F.col("read_id")
    return reads.join(bad, (reads["sample"] == bad["sample"]) & (k == bad["_rid"]), "left_anti")
