"""Test inputs derived from the driver's tables (see FIXTURES.md).

The reference ships no raw inputs, so profiles, reads, genomes, k-mers and
alignments are derived from the TPC-H-style tables by one SQL text that runs on
both Spark and DuckDB. On Spark the text is planned by ``spark.sql`` with the
source tables bound as DataFrame parameters (no global temp views); the DuckDB
oracle receives the same text as a CTE prefix.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from taxaframe.session import stored

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_MD5_ACGT = "'0123456789abcdef','ACGTACGTACGTACGT'"

# name -> SQL text; ``{x}`` placeholders name the tables/fixtures it reads.
FIXTURE_SQL: dict[str, str] = {
    "fx_genome": (
        "SELECT p_partkey AS genome_id, p_partkey+1000 AS species, "
        "cast(substr(p_brand,7) as int)+100 AS genus, cast(substr(p_brand,7) as int)%6+10 AS domain, concat("
        f"translate(md5(concat(p_brand,'-0')),{_MD5_ACGT}), "
        f"translate(md5(concat(p_brand,'-1')),{_MD5_ACGT}), "
        f"translate(md5(concat(cast(cast(substr(p_brand,7) as int)%6 as string),'-2')),{_MD5_ACGT}), "
        + ", ".join(
            f"translate(md5(concat(cast(p_partkey as string),'-{i}')),{_MD5_ACGT})" for i in range(3, 8)
        )
        + ") AS seq FROM {part}"
    ),
    "fx_taxonomy": (
        "SELECT 1 AS taxid, 0 AS parent, 'R' AS rank, 'root' AS name "
        "UNION ALL SELECT DISTINCT domain,1,'K',concat('k__D',cast(domain as string)) FROM {fx_genome} "
        "UNION ALL SELECT DISTINCT genus,domain,'G',concat('g__G',cast(genus as string)) FROM {fx_genome} "
        "UNION ALL SELECT species,genus,'S',concat('s__S',cast(species as string)) FROM {fx_genome}"
    ),
    "fx_reads": (
        # every lineitem row is a read; rows that share (order, line, part) are numbered over all their columns
        "WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey,l_linenumber,l_partkey ORDER BY l_suppkey,l_quantity,l_extendedprice,"
        "l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate) AS copy FROM {lineitem}), "
        "b AS (SELECT concat(cast(l_orderkey as string),':',cast(l_linenumber as string),':',cast(l_partkey as string),"
        "CASE WHEN copy=1 THEN '' ELSE concat(':',cast(copy as string)) END) AS read_id, "
        "l_orderkey*8+l_linenumber AS ordinal, l_suppkey%12 AS sn, l_partkey AS pk, cast(l_quantity as int) AS q, "
        "(l_orderkey*31+l_linenumber*17)%96 AS off FROM n), "
        "c AS (SELECT b.*, g.seq, cast(CASE WHEN q%10=7 THEN 1 ELSE 1+off END as int) AS st FROM b JOIN {fx_genome} g ON g.genome_id=b.pk), "
        "d AS (SELECT *, substr(seq,st,100) AS s1, reverse(translate(substr(seq,st+60,100),'ACGT','TGCA')) AS s2, "
        "translate(substr(concat(md5(concat('q',read_id)),md5(concat('r',read_id)),md5(concat('s',read_id)),md5(concat('t',read_id))),1,100),'0123456789abcdef','#+049<>?@ABCDEFI') AS q1, "
        "translate(substr(concat(md5(concat('u',read_id)),md5(concat('v',read_id)),md5(concat('w',read_id)),md5(concat('x',read_id))),1,100),'0123456789abcdef','#+049<>?@ABCDEFI') AS q2 FROM c) "
        "SELECT concat('S',lpad(cast(sn as string),2,'0')) AS sample, ordinal, read_id, "
        "CASE q%10 WHEN 1 THEN concat(substr(s1,1,85),repeat('G',15)) WHEN 2 THEN concat(substr(s1,1,10),repeat('N',8),substr(s1,19)) "
        "WHEN 3 THEN concat(substr(s1,1,60),'AGATCGGAAGAGC',substr(s1,74)) "
        "WHEN 5 THEN substr(s1,1,12) WHEN 6 THEN repeat('A',100) ELSE s1 END AS seq1, "
        "CASE q%10 WHEN 4 THEN concat(substr(q1,1,50),repeat('#',50)) WHEN 5 THEN substr(q1,1,12) ELSE q1 END AS qual1, "
        "s2 AS seq2, q2 AS qual2 FROM d"
    ),
    # pairs of which some have an insert shorter than the reads, so that both mates run into adapters
    "fx_reads_pe": (
        "SELECT sample, ordinal, read_id, "
        "CASE WHEN short THEN substr(concat(substr(seq1,1,ins),'AGATCGGAAGAGCACACGTCTGAACTCCAGTCA',repeat('A',100)),1,100) ELSE seq1 END AS seq1, qual1, "
        "CASE WHEN short THEN substr(concat(reverse(translate(substr(seq1,1,ins),'ACGT','TGCA')),'AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT',repeat('A',100)),1,100) ELSE seq2 END AS seq2, qual2 "
        "FROM (SELECT *, ordinal%5<2 AND length(seq1)=100 AND length(seq2)=100 AS short, cast(40+ordinal%50 as int) AS ins FROM {fx_reads}) x"
    ),
    "fx_base": (
        "SELECT CASE WHEN s_nationkey<2 THEN concat('Mock',cast(s_nationkey+1 as string)) WHEN s_nationkey=2 THEN 'mock3' "
        "ELSE concat('S',lpad(cast(s_nationkey as string),2,'0')) END AS sample, p_type, p_brand, p_name, p_size, p_partkey, "
        "l_quantity, l_returnflag FROM {lineitem} JOIN {part} ON l_partkey=p_partkey JOIN {supplier} ON l_suppkey=s_suppkey"
    ),
    "fx_profile_marker": (
        "SELECT sample, concat('k__',p_type,'|g__',replace(p_brand,'#','_'),'|s__',replace(p_name,' ','_')) AS clade_name, "
        "sum(l_quantity)/1000 AS relative_abundance FROM {fx_base} GROUP BY 1,2 "
        "UNION ALL SELECT sample, concat(concat('k__',p_type,'|g__',replace(p_brand,'#','_'),'|s__',replace(p_name,' ','_')),'|t__SGB',cast(p_size as string)), "
        "sum(l_quantity)/1000 FROM {fx_base} GROUP BY 1,2 "
        "UNION ALL SELECT sample, concat('k__',p_type,'|g__',replace(p_brand,'#','_')), sum(l_quantity)/1000 FROM {fx_base} GROUP BY 1,2 "
        "UNION ALL SELECT sample, 'UNCLASSIFIED', sum(CASE WHEN l_returnflag='R' AND sample<>'S05' THEN l_quantity ELSE 0 END)/1000 FROM {fx_base} GROUP BY 1"
    ),
    "fx_profile_motus": (
        "SELECT sample, CASE WHEN p_size=1 THEN 'Unassigned' ELSE concat('mOTU_',cast(p_partkey%400 as string)) END AS motu, "
        "CASE WHEN p_size=1 THEN NULL ELSE concat('d__',p_type,';g__',replace(p_brand,'#','_'),"
        "CASE WHEN p_size%10=0 THEN concat(';s__Unknown ',p_name) ELSE concat(';s__',p_name) END) END AS taxonomy, "
        "sum(l_quantity) AS value FROM {fx_base} GROUP BY 1,2,3"
    ),
    "fx_profile_bracken": (
        "SELECT sample, p_name AS name, CASE WHEN p_size%5=0 THEN 'G' ELSE 'S' END AS taxonomy_lvl, sum(l_quantity) AS new_est_reads, "
        "0.98*sum(l_quantity)/sum(sum(l_quantity)) OVER (PARTITION BY sample) AS fraction_total_reads FROM {fx_base} GROUP BY 1,2,3"
    ),
    # species rows with the ids of fx_taxonomy; some ids are unknown to it
    "fx_profile_bracken_taxid": (
        "SELECT sample, concat('Species ',cast(p_partkey as string)) AS name, CASE WHEN p_partkey%37=0 THEN 9000000 ELSE 0 END + p_partkey+1000 AS taxonomy_id, "
        "CASE WHEN p_size%5=0 THEN 'G' ELSE 'S' END AS taxonomy_lvl, "
        "0.98*sum(l_quantity)/sum(sum(l_quantity)) OVER (PARTITION BY sample) AS fraction_total_reads FROM {fx_base} GROUP BY 1,2,3,4"
    ),
    "fx_mock_abundance": (
        "SELECT concat('ASV',cast(p_partkey as string)) AS asv, cast(p_size as double) AS mock_reference FROM {part}"
    ),
    "fx_mock_taxa": (
        "SELECT concat('ASV',cast(p_partkey as string)) AS asv, p_type AS domain, CASE WHEN p_partkey%13=0 THEN NULL "
        "WHEN p_partkey%11=0 THEN 'OnlyInReference' ELSE replace(p_brand,'#','_') END AS genus FROM {part} "
        "WHERE p_partkey%17<>0"
    ),
    "fx_synonyms": (
        "SELECT * FROM (VALUES ('Brand_2','Brand_Two'),('Brand_3','Brand_Two'),('Brand_17','Brand_Seventeen')) AS t(name,canonical_name)"
    ),
    "fx_marker": (
        "SELECT p_partkey AS marker_id, replace(p_brand,'#','_') AS clade, concat('k__',p_type,';g__',replace(p_brand,'#','_')) AS lineage, "
        "100+p_size*10 AS len FROM {part}"
    ),
    "fx_alignment": (
        "SELECT concat('S',lpad(cast(l_suppkey%12 as string),2,'0')) AS sample, concat(cast(l_orderkey as string),':',cast(l_linenumber as string)) AS read_id, "
        "l_partkey AS marker_id, cast(round(l_discount*100) as int) AS mapq, 50+cast(l_quantity as int)*2 AS read_len, "
        "50+cast(l_quantity as int)*2-l_linenumber AS aln_len, l_orderkey%50 AS pos, "
        "concat(substr(seq,cast(l_orderkey%50+1 as int),19),CASE WHEN l_suppkey%7=0 THEN 'A' ELSE substr(seq,cast(l_orderkey%50+20 as int),1) END) AS bases, "
        "l_linenumber%2=0 AS proper_pair FROM {lineitem} JOIN {fx_genome} ON genome_id=l_partkey"
    ),
    # canonical k-mers (k=31) of every genome window; both engines spell the window list differently
    "fx_kmer_windows": {
        "spark": (
            "WITH k AS (SELECT species, genus, domain, explode(transform(sequence(1,226), i -> substr(seq,i,31))) AS km FROM {fx_genome}) "
            "SELECT least(km, reverse(translate(km,'ACGT','TGCA'))) AS kmer, species, genus, domain FROM k"
        ),
        "duckdb": (
            "WITH k AS (SELECT species, genus, domain, unnest(list_transform(range(1,227), lambda i: substr(seq,i,31))) AS km FROM {fx_genome}) "
            "SELECT least(km, reverse(translate(km,'ACGT','TGCA'))) AS kmer, species, genus, domain FROM k"
        ),
    },
    # "one distinct value" written as min = max (same meaning for non-null keys, no Expand on Spark)
    "fx_kmer": (
        "SELECT kmer, CASE WHEN min(species)=max(species) THEN min(species) WHEN min(genus)=max(genus) THEN min(genus) "
        "WHEN min(domain)=max(domain) THEN min(domain) ELSE 1 END AS taxid FROM {fx_kmer_windows} GROUP BY 1"
    ),
    "fx_kmer_distrib": (
        "SELECT m.taxid AS node, c.species, count(*)/cast(226 AS double) AS p FROM {fx_kmer_windows} c JOIN {fx_kmer} m ON m.kmer=c.kmer GROUP BY 1,2"
    ),
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def _text(name: str, engine: str) -> str:
    t = FIXTURE_SQL[name]
    return t[engine] if isinstance(t, dict) else t


def _deps(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(_text(name, "spark"))))


def closure(names) -> list[str]:
    """Fixtures needed by ``names`` in dependency order."""
    order: list[str] = []

    def visit(n):
        if n in BASE_TABLES or n in order:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def duckdb_with(sql: str) -> str:
    """Prefix a DuckDB query with the fixture CTEs it mentions."""
    used = [n for n in FIXTURE_SQL if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    ctes = ", ".join(
        f"{n} AS ({_PLACEHOLDER.sub(lambda m: m.group(1), _text(n, 'duckdb'))})" for n in closure(used)
    )
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        rest = body[5:].lstrip()
        if rest[:10].upper() == "RECURSIVE ":
            return f"WITH RECURSIVE {ctes}, {rest[10:]}"
        return f"WITH {ctes}, {rest}"
    return f"WITH {ctes} {body}"


def _spark_kmer_windows(fx: "Fixtures") -> DataFrame:
    """fx_kmer_windows on Spark: the same canonical k-mers, packed 2-bit (BIGINT) by the
    vectorised kernel instead of 226 substr/translate string ops per genome. Packed
    order equals text order, so ``least`` of the texts is ``min`` of the codes."""
    from pyspark.sql import functions as F

    from taxaframe.functions.kernels import canonical_kmers

    # a genome makes many windows, but its file is small: read as it is, one or two tasks would make them all
    g = fx.table("fx_genome").repartition(fx.spark.sparkContext.defaultParallelism)
    return g.select("species", "genus", "domain", F.explode(canonical_kmers(31)(F.col("seq"))).alias("kmer")).select(
        "kmer", "species", "genus", "domain"
    )


def _spark_kmer_distrib(fx: "Fixtures") -> DataFrame:
    """fx_kmer_distrib on Spark: the same text. The windows are estimated by the size of the genomes' files, which are small
    enough to broadcast long before the windows are, so the join is told to shuffle both sides."""
    params = {d: fx.table(d).hint("merge") for d in _deps("fx_kmer_distrib")}
    return fx.spark.sql(_text("fx_kmer_distrib", "spark"), **params)


_READS_SPARK = (
    "WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey,l_linenumber,l_partkey ORDER BY l_suppkey,l_quantity,l_extendedprice,"
    "l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate) AS copy FROM (SELECT * FROM {lineitem} WHERE l_partkey IS NOT NULL DISTRIBUTE BY l_partkey)), "
    "b AS (SELECT l_orderkey, l_linenumber, copy, l_suppkey%12 AS sn, l_partkey AS pk, cast(l_quantity as int) AS q, (l_orderkey*31+l_linenumber*17)%96 AS off FROM n), "
    "c AS (SELECT /*+ SHUFFLE_HASH(g) */ b.*, concat(cast(l_orderkey as string),':',cast(l_linenumber as string),':',cast(pk as string),"
    "CASE WHEN copy=1 THEN '' ELSE concat(':',cast(copy as string)) END) AS read_id, "
    "g.seq, cast(CASE WHEN q%10=7 THEN 1 ELSE 1+off END as int) AS st FROM b JOIN {fx_genome} g ON g.genome_id=b.pk), "
    "d AS (SELECT *, substr(seq,st,100) AS s1, "
    "substr(concat(md5(concat('q',read_id)),md5(concat('r',read_id)),md5(concat('s',read_id)),md5(concat('t',read_id))),1,100) AS h1, "
    "substr(concat(md5(concat('u',read_id)),md5(concat('v',read_id)),md5(concat('w',read_id)),md5(concat('x',read_id))),1,100) AS h2 FROM c) "
    "SELECT concat('S',lpad(cast(sn as string),2,'0')) AS sample, l_orderkey*8+l_linenumber AS ordinal, read_id, "
    "CASE q%10 WHEN 1 THEN concat(substr(s1,1,85),repeat('G',15)) WHEN 2 THEN concat(substr(s1,1,10),repeat('N',8),substr(s1,19)) "
    "WHEN 3 THEN concat(substr(s1,1,60),'AGATCGGAAGAGC',substr(s1,74)) "
    "WHEN 5 THEN substr(s1,1,12) WHEN 6 THEN repeat('A',100) ELSE s1 END AS seq1, "
    # '0' stands for '#' until the digits are mapped
    "CASE q%10 WHEN 4 THEN concat(substr(h1,1,50),repeat('0',50)) WHEN 5 THEN substr(h1,1,12) ELSE h1 END AS h1, "
    "substr(seq,st+60,100) AS s2, h2 FROM d"
)


def _spark_reads(fx: "Fixtures", where: Column | None = None) -> DataFrame:
    """fx_reads on Spark: the same rows. Read ids are made after the join with the genomes, so the shuffle carries
    numbers, and the mapping of characters is done by kernels. A condition on sample and read_id is applied before.

    Rows are dealt by part, which serves the numbering and the join with the genomes: one shuffle of the table.
    """
    from taxaframe.functions.kernels import map_ascii

    d = fx.spark.sql(_READS_SPARK, lineitem=fx.table("lineitem"), fx_genome=fx.table("fx_genome"))
    d = d if where is None else d.filter(where)
    phred = map_ascii("0123456789abcdef", "#+049<>?@ABCDEFI")
    same = map_ascii("", "")  # one evaluation of the bases, too
    return d.select("sample", "ordinal", "read_id", same("seq1").alias("seq1"), phred("h1").alias("qual1"), map_ascii("ACGT", "TGCA", backwards=True)("s2").alias("seq2"), phred("h2").alias("qual2"))


def _spark_tree_index(fx: "Fixtures") -> DataFrame:
    """The numbered taxonomy, which stands for a prepared database."""
    from taxaframe.operators.kmer import index_tree

    return index_tree(fx.table("fx_taxonomy"))


# Spark-side plans that replace a SQL text with an equivalent DataFrame program, or have none
SPARK_OVERRIDES = {"fx_reads": _spark_reads, "fx_kmer_windows": _spark_kmer_windows, "fx_kmer_distrib": _spark_kmer_distrib, "fx_tree_index": _spark_tree_index}

# Fixtures many times as large as the tables behind them: planned into every registered query that reads them, which
# derives the rows and columns that it needs as it goes, and never written
PLANNED = {"fx_reads", "fx_reads_pe", "fx_kmer_windows", "fx_alignment"}

# The other derived fixtures stand in for input tables, so each is written once per (session, folder) as Parquet
# in the shared folder of ``spark.checkpoint.dir``; queries scan it like any input, with
# pushed filters and pruned columns, and a lost executor costs a re-read.
_STORED: dict[tuple[str, str, str, bool], DataFrame] = {}


class Fixtures:
    """Lazily planned fixture DataFrames for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, planned: frozenset[str] | set[str] = frozenset()):
        self.spark = spark
        self.planned = planned  # not written, but a part of each plan
        self.sf_dir = sf_dir.rstrip("/")
        self._dfs: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._dfs:
            if name in BASE_TABLES:
                self._dfs[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
                return self._dfs[name]
            key = (self.spark.sparkContext.applicationId, self.sf_dir, name, name in self.planned)
            if key not in _STORED:
                if name in SPARK_OVERRIDES:
                    df = SPARK_OVERRIDES[name](self)
                else:
                    params = {d: self.table(d) for d in _deps(name)}
                    df = self.spark.sql(_text(name, "spark"), **params)
                _STORED[key] = df if name in self.planned else stored(df, name)
            self._dfs[name] = _STORED[key]
        return self._dfs[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        key = name if name in BASE_TABLES else f"fx_{name}"
        if key in FIXTURE_SQL or key in SPARK_OVERRIDES or key in BASE_TABLES:
            return self.table(key)
        raise AttributeError(name)

    def reads_where(self, named: Column) -> DataFrame:
        """The reads of a condition on their names (sample, read_id); of others, no bases are derived."""
        return _spark_reads(self, named) if "fx_reads" in self.planned else self.reads.filter(named)

    # typed views of the fixtures in the engine's canonical shapes -----------------
    @cached_property
    def profiles_long(self) -> DataFrame:
        """Marker-tool profile standardised to (sample, tax_id, abundance)."""
        from taxaframe.operators.profiles import standardize_marker

        return standardize_marker(self.profile_marker)
