"""File sources and sinks on small files written to a fresh temporary folder."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from taxaframe.operators import profiles as P
from taxaframe.sources import profiles as SP
from taxaframe.sources import reads as SR
from taxaframe.sources import sinks as SK


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="taxaframe-test-")


def _fastq(path, recs):
    with gzip.open(path, "wt") as fh:
        for rid, seq, qual in recs:
            fh.write(f"@{rid}\n{seq}\n+\n{qual}\n")


def test_fastq_pairs_source(spark, tmp):
    # a quality line starting with '@' must not confuse the parser
    _fastq(os.path.join(tmp, "a_R1.fq.gz"), [("r1/1", "ACGT", "@III"), ("r2/1", "GGGG", "IIII")])
    _fastq(os.path.join(tmp, "a_R2.fq.gz"), [("r1/2", "TTTT", "IIII"), ("r2/2", "CCCC", "@@II")])
    with open(os.path.join(tmp, "sheet.csv"), "w") as fh:
        fh.write("sample,read1,read2\na,a_R1.fq.gz,a_R2.fq.gz\n")
    df = SR.read_fastq_pairs(spark, os.path.join(tmp, "sheet.csv"))
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("a", 0, "r1", "ACGT", "@III", "TTTT", "IIII"), ("a", 1, "r2", "GGGG", "IIII", "CCCC", "@@II")]


def _bgzf(path, text, size):
    """Block gzip: members of at most ``size`` bytes of text, each with its length in the header, and an empty one."""
    import struct
    import zlib

    with open(path, "wb") as fh:
        for at in [*range(0, len(text), size), len(text)]:
            part = text[at : at + size]
            z = zlib.compressobj(6, zlib.DEFLATED, -15)
            body = z.compress(part) + z.flush()
            fh.write(b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part)))


@pytest.mark.parametrize("kinds", ["plain plain", "bgzf bgzf", "plain bgzf", "gzip plain", "gzip gzip", "crlf plain"])
@pytest.mark.parametrize("newline_at_end", [True, False])
def test_fastq_ranges_equal_the_serial_read(spark, tmp, kinds, newline_at_end):
    import random

    draw, sheet, want = random.Random(1), [("sample", "read1", "read2")], []
    for sample, n in (("a", 700), ("b", 1), ("c", 0), ("d", 37)):
        rows = []
        for i in range(n):
            seqs = ["".join(draw.choices("ACGTN", k=draw.randrange(1, 60))) for _ in "12"]
            quals = ["".join(draw.choices("@+I#", k=len(s))) for s in seqs]
            rows.append((f"r{i}:{draw.randrange(10**draw.randrange(1, 9))}", seqs, quals))
            want.append((sample, i, rows[-1][0], seqs[0], quals[0], seqs[1], quals[1]))
        names = []
        for m, kind in enumerate(kinds.split()):
            note = " 1:N:0" if draw.random() < 0.5 else ""
            text = "".join(f"@{rid}/{m + 1}{note}\n{s[m]}\n+\n{q[m]}\n" for rid, s, q in rows)
            text = (text if newline_at_end else text.removesuffix("\n")).replace("\n", "\r\n" if kind == "crlf" else "\n").encode()
            name = f"{sample}_{m}.fq" + (".gz" if kind in ("gzip", "bgzf") else "")
            path = os.path.join(tmp, name)
            if kind == "bgzf":
                _bgzf(path, text, 900)
            else:
                (gzip.open if kind == "gzip" else open)(path, "wb").write(text)
            names.append(name)
        sheet.append((sample, *names))
    with open(os.path.join(tmp, "sheet.csv"), "w") as fh:
        fh.writelines(",".join(r) + "\n" for r in sheet)
    for split in (997, 5000, 1 << 26):
        got = sorted(tuple(r) for r in SR.read_fastq_pairs(spark, os.path.join(tmp, "sheet.csv"), split).collect())
        assert got == sorted(want)
    if kinds == "plain plain":
        from taxaframe.sources.fastq import work_ranges

        full = SR.read_samplesheet(spark, os.path.join(tmp, "sheet.csv")).selectExpr("sample", *[f"concat('{tmp}/', read{m}) AS read{m}" for m in (1, 2)])
        assert work_ranges(full, os.path.getsize(os.path.join(tmp, "a_0.fq")) // 8 + 1).filter("sample = 'a'").count() == 8


def test_fastq_faults(spark, tmp):
    def read(first, second):
        open(os.path.join(tmp, "1.fq"), "w").write(first)
        open(os.path.join(tmp, "2.fq"), "w").write(second)
        open(os.path.join(tmp, "sheet.csv"), "w").write("sample,read1,read2\ns,1.fq,2.fq\n")
        return SR.read_fastq_pairs(spark, os.path.join(tmp, "sheet.csv"), 40).count

    record = "@r1\nACGT\n+\nIIII\n"
    assert read(record * 20, record * 20)() == 20
    for a, b, says in (
        (record * 20, record * 19, "different record counts"), (record * 19, record * 20, "different record counts"), (record * 9 + "@r1\nAC", record * 10, "truncated"),
        (record + "@r1\nACG\n+\nIIII\n", record * 2, "truncated"), (record + record[1:], record * 2, "malformed"), (record * 2, record + record.replace("r1", "r2"), "disagree"),
    ):
        with pytest.raises(Exception, match=says):
            read(a, b)()


def test_fastq_sink_pairs_files(spark, tmp):
    reads = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('s', id % 7)) AS sample", "id AS ordinal", "concat('r', id) AS read_id", "'ACGT' AS seq1", "'IIII' AS qual1", "'GGTT' AS seq2", "'IIII' AS qual2")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small rows would share one file
    SK.write_reads(reads, tmp + "/fq", "fastq")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    lines = spark.read.text(tmp + "/fq").selectExpr("mate", "sample", "value", "_metadata.file_name AS file", "monotonically_increasing_id() AS at").orderBy("at").collect()
    by = {}
    for r in lines:
        by.setdefault((r["sample"], r["file"]), {}).setdefault(r["mate"], []).append(r["value"])
    assert len({f for s, f in by if s == "hot"}) > 1  # a large sample lies in several part files
    last = {}
    for (sample, _), mates in sorted(by.items()):
        ids = [x.removesuffix("/1") for x in mates[1] if x.startswith("@")]
        assert ids == [x.removesuffix("/2") for x in mates[2] if x.startswith("@")]
        numbers = [int(x[2:]) for x in ids]
        assert numbers == sorted(numbers) and numbers[0] > last.get(sample, -1)
        last[sample] = numbers[-1]
    assert sum(len(m[1]) for m in by.values()) == 4 * 3000


def test_profiles_by_one_entry(spark, tmp):
    head = "name\ttaxonomy_id\ttaxonomy_lvl\tkraken_assigned_reads\tadded_reads\tnew_est_reads\tfraction_total_reads\n"
    good = [os.path.join(tmp, f"S{i}.bracken") for i in (1, 2)]
    for p in good:
        open(p, "w").write(head + "A b\t1\tS\t5\t1\t6\t0.75\n")
    tool, long = SP.read_profiles(spark, good)
    rows = sorted((r["sample"], r["tax_id"], r["abundance"]) for r in long.collect())
    assert tool == "bracken" and rows == [(s, t, a) for s in ("S1", "S2") for t, a in ((P.UNCLASSIFIED_LINEAGE, 0.25), ("s__A_b", 0.75))]
    target = SP.standardize_files(spark, good, tmp + "/out", "run7", ["S1", "S2"])
    assert target.endswith("bracken_run7_species.tsv") and SP.read_standard(spark, target).count() == 4
    mixed = os.path.join(tmp, "S3_motus.tsv")
    open(mixed, "w").write("mOTU\ttax\tS3\nm1\td__A;s__B\t2\n")
    for bad in ([*good, mixed], [os.path.join(tmp, "x.txt")], []):
        with pytest.raises(ValueError, match="exactly one known tool"):
            SP.read_profiles(spark, bad)
    assert SP.read_profiles(spark, [mixed])[1].count() == 1
    with pytest.raises(ValueError, match="species level"):
        SP.read_profiles(spark, [mixed], "genus")
    with pytest.raises(ValueError, match="not among the listed"):
        SP.standardize_files(spark, good, tmp + "/out", "run8", ["S1"])


def test_fastq_unequal_mates_fail(spark, tmp):
    _fastq(os.path.join(tmp, "b_R1.fq.gz"), [("r1", "ACGT", "IIII"), ("r2", "ACGT", "IIII")])
    _fastq(os.path.join(tmp, "b_R2.fq.gz"), [("r1", "ACGT", "IIII")])
    with open(os.path.join(tmp, "sheet.csv"), "w") as fh:
        fh.write("sample,read1,read2\nb,b_R1.fq.gz,b_R2.fq.gz\n")
    with pytest.raises(Exception, match="different record counts"):
        SR.read_fastq_pairs(spark, os.path.join(tmp, "sheet.csv")).collect()


def test_samplesheet_check(spark, tmp):
    p = os.path.join(tmp, "sheet.csv")
    with open(p, "w") as fh:
        fh.write("sample,read1,read2\na,a1,a2\na,x1,x2\nb,b1,b2\n")
    sheet = SR.read_samplesheet(spark, p)
    files = spark.createDataFrame([(f,) for f in ["a1", "a2", "x1", "x2", "b1"]], "path string")
    got = sorted(tuple(r) for r in SR.check_samplesheet(sheet, files).collect())
    assert got == [("a", "duplicate sample"), ("b", "missing read2")]


def test_marker_profile_reader_and_standardise(spark, tmp):
    p = os.path.join(tmp, "S1_metaphlan4_profile.txt")
    with open(p, "w") as fh:
        fh.write("#mpa_vJan21\n#clade_name\tNCBI_tax_id\trelative_abundance\tcoverage\test\n")
        fh.write("UNCLASSIFIED\t-1\t20.5\t\t\n")
        fh.write("k__A|g__B|s__C#1\t1|2|3\t50.0\t\t\n")  # '#' inside a name survives (K3)
        fh.write("k__A|g__B|s__D\t1|2|4\t29.5\t\t\n")
        fh.write("k__A|g__B|s__D|t__SGB1\t1|2|4|5\t29.5\t\t\n")
    raw = SP.read_metaphlan(spark, p)
    assert {r.sample for r in raw.collect()} == {"S1"}
    got = {r.tax_id: round(r.abundance, 6) for r in P.standardize_marker(raw).collect()}
    assert got == {"k__A;g__B;s__C#1": round(50 / 99.5, 6), "k__A;g__B;s__D": round(29.5 / 99.5, 6),
                   P.UNCLASSIFIED_LINEAGE: round(20 / 99.5, 6)}


def test_bracken_reader_requires_columns(spark, tmp):
    p = os.path.join(tmp, "S2.bracken")
    with open(p, "w") as fh:
        fh.write("name\ttaxonomy_id\tnew_est_reads\nFoo\t1\t3\n")
    with pytest.raises(ValueError, match="missing required"):
        SP.read_bracken(spark, p)


def test_motus_reader_by_position(spark, tmp):
    p = os.path.join(tmp, "S3_motus.tsv")
    with open(p, "w") as fh:
        fh.write("# motus\nmOTU\tconsensus_taxonomy\tS3\nm1\td__A;s__B\t2\nunassigned\tNA\t2\n")
    raw = SP.read_motus(spark, p)
    got = {r.tax_id: r.abundance for r in P.standardize_motus(raw).collect()}
    assert got == {"k__A;s__B": 0.5, P.UNCLASSIFIED_LINEAGE: 0.5}


def test_standard_sink_round_trip(spark, tmp):
    long = spark.createDataFrame([("s1", "t1", 0.25), ("s1", "t2", 0.75), ("s2", "t2", 1.0)], "sample string, tax_id string, abundance double")
    target = SK.write_standard(long, tmp, "metaphlan4", "run01", "species", ["s1", "s2"])
    back = SP.read_standard(spark, target)
    got = sorted((r.tax_id, r.sample, r.abundance) for r in back.collect())
    assert got == [("t1", "s1", 0.25), ("t1", "s2", 0.0), ("t2", "s1", 0.75), ("t2", "s2", 1.0)]


def test_detect_tool_priority(spark):
    paths = spark.createDataFrame([("x/a.bracken",), ("x/b_MetaPhlAn4.txt",)], "path string")
    assert SP.detect_tool(paths).first().tool == "metaphlan4"
    assert SP.detect_tool(spark.createDataFrame([("x/z.txt",)], "path string")).first().tool == "unknown"


def test_require_tool_raises_on_mixed_or_unknown(spark):
    frame = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    assert SP.require_tool(frame("x/a.bracken", "y/b.bracken")) == "bracken"
    for bad in (frame("x/a.bracken", "x/b_motus.tsv"), frame("x/z.txt"), frame("x/z.txt", "x/a.bracken"), frame()):
        with pytest.raises(ValueError):
            SP.require_tool(bad)


def test_bracken_header_checked_per_file(spark, tmp):
    head = "name\ttaxonomy_id\ttaxonomy_lvl\tkraken_assigned_reads\tadded_reads\tnew_est_reads\tfraction_total_reads\n"
    first, second = os.path.join(tmp, "a.bracken"), os.path.join(tmp, "b.bracken")
    open(first, "w").write(head + "A\t1\tS\t5\t1\t6\t1.0\n")
    open(second, "w").write(head + "B\t2\tS\t5\t1\t6\t1.0\n")
    assert SP.read_bracken(spark, [first, second]).count() == 2
    open(second, "w").write(head.replace("name\ttaxonomy_id", "taxonomy_id\tname") + "2\tB\tS\t5\t1\t6\t1.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        SP.read_bracken(spark, [first, second]).collect()


def test_mock_and_synonym_sources(spark, tmp):
    a, t, s = (os.path.join(tmp, n) for n in ("ab.csv", "tx.csv", "syn.csv"))
    open(a, "w").write("ASV,Mock Reference\nA1,0.5\nA2,0.5\n")
    open(t, "w").write("ASV,Domain,Genus,Species\nA1,Bac,G1,S1\nA2,Bac,G2,S2\n")
    open(s, "w").write("name,canonical_name\n G1 ,Old\nG1,New\n")
    ab, tx = SR.read_mock(spark, a, t)
    assert ab.columns == ["asv", "mock_reference"] and "genus" in tx.columns
    syn = SR.read_synonyms(spark, s).collect()
    assert [(r.name, r.canonical_name) for r in syn] == [("G1", "New")]  # trimmed, last wins
    with pytest.warns(UserWarning):
        assert SR.read_synonyms(spark, os.path.join(tmp, "missing.csv")).count() == 0


def test_mock_eval_sink(spark, tmp):
    m = spark.createDataFrame([("Mock1", 0.1, 0.9, 0.01, 0.02)], "sample string, bray_curtis double, pearson_r double, pearson_p double, rmse double")
    c = spark.createDataFrame([("G1", 0.5, 0.4)], "genus string, Mock1 double, Reference double")
    mp, cp = SK.write_mock_eval(m, c, os.path.join(tmp, "run"))
    header = spark.read.text(cp).first()[0]
    assert header.startswith("\t") or header.startswith('""\t')
    assert spark.read.option("sep", "\t").option("header", True).csv(mp).count() == 1
    assert F is not None
