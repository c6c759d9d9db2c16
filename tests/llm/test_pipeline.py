import corpus_pipeline
from pyspark.sql import functions as F
from taxaframe.llm import decontam, minhash, toxicity
from taxaframe.llm.common import id_crc32, stored


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, sf)
    assert kept.columns == docs.columns
    want = minhash.near_duplicates(docs, percent=80).filter("kept").count()
    assert kept.count() == want
    clean = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, sf)
    hit = decontam.match_benchmark(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).select("doc_id").distinct()
    assert clean.columns == docs.columns and clean.count() == docs.count() - hit.count()
    red = dict(corpus_pipeline.STAGES)["secrets"](spark, docs, sf)
    assert red.columns == docs.columns and red.count() == docs.count() and red.filter(F.length("text") != F.col("n_chars")).count() == docs.filter(F.length("text") != F.col("n_chars")).count()


def test_toxicity_stage_and_whole_run(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    stages = dict(corpus_pipeline.STAGES)
    model = toxicity.fit_toxicity(docs, labels, train=id_crc32("id") % 4 != 2)
    want = {r["doc_id"] for r in toxicity.score_toxicity(docs, model).filter("score < 0.3").collect()}
    calm = stages["toxicity"](spark, docs, sf)
    assert calm.columns == docs.columns and {r["doc_id"] for r in calm.collect()} == want
    kept = calm
    for name in ("near_duplicates", "decontamination", "secrets"):
        kept = stored(stages[name](spark, kept, sf), name)
    rows = corpus_pipeline.run(spark, sf).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == {r["doc_id"] for r in kept.select("doc_id").collect()}
    for own in pieces.values():  # each id lies in exactly one piece
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0
            at += r["length"]
        assert at == own[0]["doc_tokens"]
    full = {}
    for r in rows:
        full.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in full.values():  # gapless from 0, at most 2048
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
