import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from taxaframe.llm import ann, lm, toxicity
from taxaframe.llm.common import id_crc32
from tests.llm.helpers import docs, odd_texts, words


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def test_language_model_against_plain_counts(spark):
    draw = random.Random(3)
    texts = odd_texts() + [words(draw, draw.randrange(0, 60), 40) for _ in range(150)]
    ids = [*range(len(texts) - 1), None]
    got = lm.interpolated_scores(docs(spark, texts, ids), train=id_crc32("doc_id") % 7 != 2).collect()
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i in ids]
    uni = Counter(t for x, h in zip(texts, held) if not h for t in tokens(x))
    n, v = sum(uni.values()), len(uni)
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(texts)
    for i, text, h in zip(ids, texts, held):
        r, own = by[i], tokens(text)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, len(own), sum(uni[t] > 0 for t in own), n)
        assert math.isclose(r["base_score"], sum(math.log10((uni[t] + 1) / (n + v + 1)) for t in own), rel_tol=1e-9)
        assert r["score"] < 0
    # the mixture predicts held-out texts better than the base
    assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])
    assert lm.interpolated_scores(docs(spark, []), train=F.lit(True)).count() == 0


def test_interpolated_score_against_a_plain_mixture(spark, monkeypatch):
    draw = random.Random(4)
    texts = odd_texts() + [words(draw, draw.randrange(0, 60), 30) for _ in range(120)]
    weight = np.random.default_rng(4).dirichlet([1, 1, 1], lm.BUCKETS)
    weight[0] = [0, 0.3, 0.7]
    monkeypatch.setattr(lm, "learn_weights", lambda *_: weight)
    got = {r["doc_id"]: r["score"] for r in lm.interpolated_scores(docs(spark, texts), train=id_crc32("doc_id") % 7 != 2).collect()}
    own = [tokens(t) for t in texts]
    train = [x for i, x in enumerate(own) if zlib.crc32(str(i).encode()) % 7 != 2]
    uni, bi = Counter(w for x in train for w in x), Counter(p for x in train for p in zip(["<start>", *x], x))
    total = sum(uni.values())
    assert len(got) == len(texts) and 0 < len(train) < len(own)
    for i, x in enumerate(own):
        want = 0.0
        for before, w in zip(["<start>", *x], x):
            context = len(train) if before == "<start>" else uni[before]
            a, u, z = weight[min(int(math.log2(context)) + 1, lm.BUCKETS - 1) if context else 0]
            want += math.log10(a * bi[before, w] / max(context, 1) + u * uni[w] / total + z / (len(uni) + 1))
        assert math.isclose(got[i], want, rel_tol=1e-9), i


def test_weights_are_a_distribution_and_raise_likelihood():
    draw = np.random.default_rng(1)
    code = (draw.integers(0, 90, 500) << 40) | (draw.integers(0, 40, 500) << 20) | draw.integers(1, 90, 500)
    code = np.unique(code)
    weight = lm.learn_weights(code, np.ones(len(code)), 10_000, 500)
    assert np.allclose(weight.sum(1), 1) and (weight >= 0).all() and weight[0, 0] == 0


def test_planes_round_trip():
    for x in ([0], [255, 256], [1 << 55, 3, 0], list(range(1000))):
        x = np.array(x, np.uint64)
        assert (lm._unplanes(lm._planes(x)) == x).all()
        assert (lm._unpack_keys(lm._pack_keys(np.sort(x))) == np.sort(x)).all()


def test_toxicity_learns_from_document_labels(spark):
    draw = random.Random(6)
    texts, labels = [], []
    for i in range(600):
        sents = [words(draw, draw.randrange(3, 12)) for _ in range(draw.randrange(1, 8))]
        if i % 4 == 0:
            at = draw.randrange(len(sents))
            sents[at] += f" {draw.choice(['idiot', 'scum', 'moron'])} here"
        texts.append(". ".join(sents) + ".")
        labels.append(int(i % 4 == 0))
    frame = docs(spark, texts + odd_texts())
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(frame, marks, train=F.col("id") % 3 != 0)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(frame, model).collect()}
    assert len(got) == len(texts) + 10 and got[600]["score"] == got[601]["score"] == 0
    # an id that repeats does not add to the sample
    again = frame.unionAll(frame.filter("doc_id = 4")).unionAll(frame.filter("doc_id = 4"))
    same = toxicity.fit_toxicity(again, marks, train=F.col("id") % 3 != 0)
    assert np.count_nonzero(same[0]) == np.count_nonzero(model[0])
    held = [i for i in range(600) if i % 3 == 0]
    assert sum((got[i]["score"] >= 0.3) == bool(labels[i]) for i in held) >= 0.95 * len(held)
    for i in held:
        for s in got[i]["offences"]:
            if labels[i]:
                assert re.search("idiot|scum|moron", texts[i][s["start"] : s["end"]])
    kept = {r["doc_id"] for r in toxicity.filter_toxic(frame, model).collect()}
    assert kept == {i for i, r in got.items() if r["score"] < 0.3}
    assert toxicity.score_toxicity(docs(spark, []), toxicity.fit_toxicity(docs(spark, []), marks.limit(0))).count() == 0


def test_neighbours_against_brute_force(spark):
    draw = np.random.default_rng(5)
    x = draw.standard_normal((700, 16)).astype(float)
    x[300:420] = x[7]  # one very common vector
    x[500] = 2 * x[11]
    rows = [(int(i), v.tolist(), "z", 1) for i, v in enumerate(x)]
    rows += [(900, None, "z", 1), (950, [0.0] * 16, "z", 1), (1000, [1.0, None] + [0.0] * 14, "z", 1), (1050, [float("nan")] * 16, "z", 1), (None, x[0].tolist(), "z", 1), (1100, [float("inf")] + [1.0] * 15, "z", 1), (3, x[3].tolist(), "z", 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string, cell int")
    got = ann.nearest_neighbours(frame, F.col("vec_id") % 50 == 0, block=64).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 700, 50):
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        score = unit @ unit[q]
        for r in own:
            assert r["vec_id"] != q and math.isclose(r["score"], score[r["vec_id"]], abs_tol=1e-12)
        best = [i for i in np.lexsort((np.arange(700), -np.round(score, 12))) if i != q][:5]
        hits += len({r["vec_id"] for r in own} & set(map(int, best)))
    assert hits >= 0.9 * 14 * 5 and {r["query_id"] for r in got} == set(range(0, 700, 50))
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 300), key=lambda r: r["rank"])] == [7, 301, 302, 303, 304]
    assert ann.nearest_neighbours(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_every_query_gets_its_k_nearest_or_all(spark):
    draw = np.random.default_rng(5)
    centre = draw.normal(size=16)
    rows = [(i, (centre + 0.02 * draw.normal(size=16)).tolist()) for i in range(150)] + [(500, (-centre).tolist())]  # an outlier opposite to the cluster
    rows += [(600 + i, draw.normal(size=24).tolist()) for i in range(4)]  # a length of four vectors, and one of a single one
    rows += [(700, [1.0, 2.0]), (800, draw.normal(size=9).tolist()), (801, draw.normal(size=9).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest_neighbours(frame, F.col("vec_id") >= 500, k=5, block=32).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    for q, vec in rows[150:]:
        x = np.array(vec)
        near = sorted((-round(float(x @ np.array(y) / np.linalg.norm(x) / np.linalg.norm(y)), 9), i) for i, y in rows if i != q and len(y) == len(vec))[:5]
        assert got.get(q, []) == [(n + 1, i, -s) for n, (s, i) in enumerate(near)]
    assert [len(got.get(q, [])) for q in (500, 600, 700, 800)] == [5, 3, 0, 1]


def test_language_model_blocks_hold_texts_once(spark):
    import tracemalloc
    from unittest import mock

    import pyarrow as pa

    text = "wörd " * 1_000  # 6 bytes, 5 characters a word
    batch = pa.RecordBatch.from_arrays([pa.array(range(1300)), pa.array([True] * 1300), pa.array([text] * 1299 + [""])], names=["id", "train", "t"])
    with mock.patch.object(lm, "TaskContext", **{"get.return_value.partitionId.return_value": 3}):
        tracemalloc.start()
        blocks = list(lm._to_blocks(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert [b.column("block")[0].as_py() for b in blocks] == [3 << 32, (3 << 32) + 1]
    sizes = [s for b in blocks for s in b.column("sizes")[0].as_py()]
    assert sizes == [6_000] * 1299 + [0] and [i for b in blocks for i in b.column("ids")[0].as_py()] == list(range(1300))
    assert lm._texts(blocks[1].column("sizes")[0].as_py(), blocks[1].column("data")[0].as_py())[0] == text
    assert peak < 18_000_000  # 7.2 MB of bytes and their growth, not three copies
