import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from taxaframe.llm import filter_audit as fa

from tests.llm.helpers import docs, odd_texts, words

LABELS = "doc_id long, quality int, toxic int, part string"


def brute(rows, labels):
    """rows: (id, text, part)."""
    first, good, toxic = {}, {}, {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, q, x, _ in labels:
        good[i], toxic[i] = good.get(i, False) or q == 1, toxic.get(i, False) or x == 1
    judged = []
    for i, t, part in rows:
        t = t or ""
        w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if x]
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t]}
        judged.append((part or "", {c for c in fails if fails[c]}, i is not None and good.get(i, False), i is not None and toxic.get(i, False)))
    out = {}
    for part in {j[0] for j in judged}:
        own, total = [j for j in judged if j[0] == part], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for s, c in enumerate(order):
                gone = [j for j in own if c in j[1] and not j[1] & set(order[:s])]
                total[c] += len(gone)
                out[part, order, s + 1] = [
                    sum(not j[1] & set(order[: s + 1]) for j in own), len(gone), sum(c in j[1] for j in own) - len(gone), sum(j[1] == {c} for j in own), sum(j[2] for j in gone), sum(j[3] for j in gone),
                ]
        for (p, order, s), v in out.items():
            if p == part:
                v.append(total[order[s - 1]])
    return out


def check(spark, rows, labels, **more):
    table = spark.createDataFrame([(i, t, p, "x", 0) for i, t, p in rows], "doc_id long, text string, lang string, part string, mask int")
    got = fa.audit_filters(table, spark.createDataFrame(labels, LABELS), **more).collect()
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == brute(rows, labels)


@pytest.mark.parametrize("slice_texts", [1 << 25, 100])
def test_against_brute_force(spark, slice_texts):
    draw = random.Random(3)
    pool = [words(draw, n, 3000) for n in (3, 99, 100, 130, 400)] + [words(draw, 150, 60), "A" * 30 + words(draw, 120, 3000), "x # " + words(draw, 110, 3000)]
    texts = odd_texts() + [draw.choice(pool) for _ in range(150)] + [words(draw, draw.randrange(90, 120), 5000) + draw.choice(["", "$", " ABC" * 20]) for _ in range(150)]
    ids = list(range(1, len(texts) + 1))
    draw.shuffle(ids)
    rows = [(i, t, draw.choice(["en", "de", None, ""])) for i, t in zip(ids, texts)]
    rows += rows[40:50] + [(None, pool[3], "en"), (None, None, None), (None, pool[3], "de"), (-5, pool[3], "fr"), (ids[30], "another text of the same id", "fr")]
    labels = [(i, draw.randrange(2), draw.randrange(2), "x") for i in ids[::2]] + [(ids[0], 1, 0, "x"), (None, 1, 1, "x"), (ids[1], None, 1, "x")]
    check(spark, rows, labels, slice_texts=slice_texts)


def test_hot_copies_and_empty(spark):
    check(spark, [(i, "the same" if i % 3 else f"own {i}", "en") for i in range(900)], [(4, 1, 1, "x")])
    check(spark, [], [])


def test_sketch_clears_only_unique_texts(spark):
    table = docs(spark, [f"text {i if i % 10 else 0}" for i in range(20_000)]).repartition(7)
    h = table.select(F.xxhash64("text").alias("h"), "text")
    blocks = 2
    bits = np.zeros(blocks * fa._BLOCK // 8, np.uint8)
    for r in fa.merged_sketch(h.select("h"), blocks).collect():
        bits[r.block * fa._BLOCK // 8 : (r.block + 1) * fa._BLOCK // 8] = np.frombuffer(r.bits, np.uint8)
    rows = h.collect()
    found = fa.possible_repeats(np.array([r.h for r in rows], np.int64).view(np.uint64), bits, blocks)
    repeated = np.array([r.text == "text 0" for r in rows])
    assert found[repeated].all() and found[~repeated].mean() < 0.01
