"""Sums over pairs of samples against plain loops, with tiles smaller than the number of samples."""

import math
import random

from taxaframe.operators import rank, strain


def test_distance_over_tiles(spark):
    draw = random.Random(2)
    cells = {(f"t{t}", f"S{s:02d}"): draw.uniform(0, 1e4) for t in range(40) for s in range(11) if draw.random() < 0.3}
    cells |= {(t, "S12"): v + 1e-4 for (t, s), v in cells.items() if s == "S03"}  # nearly equal
    cells |= {(t, "S13"): v for (t, s), v in cells.items() if s == "S03"}  # equal
    frame = spark.createDataFrame([(*k, v) for k, v in cells.items()], "tax_id string, sample string, abundance double")
    names = sorted({s for _, s in cells})
    got = {(r["sample_a"], r["sample_b"]): r["distance"] for r in rank.sample_distance(frame, tile=3).collect()}
    assert set(got) == {(a, b) for a in names for b in names if a < b}
    for (a, b), d in got.items():
        want = math.sqrt(sum((cells.get((f"t{t}", a), 0) - cells.get((f"t{t}", b), 0)) ** 2 for t in range(40)))
        assert math.isclose(d, want, rel_tol=1e-9, abs_tol=1e-12)
    assert got["S03", "S13"] == 0 and rank.sample_distance(frame.limit(0)).count() == 0


def test_rates_over_tiles(spark):
    draw = random.Random(4)
    base = {(m, p, f"S{s:02d}"): draw.choice("ACGTN") for m in range(6) for p in range(15) for s in range(8) if draw.random() < 0.5}
    cons = spark.createDataFrame([(s, m, p, b) for (m, p, s), b in base.items()], "sample string, marker_id int, position int, base string")
    markers = spark.createDataFrame([(m, "ab"[m % 2]) for m in range(6)], "marker_id int, clade string")
    got = {(r["clade"], r["sample_a"], r["sample_b"]): (r["common"], r["differing"]) for r in strain.mutation_rates(cons, markers, tile=3).collect()}
    want = {}
    for (m, p, s), x in base.items():
        for (n, q, t), y in base.items():
            if (m, p) == (n, q) and s < t:
                c, d = want.get(("ab"[m % 2], s, t), (0, 0))
                want["ab"[m % 2], s, t] = (c + 1, d + (x != y))
    assert got == want
    keep = spark.createDataFrame([("a", "S01"), ("a", "S05"), ("b", "S01")], "clade string, sample string")
    assert {(r["clade"], r["sample_a"], r["sample_b"]) for r in strain.mutation_rates(cons, markers, keep=keep).collect()} == {("a", "S01", "S05")}
