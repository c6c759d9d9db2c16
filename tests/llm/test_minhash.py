import random
import re
import subprocess
import sys
from pathlib import Path

from taxaframe.llm import minhash
from tests.llm.helpers import docs, odd_texts, words


def plain(texts, ids, percent):
    sets = []
    for t in texts:
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set())
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                label[find(i)] = find(j)
    out = []
    for i, a in enumerate(sets):
        out.append((ids[i], len(a), min(ids[j] for j in range(len(texts)) if find(j) == find(i))))
    return sorted(out)


def near(draw):
    texts = []
    for _ in range(12):
        base = words(draw, draw.randrange(3, 200)).split()
        for _ in range(draw.randrange(1, 14)):
            ws = list(base)
            for _ in range(draw.randrange(0, 1 + len(ws) // 25)):
                ws[draw.randrange(len(ws))] = f"x{draw.randrange(50)}"
            texts.append(" ".join(ws).title() if draw.random() < 0.3 else "\n".join(ws))
    return texts


def check(spark, texts, ids, percent, **options):
    rows = minhash.near_duplicates(docs(spark, texts, ids), percent=percent, **options).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == plain(texts, ids, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_components_against_all_pairs(spark):
    draw = random.Random(11)
    texts = odd_texts() + near(draw)
    ids = draw.sample(range(-50, 5000), len(texts))
    check(spark, texts, ids, 85)
    # small leaves: branching and blocks do the work
    check(spark, texts, ids, 80, leaf=4, depth=2)


def test_a_text_without_id_links_others(spark):
    ws = [f"w{i}" for i in range(300)]
    middle, right = [*ws[:-15], *[f"y{i}" for i in range(15)]], [*ws[:-30], *[f"y{i}" for i in range(30)]]
    left = [f"z{i}" if i < 25 else w for i, w in enumerate(middle)]
    assert plain([" ".join(left), " ".join(right)], [1, 2], 80) == [(1, 296, 1), (2, 296, 2)]
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs(spark, [" ".join(x) for x in (left, middle, right)], [1, None, 2])).collect()}
    assert got[1]["component_id"] == got[2]["component_id"] == 1 and got[None]["component_id"] is None and got[None]["kept"]


def test_keep_first(spark):
    texts = ["a b c d e f g", "a b c d e f g", "a b c d e f g h i j k", None, "", "z y x w v u", "z y x w v u"]
    frame = docs(spark, texts, [5, 2, 3, 4, None, 9, 9])
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in minhash.keep_first(frame).select("doc_id", "text").collect())
    assert got == sorted([(2, texts[1]), (3, texts[2]), (4, None), (-1, ""), (9, texts[5])], key=lambda x: (x[0], x[1] or ""))
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_tiles_of_shingles_give_the_same_components(spark):
    draw = random.Random(13)
    texts = odd_texts() + near(draw)
    ids = [None if i in (9, 12) else x for i, x in enumerate(draw.sample(range(-50, 5000), len(texts)))]
    want = plain([t for t, i in zip(texts, ids) if i is not None], [i for i in ids if i is not None], 80)
    for tile_bytes in (64, 2000, 1 << 20):
        rows = minhash.near_duplicates(docs(spark, texts, ids), percent=80, tile_bytes=tile_bytes).collect()
        got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None)
        # a text without id may only join what is apart in the rest
        assert [x[:2] for x in got] == [x[:2] for x in want] and all(a[2] <= b[2] for a, b in zip(got, want))
    ids = [i if i is not None else 9000 + n for n, i in enumerate(ids)]
    check(spark, texts, ids, 80, tile_bytes=64)
    check(spark, texts, [*ids[:-3], 77, 77, 77], 80, tile_bytes=300)


def test_many_near_copies_of_a_long_text_in_bounded_memory():
    # the kernel alone: 1,500 sets of 20,000 shingles (240 MB) in tiles, as a task reads them
    code = """
import numpy as np, pyarrow as pa, resource
from taxaframe.llm.minhash import _confirm
draw = np.random.default_rng(1)
base = np.unique(draw.integers(0, 1 << 63, 20_000, dtype=np.uint64) << np.uint64(1))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
def batches():
    for tile in range(32):
        lo, hi = tile << 59, (tile + 1) << 59
        rows = []
        for k in range(1500):
            other = np.random.default_rng(k).integers(0, 1 << 63, 1000, dtype=np.uint64) << np.uint64(1)
            own = np.unique(np.concatenate([base[1000:], other]))
            rows.append(own[(own >= np.uint64(lo)) & (own <= np.uint64(hi - 1))].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(np.full(1500, 7)), pa.array(np.full(1500, tile)), pa.array(np.arange(1500)), pa.array(rows, pa.binary())], names=["cluster", "tile", "k", "set"])
out = pa.Table.from_batches(_confirm(80)(batches()))
assert out.num_rows == 1499 and set(out.column("a").to_pylist()) == {0}
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024, before // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parents[2])
    assert done.returncode == 0, done.stderr
    more, before = map(int, done.stdout.split())
    assert more + before < 500, done.stdout
