import random
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from taxaframe.llm import packing, tokenbin
from taxaframe.llm.common import CachedEncoder
from tests.llm.helpers import docs, odd_texts, words

P = pytest.importorskip("public_tokenizers")


@lru_cache
def library(name):
    t = Tokenizer.from_file(str(P.path(name)))
    t.encode_special_tokens = True
    return t


def plain(name, text):
    return library(name).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_ids_are_the_librarys(name):
    enc, draw = CachedEncoder(str(P.path(name))), random.Random(4)
    pool = ["the", "The.", "don't", "l'été", "3.14", " ", "  ", "\n", "\n\n", "\t", " \n", "x\ny", "é", "́a", "漢字", "🙂", " ", "…", "a,b;c", "'s", "ÀÉÎ", "ſ", "K", "İ", "Σας", "\r\n", "a\x1cb", "<|endoftext|>", "#%$", "12 345"]
    texts = odd_texts() + ["".join(draw.choice(pool) + draw.choice(["", " ", " "]) for _ in range(draw.randrange(1, 25))) for _ in range(600)]
    for text in texts:
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == plain(name, text), repr(text)[:200]


    assert enc.known
    plain_pool = ["a", "the", "The", "ndsh", "é", "Über", ",", ".", "!?", "7", "42", "\n", "\n", "\n\n", " ", " ", " ", "  ", "\t"]
    for _ in range(3000):
        text = "".join(draw.choices(plain_pool, k=draw.randrange(1, 12)))
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == plain(name, text), repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_arrays_are_the_librarys(name):
    enc, draw = CachedEncoder(str(P.path(name)), memo=50, piece=300), random.Random(5)
    pool = ["a", "the", "The", "ndsh", "é", "Über", "×", "÷", "Þ", "ß", "ÿ", "À", ",", ".", "!?", "'", "7", "42", "\n", "\n\n", " ", " ", " ", "  ", "\t", "\r", "漢", "🙂", "\x00", "Ä", "İ"]
    texts = ["".join(draw.choices(pool[: draw.choice([8, 20, len(pool)])], k=draw.randrange(0, 14))) for _ in range(4000)] + [t or "" for t in odd_texts()] + ["", "", "Ã", "\n", " "]
    array = pa.array(["dropped", *texts]).slice(1)
    seen = 0
    for lo, hi, counts, ids in enc.ids_of(array):
        assert lo == seen and len(counts) == hi - lo and counts.sum() == len(ids)
        seen, at = hi, 0
        for i, n in enumerate(counts):
            assert ids[at : at + n].tolist() == plain(name, texts[lo + i]), repr(texts[lo + i])[:200]
            at += n
    assert seen == len(texts) and not list(enc.ids_of(pa.array([], pa.string())))


def test_another_tokenizer_is_left_to_the_library(tmp_path):
    from tokenizers import models, normalizers, pre_tokenizers

    vocab = {w: i for i, w in enumerate(["[UNK]", "the", "fox", ",", "a", "-", "b"])}
    for name, pre, norm in (("split", pre_tokenizers.Whitespace(), None), ("upper", pre_tokenizers.WhitespaceSplit(), normalizers.Lowercase())):
        t = Tokenizer(models.WordLevel(vocab, unk_token="[UNK]"))
        t.pre_tokenizer = pre
        if norm:
            t.normalizer = norm
        t.save(str(tmp_path / f"{name}.json"))
        enc = CachedEncoder(str(tmp_path / f"{name}.json"))
        assert not enc.known
        for text in ("the fox, a-b", "The\nfox", "", " a"):
            assert np.frombuffer(enc.ids(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_simple8b_round_trip():
    draw = np.random.default_rng(0)
    cases = [[], [0], [0] * 500, [1 << 59], [1 << 60, 5, (1 << 64) - 1, (15 << 60) + 3, 7], list(range(300)), draw.integers(0, 1 << 16, 5000), draw.integers(0, 3, 777)]
    cases += [draw.integers(0, 1 << int(draw.integers(1, 64)), int(draw.integers(1, 200)), dtype=np.uint64) for _ in range(200)]
    for ids in cases:
        ids = np.array(ids, np.uint64)
        coded = tokenbin.encode_ids(ids)
        assert (tokenbin.decode_words(coded) == ids).all()
    assert len(tokenbin.encode_ids(np.ones(600, np.uint64))) == 10


def test_token_file(spark, monkeypatch):
    monkeypatch.setattr(tokenbin, "BLOCK_WORDS", 200)
    texts = odd_texts()
    ids = [7, 3, 3, 900, -4, 5, 6, 8, None, 1]
    got = tokenbin.read_token_file(tokenbin.write_token_file(docs(spark, texts, ids), str(P.path("byte_bpe_50k.json")), 2)).collect()
    assert len(got) == len(texts)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == sorted(ids, key=lambda i: (i is not None, i))
    want = sorted(zlib.crc32(np.array([*plain("byte_bpe_50k.json", t), 2], "<u4").tobytes()) for t in texts)
    assert sorted(zlib.crc32(r["ids"]) for r in got) == want
    empty = tokenbin.read_token_file(tokenbin.write_token_file(docs(spark, []), str(P.path("byte_bpe_50k.json")), 2))
    assert empty.count() == 0


def test_packing(spark):
    draw = random.Random(2)
    texts = odd_texts() + [words(draw, draw.randrange(1, 900)) for _ in range(120)]
    got = packing.pack_documents(docs(spark, texts), str(P.path("word_bpe_49k.json")), end_id=1, group_docs=20).collect()
    own, sequences = {}, {}
    for r in got:
        own.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for i, text in enumerate(texts):
        ids = np.array([*plain("word_bpe_49k.json", text), 1], "<u4")
        parts = sorted(own[i], key=lambda r: r["start"])
        assert b"".join(r["ids"] for r in parts) == ids.tobytes()
        assert [r["start"] for r in parts] == np.cumsum([0, *[r["length"] for r in parts]])[:-1].tolist()
        assert {r["doc_tokens"] for r in parts} == {len(ids)}
    for parts in sequences.values():
        parts.sort(key=lambda r: r["offset"])
        size = sum(r["length"] for r in parts)
        assert [r["offset"] for r in parts] == np.cumsum([0, *[r["length"] for r in parts]])[:-1].tolist()
        assert size <= 2048 and size & (size - 1) == 0 and {r["sequence_tokens"] for r in parts} == {size}
    assert packing.pack_documents(docs(spark, []), str(P.path("word_bpe_49k.json"))).count() == 0


def test_step_groups_are_balanced(spark):
    draw = random.Random(3)
    frame = docs(spark, [words(draw, draw.randrange(1, 900)) for _ in range(300)]).coalesce(1)
    got = packing.pack_documents(frame, str(P.path("word_bpe_49k.json")), step_tokens=8192)
    steps = got.groupBy("step_id").agg(F.sum("length").alias("n")).collect()
    assert all(r["n"] <= 8192 for r in steps)
    assert sum(r["n"] == 8192 for r in steps) >= len(steps) - 8


def test_pack_rests_keeps_every_token():
    draw = random.Random(5)
    for _ in range(50):
        rests = [draw.randrange(0, 2048) for _ in range(draw.randrange(0, 60))]
        seen = {}
        for window in packing.pack_rests(rests, [2048, 1024, 512, 256]):
            size = sum(n for _, _, n in window)
            assert 0 < size <= 2048 and size & (size - 1) == 0
            for i, s, n in window:
                seen.setdefault(i, []).append((s, n))
        for i, n in enumerate(rests):
            at = 0
            for s, m in sorted(seen.get(i, [])):
                assert s == at
                at += m
            assert at == n
