"""Fixture rows with the odd cases that every operator has to take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("id", T.StringType()), T.StructField("k", T.StringType()), T.StructField("row", T.StringType()), T.StructField("score", T.StringType()),
])


def words(draw: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{draw.randrange(size)}" for _ in range(n))


def docs(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en" if i else None, f"s{(i or 0) % 3}", len(t or ""), "x", "x", "x", "x") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    draw = random.Random(1)
    long = words(draw, 30_000, 5_000)
    return [None, "", "  \n\t ", "a", "a b c", "Same text here, twice.", "Same text here, twice.", long, "Ünïcode  wörds and 漢字 <|endoftext|> ́x 🙂", words(draw, 600)]
