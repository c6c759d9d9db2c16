"""License scan by a positional rare-token index.

Every template (a license phrase or notice) is a word sequence. Document frequencies of all
template words are counted over the whole corpus; the rarest word of a template is its
anchor, and the postings of an anchor are its places in templates. A file is looked up by
the anchors it holds: each occurrence proposes a placement (file position minus template
position), the placement's other words are intersected by relative position, and a notice
counts only if its mandatory key phrases stand consecutively where the placement puts them.

Phrases must match in full at a placement; notices match when the share of their words found
at the placement (weighted by IDF) reaches ``min_share`` and all key phrases are there.

Null text counts as empty; a null doc_id is carried; repeated rows give repeated rows; an
empty table gives no rows; very long texts are scanned whole. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaframe.llm.common import alnum_words


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...] = field(default=())  # mandatory phrases; none: the whole text is one


# The base phrases and their labels.
BASE = (
    Template("gpl", "gnu general public license"),
    Template("apache", "apache license"),
    Template("cc-by", "cc by"),
    Template("mit", "mit license"),
)
#: Notices that add labels of their own.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("in compliance with the license",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",)),
    Template("bsd", "licensed under the bsd license", ("bsd license",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc0", "dedicated to the public domain under cc0 1 0 universal", ("cc0 1 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("released into the public domain",)),
    Template("proprietary", "all rights reserved unauthorized copying of this file is strictly prohibited", ("all rights reserved",)),
)


def _words(text: str) -> tuple[bytes, ...]:
    return tuple(alnum_words(text))


def document_frequencies(docs: DataFrame, words: list[str], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Documents in all and per word of the (fixed, small) template vocabulary, over the whole
    corpus in one pass that sends one row per task."""
    import numpy as np

    vocabulary = sorted(words)
    number = {w.encode(): i for i, w in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for text in batch.column(0):
                n += 1
                for w in number.keys() & set(alnum_words(text.as_py())):
                    seen[number[w]] += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([seen.tolist()], pa.list_(pa.int64()))], names=["n", "seen"])

    parts = docs.select(F.col(text_col).alias("t")).mapInArrow(count, "n long, seen array<long>")
    got = parts.agg(F.sum("n").alias("n"), *[F.sum(F.col("seen")[i]).alias(f"w{i}") for i in range(len(vocabulary))]).first()
    return got["n"] or 0, {w.encode(): got[f"w{i}"] or 0 for i, w in enumerate(vocabulary)}


class Index:
    """Postings of the anchors, and the templates to verify."""

    def __init__(self, base, notices, n_docs: int, frequency: dict[bytes, int], min_share: float):
        self.n_base, self.min_share = len(base), min_share
        self.templates = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, item in enumerate((*base, *notices)):
            words = _words(item.text)
            idf = [math.log((n_docs + 1) / (frequency.get(w, 0) + 1)) + 1e-6 for w in words]
            keys = []
            for key in item.keys or (item.text,):
                k = _words(key)
                keys += [(at, k) for at in range(len(words) - len(k) + 1) if words[at : at + len(k)] == k][:1]
            # anchors: the rarest word of each mandatory phrase (every true placement holds it)
            at, key = max(keys, key=lambda x: max(idf[x[0] : x[0] + len(x[1])]))
            best = max(range(at, at + len(key)), key=lambda p: idf[p])
            self.postings[words[best]].append((t, best))
            self.templates.append((item.label, words, idf, keys))

    def look_up(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, share) of the placements that hold."""
        out = []
        anchors = self.postings
        for p in [i for i, w in enumerate(words) if w in anchors]:
            for t, at in anchors[words[p]]:
                start, (_, own, idf, keys) = p - at, self.templates[t]
                if any(tuple(words[max(0, start + a) : start + a + len(k)]) != k for a, k in keys) or start + keys[0][0] < 0:
                    continue
                got = [0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(own)]
                share = sum(x for x, g in zip(idf, got) if g) / sum(idf)
                if all(got) if t < self.n_base else share >= self.min_share:
                    out.append((t, start, share))
        return out


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label:string,start:long,n_words:long,share:double>>"


def scan_licenses(
    docs: DataFrame, base: tuple[Template, ...] = BASE, notices: tuple[Template, ...] = NOTICES, min_share: float = 0.6, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: places of the base phrases, labels, score and all matches."""
    vocabulary = {w.decode() for t in (*base, *notices) for w in _words(t.text)}
    n_docs, frequency = document_frequencies(docs, sorted(vocabulary), text_col)
    index, n_base = Index(base, notices, n_docs, frequency, min_share), len(base)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = alnum_words(text.as_py())
                found = sorted(index.look_up(words), key=lambda x: (x[1], x[0]))
                label = lambda t: index.templates[t][0]
                starts = [s for t, s, _ in found if t < n_base]
                rows.append({
                    "doc_id": doc_id, "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted({label(t) for t, _, _ in found if t < n_base})), "labels": ",".join(sorted({label(t) for t, _, _ in found})),
                    "score": max((min(1.0, (0.8 if t < n_base else 1.0) * share) for t, _, share in found), default=0.0),
                    "matches": [{"label": label(t), "start": s, "n_words": len(index.templates[t][1]), "share": share} for t, s, share in found],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(scan, SCHEMA)


_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("matches", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("n_words", pa.int64()), ("share", pa.float64())]))),
])
