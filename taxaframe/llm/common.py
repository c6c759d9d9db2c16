"""Helpers shared by the corpus operators: stored tables, words, hashes, tokenizers."""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaframe.session import ensure_checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_crc32(col) -> "F.Column":
    """crc32 of an integer id written as text: decides folds (null: crc32 of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


# --- words ---------------------------------------------------------------------------------

#: bytes -> bytes: A-Z lower-cased; every ASCII byte that is no digit and no letter becomes a space.
_ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_ALNUM).split()


_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = _MUL
    return np.multiply.accumulate(out)


def space_word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of the texts, and
    the number of words of each text. Vectorised over the bytes of the joined texts."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = _SPACE[buf]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    last = ~space[:-1] & space[1:]
    ends = np.flatnonzero(last) + 1
    n = int((ends - starts).max())
    word = np.cumsum(first) - 1
    pos = np.arange(len(buf)) - starts[np.maximum(word, 0)]
    pos[space] = 0
    size = 1 << max(6, n.bit_length())
    val = (buf.astype(np.uint64) + _U(1)) * _powers(size)[pos]
    val[space] = 0
    h = mix64(np.add.reduceat(val, starts) ^ ((ends - starts).astype(np.uint64) << _U(48)))
    text_end = np.cumsum([len(r) + 1 for r in raw])
    return h, np.diff(np.concatenate([[0], np.searchsorted(starts, text_end)]))


def pieces_by_bytes(texts: list[str], limit: int = 2_000_000):
    """Index ranges of consecutive texts of about ``limit`` characters in all (bounds memory)."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


# --- tokenizers ----------------------------------------------------------------------------

_L, _P = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
_WHOLE = re.compile(rf" ?[{_L}{_P}0-9]+(?:\n[{_L}{_P}0-9]+)*")
_PARTS = re.compile(rf" ?[{_L}]+| ?[0-9]+| ?[{_P}]+|\n")
_CHUNK = re.compile(rf"[{_L}{_P}0-9]+")
_CORES = re.compile(rf"[{_L}]+|[0-9]|[{_P}]+")
_SOLID = r"!-~¡-ᙿ、-퟿"
_ENDS = re.compile(rf"[{_SOLID}](?:.*[{_SOLID}])?", re.S)


def _classes(space: str, line: str) -> np.ndarray:
    """Class of each byte: 1 letter, 2 digit, 3 mark, 4 space, 5 newline, 0 anything else."""
    out = np.zeros(256, np.uint8)
    for kind, pattern in ((1, "[A-Za-z]"), (2, "[0-9]"), (3, f"[{_P}]"), (4, f"[{space}]"), (5, f"[{line}]" if line else "$.")):
        out[[c for c in range(128) if re.match(pattern, chr(c))]] = kind
    return out


_CLASS, _CLASS_WORD = _classes(" ", "\n"), _classes(" \n\t\r", "")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Memo(dict):
    """A bounded dict that fills itself. It keeps two generations of at most ``limit`` keys; keys
    used again move on, the rest are forgotten, so memory is bounded and frequent keys stay."""

    def __init__(self, make, limit: int = 100_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > 64:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _Joined(Exception):
    """A text whose spaces are no safe places to cut it."""


#: Texts on which the cuts of a tokenizer file are tried; a file that cuts elsewhere is left to the library.
_PROBES = [
    "The quick, brown fox.", "don't l'été 3.14 x12y", "a\nb c\n\nd \n e", "ÀÉÎ œuvre ß", "(a-b) #1 $x% & *y*", "AKIAIOSFODNN7 x_y z=1;", "  two  spaces ", "a\n", "\nb",
    "tab\tand\r\nmore", "漢字 and 🙂 mixed…", "UPPER lower MiXeD 12 345", "x" * 30 + " " + "y" * 5, "http://a.b/c?d=e", "e\u0301 <|endoftext|> </s>",
]


class CachedEncoder:
    """Ids of whole texts by a ``tokenizers`` file, with the ids of repeated words remembered.

    The two kinds of files known here (byte-level and lower-casing word BPE) split a text into pre-tokens before merging. Texts are cut at places
    where a pre-token surely ends (a single space between two visible characters; changes
    between letters, digits and marks), the parts are encoded by the library and remembered.
    Anything else is handed to the library whole, as is every text if the file gives other ids for the
    probe texts, so the ids are the library's in all cases.
    """

    def __init__(self, path: str, memo: int = 100_000, piece: int = 2 << 20):
        """``memo``: pre-tokens remembered; ``piece``: bytes of text that are cut at once. Both bound memory only."""
        import os

        self.piece = piece
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.keeps_space = self.tokenizer.normalizer is None
        self.model = self.tokenizer.model
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        known = re.findall(rf"[{_L}{_P}0-9 \n]", "".join(map(chr, range(256))))
        self.table = {ord(c): to_bytes.pre_tokenize_str(c)[0][0] for c in known}
        self.space = self.table[ord(" ")]
        self.part = _Memo(self._merge, memo)
        self.word = _Memo(self._spaced_word if self.keeps_space else self._unspaced)
        self.known = True
        self.known = self._agrees()

    def _agrees(self) -> bool:
        try:
            return all(self.ids(t) == self._encode(t) for t in _PROBES)
        except Exception:  # a model or normalizer that the cuts do not fit, in whatever way
            return False

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _merge(self, part: str) -> bytes:
        """Ids of one pre-token of known characters, by the library's merges alone."""
        if part.isspace() and not self.keeps_space:
            return b""
        if part.isascii():  # ASCII letters stand for themselves
            word = part.removeprefix(" ")
            if word.isalpha():
                return self._merged(word if word is part else self.space + word)
        return self._merged(part.translate(self.table))

    def _merged(self, part: str) -> bytes:
        found = self.model.tokenize(part)
        if len(found) == 1:
            return found[0].id.to_bytes(4, "little")
        return array("I", [t.id for t in found]).tobytes()

    def _spaced_word(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():  # one pre-token; ASCII letters stand for themselves
            return self._merged(self.space + word)
        return self._spaced(" " + word)

    def _spaced(self, text: str) -> bytes:
        if _WHOLE.fullmatch(text):
            return b"".join([self.part[p] for p in _PARTS.findall(text)])
        if not _ENDS.fullmatch(text[1:] if text[:1] == " " else text):
            raise _Joined
        return self._encode(text)

    def _unspaced(self, text: str) -> bytes:
        if text.isalpha() and text.isascii():
            return self._merged(text.lower())
        out = []
        for chunk in re.split(r"[ \t\n\r]+", text):
            if _CHUNK.fullmatch(chunk):
                out += [self.part[p] for p in _CORES.findall(chunk.lower())]
            elif chunk:
                out.append(self._encode(chunk))
        return b"".join(out)

    def _plain(self, text: str) -> list[str] | None:
        """The pre-tokens of a text of known characters only, None for any other text."""
        if self.keeps_space:
            # runs of spaces and newlines that do not stand alone are left to the library
            if "\n\n" in text or "\n " in text or text[0] == "\n" or text[-1] == "\n":
                return None
            parts = _PARTS.findall(text)
            return parts if sum(map(len, parts)) == len(text) else None
        text = text.lower()
        parts = _CORES.findall(text)
        return parts if sum(map(len, parts)) + sum(map(text.count, " \n\t\r")) == len(text) else None

    def ids(self, text: str | None) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.known:
            return self._encode(text)
        parts = self._plain(text)
        if parts is not None:
            return b"".join(map(self.part.__getitem__, parts))
        words = text.split(" ")
        if not self.keeps_space:
            return b"".join(map(self.word.__getitem__, words))
        try:
            return self._spaced(words[0]) + b"".join(map(self.word.__getitem__, words[1:]))
        except _Joined:
            return self._encode(text)


    def ids_of(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ids of a string array without nulls, a few megabytes at a time: (first text, last + 1, ids per text, all ids).

        Texts of known characters are cut into pre-tokens by the classes of their bytes, all at once;
        each distinct pre-token of a piece is looked up once, and ids are gathered by offsets.
        """
        if not pa.types.is_string(texts.type):
            texts = texts.cast(pa.string())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + self.piece, "right")))
            yield at, end, *self._piece(texts.slice(at, end - at))
            at = end

    def _piece(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        fine, cut = self._cut(texts) if self.known else (np.zeros(len(texts), bool), None)
        if not fine.all():
            rest = np.flatnonzero(~fine)
            other = [np.frombuffer(self.ids(texts[int(i)].as_py()), "<u4") for i in rest]
            counts = np.zeros(len(texts), np.int64)
            counts[rest] = [len(x) for x in other]
            if fine.any():
                counts[fine], ids = self._gather(*self._cut(texts.filter(pa.array(fine)))[1])
            else:
                ids = np.zeros(0, "<u4")
            out, starts = np.empty(int(counts.sum()), "<u4"), np.cumsum(counts) - counts
            own = np.repeat(fine, counts)
            out[own] = ids
            for i, x in zip(rest, other):
                out[starts[i] : starts[i] + len(x)] = x
            return counts, out
        return self._gather(*cut)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, tuple[pa.Array, np.ndarray]]:
        """Whether each text has known characters only, and of all texts the pre-tokens and where each text's begin."""
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        buf = (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind = (_CLASS if self.keeps_space else _CLASS_WORD)[buf]
        lead = np.flatnonzero(buf == 0xC3)
        if len(lead):  # the two bytes of a Latin letter
            second = buf[np.minimum(lead + 1, len(buf) - 1)]
            letter = (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)
            kind[lead[letter]] = kind[lead[letter] + 1] = 1
        if not self.keeps_space:
            buf = _LOWER[buf]
            if len(lead):
                upper = lead[letter & (second <= 0x9E)] + 1
                buf[upper] += 0x20
        first = np.zeros(len(buf) + 1, bool)  # of a text; the end counts
        first[offsets] = True
        odd = kind == 0
        before, space, line = np.concatenate([kind[:1], kind[:-1]]), kind == 4, kind == 5
        begins = kind != before
        if self.keeps_space:
            after = np.concatenate([kind[1:], kind[:0], [4]])[: len(kind)]
            odd |= (space | line) & ((after >= 4) | first[1:]) | line & first[:-1]
            begins &= before != 4  # a space belongs to what follows it
        else:
            begins |= kind == 2  # digits stand alone
        begins |= first[:-1]
        fine = np.ones(len(texts), bool)
        fine[np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1] = False
        starts = np.flatnonzero(begins)
        ends = np.append(starts, len(buf)).astype(np.int32)
        # a cut within a letter of an unknown text would be no text: such parts stay bytes
        parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(buf))])
        return fine, (parts, np.searchsorted(starts, offsets))

    def _gather(self, parts: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        coded = parts.dictionary_encode()
        found = [self.part[p] for p in coded.dictionary.cast(pa.string()).to_pylist()]
        size = np.array([len(x) // 4 for x in found], np.int64)
        flat, index = np.frombuffer(b"".join(found), "<u4"), coded.indices.to_numpy(zero_copy_only=False)
        each = size[index] if len(index) else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat((np.cumsum(size) - size)[index] - upto[:-1], each) + np.arange(upto[-1])] if len(index) else np.zeros(0, "<u4")
        return np.diff(upto[first]), ids


@lru_cache(maxsize=4)
def encoder(path: str, memo: int = 100_000, piece: int = 2 << 20) -> CachedEncoder:
    """The encoder of a Python worker, kept between its tasks."""
    return CachedEncoder(path, memo, piece)
