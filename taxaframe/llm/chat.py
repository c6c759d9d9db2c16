"""Chat formatting by columnar byte assembly.

Rows of (conversation, turn, role, text) are sorted by a range shuffle that also cuts a long
conversation, so no task holds a whole one. A task formats a few megabytes at a time: every
turn is three segments (header, content, footer); their lengths, cumulative offsets and
scatter indices are computed in numpy, and all bytes are copied into one preallocated Arrow
buffer, of which the formatted texts are slices. Texts and foreign role names are escaped so
that no control string of the template is left in them; ``parse_chat`` gives them back.

The formatted table has a row per chunk (a run of turns of one conversation): ``conv_id``,
``chunk`` (ascending within a conversation), ``begins`` and ``ends`` (whether it surely holds the
conversation's first and last turn), ``n_turns``, ``text`` and ``loss``, the spans of code
points of ``text`` to train on: the escaped contents of the trained roles.

Null texts and null roles count as empty; null turns come first; rows with a null conversation
form one conversation. Rows of equal turn are ordered by hashes of their role and text;
repeated rows are formatted each. An empty table gives no chunks. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNKS = "conv_id long, chunk long, begins boolean, ends boolean, n_turns long, text string, loss array<struct<start:long,length:long>>"
_LOSS = pa.struct([("start", pa.int64()), ("length", pa.int64())])
#: Contents above this size are copied as slices; shorter ones by scatter indices.
_LONG = 1 << 16


@dataclass(frozen=True)
class ChatTemplate:
    """Headers and footers of the known roles, and the three markers around the rest."""

    roles: tuple[tuple[str, str, str], ...] = (("user", "[INST] ", " [/INST]"), ("assistant", " ", "</s>"), ("system", "<<SYS>>\n", "\n<</SYS>>"))
    other: tuple[str, str, str] = ("<|role|>", "<|text|>", "<|end|>")
    trained: tuple[str, ...] = ("assistant",)
    #: control strings of the model that the template itself does not write
    reserved: tuple[str, ...] = ("<s>",)

    def __post_init__(self):
        heads = [h for _, h, _ in self.roles] + [self.other[0]]
        if any(a != b and b.startswith(a) or not a for a in heads for b in heads) or len(set(heads)) < len(heads):
            raise ValueError("headers must be distinct, and none may start with another")
        for mark in self.controls | {t for _, _, t in self.roles}:
            if len(mark) < 2 or "\\" in mark or any(mark.startswith(mark[i:]) for i in range(1, len(mark))):
                raise ValueError(f"marker {mark!r}: at least two characters, no backslash, no end that is also its start")
        if any(not t.strip() for _, _, t in self.roles):
            raise ValueError("a footer needs a visible marker")

    @cached_property
    def controls(self) -> set[str]:
        marks = [m for _, head, tail in self.roles for m in (head, tail)] + list(self.other + self.reserved)
        return {m.strip() for m in marks} - {""}

    @cached_property
    def _unsafe(self) -> re.Pattern:
        return re.compile("|".join(re.escape(c) for c in sorted(self.controls, key=len, reverse=True)))

    @cached_property
    def unsafe_re2(self) -> str:
        return "|".join([r"\\", *(re.sub(r"([^\w\s])", r"\\\1", c) for c in self.controls)])

    def escape(self, text: str) -> str:
        """Doubles backslashes and puts one behind the first character of each control string."""
        return self._unsafe.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text

    def markers(self, role: str) -> tuple[str, str]:
        for name, head, tail in self.roles:
            if role == name:
                return head, tail
        return self.other[0] + self.escape(role) + self.other[1], self.other[2]


def parse_chat(template: ChatTemplate, text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    at, known = 0, sorted(template.roles, key=lambda r: len(r[1]), reverse=True)
    first, middle, last = template.other
    while at < len(text):
        if text.startswith(first, at):
            cut = text.index(middle, at + len(first))
            role, at, tail = template.unescape(text[at + len(first) : cut]), cut + len(middle), last
        else:
            role, head, tail = next(r for r in known if text.startswith(r[1], at))
            at += len(head)
        end = text.index(tail, at)
        yield role, template.unescape(text[at:end])
        at = end + len(tail)


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all bytes of the segments, one segment after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and offsets of a string array."""
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def assemble(template: ChatTemplate, roles: pa.Array, texts: pa.Array):
    """Formats turns. Returns the buffer, the byte and code point at which each turn begins (and
    the end of the last one), and start and length of each content in code points."""
    unsafe = pc.match_substring_regex(texts, template.unsafe_re2)
    if pc.any(unsafe).as_py():
        texts = pc.replace_with_mask(texts, unsafe, pa.array([template.escape(t.as_py()) for t in texts.filter(unsafe)], texts.type))
    coded = roles.dictionary_encode()
    marks = [template.markers(r) for r in coded.dictionary.to_pylist()]
    kind = coded.indices.to_numpy(zero_copy_only=False)
    raw = [m.encode() for pair in marks for m in pair]
    pool, size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(m) for m in raw], np.int64)
    place = np.cumsum(size) - size
    chars = np.array([len(m) for pair in marks for m in pair], np.int64)
    data, offsets = _bytes_of(texts)
    n = len(texts)
    # three segments a turn: lengths and offsets in bytes, then in code points
    length, points = np.empty((n, 3), np.int64), np.empty((n, 3), np.int64)
    head, tail = 2 * kind, 2 * kind + 1
    length[:, 0], length[:, 1], length[:, 2] = size[head], np.diff(offsets), size[tail]
    points[:, 0], points[:, 1], points[:, 2] = chars[head], pc.utf8_length(texts).to_numpy(zero_copy_only=False), chars[tail]
    begin = np.concatenate([[0], np.cumsum(length)])
    point = np.concatenate([[0], np.cumsum(points)])
    buffer = pa.allocate_buffer(int(begin[-1]))
    out = np.frombuffer(buffer, np.uint8)
    for segment, which in ((0, head), (2, tail)):
        out[_places(begin[segment:-1:3], length[:, segment])] = pool[_places(place[which], size[which])]
    target, body = begin[1:-1:3], length[:, 1]
    short = body <= _LONG
    out[_places(target[short], body[short])] = data[_places(offsets[:-1][short], body[short])]
    for i in np.flatnonzero(~short):
        out[target[i] : target[i] + body[i]] = data[offsets[i] : offsets[i + 1]]
    return buffer, begin[::3], point[::3], point[1::3], points[:, 1]


def _pieces(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``limit`` bytes of text."""
    for batch in batches:
        sums = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sums, limit + (sums[at - 1] if at else 0), "right")))
            yield batch.slice(at, end - at)
            at = end


def _format(template: ChatTemplate, piece_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        held = seen = None  # columns whose last chunk may go on; the last conversation seen

        def emit(ends_last: bool) -> pa.RecordBatch:
            ends = np.ones(held["n"], bool)
            ends[-1] = ends_last
            return pa.RecordBatch.from_arrays([*held["cols"][:3], pa.array(ends), *held["cols"][3:]], names=[c.split()[0] for c in CHUNKS.split(", ")])

        for piece in _pieces(batches, piece_bytes):
            conv, roles = piece.column("conv_id"), piece.column("role")
            buffer, begin, point, content, points = assemble(template, roles, piece.column("text"))
            value, valid = pc.fill_null(conv, 0).to_numpy(zero_copy_only=False), pc.is_valid(conv).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (valid[1:] != valid[:-1])]))
            key, last = (int(value[0]), bool(valid[0])), (int(value[-1]), bool(valid[-1]))
            if held:
                yield emit(seen != key)
            begins = np.ones(len(first), bool)
            begins[0] = seen is not None and seen != key
            edges = np.append(first, len(value))
            trained = pc.is_in(roles, pa.array(template.trained, pa.string())).to_numpy(zero_copy_only=False)
            owner = np.searchsorted(first, np.flatnonzero(trained), "right") - 1
            spans = pa.StructArray.from_arrays([pa.array(content[trained] - point[first][owner]), pa.array(points[trained])], fields=list(_LOSS))
            texts = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(begin[edges].astype(np.int32)), buffer])
            loss = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(first) + 1)).astype(np.int32)), spans)
            held = {"n": len(first), "cols": [conv.take(pa.array(first)), pa.array(chunk + np.arange(len(first))), pa.array(begins), pa.array(np.diff(edges)), texts, loss]}
            chunk, seen = chunk + len(first), last
        if held:
            yield emit(False)

    return run


def format_conversations(rows: DataFrame, template: ChatTemplate = ChatTemplate(), piece_bytes: int = 4 << 20, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The formatted table of all conversations, in chunks of about ``piece_bytes`` at most (a longer turn is one chunk)."""
    own = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumns({"_h": F.xxhash64("text"), "_r": F.xxhash64("role")})
    # border rows go to the driver, so they hold hashes instead of texts; equal rows are dealt by their place
    order = ["conv_id", "turn", "_r", "_h"]
    dealt = own.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order, "_at").sortWithinPartitions("conv_id", "turn", "_r", "_h")
    return dealt.select("conv_id", "role", "text").mapInArrow(_format(template, piece_bytes), CHUNKS)


def _digest(template: ChatTemplate):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def rows(out: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if "sha" in x else pa.int64()) for x, c in zip(names, zip(*out))], names=names)

        def closed() -> list:
            turns, all_text, chars, loss, formatted = state
            return [conv, turns, all_text.hexdigest(), chars, loss.hexdigest(), formatted]

        for batch in batches:
            out = []
            for conv_id, text, spans in zip(batch.column("conv_id").to_pylist(), batch.column("text"), batch.column("loss")):
                if state is None or conv != conv_id:
                    if state is not None:
                        out.append(closed())
                    conv, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = text.as_py()
                for role, said in parse_chat(template, text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in spans.as_py():
                    said = template.unescape(text[span["start"] : span["start"] + span["length"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
            if out:
                yield rows(out)
        if state is not None:
            yield rows([closed()])

    return run


def read_formatted(chunks: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Per conversation, read back from the formatted table: turns, digest of all turns, and of the text under the loss mask.

    A conversation within one chunk is read where it lies; only chunks of cut ones are brought
    together, as an ordered stream of which a task holds one batch.
    """
    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    whole = F.col("begins") & F.col("ends")
    use = ["conv_id", "text", "loss"]
    alone = chunks.where(whole).select(*use).mapInArrow(_digest(template), out)
    cut = chunks.where(~whole).repartition("conv_id").sortWithinPartitions("conv_id", "chunk").select(*use)
    return alone.unionByName(cut.mapInArrow(_digest(template), out))
