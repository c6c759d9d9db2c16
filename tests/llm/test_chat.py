import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from taxaframe.llm.chat import ChatTemplate, assemble, format_conversations, parse_chat, read_formatted
from taxaframe.llm.common import stored

SCHEMA = "conv_id long, turn long, role string, text string, chunk string, loss string"
PIECES = ["[INST]", "[/INST]", " [/INST]", "</s>", "<s>", "<<SYS>>", "\n<</SYS>>", "<|role|>", "<|text|>", "<|end|>", "\\", "<", "[", "é漢🙂", " ", "\n", "a"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT)


@given(st.lists(st.tuples(ROLE, TEXT), min_size=1, max_size=6))
def test_round_trip(turns):
    template = ChatTemplate()
    buffer, begin, point, content, points = assemble(template, pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
    text = buffer.to_pybytes().decode()
    assert list(parse_chat(template, text)) == turns
    assert begin[-1] == len(buffer) and point[-1] == len(text)
    for (role, said), at, n in zip(turns, content, points):
        assert template.unescape(text[at : at + n]) == said
        assert not any(c in text[at : at + n] for c in template.controls)


def brute(rows):
    out = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        o = out.setdefault(c, [0, "", ""])
        o[0] += 1
        o[1] += f"{role or ''}\n{text or ''}\n"
        o[2] += (text or "") if role == "assistant" else ""
    return {c: (n, hashlib.sha256(a.encode()).hexdigest(), len(b), hashlib.sha256(b.encode()).hexdigest()) for c, (n, a, b) in out.items()}


@pytest.mark.parametrize("piece_bytes", [100, 4 << 20])
def test_conversations(spark, piece_bytes):
    draw = random.Random(2)
    rows = [(draw.randrange(40) if draw.random() < 0.7 else 7, i, draw.choice(["user", "assistant", "system", "tool", None]), "".join(draw.choices(PIECES, k=draw.randrange(12)))) for i in range(600)]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", None), (50, 1, "assistant", ""), (51, 3, "assistant", "long \\ " * 30_000), (52, 1, "user", "same"), (52, 1, "user", "same")]
    draw.shuffle(rows)
    table = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA)
    chunks = stored(format_conversations(table, piece_bytes=piece_bytes), "chat")
    got = read_formatted(chunks).collect()
    assert len(got) == len(brute(rows))
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(rows)
    assert chunks.selectExpr("sum(length(text))").first()[0] == sum(r.formatted_chars for r in got)


def test_empty(spark):
    assert read_formatted(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_unusable_templates():
    with pytest.raises(ValueError, match="footer"):
        ChatTemplate(roles=(("user", "<u>", "\n\t"),))
    with pytest.raises(ValueError, match="start"):
        ChatTemplate(roles=(("user", "aba", "<e>"),))
    with pytest.raises(ValueError, match="distinct"):
        ChatTemplate(roles=(("user", "<u>", "<e>"), ("tool", "<u>", "<e>")))
