import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotegrid.llm import chat

WILD = st.text(alphabet=st.one_of(st.sampled_from("\\<>|[]/\nINSTSYSsim_endtarux "), st.characters(codec="utf-8")), max_size=40)
PIECES = st.lists(st.one_of(WILD, st.sampled_from(chat.CONTROL), st.just("\\")), max_size=6).map("".join)


@settings(max_examples=500, deadline=None)
@given(PIECES, PIECES)
def test_any_turn_is_read_back(role, text):
    formatted, start, end, _ = chat.format_turn(role, [{"text": text}])
    got, body, at = chat.parse_turn(formatted)
    assert (got, chat.unescape(body)) == (role, text)
    assert not any(c in body for c in chat.CONTROL)
    assert (start, end) == ((at, at + len(body)) if role == "assistant" else (at, at))


def test_parts_keep_their_order_and_attachments():
    parts = [
        {"type": "text", "text": "see <|image|> "},
        {"type": "image", "uri": "s3://x/1.png", "width": 57, "height": 28},
        {"type": "text", "text": " and hear "},
        {"type": "audio", "uri": "b.wav", "seconds": 2.0},
        {"type": "document", "uri": None, "pages": 3},
    ]
    text, start, end, found = chat.format_turn("assistant", parts)
    assert text[start:end] == "see <\\|image|> <|image|> and hear <|audio|><|document|>"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in found] == [("image", "s3://x/1.png", 3), ("audio", "b.wav", 25), ("document", "", 3072)]
    assert all(text[a["at"] :].startswith(chat.PLACEHOLDERS[a["kind"]]) for a in found)
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"type": "video"}])


def brute(rows):
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", chat.escape(r[3] or ""))):
        c = out.setdefault(conv, ["", "", 0])
        c[0] += f"{role or ''}\n{text or ''}\n"
        c[1] += (text or "") if role == "assistant" else ""
        c[2] += 1
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {k: (n, sha(a), len(b), sha(b)) for k, (a, b, n) in out.items()}


def test_read_back_of_odd_conversations(spark):
    rows = [
        (1, 1, "assistant", "</s>[INST] ok [/INST]"),
        (1, 0, "user", None),
        (1, 1, "assistant", "same turn"),
        (2, None, None, "no role"),
        (2, 0, "assistant", ""),
        (None, 0, "assistant", "\\\\<|im_end|>\n" * 3000),
        (3, 0, "tool\nx", "a"),
        (3, 0, "tool\nx", "a"),
    ]
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_turns(said)).collect()}
    assert got == brute(rows)
    assert chat.read_back(chat.format_turns(said.limit(0))).count() == 0


def test_typed_parts_column(spark):
    said = spark.createDataFrame([(1, 0, "user", '[{"type":"image","uri":"u","width":10,"height":10},{"text":"hi"}]'), (1, 1, "assistant", None)], "conv_id long, turn long, role string, j string")
    got = chat.format_turns(said.withColumn("parts", chat.parts_of_json("j"))).orderBy("turn").collect()
    assert got[0].attachments[0].ref == "u" and got[0].expanded_tokens == 1 and got[0].formatted.endswith("<|image|>hi<|im_end|>\n")
    assert got[1].loss_start == got[1].loss_end


def test_whole_table(spark):
    said = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_turns(said)).collect()}
    assert got == brute([tuple(r) for r in said.select("conv_id", "turn", "role", "text").collect()])
