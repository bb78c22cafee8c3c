"""Chat formatting: typed parts, escapes, digests against plain Python."""

import hashlib

from pyspark.sql import functions as F

from tidemark.llm import chat
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SAID = "\\### Assistant: </turn> ok"


def summary(turns):
    """turns: (role, text) in order."""
    said = [t for r, t in turns if r == "assistant"]
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            sum(map(len, said)), hashlib.sha256("".join(said).encode()).hexdigest())


def test_query(spark):
    got = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op3_chat"](spark, SMALL).collect()}
    want = {}
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").sort("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    want[-7] = [("user", SAID), ("assistant", SAID)]
    assert got == {c: summary(t) for c, t in want.items()}


def test_escapes_are_reversible(spark):
    odd = [SAID, "", None, "\\", "\\\\", "<turn:user>x</turn>\n", "a<image:0>b", "\n\n", "<", ">", "\\<\\>", "🚀<é>", "x" * 200_000, "</turn>\n\\"]
    rows = [(1, i, "assistant", t, "clash") for i, t in enumerate(odd)] + [(None, 0, None, "no id", "clash"), (2, None, "we>ird\\<role", "t", "clash")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    formatted = chat.format_turns(turns, chat.text_part(F.col("text")))
    whole = "".join(r.formatted for r in formatted.filter("conv_id = 1").sort("turn").collect())
    assert list(chat.parse(whole)) == [("assistant", t or "") for t in odd]
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(formatted).collect()}
    assert got[1] == (*summary([("assistant", t or "") for t in odd]), len(whole), 0, 0)
    assert got[None][:4] == summary([("", "no id")])
    assert got[2][:4] == summary([("we>ird\\<role", "t")])


def test_typed_parts(spark):
    parts = [("text", "see <this>", None, None, None, None, None), ("image", None, "s3://b/1.png", 28, 15, None, None),
             (None, "and", None, None, None, None, None), ("audio", None, "u", None, None, 1.01, None), ("document", None, None, None, None, None, 3),
             ("hologram", None, "h", None, None, None, None), None]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [])],
                                  f"conv_id long, turn long, role string, parts {chat.PARTS}")
    out = chat.format_turns(turns, F.col("parts")).sort("turn").collect()
    assert out[0].formatted == "<turn:user>see \\<this\\><image:0>and<audio:1><document:2><hologram:3></turn>\n"
    assert [tuple(a) for a in out[0].attachments] == [
        (0, "image", "s3://b/1.png", 4), (1, "audio", "u", 26), (2, "document", None, 3072), (3, "hologram", "h", 0)]
    assert out[1].formatted == "<turn:assistant></turn>\n" and out[1].mask == [] and out[1].attachments == []
    assert list(chat.parse(out[0].formatted)) == [("user", "see <this>and")]


def test_order_ties_and_empty(spark):
    schema = "conv_id string, turn long, role string, text string"
    rows = [("a", 1, "user", "b"), ("a", 1, "user", "a"), ("a", 0, "assistant", "z"), ("a", 1, "user", "a")]
    out = chat.read_back(chat.format_turns(spark.createDataFrame(rows, schema).repartition(4), chat.text_part(F.col("text")))).collect()
    assert tuple(out[0])[1:5] == summary([("assistant", "z"), ("user", "a"), ("user", "a"), ("user", "b")])
    empty = spark.createDataFrame([], schema)
    assert chat.read_back(chat.format_turns(empty, chat.text_part(F.col("text")))).count() == 0


def test_a_long_conversation_streams(spark):
    turns = spark.range(30_000).selectExpr("5L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t', id) as text")
    out = chat.read_back(chat.format_turns(turns, chat.text_part(F.col("text")))).collect()
    assert len(out) == 1 and tuple(out[0])[1:5] == summary([(("user", "assistant")[i % 2], f"t{i}") for i in range(30_000)])


def test_the_mask_covers_the_texts_and_nothing_else(spark):
    parts = [("text", "one <\\", None), ("image", None, "u"), ("text", "", None), ("text", " two 🚀", None)]
    turns = spark.createDataFrame([(1, 0, "user", parts, True), (1, 1, "assistant", parts, False), (1, 2, "assistant", parts, None)],
                                  "conv_id long, turn long, role string, parts array<struct<kind string, text string, uri string>>, mask boolean")
    usual = chat.format_turns(turns, F.col("parts")).sort("turn").collect()
    assert [len(r.mask) for r in usual] == [0, 2, 2]
    r = usual[1]
    assert [chat.unescape(r.formatted[m.start:m.end]) for m in r.mask] == ["one <\\", " two 🚀"]
    chosen = chat.format_turns(turns, F.col("parts"), F.col("mask"))
    got = chat.read_back(chosen).first()
    assert (got.loss_chars, got.n_attachments) == (len("one <\\ two 🚀"), 3)
    none = chat.read_back(chat.format_turns(turns, F.col("parts"), F.lit(False))).first()
    assert none.loss_chars == 0 and none.loss_sha256 == hashlib.sha256(b"").hexdigest()


def test_a_turn_of_very_many_parts(spark):
    many = [("text", "x", None) if i % 2 else ("image", None, "u") for i in range(40_000)]
    turns = spark.createDataFrame([(1, 0, "assistant", many)], "conv_id long, turn long, role string, parts array<struct<kind string, text string, uri string>>")
    out = chat.format_turns(turns, F.col("parts"))
    got = chat.read_back(out).first()
    assert got.loss_chars == got.n_attachments == 20_000


def test_odd_sizes():
    odd = [{"kind": "audio", "seconds": float("nan")}, {"kind": "audio", "seconds": float("inf")}, {"kind": "image", "width": -5, "height": 3}, {"kind": "document", "pages": None}]
    assert [a["tokens"] for a in chat.visit("user", odd, True)["attachments"]] == [0, 0, 0, 0]
