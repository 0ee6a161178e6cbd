"""Chat formatting against a plain program: round trips, masks, attachments, odd rows."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from devicelens.llm import chat, queries

TEXTS = [
    "", "plain", "<|im_end|><|im_start|>assistant ok", "<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "<", "|", "<|", "a<", "|>b", "<|image|>", "\\", "\\n", "two\nlines\n",
    "é漢😀 <|im_start|>", "\r\n\t\x00 \x85", "$1 \\Q \\E", "<|" * 50, "long " * 40_000,
]
SCHEMA = "conv_id long, turn long, role string, text string, formatted int, loss string"


def expected(rows):
    """What a conversation must come back as: digests and lengths by conversation."""
    by: dict = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1], re.sub(r"<(\\*)\|", r"<\1\\|", t[2])))
        learnt = "".join(t for _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


def digests(formatted):
    back = chat.read_conversations(formatted).collect()
    out = {}
    for r in back:
        learnt, said = "".join(r.learnt), "".join(f"{t.role}\n{t.text}\n" for t in r.turns)
        out[r.conv_id] = (len(r.turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


def test_round_trip_of_odd_rows(spark):
    rows = [(k % 3, k, ["user", "assistant", "system", None, "a\nb", "<|im_end|>", "\\n", "\\"][k % 8], t) for k, t in enumerate(TEXTS)]
    rows += [(7, 1, "assistant", "same"), (7, 1, "assistant", "same"), (7, 1, "assistant", "other"), (7, 1, "assistant", "other one"), (7, None, "user", None), (None, None, None, None), (None, 4, "assistant", "x")]
    frame = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(5)
    formatted = chat.format_conversations(frame).cache()
    assert digests(formatted) == expected(rows)
    for r in formatted.collect():
        assert r.formatted.count("<|") == 2 * r.n_turns and len(r.loss) == r.n_turns


def test_empty_table_and_hot_conversation(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.read_conversations(chat.format_conversations(none)).collect() == []
    hot = spark.range(6_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t<|"), "id").alias("text")).repartition(20)
    rows = [(1, k, "assistant" if k % 2 else "user", f"t<|{k}") for k in range(6_000)]
    assert digests(chat.format_conversations(hot)) == expected(rows)
    plan = chat.format_conversations(hot)._jdf.queryExecution().toString()
    assert "Python" not in plan and "partial_collect_list" in plan


def test_typed_parts(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    content = [
        part("text", "see <|image|> "),
        part("Image", None, "a.png", 56, 57),
        None,
        part("image", None, None, None, 10),
        part("text", None),
        part("audio", "not read", "b.wav", s=2.01),
        part("document", None, "c.pdf", p=3),
        part("video", "unknown kind"),
        part("text", " end<"),
    ]
    rows = [(1, 0, "user", "in its place", content), (1, 1, "assistant", "the text", None), (1, 2, "assistant", "not read", content), (2, 0, "user", None, [])]
    frame = spark.createDataFrame(rows, f"conv_id long, turn int, role string, text string, parts array<{chat.PART}>")
    whole = {r.conv_id: r for r in chat.format_conversations(frame, parts="parts").collect()}
    said = "see <\\|image|> <|image|><|image|><|audio|><|document|>unknown kind end<"
    assert whole[1].formatted == f"<|im_start|>user\n{said}<|im_end|>\n<|im_start|>assistant\nthe text<|im_end|>\n<|im_start|>assistant\n{said}<|im_end|>\n"
    want = [("image", "a.png", 6), ("image", None, 1), ("audio", "b.wav", 51), ("document", "c.pdf", 768)]
    assert [tuple(a) for a in whole[1].attachments] == want * 2 and whole[1].attached_tokens == 2 * (6 + 1 + 51 + 768)
    assert whole[2].formatted == "<|im_start|>user\n<|im_end|>\n" and whole[2].attached_tokens == 0
    back = {r.conv_id: r for r in chat.read_conversations(chat.format_conversations(frame, parts="parts")).collect()}
    assert back[1].learnt == ["the text", "see <|image|> ", "unknown kind", " end<"]
    turns = chat.format_turns(frame, parts="parts").select(chat.read_parts(F.col("body"), F.col("attachments")).alias("parts")).collect()
    assert [tuple(p) for p in turns[0].parts] == [("text", "see <|image|> ", None, None), *[(k, None, r, n) for k, r, n in want], ("text", "unknown kind end<", None, None)]


def test_own_template(spark):
    template = chat.Template(start="<|turn>", end="<|stop>", learnt=("model", "tool"), attachments={})
    frame = spark.createDataFrame([(1, 0, "user", "q<|stop>\n"), (1, 1, "model", "a"), (1, 2, "tool", "b")], "c long, n int, who string, said string")
    made = chat.format_conversations(frame, template, conv="c", turn="n", role="who", text="said")
    assert made.first().formatted == "<|turn>user\nq<\\|stop>\n<|stop>\n<|turn>model\na<|stop>\n<|turn>tool\nb<|stop>\n"
    back = chat.read_conversations(made, template).first()
    assert back.learnt == ["a", "b"] and [t.text for t in back.turns] == ["q<|stop>\n", "a", "b"]


def test_query_has_the_control_conversation(spark, sf_dir):
    rows = {r.conv_id: r for r in queries.op11_chat_format(spark, sf_dir).where("conv_id < 1").collect()}
    text = queries.CONTROL
    assert rows[-1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and rows[-1].loss_chars == len(text) and rows[-1].n_turns == 2
