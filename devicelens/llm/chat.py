"""Chat formatting: turns of typed content parts become one marked text with a loss mask, attachments and token counts.

A turn is an array of parts. A visitor looks at each part by its kind and gives what the template needs of it: an
escaped text, or a placeholder with the reference and the number of tokens that will stand in its place. Everything is column
expressions; a turn is formatted on its own row, and only :func:`format_conversations` brings the turns of a conversation together.

``<|`` stands in the output in markers and placeholders only. In texts one backslash is put between ``<`` and ``|`` (one more, if
there are some), so the escape takes nothing away and :func:`unescape` gives every text back.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns of a part that the visitor reads; a part may lack all but ``kind``, and may have others.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
_SPAN = "array<struct<from:int,to:int>>"
_ATTACHED = "array<struct<kind:string,ref:string,tokens:bigint>>"


def image_tokens(part: Column) -> Column:
    """One token per patch of 28 by 28 points, rounded up on both sides; one if the size is not known."""
    across, down = F.ceil(part["width"] / 28), F.ceil(part["height"] / 28)
    return F.greatest(F.coalesce(across * down, F.lit(1)), F.lit(1)).cast("long")


def audio_tokens(part: Column) -> Column:
    """25 tokens per second, rounded up; one if the length is not known."""
    return F.greatest(F.coalesce(F.ceil(F.when(part["seconds"] < 1e12, part["seconds"]) * 25), F.lit(1)), F.lit(1)).cast("long")


def document_tokens(part: Column) -> Column:
    """256 tokens per page; one if the number of pages is not known."""
    return F.greatest(F.coalesce(part["pages"].cast("long") * 256, F.lit(1)), F.lit(1)).cast("long")


@dataclass(frozen=True)
class Template:
    """Markers of a turn, the roles that are learnt, and the kinds of attachment with their token counts."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    learnt: tuple[str, ...] = ("assistant",)
    attachments: Mapping[str, object] = field(default_factory=lambda: {"image": image_tokens, "audio": audio_tokens, "document": document_tokens})

    def placeholder(self, kind: str) -> str:
        return f"<|{kind}|>"


CHATML = Template()


def escape(text: Column) -> Column:
    """The text without ``<|``; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    """What :func:`escape` was given."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role on one line and without ``<|``."""
    return escape(F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    pieces = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(pieces, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def visit(part: Column, template: Template) -> Column:
    """What the template needs of one part: ``out``, whether it is ``text``, and the attachment (null for text).

    A part of a kind that the template does not know is read as text; a part that is null is the empty text.
    """
    kind = F.lower(part["kind"])
    out, tokens = escape(part["text"]), F.lit(None).cast("long")
    for name, count in template.attachments.items():
        out = F.when(kind == name, F.lit(template.placeholder(name))).otherwise(out)
        tokens = F.when(kind == name, count(part)).otherwise(tokens)
    attached = kind.isin(*template.attachments)
    return F.struct(
        out.alias("out"),
        (~F.coalesce(attached, F.lit(False)) & (out != "")).alias("text"),
        F.when(attached, F.struct(kind.alias("kind"), part["ref"].alias("ref"), tokens.alias("tokens"))).alias("attachment"),
    )


def text_parts(text: Column) -> Column:
    """A turn that has only a text, as an array of one part."""
    missing = [F.lit(None).cast(t).alias(n) for n, t in (f.split(":") for f in PART[7:-1].split(",")[2:])]
    return F.array(F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"), *missing))


def render(role: Column, body: Column, template: Template = CHATML) -> Column:
    """A turn between its markers; ``body`` is escaped already."""
    return F.concat(F.lit(template.start), escape_role(role), F.lit("\n"), body, F.lit(template.end + "\n"))


def format_turns(rows: DataFrame, template: Template = CHATML, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None) -> DataFrame:
    """``conv_id, turn, role, body, loss, attachments, formatted``: every turn as it will stand in its conversation.

    ``body`` is what stands between the markers, ``formatted`` the turn with them. ``loss`` lists the stretches of ``body`` (code
    points from its start) that are to be learnt: each text of a turn whose role is learnt, without placeholders. ``attachments``
    lists kind, reference and number of tokens in the order of the placeholders. The content is column ``parts`` (array of
    :data:`PART`) if it is named and not null, else ``text``. A null role or text is empty; a null turn comes before the others, a
    null conversation is one of its own. Repeated rows are turns of their own, and further columns are left out. No shuffle.
    """
    content = text_parts(F.col(text)) if text in rows.columns else F.array().cast(f"array<{PART}>")
    if parts is not None:
        content = F.coalesce(F.col(parts).cast(f"array<{PART}>"), content)
    made = rows.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.transform(content, lambda p: visit(p, template)).alias("seen"),
    )
    step = lambda done, p: F.struct(
        (done["at"] + F.length(p["out"])).alias("at"),
        F.when(p["text"], F.concat(done["spans"], F.array(F.struct(done["at"].alias("from"), (done["at"] + F.length(p["out"])).alias("to"))))).otherwise(done["spans"]).alias("spans"),
    )
    spans = F.aggregate("seen", F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans")), step, lambda done: done["spans"])
    turns = made.select(
        "conv_id",
        "turn",
        "role",
        F.array_join(F.transform("seen", lambda p: p["out"]), "").alias("body"),
        F.when(F.col("role").isin(*template.learnt), spans).otherwise(F.array().cast(_SPAN)).alias("loss"),
        F.transform(F.filter("seen", lambda p: p["attachment"].isNotNull()), lambda p: p["attachment"]).cast(_ATTACHED).alias("attachments"),
    )
    return turns.withColumn("formatted", render(F.col("role"), F.col("body"), template))


def format_conversations(rows: DataFrame, template: Template = CHATML, **columns: str | None) -> DataFrame:
    """``conv_id, formatted, loss, attachments, n_turns, attached_tokens``: one row per conversation.

    Turns stand in the order of ``turn``; equal ones in that of their role, then of their body. ``loss`` has one array per turn, as
    :func:`format_turns` gives it. Turns of a conversation are gathered before the shuffle, so a conversation with very many
    turns reaches its task as a few long rows; it must fit into a row, as its text does. Columns as in :func:`format_turns`.
    An empty table gives no rows.
    """
    turns = format_turns(rows, template, **columns)
    kept = F.struct("turn", "role", "body", "loss", "attachments")
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(kept)).alias("turns"))
    attached = F.flatten("turns.attachments")
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: render(t["role"], t["body"], template)), "").alias("formatted"),
        F.col("turns.loss").alias("loss"),
        attached.alias("attachments"),
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("attached_tokens"),
    )


def _turns_of(formatted: Column, template: Template) -> Column:
    """The turns of a formatted text, each from its start marker up to its end marker."""
    quoted = "\\Q" + template.end + "\\E\n"
    pieces = F.split(formatted, quoted)
    return F.slice(pieces, 1, F.size(pieces) - 1)


def read_conversations(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """``conv_id, turns, learnt``: what :func:`format_conversations` was given, read from ``formatted`` and ``loss`` alone.

    ``turns`` has role, text and the still escaped ``body`` of every turn. Where a turn has attachments, only the body tells
    their placeholders from texts that look so: use :func:`read_parts`. ``learnt`` has the texts under the loss mask, in order.
    """
    line = lambda t: F.substring_index(t, "\n", 1)
    body = lambda t: F.substr(t, F.length(line(t)) + 2)
    role = lambda t: unescape_role(F.substr(line(t), F.lit(len(template.start) + 1)))
    read = formatted.select("conv_id", "loss", F.transform(_turns_of(F.col("formatted"), template), lambda t: F.struct(role(t).alias("role"), body(t).alias("body"))).alias("raw"))
    under = lambda t, spans: F.transform(spans, lambda s: unescape(F.substr(t["body"], s["from"] + 1, s["to"] - s["from"])))
    return read.select(
        "conv_id",
        F.transform("raw", lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text"), t["body"].alias("body"))).alias("turns"),
        F.flatten(F.zip_with("raw", "loss", under)).alias("learnt"),
    )


def read_parts(body: Column, attachments: Column, template: Template = CHATML) -> Column:
    """The parts of one turn's body: texts unescaped, placeholders with the kind, reference and tokens of their attachment.

    Empty texts are left out; neighbouring texts come back as one.
    """
    kinds = "|".join(template.attachments)
    texts = F.split(body, rf"<\|(?:{kinds})\|>")
    empty = F.struct(F.lit("").alias("kind"), F.lit("").alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens"))
    as_text = lambda t: F.struct(F.lit("text").alias("kind"), unescape(t).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens"))
    as_part = lambda a: F.struct(a["kind"].alias("kind"), F.lit(None).cast("string").alias("text"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))
    pairs = F.zip_with(texts, attachments, lambda t, a: F.array(F.when(t != "", as_text(t)).otherwise(empty), F.when(a.isNotNull(), as_part(a)).otherwise(empty)))
    return F.filter(F.flatten(pairs), lambda p: p["kind"] != "")
