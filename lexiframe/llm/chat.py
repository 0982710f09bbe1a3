"""Chat formatting with typed content parts, in DataFrame functions only.

A message has a role and an array of parts: text, image, audio or document.
A visitor flattens the parts in order: text is escaped, any other part becomes
a placeholder, and its reference and the tokens it will expand to are recorded
beside the string. Turns are marked by control strings:

    <|im_start|>role NEWLINE content<|im_end|> NEWLINE

Inside roles and texts a backslash is doubled, ``<|`` becomes ``<\\|``, and in
roles a line break becomes ``\\n``. Thus no content holds ``<|``, whatever it
says, and the escapes can be undone.

Null roles, texts, parts and part lists are empty; an unknown kind of part
becomes ``<|attachment|>`` and expands to nothing. Messages of the same turn
are ordered by role and content; repeated rows are repeated turns. A null
conversation id is a conversation of its own. Other columns are ignored, and
an empty table gives no conversations. A conversation becomes one string, so
one conversation must fit in a row, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
START_PATTERN = r"<\|im_start\|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens for each unit of a part: an image tile, a second of audio, a page of a document.
TOKENS_PER_UNIT = {"image": 256.0, "audio": 25.0, "document": 768.0}
PART = "struct<kind:string,text:string,ref:string,units:double>"


def text_parts(text: Column) -> Column:
    """The part list of a message that is one text."""
    nothing = F.lit(None)
    part = F.struct(F.lit("text").alias("kind"), text.alias("text"), nothing.cast("string").alias("ref"), nothing.cast("double").alias("units"))
    return F.array(part).cast(f"array<{PART}>")


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Undo ``escape`` and ``escape_role``; cut at doubled backslashes, no piece has another one than an escape's."""

    def piece(p: Column) -> Column:
        return F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))

    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def visit(part: Column) -> Column:
    """What a part adds to the string."""
    shown = reduce(lambda other, kind: F.when(part.kind == kind, F.lit(PLACEHOLDERS[kind])).otherwise(other), PLACEHOLDERS, F.lit("<|attachment|>"))
    return F.when(part.kind.isNull(), F.lit("")).when(part.kind == "text", escape(part.text)).otherwise(shown)


def expanded_tokens(part: Column) -> Column:
    rate = reduce(lambda other, kind: F.when(part.kind == kind, F.lit(TOKENS_PER_UNIT[kind])).otherwise(other), TOKENS_PER_UNIT, F.lit(0.0))
    return F.ceil(rate * F.coalesce(part.units, F.lit(1.0))).cast("long")


def format_chats(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row for each conversation: ``formatted`` and what refers into it.

    ``loss_spans`` are the contents of messages by ``loss_roles``: turn number,
    code points from the start of its block and of the string, and length.
    ``attachments`` has kind, reference, turn number, place among the message's
    parts and expanded tokens of each part that isn't text, in order;
    ``attachment_tokens`` is their sum.
    """
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    content = F.array_join(F.transform(parts, visit), "")
    head = F.concat(F.lit(START), escape_role(F.col(role_col)), F.lit("\n"))

    def attachment(part: Column, at: Column) -> Column:
        return F.struct(part.kind.alias("kind"), part.ref.alias("ref"), at.cast("int").alias("part"), expanded_tokens(part).alias("tokens"))

    rows = messages.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.concat(head, content, F.lit(END + "\n")).alias("block"),
        F.length(head).cast("long").alias("head_chars"),
        F.length(content).cast("long").alias("content_chars"),
        F.filter(F.transform(parts, attachment), lambda a: a.kind != "text").alias("attached"),
    )
    turns = Window.partitionBy("conv").orderBy("turn", "role", "block")
    numbered = rows.select(
        "*",
        (F.row_number().over(turns) - 1).alias("n"),
        F.coalesce(F.sum(F.length("block")).over(turns.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
    )
    loss = F.struct("n", F.col("head_chars").alias("offset"), (F.col("start") + F.col("head_chars")).alias("start"), F.col("content_chars").alias("length"))
    attached = F.transform("attached", lambda a: F.struct(F.col("n"), a.part.alias("part"), a.kind.alias("kind"), a.ref.alias("ref"), a.tokens.alias("tokens")))
    gathered = numbered.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("n", "block"))).alias("blocks"),
        F.sort_array(F.collect_list(F.when(F.col("role").isin(*loss_roles), loss))).alias("loss_spans"),
        F.sort_array(F.flatten(F.collect_list(F.when(F.size("attached") > 0, attached)))).alias("attachments"),
    )
    return gathered.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.col("blocks.block"), "").alias("formatted"),
        "loss_spans",
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a.tokens).alias("attachment_tokens"),
    )


def blocks_of(formatted: Column) -> Column:
    """The string cut where turns begin, without the start marks."""
    parts = F.split(formatted, START_PATTERN)
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))


def read_turns(formatted: Column) -> Column:
    """Role and content of every turn, unescaped, in order; placeholders stay as they are."""

    def turn(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        content = F.substr(block, F.length(role) + 2, F.length(block) - F.length(role) - 2 - len(END))
        return F.struct(unescape(role).alias("role"), unescape(content).alias("text"))

    return F.transform(blocks_of(formatted), turn)


def masked_text(formatted: Column, loss_spans: Column) -> Column:
    """All contents under the loss mask, unescaped, one after another; each span is cut from its own block."""
    blocks = blocks_of(formatted)

    def cut_out(span: Column) -> Column:
        return F.substr(F.get(blocks, span.n), (span.offset - len(START) + 1).cast("int"), span.length.cast("int"))

    return F.array_join(F.transform(loss_spans, lambda s: unescape(cut_out(s))), "")
