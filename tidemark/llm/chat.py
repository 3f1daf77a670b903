"""Chat messages with typed parts, as marked text with a loss mask.

A message is a row: conversation, turn, role and an array of parts. A part has a type (text,
image, audio or document) and what its type needs. A visitor turns the parts of a message, in
their order, into text; anything but text becomes a placeholder, a reference to its attachment and
the number of tokens it will be expanded to. Control strings inside texts and roles are escaped so
that they can be told from the marks of the template, and can be restored.

A turn is formatted as ``<|im_start|>role LF content<|im_end|> LF``. Null text, role or parts are
empty; a part of an unknown type becomes a placeholder of no tokens. Rows of one conversation
follow turn, role and content, null turns first; repeated rows are repeated turns; rows without a
conversation form one of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    r"""``<|`` becomes ``<\|``, and one backslash more for each that stands there already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    r"""A role is one line: backslash as ``\\``, line feed as ``\n``, then as any text."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    halves = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(halves, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def part_tokens(part: Column, tile: int = 512, per_tile: int = 256, per_second: int = 25, per_page: int = 1024) -> Column:
    """Tokens that a part is expanded to: tiles of an image, seconds of sound, pages of a document; null counts as 0."""
    tiles = F.ceil(F.coalesce(part["width"], F.lit(0)) / tile) * F.ceil(F.coalesce(part["height"], F.lit(0)) / tile)
    count = (
        F.when(part["type"] == "image", tiles * per_tile)
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * per_second))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * per_page)
        .otherwise(F.lit(0)))
    return F.greatest(count.cast("long"), F.lit(0).cast("long"))


def placeholder(part: Column) -> Column:
    return F.concat(F.lit("<|"), F.when(part["type"].isin("image", "audio", "document"), part["type"]).otherwise("unknown"), F.lit("|>"))


def visit(part: Column) -> Column:
    """The text of a part."""
    return F.when(part["type"] == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(placeholder(part))


def text_part(text: Column) -> Column:
    """A message of one text, as parts."""
    none = [F.lit(None).cast(t).alias(n) for n, t in (
        ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *none))


def format_turns(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """conv_id, turn, role, parts -> a row for each turn, formatted.

    ``formatted`` is the text of the turn. ``loss`` are the spans of it that are learned, as
    (start, length) in code points: the content of the ``trained`` role, without marks.
    ``attachments`` are (position, type, ref, tokens) of what is not text, in order; null refs stay.
    """
    # A null part is none.
    parts = F.coalesce(F.filter("parts", lambda p: p.isNotNull()), F.array().cast(f"array<{PART}>"))
    base = messages.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("_role"), parts.alias("_parts"))
    head = F.concat(F.lit(START), escape_role(F.col("_role")), F.lit("\n"))
    content = F.array_join(F.transform("_parts", visit), "")
    attached = F.filter(
        F.transform("_parts", lambda p, i: F.struct(
            i.alias("position"), p["type"].alias("type"), p["ref"].alias("ref"), part_tokens(p).alias("tokens"))),
        lambda a: ~a["type"].eqNullSafe(F.lit("text")))
    span = F.array(F.struct((F.length("_head") + 1).alias("start"), F.length("_content").alias("length")))
    made = base.select("conv_id", "turn", "_role", head.alias("_head"), content.alias("_content"), attached.alias("attachments"))
    return made.select(
        "conv_id", "turn", F.concat("_head", "_content", F.lit(END + "\n")).alias("formatted"),
        F.when(F.col("_role") == trained, span).otherwise(F.array().cast("array<struct<start:int,length:int>>")).alias("loss"),
        "attachments", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"))


def read_turns(turns: DataFrame) -> DataFrame:
    """What the formatted turns say: role and text unescaped, and the text under the loss mask."""
    piece = F.regexp_extract("formatted", r"(?s)^<\|im_start\|>(.*)<\|im_end\|>\n$", 1)
    cut = F.instr("_piece", "\n")
    return turns.select("*", piece.alias("_piece")).select(
        "conv_id", "turn", "formatted",
        unescape_role(F.substring("_piece", F.lit(1), cut - 1)).alias("role"),
        unescape(F.substring("_piece", cut + 1, F.length("_piece"))).alias("text"),
        F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"], s["length"]))), "").alias("loss_text"))


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its formatted turns.

    A digest covers a conversation as a whole, so its turns meet in one row; only their texts
    travel, and only they are held.
    """
    read = read_turns(turns).select(
        "conv_id", F.col("turn").alias("_turn"), F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("said"),
        "loss_text", F.length("formatted").cast("long").alias("n"))
    grouped = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("_turn", "said", "loss_text"))).alias("t"), F.sum("n").alias("formatted_chars"))
    joined = lambda name: F.array_join(F.col(f"t.{name}"), "")
    return grouped.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(joined("said"), 256).alias("turns_sha256"),
        F.length(joined("loss_text")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss_text"), 256).alias("loss_sha256"), "formatted_chars")
