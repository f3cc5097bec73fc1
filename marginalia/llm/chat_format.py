"""Chat formatting with typed content parts.

A message is a list of parts (text, image, audio, document).  A visitor over
the parts writes text escaped and every other part as a numbered placeholder,
and records the attachment's reference and the tokens its placeholder expands
to.  Everything is a DataFrame or SQL function.

Template, one turn after the other::

    <turn>ROLE\\nBODY</turn>\\n

Every control string starts with ``<``.  Inside texts and roles ``\\`` becomes
``\\b``, ``<`` becomes ``\\l`` and (roles only) a line feed becomes ``\\n``, so no
text can hold a control string, and the escape is undone by three plain
replacements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
#: What a turn's parts column holds.
PARTS = "array<struct<type: string, text: string, ref: string, units: long>>"
#: Tokens that one unit of an attachment expands to: an image tile, a second of audio, a page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undo :func:`escape`: in escaped text every backslash starts one of two pairs."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """A parts column of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units"))).cast(PARTS)


def format_chats(turns: DataFrame, tokens_per_unit: dict[str, int] | None = None, learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, expanded_tokens.

    ``turns`` has conv_id, turn, role and parts (type :data:`PARTS`); other
    columns are ignored.  ``loss_spans`` are (start, length) in characters of
    ``formatted``: the bodies of the turns whose role is ``learn``, in order.
    ``attachments`` lists (turn_no, part_no, type, ref, tokens) in order, and
    ``expanded_tokens`` is their sum.  A part of any type but text becomes
    ``<type:k>``, k counting the conversation's attachments from 0; an unknown type
    counts no tokens.

    Turns are ordered by (turn, role, parts), nulls first, so ties and repeated rows come
    out alike in every run (repeats are kept).  Null roles and texts are
    empty, null parts are no parts, a null conv_id is a conversation of its own,
    and an empty table gives no rows.

    Escaping and flattening are done per turn, before the shuffle.  Then a
    conversation is one row, because its formatted text is one value.
    """
    per_unit = TOKENS_PER_UNIT if tokens_per_unit is None else tokens_per_unit
    rate = F.create_map(*[F.lit(x) for kv in per_unit.items() for x in kv]) if per_unit else F.create_map().cast("map<string,int>")
    none = F.array().cast(PARTS)

    def is_text(p: Column) -> Column:
        return F.coalesce(p["type"], F.lit("text")) == "text"

    def visit(p: Column) -> Column:
        """Text escaped; an attachment as a mark that holds no text, numbered later."""
        return F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<"), escape_role(p["type"]), F.lit(":>")))

    def attachment(p: Column, k: Column) -> Column:
        return F.when(~is_text(p), F.struct(
            k.alias("part_no"), p["type"].alias("type"), p["ref"].alias("ref"),
            F.coalesce(F.try_element_at(rate, p["type"]).cast("long") * F.coalesce(p["units"], F.lit(1)), F.lit(0)).alias("tokens")))

    parts = F.filter(F.coalesce(F.col("parts").cast(PARTS), none), lambda p: p.isNotNull())
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    flat = turns.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), parts.alias("parts"),
    ).select(
        "conv_id", F.struct(
            "turn", "role", F.transform("parts", visit).alias("pieces"),
            F.filter(F.transform("parts", attachment), lambda a: a.isNotNull()).alias("attached")).alias("t"))
    conv = flat.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    # a running count over the turns numbers the placeholders
    attached = F.flatten(F.transform("ts", lambda t, i: F.transform(t["attached"], lambda a: F.struct(
        i.cast("long").alias("turn_no"), a["part_no"].cast("long").alias("part_no"), a["type"].alias("type"),
        a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    conv = conv.select("conv_id", "ts", attached.alias("attachments"))
    conv = conv.withColumn("_before", F.transform("ts", lambda t, i: F.size(F.filter("attachments", lambda a: a["turn_no"] < i))))

    def body(t: Column, before: Column) -> Column:
        def one(k: Column) -> Column:
            piece = F.element_at(t["pieces"], k)
            is_mark = piece.endswith(":>") & piece.startswith("<")
            nth = before + F.size(F.filter(t["attached"], lambda a: a["part_no"] < k - 1))
            return F.when(is_mark, F.concat(piece.substr(F.lit(1), F.char_length(piece) - 1), nth.cast("string"), F.lit(">"))).otherwise(piece)

        return F.when(F.size(t["pieces"]) == 0, F.lit("")).otherwise(
            F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.size(t["pieces"]), F.lit(1))), one), ""))

    turn_rows = F.zip_with("ts", "_before", lambda t, n: F.struct(
        t["role"].alias("role"),
        F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n")).alias("head"), body(t, n).alias("body")))
    conv = conv.select("conv_id", "attachments", turn_rows.alias("ts"))
    # lengths, then starts: a fold over (position, spans)
    spans = F.aggregate(
        "ts", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: long, length: long>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(t["head"]) + F.char_length(t["body"]) + len(CLOSE)).cast("long").alias("at"),
            F.when(t["role"] == learn, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.char_length(t["head"])).cast("long").alias("start"), F.char_length(t["body"]).cast("long").alias("length")))))
            .otherwise(acc["spans"]).alias("spans")))["spans"]
    return conv.select(
        "conv_id", F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("formatted"),
        spans.alias("loss_spans"), "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> parsed from the formatted text (placeholders stay in the text)."""
    turns = F.slice(F.split(formatted, CLOSE), F.lit(1), F.size(F.split(formatted, CLOSE)) - 1)

    def one(t: Column) -> Column:
        line = F.instr(t, "\n")
        return F.struct(unescape_role(t.substr(F.lit(len(OPEN) + 1), line - len(OPEN) - 1)).alias("role"),
                        unescape(t.substr(line + 1, F.char_length(t))).alias("text"))

    return F.transform(turns, one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        formatted.substr((s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
