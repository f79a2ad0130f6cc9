"""Chat formatting from an event log, with DataFrame functions only.

A conversation is a log of events ordered by ``seq``:

* ``delta`` adds text to the message of its turn;
* ``edit`` replaces the message of its turn and voids all later turns so far;
* ``regenerate`` does the same for an answer that is made anew.

``fold`` turns logs into final messages, ``render`` messages into one text per
conversation with a loss mask, ``read_back`` a rendered text into messages.

Defined cases: a null text or role counts as empty; events without a
conversation share the null conversation; events equal in ``seq`` are taken by turn, kind and
text; a turn all of whose events are void does not exist; an empty log gives no row.
A conversation becomes one text, so one row holds a whole conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The template: "### " role ": " text " </turn>" and a line end, per turn.
# '\', '#' and '<' of a text are written as '\\', '\h' and '\l', so neither
# control string can occur in an escaped text.
HEAD, COLON, TAIL = "### ", ": ", " </turn>\n"
RESETS = ("edit", "regenerate")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("#"), F.lit("\\h"))
    return F.replace(out, F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undo ``escape``; pairs of backslashes are cut out before the letters are read."""

    def letters(part: Column) -> Column:
        part = F.replace(part, F.lit("\\h"), F.lit("#"))
        return F.replace(part, F.lit("\\l"), F.lit("<"))

    parts = F.split(text, r"\\\\")
    return F.array_join(F.transform(parts, letters), "\\")


def escape_role(role: Column) -> Column:
    """As ``escape``; a colon becomes '\\c', so that the first colon ends the role."""
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    def letters(part: Column) -> Column:
        part = F.replace(part, F.lit("\\c"), F.lit(":"))
        part = F.replace(part, F.lit("\\h"), F.lit("#"))
        return F.replace(part, F.lit("\\l"), F.lit("<"))

    return F.array_join(F.transform(F.split(role, r"\\\\"), letters), "\\")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of logs (conv_id, seq, turn, kind, role, text).

    An event is void when a later edit or regeneration of its turn or an
    earlier one exists. The role is that of the first event that counts.
    """
    resets = F.when(F.col("kind").isin(*RESETS), F.col("turn"))
    later = (
        W.partitionBy("conv_id")
        .orderBy(F.desc("seq"), F.desc("turn"), F.desc("kind"), F.desc("text"))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    voided = F.min(resets).over(later)
    counted = events.withColumn("_void", voided).where(
        F.col("_void").isNull() | (F.col("_void") > F.col("turn"))
    )
    place = F.struct(
        "seq",
        "kind",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("role", F.lit("")).alias("role"),
    )
    pieces = F.sort_array(F.collect_list(place))
    return counted.groupBy("conv_id", "turn").agg(pieces.alias("_pieces")).select(
        "conv_id",
        "turn",
        F.col("_pieces")[0]["role"].alias("role"),
        F.array_join(F.col("_pieces.text"), "").alias("text"),
    )


def render(messages: DataFrame, learned: str = "assistant") -> DataFrame:
    """One text per conversation: (conv_id, formatted, mask).

    ``mask`` lists (start, length) in code points of the formatted text, one
    span per message of the learned role, over its escaped text alone.
    """
    body = escape(F.coalesce("text", F.lit("")))
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(HEAD), escape_role(role), F.lit(COLON))
    turn = F.struct(
        "turn",
        role.alias("role"),
        head.alias("head"),
        body.alias("body"),
    )
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    # Integer lengths are folded, so the fold copies no text.
    sizes = F.transform(
        "_turns",
        lambda t: F.struct(
            F.length(t["head"]).alias("head"),
            F.length(t["body"]).alias("body"),
            (t["role"] == learned).alias("learned"),
        ),
    )
    start = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,length:int>>").alias("spans"),
    )

    def step(acc: Column, t: Column) -> Column:
        span = F.struct(
            (acc["at"] + t["head"]).cast("int").alias("start"), t["body"].alias("length")
        )
        return F.struct(
            (acc["at"] + t["head"] + t["body"] + F.lit(len(TAIL))).cast("int").alias("at"),
            F.when(t["learned"], F.concat(acc["spans"], F.array(span)))
            .otherwise(acc["spans"])
            .alias("spans"),
        )

    written = F.transform("_turns", lambda t: F.concat(t["head"], t["body"], F.lit(TAIL)))
    return turns.select(
        "conv_id",
        F.array_join(written, "").alias("formatted"),
        F.aggregate(sizes, start, step)["spans"].alias("mask"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, formatted, messages, learned): messages as parsed, learned text by the mask."""
    lines = F.filter(F.split("formatted", TAIL), lambda part: part != "")

    def message(line: Column) -> Column:
        role = F.substring_index(F.substr(line, F.lit(len(HEAD) + 1)), COLON, 1)
        text = F.substr(line, F.length(role) + F.lit(len(HEAD) + len(COLON) + 1))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    def masked(span: Column) -> Column:
        return unescape(F.substr("formatted", span["start"] + 1, span["length"]))

    return rendered.select(
        "conv_id",
        "formatted",
        F.transform(lines, message).alias("messages"),
        F.array_join(F.transform("mask", masked), "").alias("learned"),
    )


def turn_events(conversations: DataFrame, step: int = 400) -> DataFrame:
    """The log of a table of finished turns: each text streamed in deltas of ``step`` characters.

    Repeated rows of a turn are turns of their own, by role and text.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce("text", F.lit(""))
    numbered = conversations.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        text.alias("text"),
    )
    cuts = F.sequence(F.lit(0), F.floor(F.length("text") / F.lit(step)).cast("int"))
    return numbered.select("conv_id", "turn", "role", "text", F.explode(cuts).alias("_cut")).select(
        "conv_id",
        (F.col("turn") * (1 << 32) + F.col("_cut")).alias("seq"),
        "turn",
        F.lit("delta").alias("kind"),
        "role",
        F.substr("text", F.col("_cut") * step + 1, F.lit(step)).alias("text"),
    )
