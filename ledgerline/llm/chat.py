"""Chat formatting from logs of streamed messages.

A log holds events of conversations: deltas that append text to a message, edits that replace it,
and regenerations that discard it with everything after it and start it anew. Events are sorted by
their sequence number and folded into final messages; the messages are escaped, marked and joined
into one string per conversation, with the spans that a loss may look at.

Everything is a DataFrame function. Superseded events leave before texts are collected, and a
message is put together before its conversation is, so the only rows that hold a whole
conversation are those of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DELTA, EDIT, REGENERATE = "delta", "edit", "regenerate"
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    """Puts a backslash into every <| (and one more where there are some), so no marker is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """As :func:`escape`; line breaks become <n>, and a <n> of the role itself gets a backslash."""
    return escape(F.replace(F.regexp_replace(role, r"<(\\*)n>", r"<\\$1n>"), F.lit("\n"), F.lit("<n>")))


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(unescape(role), F.lit("<n>"), F.lit("\n")), r"<\\(\\*)n>", "<$1n>")


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of ``events``.

    ``events`` has conv_id, seq, message (the message's place in its conversation), kind, role and
    text. In the order of seq a delta appends, an edit replaces, and a regeneration empties its
    message and removes all later messages of that moment; its text, if any, is the first delta of
    the new try. A message's role is the last one given.

    * NULL text is empty, a NULL kind is a delta, NULL roles give an empty role.
    * Events of equal seq in a message are sorted by text; repeated events count as often as they occur.
    * NULL conversations and NULL messages are a conversation and a message of their own.
    * Messages with nothing but superseded events are gone. No events give no messages.
    """
    kind = F.coalesce("kind", F.lit(DELTA))
    messages = events.groupBy("conv_id", "message").agg(
        F.max(F.when(kind.isin(EDIT, REGENERATE), F.col("seq"))).alias("reset"),
        F.max(F.when(kind == REGENERATE, F.col("seq"))).alias("again"),
    )
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy(F.col("message").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    since = messages.select(
        F.col("conv_id").alias("__conv"),
        F.col("message").alias("__message"),
        F.col("reset").alias("__reset"),
        F.max("again").over(earlier).alias("__again"),
    )
    standing = events.join(since, _same("conv_id", "__conv") & _same("message", "__message")).filter(
        (F.col("__reset").isNull() | (F.col("seq") >= F.col("__reset")))
        & (F.col("__again").isNull() | (F.col("seq") > F.col("__again")))
    )
    pieces = F.sort_array(F.collect_list(F.struct("seq", F.coalesce("text", F.lit("")).alias("text"))))
    roles = F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role")))
    return standing.groupBy("conv_id", "message").agg(
        F.coalesce(roles["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame, loss_roles: Sequence[str] = LOSS_ROLES) -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, message, role, text): conv_id, formatted, loss_spans.

    A turn is the begin mark, the role, a line break, the text and the end mark, with control
    strings inside role and text escaped. ``loss_spans`` are the texts of ``loss_roles`` in order,
    as start and length in code points and in bytes of the formatted string, counted from 0.
    """
    head = F.concat(F.lit(BEGIN), escape_role(F.col("role")), F.lit("\n"))
    turns = messages.select("conv_id", "message", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    before = (
        Window.partitionBy("conv_id")
        .orderBy(F.col("message").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def start(length) -> Column:
        whole = length(F.col("head")) + length(F.col("body")) + F.lit(len(END))
        return F.coalesce(F.sum(whole).over(before), F.lit(0)) + length(F.col("head"))

    span = F.struct(
        start(F.char_length).alias("start"),
        F.char_length("body").alias("length"),
        start(F.octet_length).alias("first_byte"),
        F.octet_length("body").alias("bytes"),
    )
    placed = turns.select(
        "conv_id", "message", "head", "body", span.alias("span"), F.col("role").isin(*loss_roles).alias("in_loss")
    )
    ordered = F.sort_array(F.collect_list(F.struct("message", "head", "body", "span", "in_loss")))
    return placed.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["in_loss"]), lambda t: t["span"]).alias("loss_spans"),
    )


def format_events(events: DataFrame, loss_roles: Sequence[str] = LOSS_ROLES) -> DataFrame:
    """:func:`fold_events`, then :func:`render`."""
    return render(fold_events(events), loss_roles)


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted conversation."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    # nothing follows the last end mark
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        line = F.instr(part, "\n")
        return F.struct(
            unescape_role(F.substring(part, F.lit(len(BEGIN) + 1), line - 1 - len(BEGIN))).alias("role"),
            unescape(F.substring(part, line + 1, F.char_length(part))).alias("text"),
        )

    return F.transform(turns, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss spans, unescaped, with nothing in between."""

    def texts(raw: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: unescape(F.decode(F.substring(raw, (s["first_byte"] + 1).cast("int"), s["bytes"]), "UTF-8")),
            ),
            "",
        )

    # the bytes are bound once, not once per span
    return F.get(F.transform(F.array(F.encode(formatted, "UTF-8")), texts), 0)


def turn_events(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log in which every row is one delta.

    Rows are messages in the order of turn, role and text, NULLs first; repeated rows are messages
    of their own.
    """
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    place = F.row_number().over(order).cast("long")
    return rows.select(
        "conv_id", place.alias("seq"), place.alias("message"), F.lit(DELTA).alias("kind"), "role", "text"
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, as counts and digests."""
    turns = read_turns(F.col("formatted"))
    loss = read_loss(F.col("formatted"), F.col("loss_spans"))
    line = F.lit("\n")
    return formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "").cast("binary"), 256
        ).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
