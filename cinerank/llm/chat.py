"""Conversations rebuilt from an event log and rendered with a chat template; DataFrame functions only.

An event has conv_id, message, seq, kind, role and text.  ``seq`` may have any orderable type.  Kinds:
``start`` opens a message, ``delta`` appends its text, ``edit`` replaces the message's text by its own, and
``regenerate`` throws the text so far away.  A message's final text is that of its last start, edit or
regenerate followed by the later deltas, in order of seq (ties: kind, then text).  Messages stand in order of
their first event (ties: the message's key).

Nulls: a null text or role is empty, a null kind counts as ``delta``, null keys group together and null seq sorts
first.  Empty tables give no rows; columns besides these are ignored.

The template marks each turn as ``<|turn|>role\\ntext<|end|>\\n``.  In roles and texts ``&``, ``<`` and ``[`` (and
line feeds in roles) are written as character references, so no text can hold a mark, and undoing that gives the
text back exactly.  ``loss`` has one run for each turn: characters skipped from the turn's start, then characters
under the mask (the text of assistant turns, else none).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
_RESETS = ("start", "edit", "regenerate")


def escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescape(c: Column) -> Column:
    for a, b in (("[", "&#91;"), ("<", "&lt;"), ("&", "&amp;")):
        c = F.replace(c, F.lit(b), F.lit(a))
    return c


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, message, first (seq of its first event), role and text of each message.

    Shuffled by conversation and message, so that the messages of one long conversation fold in many tasks.
    """
    e = F.struct("seq", F.coalesce("kind", F.lit("delta")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))
    log = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(e)).alias("log"))
    resets = F.filter("log", lambda x: x["kind"].isin(*_RESETS))
    last = F.element_at(F.transform(resets, lambda x: x["seq"]), -1)
    has = F.size(resets) > 0
    live = F.filter("log", lambda x: F.when(has & (x["seq"] < last), F.lit(False)).otherwise(True))
    # events at the seq of the last reset that sort before it belong to what it replaced
    at = F.array_position(F.transform(live, lambda x: x["seq"].eqNullSafe(last) & x["kind"].eqNullSafe(F.element_at(resets, -1)["kind"])), True)
    live = F.when(has & (at > 0), F.slice(live, at.cast("int"), F.size(live))).otherwise(live)
    text = F.array_join(F.transform(live, lambda x: F.when(x["kind"].isin("start", "delta", "edit"), x["text"]).otherwise("")), "")
    role = F.element_at(F.concat(F.filter(F.transform("log", lambda x: x["role"]), lambda r: r != ""), F.array(F.lit(""))), 1)
    return log.select("conv_id", "message", F.element_at("log", 1)["seq"].alias("first"), role.alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted (string) and loss (array of skip and take) of each conversation."""
    head = F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    body = escape(F.col("text"))
    turn = F.struct(
        "first", "message", F.concat(head, body, F.lit(END)).alias("block"), F.length(head).alias("skip"),
        F.when(F.col("role") == "assistant", F.length(body)).otherwise(0).alias("take"),
    )
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return turns.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["skip"].alias("skip"), t["take"].alias("take"))).alias("loss"),
    )


def format_conversations(events: DataFrame) -> DataFrame:
    return render(fold_events(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (array of role and text) and loss_text, all taken from the rendered string and its mask."""
    blocks = F.slice(F.split("formatted", r"<\|end\|>\n", -1), 1, F.greatest(F.lit(0), F.size(F.split("formatted", r"<\|end\|>\n", -1)) - 1))
    inner = F.transform(blocks, lambda b: F.substring(b, len(TURN) + 1, 0x7FFFFFFF))
    turns = F.transform(inner, lambda b: F.struct(
        F.replace(unescape(F.substring_index(b, "\n", 1)), F.lit("&#10;"), F.lit("\n")).alias("role"),
        unescape(F.substring(b, F.locate("\n", b) + 1, F.lit(0x7FFFFFFF))).alias("text"),
    ))
    masked = F.zip_with(blocks, "loss", lambda b, m: unescape(F.substring(b, m["skip"] + 1, m["take"])))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def events_of_rows(rows: DataFrame) -> DataFrame:
    """The event log of a table with a row a turn: a start and the text as two streamed deltas.

    Rows with one turn number stay apart, ordered by role and sha256 of the text; equal rows count as often as
    they occur.
    """
    n = rows.groupBy("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).agg(F.count(F.lit(1)).alias("n"))
    each = n.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    half = F.floor(F.length("text") / 2).cast("int")
    part = lambda i, kind, text: F.struct(F.lit(i).alias("part"), F.lit(kind).alias("kind"), text.alias("text"))
    parts = F.array(part(0, "start", F.lit("")), part(1, "delta", F.substring("text", F.lit(1), half)), part(2, "delta", F.substring("text", half + 1, F.length("text"))))
    key = F.struct("turn", "role", F.sha2("text", 256).alias("digest"), "k")
    return each.select("conv_id", key.alias("message"), "role", F.explode(parts).alias("p")).select(
        "conv_id", "message", F.struct("message", "p.part").alias("seq"), F.col("p.kind").alias("kind"), "role", F.col("p.text").alias("text"),
    )
