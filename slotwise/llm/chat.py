"""Chat formatting (op 6): event-sourced reconstruction of conversations, in DataFrame functions only.

An event log has rows (conv_id, seq, message, kind, role, text). Kinds: `delta` appends text to a message, `edit`
replaces what it says so far, `regenerate` empties it. The log is partitioned by conversation and message and sorted by
sequence; what comes after the last reset is the message's final text. Messages are then put in the order of their
first event and rendered.

Template: `<s>` role `[INST]` text `[/INST]</s>` for each turn. Inside roles and texts, every control string gets a
backslash after its first character, and every already escaped one gets one more, so that unescaping is exact.

Defined results: null texts and null roles are empty; events without a sequence come first; equal sequences are ordered
by kind, role and text; repeated rows of a table of turns are turns of their own; rows without a conversation id form
one conversation; extra columns are dropped; an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import pick

CONTROLS = r"(?:/?s>|/?INST\])"  # fixed values, without their first character
OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "[/INST]</s>"
_PLAIN = rf"([<\[])(\\*)({CONTROLS})"
_ESCAPED = rf"([<\[])\\(\\*)({CONTROLS})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def turn_events(turns: DataFrame) -> DataFrame:
    """The event log that would have led to a table of turns (conv_id, turn, role, text).

    Every text arrives in two deltas. An assistant's first attempt is thrown away by a regeneration; a user's turn is
    first typed in part and then replaced by an edit.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    text = F.coalesce("text", F.lit(""))
    half = (F.length(text) / 2).cast("int")
    first, second = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))

    def event(step: int, kind: str, part: Column) -> Column:
        return F.struct((F.col("message") * 4 + step).alias("seq"), F.lit(kind).alias("kind"), part.alias("text"))

    draft = event(0, "delta", second)
    reply = F.array(draft, event(1, "regenerate", F.lit("")), event(2, "delta", first), event(3, "delta", second))
    typed = F.array(draft, event(1, "edit", first), event(2, "delta", second))
    events = rows.select("conv_id", "message", "role", F.explode(F.when(F.col("role") == "assistant", reply).otherwise(typed)).alias("e"))
    return events.select("conv_id", "message", "role", "e.seq", "e.kind", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, first, message, role, text): the final text of every message."""
    rows = pick(events, "conv_id", "seq", "message", "kind", "role", "text")
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("role", F.coalesce("role", F.lit("")))
    parts = F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("parts")
    logs = rows.groupBy("conv_id", "message").agg(parts)
    indexed = F.transform("parts", lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    resets = F.transform(F.filter(indexed, lambda x: x["p"]["kind"] != "delta"), lambda x: x["i"])
    logs = logs.withColumn("from", F.coalesce(F.array_max(resets), F.lit(-1)))
    counts = F.filter(indexed, lambda x: (x["i"] > F.col("from")) | ((x["i"] == F.col("from")) & (x["p"]["kind"] == "edit")))
    text = F.array_join(F.transform(counts, lambda x: x["p"]["text"]), "")
    start = F.col("parts")[0]
    return logs.select("conv_id", start["seq"].alias("first"), "message", start["role"].alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the rendered conversation and the code-point spans (start, length) of assistant text."""
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    turns = messages.select("conv_id", "first", "message", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("learn"))
    turns = turns.withColumn("length", F.length("head") + F.length("body") + F.lit(len(CLOSE)))
    before = Window.partitionBy("conv_id").orderBy("first", "message").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("int"))
    turn = F.struct("first", "message", "start", "head", "body", "learn")
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    span = lambda t: F.struct((t["start"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))
    loss = F.transform(F.filter("turns", lambda t: t["learn"]), span)
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return whole.select("conv_id", formatted.alias("formatted"), loss.alias("loss"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, learned): turns (role, text) parsed from the formatted text, and the text under the loss mask."""
    parts = F.split("formatted", r"<s>")
    parts = F.slice(parts, 2, F.size(parts))

    def turn(part: Column) -> Column:
        halves = F.split(F.substring(part, F.lit(1), F.length(part) - len(CLOSE)), r"\[INST\]")
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return rendered.select("conv_id", "formatted", F.transform(parts, turn).alias("turns"), F.array_join(learned, "").alias("learned"))


def conversations_table(events: DataFrame) -> DataFrame:
    return render(fold(events))
