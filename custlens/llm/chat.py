"""Chat formatting from event logs.

A conversation is a log of events ordered by sequence number.  Folding the
log gives the final messages; the messages are rendered with a template
that marks turns, and a loss mask covers the assistant texts.

Events: (conversation, seq, turn, kind, role, text) with kind

* ``message``: the turn's text starts anew with this text,
* ``delta``: streamed text, appended to the turn,
* ``edit``: the turn's text is replaced,
* ``regenerate``: the turn and all later turns recorded so far are void;
  what follows builds them again.

Template: ``<|role|>text<|end|>`` per turn.  In roles and texts ``\\\\``,
``<``, ``[`` and ``|`` are written as ``\\\\e``, ``\\\\l``, ``\\\\b`` and ``\\\\p``, so a text
can hold no control string of this or another template, and reading back
is exact.

Only DataFrame functions are used.  The fold is two windows over small
columns (numbers, not texts); texts meet once, in the conversation's row,
which is the result's own shape.

Defined cases: null texts and roles are empty; a null kind is a message;
events with equal seq are ordered by turn, kind, role and text, a null seq
comes first; a null turn comes before all others and is never void; a null
conversation id is a conversation; repeated rows are events of their own;
an empty log gives no row; extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
END = "<|end|>"


def escape(c: Column) -> Column:
    for raw, code in (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p")):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for raw, code in (("|", "\\p"), ("[", "\\b"), ("<", "\\l"), ("\\", "\\e")):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def fold(events: DataFrame) -> DataFrame:
    """Event log -> final messages (conv_id, turn, part, role, text): ``part`` tells
    apart several messages recorded for one turn."""
    e = events.select(
        "conv_id", "seq", "turn", F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("seq"), F.desc("turn"), F.desc("kind"), F.desc("role"), F.desc("text"))
    # void: a later event regenerates this turn or an earlier one
    redone = F.min(F.when(F.col("kind") == "regenerate", F.col("turn"))).over(later.rowsBetween(Window.unboundedPreceding, -1))
    live = e.withColumn("__redone", redone).where("(__redone IS NULL OR turn IS NULL OR turn < __redone) AND kind <> 'regenerate'").drop("__redone")
    # a message opens a part; an edit voids what its part held before
    order = Window.partitionBy("conv_id", "turn").orderBy("seq", "kind", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    live = live.withColumns({"part": F.sum(F.when(F.col("kind") == "message", 1).otherwise(0)).over(so_far),
                             "place": F.row_number().over(order)})
    piece = Window.partitionBy("conv_id", "turn", "part")
    live = live.withColumn("__edit", F.max(F.when(F.col("kind") == "edit", F.col("place"))).over(piece))
    live = live.where("__edit IS NULL OR place >= __edit")
    return live.groupBy("conv_id", "turn", "part").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("p")).select(
        "conv_id", "turn", "part", F.element_at("p", 1)["role"].alias("role"),
        F.concat_ws("", F.transform("p", lambda x: x["text"])).alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """Messages -> (conv_id, formatted, loss_mask): ``loss_mask`` has for every turn
    the place of its text in ``formatted`` (start from 0, length) and whether
    loss is taken on it."""
    head = F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>"))
    m = messages.select("conv_id", "turn", "part", head.alias("head"), escape(F.col("text")).alias("body"),
                        (F.col("role") == ASSISTANT).alias("loss"))
    before = Window.partitionBy("conv_id").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END)
    m = m.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    turn = F.struct("turn", "part", "head", "body", "start", F.length("body").alias("length"), "loss")
    rows = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return rows.select(
        "conv_id", F.concat_ws("", F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(END)))).alias("formatted"),
        F.transform("t", lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"), x["loss"].alias("loss"))).alias("loss_mask"))


def format_conversations(events: DataFrame) -> DataFrame:
    """Event log -> (conv_id, formatted, loss_mask)."""
    return render(fold(events))


def parse(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask) plus what is read back from them: turns
    array<struct<role, text>> and loss_text, the unescaped text under the mask.

    A turn's text ends where its segment ends, so the masked characters are
    the last ``length`` ones of the segment: every segment is read once."""
    cut = F.split("formatted", r"<\|end\|>", -1)
    f = formatted.withColumn("segments", F.slice(cut, F.lit(1), F.size(cut) - 1))
    turns = F.transform("segments", lambda s: F.struct(
        unescape(F.substring_index(s.substr(F.lit(3), F.length(s)), "|>", 1)).alias("role"),
        unescape(s.substr(F.locate("|>", s) + 2, F.length(s))).alias("text")))
    masked = F.filter(F.arrays_zip("segments", "loss_mask"), lambda z: z["loss_mask"]["loss"])
    loss = F.transform(masked, lambda z: F.right(z["segments"], z["loss_mask"]["length"]))
    return f.select("*", turns.alias("turns"), unescape(F.concat_ws("", loss)).alias("loss_text")).drop("segments")
