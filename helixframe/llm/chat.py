"""Formatting conversations as budgeted windows of turns, in DataFrame functions only.

Prefix sums of turn tokens cut a conversation into turn-aligned windows: a turn is new
in window floor(tokens before it / stride).  Every window retains the conversation's
system turn (its first turn, where that has the role ``system``) and repeats as many of
the turns just before it as fit in ``history`` tokens.  Repeated turns are context: only
assistant texts that are new in a window are in its loss mask, so each is a target once.

A system turn that leaves no room (its tokens and ``history`` reach ``budget``) gives a stride of 1: every
turn has a window of its own, with the whole system turn, and is ``over_budget``.

With stride = (budget - history - system tokens) / 2 a window keeps to the budget
whenever no single turn is longer than the stride; a longer turn is never cut, and its
window says so in ``over_budget``.

The template is ``<turn:STATE:ROLE>TEXT</turn>\\n`` with STATE new, kept (system turn)
or seen (history).  Texts and roles have ``&``, ``<`` and ``>`` escaped, so that no
text can hold a control string and reading back is exact.

Defined results for unusual input: null texts and roles are empty; turns go in order of
(turn, role, text), null turns first, repeated rows side by side; a null conversation
id is a conversation of its own; an empty table gives an empty table; other columns are
ignored, whatever their names; texts of any length are kept whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.runtime import materialize

#: Turn numbers that are summed up together before conversations are.
RUN = 256
END = "</turn>\n"


def escape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def tokens(text: Column) -> Column:
    """Estimated tokens of a turn: a quarter of its bytes, rounded up, and 4 for the template."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("bigint")


def _numbered(turns: DataFrame) -> DataFrame:
    """Turns with pos (from 1), p (tokens before) and k (own tokens); sums go run by run, then over the runs."""
    key, order = ["c", "run"], ["turn", "role", "text"]
    inner = Window.partitionBy(*key).orderBy(*(F.asc_nulls_first(x) for x in order))
    rows = turns.withColumn("n", F.row_number().over(inner).cast("bigint"))
    rows = rows.withColumn("q", F.sum("k").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("k"))
    runs = turns.groupBy(*key).agg(F.count("*").alias("rn"), F.sum("k").alias("rk"))
    outer = Window.partitionBy("c").orderBy(F.asc_nulls_first("run")).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("c", "run", F.coalesce(F.sum("rn").over(outer), F.lit(0)).alias("on"), F.coalesce(F.sum("rk").over(outer), F.lit(0)).alias("ok"))
    joined = rows.join(runs, key)
    return joined.select("c", "role", "text", "k", (F.col("n") + F.col("on")).alias("pos"), (F.col("q") + F.col("ok")).alias("p"))


def format_windows(conversations: DataFrame, budget: int = 512, history: int = 64, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, window, n_new, n_tokens, over_budget, formatted, loss_spans).

    ``loss_spans`` holds [start, end) in characters of ``formatted``.
    """
    said = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    turns = conversations.select(
        F.struct(F.col(f"`{id}`").alias("id")).alias("c"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.floor(F.col(f"`{turn}`") / RUN), F.lit(-(1 << 62))).alias("run"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        said.alias("text"),
        tokens(said).alias("k"),
    )
    # Written once: system turns, window starts and pieces are all read from it.
    rows = materialize(_numbered(turns), "turns")
    first = (F.col("pos") == 1) & (F.col("role") == "system")
    system = rows.where(first).select("c", F.col("text").alias("sys"), F.col("k").alias("sk"))
    body = rows.where(~first).join(system.select("c", "sk"), "c", "left").withColumn("sk", F.coalesce("sk", F.lit(0)))
    body = body.withColumn("p", F.col("p") - F.col("sk")).withColumn("stride", F.greatest(F.lit(1), F.floor((F.lit(budget - history) - F.col("sk")) / 2)).cast("bigint"))
    body = body.withColumn("w", F.expr("p div stride"))
    starts = body.groupBy("c", "w").agg(F.min("p").alias("start"))
    again = body.withColumn("to", F.expr(f"(p + {int(history)}L) div stride")).where("to > w")
    again = again.select("c", "role", "text", "k", "pos", "p", F.explode(F.expr("sequence(w + 1, to)")).alias("w"))
    again = again.join(starts, ["c", "w"]).where(F.col("start") - F.col("p") <= history)
    opening = starts.groupBy("c").agg(F.min("w").alias("w"))
    with_system = starts.join(opening.select("c", F.col("w").alias("w0")), "c").join(system, "c")
    alone = system.join(opening, "c", "left_anti").select("c", F.lit(0).cast("bigint").alias("w"), F.lit(True).alias("own"), "sys", F.col("sk"))
    heads = with_system.select("c", "w", (F.col("w") == F.col("w0")).alias("own"), "sys", "sk").unionByName(alone)
    pieces = (
        body.select("c", "w", F.lit("new").alias("state"), "role", "text", "k", "pos")
        .unionByName(again.select("c", "w", F.lit("seen").alias("state"), "role", "text", "k", "pos"))
        .unionByName(heads.select("c", "w", F.when(F.col("own"), "new").otherwise("kept").alias("state"), F.lit("system").alias("role"), F.col("sys").alias("text"), F.col("sk").alias("k"), F.lit(0).cast("bigint").alias("pos")))
    )
    head = F.concat(F.lit("<turn:"), "state", F.lit(":"), escape(F.col("role")), F.lit(">"))
    piece = pieces.select("c", "w", "pos", "k", (F.col("state") == "new").alias("new"), ((F.col("state") == "new") & (F.col("role") == "assistant")).alias("loss"), head.alias("head"), escape(F.col("text")).alias("body"))
    grouped = piece.groupBy("c", "w").agg(
        F.sort_array(F.collect_list(F.struct("pos", "head", "body", "loss"))).alias("t"),
        F.count_if("new").alias("n_new"),
        F.sum("k").alias("n_tokens"),
    )
    spans = F.expr(
        f"""aggregate(t, named_struct('at', 0, 'spans', cast(array() AS array<struct<start:int,end:int>>)),
            (acc, x) -> named_struct(
                'at', acc.at + length(x.head) + length(x.body) + {len(END)},
                'spans', if(x.loss, concat(acc.spans, array(named_struct('start', acc.at + length(x.head), 'end', acc.at + length(x.head) + length(x.body)))), acc.spans)),
            acc -> acc.spans)"""
    )
    text_of = F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    return grouped.select(F.col("c.id").alias("conv_id"), F.col("w").alias("window"), "n_new", "n_tokens", (F.col("n_tokens") > budget).alias("over_budget"), text_of.alias("formatted"), spans.alias("loss_spans"))


def new_turns(formatted: Column) -> Column:
    """Read back from a formatted window: array of (role, text) of its new turns, in order."""
    marks = F.filter(F.split(formatted, END), lambda x: x.startswith("<turn:new:"))

    def turn(x: Column) -> Column:
        at = F.instr(x, ">")
        return F.struct(unescape(F.substring(x, F.lit(11), at - 11)).alias("role"), unescape(F.substring(x, at + 1, F.length(x))).alias("text"))

    return F.transform(marks, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """Read back from a formatted window: the unescaped text under its loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
