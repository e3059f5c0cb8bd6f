"""Conversations as training windows: a turn template, a token budget and a loss mask.

Only DataFrame operations.  Prefix sums of the turns' tokens choose the windows: a window
takes the turns that begin in its stretch of the sum, so spans end at turns, and no turn
is cut or lost.  Every window begins with the conversation's system turn, then repeats
the turns that lie within ``history`` tokens before its first new one.  The loss covers
the assistant texts among the new turns; repeated ones are context and masked, so each
assistant text is a target once.

A stretch is half of what system turn and history leave of the budget: a window then
keeps to the budget if no turn of it is longer than a stretch.  Others are marked.

The template is ``<|turn|>role<|text|>text<|end|>``.  Control strings inside roles and
texts (these three, and those of other common templates) get a backslash after their
first character, one more if they have some already; reading takes one away.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm.common import column

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Fixed value: control strings, without their first character.
CONTROL = r"(\|turn\|>|\|text\|>|\|end\|>|\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"([<\[])(\\*)" + CONTROL), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"([<\[])\\(\\*)" + CONTROL), F.lit("$1$2$3"))


def four_bytes(text: Column) -> Column:
    """A token for every four bytes, and three for the template."""
    return F.ceil(F.octet_length(text) / 4).cast("long") + 3


def windows(
    turns: DataFrame, budget: int = 2048, history: int = 256, tokens=four_bytes, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conv, window, formatted, context, loss, tokens, over)``, one row per window.

    ``context`` counts the leading turns that are repeated; ``loss`` is an array of
    (start, end) in code points of ``formatted``; ``over`` marks a window beyond the
    budget.  Rows go by turn, then role, then text; nulls first.  Repeated rows are turns
    of their own, a null role or text is empty, a null conversation is one of its own.
    The system turn is the first row, if its role is ``system``.
    """
    empty = lambda c: F.coalesce(column(c).cast("string"), F.lit(""))
    rows = turns.select(column(conv).alias("conv"), column(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    rows = rows.withColumn("tokens", tokens(F.col("text")))
    one = Window.partitionBy("conv")
    order = one.orderBy("turn", "role", "text")
    rows = rows.withColumn("k", F.row_number().over(order))
    lead = (F.col("k") == 1) & (F.col("role") == "system")
    seen = one.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("lead", lead).withColumn("system", F.first(F.when(lead, F.struct("role", "text", "tokens"))).over(seen))
    own = F.when(F.col("lead"), 0).otherwise(F.col("tokens"))
    rows = rows.withColumn("begin", F.sum(own).over(seen) - own)
    room = F.lit(budget - history) - F.coalesce("system.tokens", F.lit(0))
    rows = rows.withColumn("window", F.floor(F.col("begin") / F.greatest(F.lit(1), F.floor(room / 2))).cast("long"))
    rows = rows.withColumn("opens", F.coalesce(F.col("window") != F.lag("window").over(one.orderBy("k")), F.lit(True)))
    # where the next window opens; sums grow, so the nearest is the least
    after = one.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    for name in ("begin", "window"):
        rows = rows.withColumn(f"next_{name}", F.min(F.when(F.col("opens"), F.col(name))).over(after))
    again = ~F.col("lead") & (F.col("next_begin") - F.col("begin") <= history)
    uses = F.array(F.struct(F.col("window").alias("window"), F.lit(True).alias("new")), F.struct(F.col("next_window").alias("window"), F.lit(False).alias("new")))
    uses = F.when(again, uses).otherwise(F.slice(uses, 1, 1))
    rows = rows.withColumn("use", F.explode(uses))

    piece = F.struct(F.col("k"), F.col("use.new").alias("new"), F.col("role"), F.col("text"), F.col("tokens"))
    made = rows.groupBy("conv", F.col("use.window").alias("window")).agg(
        F.sort_array(F.collect_list(piece)).alias("turns"),
        F.first("system", ignorenulls=True).alias("system"),
        F.bool_or(F.col("lead") & F.col("use.new")).alias("opened"),
    )
    repeat = F.struct(F.lit(0).alias("k"), F.lit(False).alias("new"), F.col("system.role").alias("role"), F.col("system.text").alias("text"), F.col("system.tokens").alias("tokens"))
    turns_of = F.when(F.col("system").isNotNull() & ~F.col("opened"), F.concat(F.array(repeat), "turns")).otherwise(F.col("turns"))
    made = made.withColumn("turns", turns_of)

    # a window's turns are bounded by the budget, so adding one after another is cheap
    def add(state, t):
        head = F.concat(state["done"], F.lit(TURN), escape(t["role"]), F.lit(TEXT))
        body = escape(t["text"])
        start = F.length(head)
        span = F.struct(start.alias("start"), (start + F.length(body)).alias("end"))
        loss = F.when(t["new"] & (t["role"] == "assistant"), F.concat(state["loss"], F.array(span))).otherwise(state["loss"])
        return F.struct(F.concat(head, body, F.lit(END)).alias("done"), loss.alias("loss"))

    begin = F.struct(F.lit("").alias("done"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))
    made = made.withColumn("made", F.aggregate("turns", begin, add))
    total = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"])
    return made.select(
        F.col("conv").alias(conv),
        "window",
        F.col("made.done").alias("formatted"),
        F.size(F.filter("turns", lambda t: ~t["new"])).alias("context"),
        F.col("made.loss").alias("loss"),
        total.alias("tokens"),
        (total > budget).alias("over"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted window, read back: an array of (role, text)."""
    parts = F.slice(F.split(formatted, r"<\|turn\|>", -1), 2, 1 << 30)

    def read(part):
        role = F.substring_index(part, TEXT, 1)
        body = F.substring(part, F.length(role) + len(TEXT) + 1, F.length(part) - F.length(role) - len(TEXT) - len(END))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(parts, read)


def losses_of(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, read back."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
