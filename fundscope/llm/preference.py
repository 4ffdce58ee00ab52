"""Chat formatting of preference pairs: one prompt, two completions, and which of their characters are trained on.

A pair is a chosen and a rejected conversation.  Their longest common prefix of turns (equal role and text) is rendered
once, as the prompt; the turns after it are the completions.  In a completion only the text and end mark of assistant
turns are trained on; everything else, and the whole prompt, is masked.

All of it is windows and higher-order functions over rows of turns, in one exchange by pair.  A pair is rendered by one
task, which holds its text as one value: a conversation of any length comes whole, but must fit into a task.

Nulls and repeats: rows with a null conversation, pair or turn number are left out; a null role or text equals only
another null and renders empty; of several rows with one pair, side and turn number, each is a turn, in the order of role
and text, nulls first.  A side without turns gives an empty completion.  Other columns are ignored.  Empty tables give no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, TURN, END = "<|", "|>\n", "<|end|>\n"


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(role, F.lit("")), F.lit(TURN))


def _body(text: Column) -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.lit(END))


def preference_rows(turns: DataFrame) -> DataFrame:
    """(pair_id, prompt, prompt_turns, chosen, rejected, chosen_spans, rejected_spans) of rows (pair_id, side, turn, role, text).

    ``side`` is 'chosen' or 'rejected'.  Spans are [begin, end) character ranges of the completion that are trained on.
    """
    turns = turns.filter("pair_id is not null and turn is not null and side in ('chosen', 'rejected')").select("pair_id", "side", "turn", "role", "text")
    # all windows and the grouping keep to the partitioning by pair
    placed = turns.repartition("pair_id").withColumn("place", F.row_number().over(Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")))
    # a place is common if both sides have it with one (role, text)
    at, pair, said = Window.partitionBy("pair_id", "place"), Window.partitionBy("pair_id"), F.struct("role", "text")
    placed = placed.withColumn("same", (F.count(F.lit(1)).over(at) == 2) & F.min(said).over(at).eqNullSafe(F.max(said).over(at)))
    placed = placed.withColumn("cut", F.coalesce(F.min(F.when(~F.col("same"), F.col("place"))).over(pair), F.max("place").over(pair) + 1))
    placed = placed.filter("side = 'chosen' or place >= cut")
    shown = placed.withColumns({"part": F.when(F.col("place") < F.col("cut"), "prompt").otherwise(F.col("side")), "head": _head(F.col("role")), "body": _body(F.col("text"))})
    one = F.struct("place", F.concat("head", "body").alias("shown"), F.char_length("head").alias("skip"), F.char_length(F.concat("head", "body")).alias("n"), (F.col("role").eqNullSafe(F.lit("assistant"))).alias("train"))
    gathered = shown.groupBy("pair_id").agg(*[F.array_sort(F.collect_list(F.when(F.col("part") == p, one))).alias(p) for p in ("prompt", "chosen", "rejected")])
    text = lambda c: F.array_join(F.transform(c, lambda x: x["shown"]), "")
    return gathered.select("pair_id", text("prompt").alias("prompt"), F.size("prompt").alias("prompt_turns"), text("chosen").alias("chosen"), text("rejected").alias("rejected"), _spans("chosen").alias("chosen_spans"), _spans("rejected").alias("rejected_spans"))


def _spans(part: str) -> Column:
    """Trained ranges, from running lengths of the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        span = F.struct((state["at"] + x["skip"]).alias("begin"), (state["at"] + x["n"]).alias("end"))
        return F.struct((state["at"] + x["n"]).alias("at"), F.when(x["train"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(F.col(part), start, step, lambda s: s["spans"])


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Preference pairs from single conversations: the rejected side ends with the last turn's text of a neighbour.

    A conversation is the chosen side of the pair of its own id.  The rejected side has the same turns, but its last turn
    has the text of the last turn of conversation id XOR 1, and is missing where that has no turns.  Of several rows with
    the last turn number, the last one by role and text, nulls first, is the last turn, and the others stay in both sides.
    Both neighbours are in one partition, so that a single exchange serves all of it.
    """
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").filter("conv_id is not null and turn is not null")
    c = c.withColumn("two", F.shiftright("conv_id", 1)).repartition("two")
    latest = Window.partitionBy("two", "conv_id").orderBy(F.desc("turn"), F.desc_nulls_last("role"), F.desc_nulls_last("text"))
    c = c.withColumn("last", F.row_number().over(latest) == 1)
    # the last turns of the even and of the odd conversation; a struct tells a null text from no turn
    end = lambda odd: F.max(F.when(F.col("last") & (F.pmod("conv_id", F.lit(2)) == odd), F.struct("text"))).over(Window.partitionBy("two"))
    c = c.withColumns({"even": end(0), "odd": end(1)})
    other = F.when(F.pmod("conv_id", F.lit(2)) == 0, F.col("odd")).otherwise(F.col("even"))
    chosen = F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text"))
    rejected = F.when(~F.col("last"), F.struct(F.lit("rejected").alias("side"), F.col("text").alias("text"))).when(other.isNotNull(), F.struct(F.lit("rejected").alias("side"), other["text"].alias("text")))
    sides = F.explode(F.array_compact(F.array(chosen, rejected))).alias("s")
    return c.select(F.col("conv_id").alias("pair_id"), "turn", "role", sides).select("pair_id", "s.side", "turn", "role", "s.text")


def flat_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
