"""Multi-party chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant and all others as named users; the mask marks
the assistant's own words, the only ones a model is trained on.

The result has one row per (conversation, participant, turn) with the turn's
rendering and its character offsets in the whole rendered dialogue, so a
dialogue of any length is spread over tasks: offsets are prefix sums in two
levels (inside blocks of turns, then over the blocks' totals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save

#: Turns of one conversation that one task sums at most.
BLOCK = 512

#: The template: a header per turn and an end mark.
ASSISTANT_HEAD = "<|assistant|>\n"
USER_HEAD = ("<|user|>", "\n")
END = "\n<|end|>\n"


def _head(own: Column, name: Column) -> Column:
    return F.when(own, F.lit(ASSISTANT_HEAD)).otherwise(F.concat(F.lit(USER_HEAD[0]), name, F.lit(USER_HEAD[1])))


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text") -> DataFrame:
    """Return (conv_id, participant, turn, seq, speaker_as, name, rendered,
    char_start, char_end, mask_start, mask_end).

    seq numbers a conversation's turns from 0 by (turn, speaker, text), nulls
    first; repeated rows are turns of their own.  A null speaker is the
    participant named ``unknown``; a null text is empty.  Rows with a null
    conversation form one conversation whose id is null.  mask_start/mask_end
    bound the assistant's words in characters of the whole rendering (null for
    users).  An empty table gives no rows; other columns are not read.
    """
    name = F.coalesce(F.col(speaker_col).cast("string"), F.lit("unknown"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), name.alias("name"), text.alias("text"),
        F.monotonically_increasing_id().alias("tie"))
    order = ["conv_id", "turn", "name", "text"]
    # a global order in which blocks are parts of partitions
    ranged = rows.repartitionByRange(*order, "tie").sortWithinPartitions(*order).drop("tie")
    ranged = save(ranged.withColumn("pid", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id()), "chat-turns")
    light = ranged.select("conv_id", "turn", "name", "pid", "pos", F.length("text").cast("long").alias("chars"))
    light = light.withColumn("block", F.floor(F.col("pos") % (1 << 33) / BLOCK))
    own_len, other_len = len(ASSISTANT_HEAD) + len(END), len(USER_HEAD[0]) + len(USER_HEAD[1]) + len(END)
    # per turn as a user's turn, and what it gains or loses as the assistant's
    light = light.withColumn("as_user", F.col("chars") + F.length("name") + other_len).withColumn("gain", F.lit(own_len - other_len) - F.length("name"))

    at = ["conv_id", "pid", "block"]
    inside = Window.partitionBy(*at).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        light.withColumn("n_in", F.row_number().over(Window.partitionBy(*at).orderBy("pos")) - 1)
        .withColumn("c_in", F.coalesce(F.sum("as_user").over(inside), F.lit(0)))
    )
    # totals per block and, for the gains, per block and participant
    blocks = light.groupBy(*at).agg(F.count("*").alias("n"), F.sum("as_user").alias("c"))
    over = Window.partitionBy("conv_id").orderBy("pid", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*at, F.coalesce(F.sum("n").over(over), F.lit(0)).alias("n_base"), F.coalesce(F.sum("c").over(over), F.lit(0)).alias("c_base"))
    same = lambda l, r, cols: [F.col(f"{l}.{c}").eqNullSafe(F.col(f"{r}.{c}")) for c in cols]
    base = placed.alias("p").join(blocks.alias("b"), same("p", "b", at)).select(
        "p.*", (F.col("n_base") + F.col("n_in")).alias("seq"), (F.col("c_base") + F.col("c_in")).alias("c"))
    people = light.select("conv_id", F.col("name").alias("participant")).distinct()
    spread = base.alias("t").join(people.alias("q"), same("t", "q", ["conv_id"])).select("t.*", "participant")
    spread = spread.withColumn("own", F.col("name") == F.col("participant")).withColumn("g", F.when(F.col("own"), F.col("gain")).otherwise(0))
    key = [*at, "participant"]
    g_in = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    spread = spread.withColumn("g_in", F.coalesce(F.sum("g").over(g_in), F.lit(0)))
    gains = light.groupBy(*at, F.col("name").alias("participant")).agg(F.sum("gain").alias("g_block"))
    # every block of a conversation appears for every participant
    grid = blocks.alias("b").join(people.alias("q"), same("b", "q", ["conv_id"])).select("b.conv_id", "pid", "block", "participant")
    grid = grid.alias("x").join(gains.alias("y"), same("x", "y", key), "left").select("x.*", F.coalesce("g_block", F.lit(0)).alias("g_block"))
    g_over = Window.partitionBy("conv_id", "participant").orderBy("pid", "block").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.select(*key, F.coalesce(F.sum("g_block").over(g_over), F.lit(0)).alias("g_base"))
    start = (F.col("c") + F.col("g_base") + F.col("g_in")).alias("char_start")
    offsets = spread.alias("x").join(grid.alias("y"), same("x", "y", key)).select(
        "x.pid", "x.pos", "x.participant", "x.own", "x.seq", start)
    words = ranged.select("conv_id", "turn", "name", "text", "pos", "pid")
    head = _head(F.col("own"), F.col("name"))
    out = words.join(offsets, ["pid", "pos"]).withColumn("rendered", F.concat(head, F.col("text"), F.lit(END)))
    inner = F.col("char_start") + F.length(head)
    return out.select(
        "conv_id", "participant", "turn", "seq", F.when(F.col("own"), "assistant").otherwise("user").alias("speaker_as"), "name", "rendered",
        "char_start", (F.col("char_start") + F.length("rendered")).alias("char_end"),
        F.when(F.col("own"), inner).alias("mask_start"), F.when(F.col("own"), inner + F.length("text")).alias("mask_end"))
