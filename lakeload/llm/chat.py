"""Chat logs: collapse of cumulative snapshots, then rendering.

A log that stores a conversation after every turn holds each conversation many times, every
copy a prefix of the next. Rolling hashes of turn prefixes find the copies that a longer
conversation begins with; only maximal conversations are rendered. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.session import settle

LANES = ["_h0", "_h1", "_h2", "_h3"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """The turns in their order, dealt into sorted blocks of even size and written.

    Turns are ordered by ``turn`` (null first), then role, text and place in the input. A
    conversation that holds a third of all turns spans many blocks.
    """
    blocks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "text", "_at"]
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    turns = settle(turns.withColumn("_at", F.monotonically_increasing_id()), "turns")
    turns = turns.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    return settle(turns.withColumn("_block", F.spark_partition_id()), "ordered")


def _carried(df: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Add what earlier blocks of the same conversation sum up to.

    Blocks are ranges, so a block shares at most one conversation with its predecessor: what
    is broadcast has at most one row for each block.
    """
    totals = df.groupBy("_block", "conv_id").agg(*[v.alias(k) for k, v in sums.items()])
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumns({k: F.sum(k).over(before) for k in sums}).where(F.col(next(iter(sums))).isNotNull())
    carried = carried.select(F.col("_block").alias("_b"), F.col("conv_id").alias("_c"), *[F.col(k).alias(f"{k}_before") for k in sums])
    return df.join(F.broadcast(carried), (F.col("_block") == F.col("_b")) & F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_b", "_c").fillna(0, [f"{k}_before" for k in sums])


def numbered(turns: DataFrame) -> DataFrame:
    """Add ``position``, from 0 in each conversation, to what ``ordered_turns`` gives."""
    within = Window.partitionBy("_block", "conv_id").orderBy("turn", "role", "text", "_at")
    out = _carried(turns, {"_n": F.count(F.lit(1))}).withColumn("_row", F.row_number().over(within))
    return out.withColumn("position", F.col("_n_before") + F.col("_row") - 1).drop("_row", "_n_before")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """For every turn the hash of the conversation up to it: 128 bits as four sums.

    Each turn's hash covers its position, role and text, so the sum over a prefix rolls on
    from turn to turn and can be carried from block to block.
    """
    content = [F.col("position"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    one, two = F.xxhash64(*content), F.xxhash64(F.lit("second"), *reversed(content))
    low = F.lit((1 << 32) - 1).cast("long")
    lanes = dict(zip(LANES, [one.bitwiseAND(low), F.shiftrightunsigned(one, 32), two.bitwiseAND(low), F.shiftrightunsigned(two, 32)], strict=True))
    hashed = numbered(turns).select("conv_id", "_block", "position", *[v.alias(k) for k, v in lanes.items()])
    hashed = settle(hashed, "turn_hashes")
    rolling = Window.partitionBy("_block", "conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rolled = _carried(hashed, {k: F.sum(k) for k in LANES})
    return rolled.select("conv_id", "position", *[(F.sum(k).over(rolling) + F.col(f"{k}_before")).alias(k) for k in LANES])


def maximal(hashes: DataFrame) -> DataFrame:
    """Ids of the conversations that no other one contains as a prefix, with ``n_turns`` and the number of equal copies.

    Of equal conversations the smallest id stays (a null id only if there is no other).
    Both sides of the anti-join are distinct before they meet, so no opening turn is hot.
    """
    ends = hashes.groupBy("conv_id").agg(F.max_by(F.struct("position", *LANES), "position").alias("_e"))
    ends = ends.select("conv_id", "_e.*")
    distinct = ends.groupBy("position", *LANES).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    lengths = ends.select(F.col("conv_id").alias("_c"), F.col("position").alias("_last"))
    inner = hashes.join(lengths, F.col("conv_id").eqNullSafe(F.col("_c"))).where(F.col("position") < F.col("_last"))
    prefixes = inner.select("position", *LANES).distinct()
    kept = distinct.join(prefixes, ["position", *LANES], "left_anti")
    return kept.select("conv_id", (F.col("position") + 1).alias("n_turns"), "n_copies")


def render(turns: DataFrame, kept: DataFrame, template: str = "<|im_start|>{role}\n{text}<|im_end|>\n") -> DataFrame:
    """One row for each turn of the kept conversations, its text set into ``template``.

    Concatenated by ``position`` they are the rendered conversation. Rows stay apart because
    one conversation may be larger than a task. A null role or text is set in as empty.
    """
    head, _, rest = template.partition("{role}")
    middle, _, tail = rest.partition("{text}")
    said = F.concat(F.lit(head), F.coalesce("role", F.lit("")), F.lit(middle), F.coalesce("text", F.lit("")), F.lit(tail))
    kept = kept.withColumnRenamed("conv_id", "_c")
    out = numbered(turns).join(kept, F.col("conv_id").eqNullSafe(F.col("_c")))
    return out.select("conv_id", "position", "n_turns", "n_copies", "role", said.alias("rendered"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Collapse snapshots and render what is left.

    Reads conv_id, turn, role and text; other columns are not read. Rows with a null conv_id
    are one conversation. A repeated row is a turn of its own. An empty table gives none.
    """
    turns = ordered_turns(conversations)
    hashes = settle(prefix_hashes(turns), "prefixes")
    return render(turns, settle(maximal(hashes), "maximal"))
