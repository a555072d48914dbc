"""A Merkle manifest of a dataset: a tree of SHA-256 digests over all rows, a proof for each.

A level of the tree over an aligned block of nodes is one string of hexadecimal digests, 64
characters each. FAN digests in a row are a substring of fixed width, whose hash is the
parent; a node's siblings are what flanks it in that substring. A block of FAN**3 nodes thus
gives three levels and one digest, and blocks' digests are nodes again, until one is left.
A source may hold a third of all rows: nothing but blocks of bounded size is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.session import settle

FAN, DIGEST = 16, 64
RUN = FAN * DIGEST
#: Levels within a block, and the nodes it holds.
LEVELS = 3
BLOCK = FAN**LEVELS
#: Blocks of a tree that meet its subroot in one key.
PIECE = 16
PATH = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    """How a value enters a leaf: ``-`` for null, else its bytes' number, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _parents(level: str) -> Column:
    """The next level's digests, of a level held as one binary string."""
    runs = f"transform(sequence(0, int(length({level}) - 1) div {RUN}), i -> sha2(substring({level}, i * {RUN} + 1, {RUN}), 256))"
    return F.expr(f"CAST(array_join({runs}, '') AS BINARY)")


def _flanks(level: str, at: str) -> str:
    """SQL of the digests left and right of node ``at`` in its run."""
    left = f"substring({level}, int(({at}) div {FAN}) * {RUN} + 1, int(({at}) % {FAN}) * {DIGEST})"
    right = f"substring({level}, int({at}) * {DIGEST} + {DIGEST + 1}, ({FAN - 1} - int(({at}) % {FAN})) * {DIGEST})"
    return f"struct({left} AS left, {right} AS right)"


def _nodes_before(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add ``pos``, the place of each row among its tree's rows, and their number ``n``, by range-sorted rows that are never gathered."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [tree, *order, "_at"]
    rows = settle(rows.withColumn("_at", F.monotonically_increasing_id()), "leaves")
    rows = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("_at")
    # This number is the task's in its upper bits and the place in the task in its lower 33.
    rows = settle(rows.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("_task", F.shiftright("_id", 33))
    seen = rows.groupBy(tree, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_low"))
    before = Window.partitionBy(tree).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("_n").over(Window.partitionBy(tree)).alias("n")
    seen = seen.select(tree, "_task", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), whole)
    return rows.join(seen, [tree, "_task"]).withColumn("pos", F.expr("_before + _id - _low")).drop("_task", "_id", "_low", "_before")


def _climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For nodes (tree, pos, n of the tree, leaves of the tree, digest, payload): blocks with their members and the path above them, and each tree's top.

    A block row has ``members`` (pos, digest, payload), ``l0`` to ``l2``, ``depth`` (its levels)
    and ``above``, the flanks of the block's digest from there to the top of its tree.
    """
    own = F.struct("pos", "digest", "payload")
    same = [F.max(c).alias(c) for c in ("n", "leaves")]
    blocks = nodes.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block")).agg(F.sort_array(F.collect_list(own)).alias("members"), *same)
    blocks = blocks.withColumn("l0", F.expr("CAST(array_join(transform(members, m -> m.digest), '') AS BINARY)"))
    for level in range(1, LEVELS + 1):
        blocks = blocks.withColumn(f"l{level}", _parents(f"l{level - 1}"))
    depth = F.expr(f"CASE WHEN n > {BLOCK} THEN {LEVELS} ELSE " + " + ".join(f"int(n > {FAN**k})" for k in range(LEVELS)) + " END")
    blocks = settle(blocks.withColumn("depth", depth), "levels")
    digest = F.expr("CAST(CASE depth " + " ".join(f"WHEN {k} THEN l{k}" for k in range(LEVELS + 1)) + " END AS STRING)")
    tops = blocks.where(f"n <= {BLOCK}").select("tree", digest.alias("top"), "leaves")
    none = F.array().cast(PATH)
    more = blocks.where(f"n > {BLOCK}")
    if more.isEmpty():
        return blocks.withColumn("above", none), tops
    wider = F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n")
    higher, higher_tops = _climb(more.select("tree", F.col("block").alias("pos"), wider, "leaves", digest.alias("digest"), F.lit(None).cast("string").alias("payload")))
    above = _paths(higher).select("tree", F.col("pos").alias("block"), F.col("path").alias("above"))
    return blocks.join(above, ["tree", "block"], "left").withColumn("above", F.coalesce("above", none)), tops.union(higher_tops)


def _paths(blocks: DataFrame, *kept: str) -> DataFrame:
    """tree, pos, digest, payload and ``path`` (flanks of every level, bottom first) of each member of the blocks."""
    at = f"(m.pos % {BLOCK})"
    levels = ", ".join(_flanks(f"l{k}", f"{at} div {FAN**k}") for k in range(LEVELS))
    member = f"struct(m.pos AS pos, m.digest AS digest, m.payload AS payload, CAST(concat(slice(array({levels}), 1, depth), above) AS {PATH}) AS path)"
    return blocks.select("tree", *kept, F.expr(f"inline(transform(members, m -> {member}))"))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    step = lambda node, s: F.sha2(F.concat(s["left"], node.cast("binary"), s["right"]), 256)
    return F.aggregate(path, start, step)


def manifest(documents: DataFrame, columns: list[str], key: str = "doc_id", tree: str = "source", tampered: Column | None = None) -> DataFrame:
    """leaf, subroot, root, proof (all siblings, as one string), folded_root and verified of every row, with its ``key``.

    A leaf is the digest of the named columns; leaves of one ``tree`` value ascend by key
    (null first), rows of one key by their leaf, so rows that tie are equal. Null is a tree of
    its own, before the others. ``folded_root`` starts from ``tampered``, a leaf as somebody
    else states it, by default the row's own. A tree of one row has its leaf for subroot, one
    tree its subroot for root; the proof of a row alone is empty. Columns that are not named
    are not read; an empty table gives an empty one.
    """
    own = leaf(*[F.col(c) for c in columns])
    claim = own if tampered is None else tampered
    rows = documents.select(
        F.coalesce(F.concat(F.lit("s"), F.col(tree).cast("string")), F.lit("")).alias("tree"),
        F.struct(F.col(key).cast("long").alias("key"), F.when(claim != own, claim).alias("claim")).alias("payload"),
        own.alias("digest"),
    )
    rows = rows.withColumn("_key", F.col("payload.key"))
    placed = _nodes_before(rows, "tree", ["_key", "digest"]).drop("_key")
    blocks, tops = _climb(placed.withColumn("leaves", F.col("n")))
    subroots = tops.select(F.lit(0).alias("tree"), F.struct(F.col("tree").alias("own"), "leaves").alias("payload"), F.col("top").alias("digest"))
    ranked = _nodes_before(subroots.withColumn("_key", F.col("payload.own")), "tree", ["_key"]).drop("_key")
    upper, root = _climb(ranked.withColumn("leaves", F.col("n")))
    upper = _paths(upper).join(root, "tree").select("payload.*", F.col("digest").alias("subroot"), F.col("path").alias("_over"), F.col("top").alias("root"))
    # A large tree's blocks meet its subroot in pieces.
    pieces = F.explode(F.expr(f"sequence(0, (leaves - 1) div {BLOCK * PIECE})")).alias("_piece")
    upper = upper.select(F.col("own").alias("tree"), "subroot", "_over", "root", pieces)
    blocks = blocks.withColumn("_piece", F.expr(f"block div {PIECE}")).join(upper, ["tree", "_piece"])
    paths = _paths(blocks.withColumn("above", F.concat("above", "_over")), "subroot", "root")
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"]).cast("string")), "")
    out = paths.select(
        F.col("payload.key").alias(key),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        siblings.alias("proof"),
        fold(F.coalesce("payload.claim", "digest"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
