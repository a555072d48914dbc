"""SpotSigs fingerprints: each common word is an anchor, the content words after it form its chain.

A text's fingerprint is the set of its chains. Sets are compared by Jaccard similarity,
within partitions of like set length and pruned by what lengths and rare signatures allow.
Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Frequent words of English, German, French and Spanish.
ANCHORS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "this", "by", "are", "at", "from",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "ein", "eine",
    "de", "la", "le", "les", "et", "des", "un", "une", "que", "du",
    "el", "los", "las", "y", "en", "por", "con", "una", "se", "del",
]
CHAIN = 2
THRESHOLD = 0.75


def with_spots(df: DataFrame, text: str, name: str, chain: int = CHAIN) -> DataFrame:
    """Add the sorted set of chain hashes of a text column.

    Of the words (letters and digits, lower case) the common ones are anchors; an anchor's
    chain is itself and the next ``chain`` content words, other anchors left out. A text whose
    anchors have no whole chain has one hash of all its words; one without words has none.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    out = df.withColumn("_words", words).withColumn("_content", F.filter("_words", lambda w: ~w.isin(ANCHORS)))
    anchors = F.filter(F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda a: a["w"].isin(ANCHORS))
    # Before an anchor at word i, the r-th anchor, stand i - r content words; its chain begins with the next.
    content = lambda k: F.get("_content", k)
    chains = F.transform(anchors, lambda a, r: F.when(a["i"] - r + chain <= F.size("_content"), F.xxhash64(a["w"], *[content(a["i"] - r + k) for k in range(chain)])))
    found = F.array_distinct(F.filter(chains, lambda h: h.isNotNull()))
    whole = F.when(F.size("_words") > 0, F.array(F.xxhash64(F.array_join("_words", " ")))).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("_found", found)
    return out.withColumn(name, F.sort_array(F.when(F.size("_found") > 0, F.col("_found")).otherwise(whole))).drop("_words", "_content", "_found")


def fingerprint(spots: Column) -> Column:
    """A digest of a set: equal sets, equal digests."""
    return F.sha2(F.array_join(F.transform(spots, lambda h: h.cast("string")), " ").cast("binary"), 256)


def likeness(one: Column, two: Column) -> Column:
    """Jaccard similarity of two sets; two empty sets are alike, one empty set is like no other."""
    shared = F.size(F.array_intersect(one, two))
    union = F.size(one) + F.size(two) - shared
    return F.when(union == 0, F.lit(1.0)).when(F.least(F.size(one), F.size(two)) == 0, F.lit(0.0)).otherwise(shared / union)


def with_next(df: DataFrame, order: list[str], carried: list[str], prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add the ``carried`` columns of the next row in the global order as ``next_…``; the first row follows the last.

    ``prepare`` adds columns to carry; it is applied once to each row, and to the blocks' first rows.

    ``order`` begins with an integer column without nulls, by whose quantiles rows are dealt
    into blocks, each once. The look-ahead stays within a block; a block's last row takes the
    first row of the next block, which are as many rows as blocks. Rows equal in all of
    ``order`` are interchangeable and stay in one block.
    """
    spark = df.sparkSession
    blocks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.agg(F.percentile_approx(order[0], [k / blocks for k in range(1, blocks)], 100 * blocks)).first()[0] or []
    cuts = sorted(set(cuts))
    # Number of cuts at or below the value, by halving.
    steps = [1 << k for k in reversed(range(max(1, len(cuts)).bit_length()))]
    held = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    further = lambda at, step: F.when((at + step <= len(cuts)) & (F.get(held, at + step - 1) <= F.col(order[0])), at + step).otherwise(at)
    block = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)
    rows = df.withColumn("_block", block)
    firsts = rows.groupBy("_block").agg(F.min(F.struct(*order)).alias("_o")).select("_block", "_o.*").collect()
    firsts = sorted(firsts, key=lambda r: r["_block"])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    follows = [(firsts[k]["_block"], *[firsts[(k + 1) % len(firsts)][c] for c in order]) for k in range(len(firsts))]
    heads = spark.createDataFrame(follows, "_block int, " + ", ".join(f"{c} {types[c]}" for c in order))
    heads = prepare(df.join(F.broadcast(heads), order).dropDuplicates(["_block"]))
    heads = heads.select("_block", F.struct(*carried).alias("_head"))
    ahead = Window.partitionBy("_block").orderBy(*order)
    out = prepare(rows).withColumn("_next", F.lead(F.struct(*carried)).over(ahead)).join(heads, "_block", "left")
    out = out.withColumn("_next", F.coalesce("_next", "_head")).drop("_head", "_block")
    return out.select("*", *[F.col("_next")[c].alias(f"next_{c}") for c in carried]).drop("_next")


def edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text, of an edited version of it, and how like it are that and the next document.

    The edited text has its last floor(n/2) code points replaced by as many first ones of the
    next document by id. Null texts count as empty; null ids come first; rows of equal id
    follow by a hash of the text; equal rows give equal fingerprints. Other columns are not read.
    """
    least = -(1 << 63)
    rows = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("th", F.xxhash64("text"))
    rows = with_next(rows, ["doc_id", "th"], ["text", "spots"], lambda df: with_spots(df, "text", "spots"))
    half = "CAST(floor(char_length(text) / 2) AS INT)"
    edited = F.expr(f"concat(left(text, char_length(text) - {half}), left(next_text, {half}))")
    rows = with_spots(rows.withColumn("edited", edited).drop("next_text"), "edited", "edited_spots")
    return rows.select(
        F.when(F.col("doc_id") != least, F.col("doc_id")).alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def search(queries: DataFrame, corpus: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``corpus`` at least ``threshold`` alike to each query; both have doc_id and spots. Empty sets match nothing.

    Lengths are dealt into partitions so wide that a match lies in the query's partition or a
    neighbour; a pair meets only in a shared signature among the query's rarest, of which a
    match must hold one, and is compared only if the lengths allow the threshold. Equal sets
    of the corpus are compared once.
    """
    partition = lambda n: F.floor(F.log(n) / F.log(F.lit(1 / threshold))).cast("int")
    sets = corpus.where(F.size("spots") > 0).groupBy("spots").agg(F.min("doc_id").alias("first")).withColumn("part", partition(F.size("spots")))
    index = sets.select("part", F.explode("spots").alias("sig"), "first", F.size("spots").alias("n"))
    common = index.groupBy("sig").agg(F.count(F.lit(1)).alias("seen"))
    asked = queries.where(F.size("spots") > 0).groupBy("spots").agg(F.min("doc_id").alias("query"))
    asked = asked.withColumn("n", F.size("spots"))
    rare = asked.select("query", "n", F.explode("spots").alias("sig")).join(common, "sig", "left").fillna(0, ["seen"])
    rank = Window.partitionBy("query").orderBy("seen", "sig")
    rare = rare.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1)
    probes = rare.select("query", F.col("n").alias("m"), "sig", F.explode(F.array(*[partition(F.col("n")) + k for k in (-1, 0, 1)])).alias("part"))
    pairs = probes.join(index, ["part", "sig"]).where(F.least("n", "m") >= threshold * F.greatest("n", "m")).select("query", "first").distinct()
    pairs = pairs.join(asked.select("query", F.col("spots").alias("_a")), "query").join(sets.select("first", F.col("spots").alias("_b")), "first")
    pairs = pairs.withColumn("likeness", likeness(F.col("_a"), F.col("_b"))).where(F.col("likeness") >= threshold)
    same = corpus.select(F.col("doc_id"), F.col("spots").alias("_b"))
    hits = pairs.join(same, "_b").select("query", "doc_id", "likeness")
    ids = queries.select(F.col("doc_id").alias("query_id"), "spots").join(asked.select("spots", "query"), "spots").select("query_id", "query")
    return ids.join(hits, "query").select("query_id", "doc_id", "likeness")
