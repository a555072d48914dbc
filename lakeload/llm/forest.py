"""Near-duplicates by an LSH forest: MinHash labels in several sorted orders.

In each order (tree) a document's neighbours are those whose labels share the longest prefix
with its own; they are the candidates. A region, all labels with one prefix, is looked at
two hashes deep where it is small and deeper where it is crowded. Candidates are confirmed on
the full shingle sets, and links are joined into components. What neighbours miss is then
looked up exactly: sets of different components meet at their rarest shingles.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.session import discard, settle

from . import bytestext

TREES, DEPTH = 12, 8
#: Hashes at the top of a label that define the regions of each level.
LEVELS = (2, 4, 6, 8)
#: Rows of a region beyond which it is divided by the next level.
CROWDED = 2_000
#: Following neighbours of each label that are candidates.
NEIGHBOURS = 6
#: Of the sketch's 96 bits so many may differ; 0.75 alike texts differ in 12 on average, the deviation is 3.2.
SKETCH_BITS = 26
NOBODY = (1 << 63) - 1
#: Buckets that shingles are counted in, by their highest bits, to tell frequent ones.
BUCKET_BITS = 20
#: Bits in which a set's shingles are counted modulo two; bits that differ are at most the shingles that do.
#: Sets of more than LARGE shingles are counted in many bits as well, as few would fill up.
PARITY_BITS, WIDE_BITS, LARGE = 512, 4096, 64

_FACTORS = bytestext.mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = bytestext.mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) + np.uint64(1 << 32))
SIGNED = "doc_id long, th long, n_shingles long, d1 long, d2 long, s1 long, s2 long, label array<long>"


def shingle_sets(column, size: int = 5):
    """For slices of a text column: the first row, and the shingles' hashes with their row bounds (not distinct yet)."""
    data, bounds = bytestext.flat(column)
    for begin, end in bytestext.slices(bounds):
        own = bounds[begin : end + 1] - bounds[begin]
        part = data[bounds[begin] : bounds[end]]
        starts, ends, of_row = bytestext.words(part, own)
        yield begin, *bytestext.shingles(bytestext.span_hashes(part, starts, ends), of_row, size)


def _key(documents: DataFrame, id_column: str, text_column: str) -> list[Column]:
    text = F.col(text_column).cast("string")
    return [F.coalesce(F.col(id_column).cast("long"), F.lit(NOBODY)).alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text")]


def signatures(keyed: DataFrame) -> DataFrame:
    """Set size, digest, sketch and labels of every text; without words the size is 0."""

    def sign(batches):
        for batch in batches:
            rows = len(batch)
            n, digests = np.zeros(rows, np.int64), np.zeros((4, rows), np.uint64)
            labels = np.zeros((rows, TREES * DEPTH), np.uint32)
            for first, hashes, begins in shingle_sets(batch.column(2)):
                full = np.flatnonzero(np.diff(begins)) + first
                if not len(full):
                    continue
                at = begins[:-1][full - first]
                for row, begin in zip(full, at, strict=True):
                    own = np.unique(hashes[begin : begins[row - first + 1]])
                    n[row] = len(own)
                    digests[0, row], digests[1, row] = own.sum(), bytestext.mix(own).sum()
                for k in range(TREES * DEPTH):
                    labels[full, k] = np.minimum.reduceat((hashes * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32), at).astype(np.uint32)
            bits = (labels & np.uint32(1)).astype(np.uint8)
            half = TREES * DEPTH // 2
            for lane, part in ((2, bits[:, :half]), (3, bits[:, half:])):
                padded = np.zeros((rows, 64), np.uint8)
                padded[:, :half] = part
                digests[lane] = np.packbits(padded, axis=1).view(">u8").ravel()
            pairs = (labels[:, 0::2].astype(np.uint64) << np.uint64(32)) | labels[:, 1::2]
            flat = pa.array((pairs ^ np.uint64(1 << 63)).view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * (TREES * DEPTH // 2)), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), *[pa.array(d.view(np.int64)) for d in digests], lists],
                ["doc_id", "th", "n_shingles", "d1", "d2", "s1", "s2", "label"],
            )

    return bytestext.small_batches(keyed).mapInArrow(bytestext.tidy(sign), SIGNED)


def classes(signed: DataFrame) -> DataFrame:
    """One row for each distinct set: digest, node (the first document that has it), size, sketch and labels."""
    first = F.min(F.struct("doc_id", "th", "n_shingles", "s1", "s2", "label")).alias("_f")
    return signed.where("n_shingles > 0").groupBy("d1", "d2").agg(first).select(
        "d1", "d2", F.struct("_f.doc_id", "_f.th").alias("node"), "_f.n_shingles", "_f.s1", "_f.s2", "_f.label"
    )


def candidates(nodes: DataFrame) -> DataFrame:
    """Pairs (a before b) of neighbours in any tree whose sketches and sizes allow the similarity; ``far`` counts differing bits.

    A region that stays crowded at full depth (labels all but equal) is dealt into chunks by
    the node's hash, and each chunk's members are also paired with the region's first, so
    neighbours never need a whole region in one task.
    """
    half = DEPTH // 2
    tree = lambda t: F.struct(t.alias("tree"), *[F.element_at("label", t * half + k + 1).alias(f"p{k}") for k in range(half)])
    trees = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), tree)
    rows = nodes.select("node", "n_shingles", "s1", "s2", F.inline(trees))
    heads = [["tree", *[f"p{k}" for k in range(level // 2)]] for level in LEVELS]
    parts, star = [], None
    for head, deeper in zip(heads, [*heads[1:], None], strict=True):
        crowd = settle(rows.groupBy(*head).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("node", "n_shingles", "s1", "s2")).alias("_first")).where(F.col("_n") > CROWDED), "crowd")
        parts.append(rows.join(crowd.select(*head), head, "left_anti").withColumn("_region", F.xxhash64(*head)).withColumn("_chunk", F.lit(0).cast("long")))
        if crowd.isEmpty():
            break
        rows = rows.join(crowd, head)
        if deeper is None:
            chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("_n") / CROWDED))
            parts.append(rows.withColumn("_region", F.xxhash64(*head)).withColumn("_chunk", chunk).drop("_n", "_first"))
            star = rows.select(F.col("_first").alias("one"), F.struct("node", "n_shingles", "s1", "s2").alias("two"))
        rows = rows.drop("_n", "_first")
    region = Window.partitionBy("tree", "_region", "_chunk").orderBy(*[f"p{k}" for k in range(half)], "node")
    own = F.struct("node", "n_shingles", "s1", "s2")
    near = functools.reduce(DataFrame.unionByName, parts).select(own.alias("one"), F.array(*[F.lead(own, k).over(region) for k in range(1, NEIGHBOURS + 1)]).alias("after"))
    possible = lambda one, two: (
        (100 * F.least(one["n_shingles"], two["n_shingles"]) >= 75 * F.greatest(one["n_shingles"], two["n_shingles"])) & (_far(one, two) <= SKETCH_BITS)
    )
    near = near.select("one", F.explode(F.filter("after", lambda two: two.isNotNull() & possible(F.col("one"), two))).alias("two"))
    if star is not None:
        near = near.union(star.where((F.col("one.node") != F.col("two.node")) & possible(F.col("one"), F.col("two"))))
    swap = F.col("one.node") > F.col("two.node")
    a, b = F.when(swap, F.col("two.node")).otherwise(F.col("one.node")), F.when(swap, F.col("one.node")).otherwise(F.col("two.node"))
    return near.select(a.alias("a"), b.alias("b"), _far(F.col("one"), F.col("two")).alias("far")).groupBy("a", "b").agg(F.min("far").alias("far"))


def _far(one: Column, two: Column) -> Column:
    return F.bit_count(one["s1"].bitwiseXOR(two["s1"])) + F.bit_count(one["s2"].bitwiseXOR(two["s2"]))


def texts_of(keyed: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts that ``nodes`` names, each once, compressed: a third of what its shingles' hashes would take."""

    def pack(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(2).fill_null("").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([packer.compress(t) for t in texts], pa.binary())], ["doc_id", "th", "packed"])

    wanted = nodes.select(F.col("node.doc_id").alias("doc_id"), F.col("node.th").alias("th"))
    texts = keyed.join(wanted.hint("merge"), ["doc_id", "th"], "left_semi").dropDuplicates(["doc_id", "th"])
    return texts.select("doc_id", "th", "text").mapInArrow(bytestext.tidy(pack), "doc_id long, th long, packed binary").select(F.struct("doc_id", "th").alias("node"), "packed")


def _sets(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct shingles of each text."""
    out: list[np.ndarray] = []
    for _, hashes, begins in shingle_sets(pa.array(texts, pa.large_binary()).cast(pa.large_string())):
        out += [np.unique(hashes[b:e]) for b, e in zip(begins[:-1], begins[1:], strict=True)]
    return out


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of which at least three quarters of the united set is shared."""

    def check(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            keep, begin = [], 0
            packed = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            while begin < len(batch):
                one, two, size = [], [], 0
                while begin < len(batch) and (not one or size < bytestext.SLICE_BYTES):
                    one.append(unpack.decompress(packed[0][begin]))
                    two.append(unpack.decompress(packed[1][begin]))
                    size, begin = size + len(one[-1]) + len(two[-1]), begin + 1
                for x, y in zip(_sets(one), _sets(two), strict=True):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * shared >= 75 * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    out = pairs.join(texts.select(F.col("node").alias("b"), F.col("packed").alias("_b")), "b")
    out = out.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("_a")), "a").select("a", "b", "_a", "_b")
    kind = "struct<doc_id:bigint,th:bigint>"
    return bytestext.small_batches(out).mapInArrow(bytestext.tidy(check), f"a {kind}, b {kind}")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The smallest node (``home``) that each linked node reaches, by alternating star contractions.

    Each round points every node's larger neighbours, then its smaller ones, at the smallest
    node it knows; a node's neighbours are only ever summed up, never gathered. The number of
    rounds grows with the logarithm of the longest chain; links are written between rounds.
    """
    links = settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    for _ in range(most_rounds):
        if _are_stars(links):
            return links.select(F.col("b").alias("node"), F.col("a").alias("home"))
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("_m").alias("a"), "b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("_m"))
        small = large.join(low, "b").select(F.col("_m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where(F.col("a") != F.col("b")).distinct()
        links = settle(small, "links")
    raise RuntimeError(f"links not joined after {most_rounds} rounds")


def _are_stars(links: DataFrame) -> bool:
    """Whether each b stands once and no b is an a, so that links (a before b) are components already."""
    end = lambda side, below: F.struct(F.col(side).alias("node"), F.lit(below).alias("below"))
    ends = links.select(F.inline(F.array(end("a", 0), end("b", 1)))).groupBy("node").agg(F.sum("below").alias("below"), F.count(F.lit(1)).alias("n"))
    return ends.where("below > 0 AND n > 1").isEmpty()


def rooted(parents: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The first node (``home``) of each chain of links (a before b) in which every b stands once, by pointer doubling.

    A round is one join in which the rows not yet at a chain's first node look up where their
    home points; the number of rounds grows with the logarithm of the longest chain.
    """
    homes = settle(parents.select(F.col("b").alias("node"), F.col("a").alias("home"), F.lit(True).alias("moved")), "homes")
    for _ in range(most_rounds):
        up = homes.select(F.col("node").alias("home"), F.col("home").alias("_up"))
        step = homes.where("moved").join(up, "home", "left").select("node", F.coalesce("_up", "home").alias("home"), F.col("_up").isNotNull().alias("moved"))
        homes, before = settle(step.union(homes.where("NOT moved")), "homes"), homes
        discard(homes.sparkSession, before)
        if homes.where("moved").isEmpty():
            return homes.select("node", "home")
    raise RuntimeError(f"chains not followed after {most_rounds} rounds")


def joined(homes: DataFrame, links: DataFrame) -> DataFrame:
    """``homes`` (node, home; each home the smallest of its component) after more links (a, b), by the links between components alone."""
    if links.isEmpty():
        return homes
    home = lambda side: homes.select(F.col("node").alias(side), F.col("home").alias(f"_{side}"))
    between = links.join(home("a"), "a", "left").join(home("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    moved = components(between.where(F.col("a") != F.col("b")))
    up = moved.select(F.col("node").alias("home"), F.col("home").alias("_up"))
    return settle(homes.join(up, "home", "left").select("node", F.coalesce("_up", "home").alias("home")).union(moved), "homes")


def link(keyed: DataFrame, nodes: DataFrame) -> DataFrame:
    """The smallest node (``home``) that each node reaches by links between distinct sets; a node that is its own home is left out.

    Each node's likest earlier candidate is confirmed first; of the other candidates only
    those between different components are left to confirm.
    """
    pairs = settle(candidates(nodes), "candidates")
    texts = settle(texts_of(keyed, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "texts")
    likest = pairs.groupBy("b").agg(F.min(F.struct("far", "a")).alias("_l")).select(F.col("_l.a").alias("a"), "b")
    homes = rooted(confirmed(likest, texts))
    home = lambda side: homes.select(F.col("node").alias(side), F.col("home").alias(f"_{side}"))
    rest = pairs.select("a", "b").join(home("a"), "a", "left").join(home("b"), "b", "left")
    rest = rest.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b").join(likest, ["a", "b"], "left_anti")
    homes = joined(homes, settle(confirmed(rest, texts), "links"))
    discard(keyed.sparkSession, pairs, texts)
    return homes


def frequent(keyed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of shingles that stand out in some task, with their counts. They set an order only, results do not rest on them."""

    def count(batches):
        times = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for _, hashes, _ in shingle_sets(batch.column(2)):
                times += np.bincount((hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(times))
        often = np.flatnonzero(times > 2 * times.mean() + 8)
        yield pa.RecordBatch.from_arrays([pa.array(often), pa.array(times[often])], ["bucket", "times"])

    counted = bytestext.small_batches(keyed).mapInArrow(bytestext.tidy(count), "bucket long, times long")
    table = counted.groupBy("bucket").agg(F.sum("times").alias("times")).toArrow()
    return table.column(0).to_numpy(), table.column(1).to_numpy()


def _parity(own: np.ndarray, bits: int) -> np.ndarray:
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *rows])))


def rarest(keyed: DataFrame, buckets: np.ndarray, times: np.ndarray) -> DataFrame:
    """The first shingles of each text in one order of all shingles, rare before frequent: one more than a set 0.75 alike may lack.

    ``cold`` of them are not in a frequent bucket; these come first. ``parity`` is of the whole set, ``wide`` too, if it is large.
    """

    def pick(batches):
        weights = np.zeros(1 << BUCKET_BITS, np.int64)
        weights[buckets] = times
        for batch in batches:
            cold, found, parity, wide = [], [], [], []
            for _, hashes, begins in shingle_sets(batch.column(2)):
                for b, e in zip(begins[:-1], begins[1:], strict=True):
                    own = np.unique(hashes[b:e])
                    weight = weights[(own >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                    first = np.argsort(weight, kind="stable")[: len(own) - -(-3 * len(own) // 4) + 1]
                    cold.append(int((weight[first] == 0).sum()))
                    found.append(own[first].view(np.int64))
                    parity.append(_parity(own, PARITY_BITS))
                    wide.append(_parity(own, WIDE_BITS) if len(own) > LARGE else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cold, pa.int32()), _lists(found), _lists(parity), _lists(wide)],
                ["doc_id", "th", "cold", "first", "parity", "wide"],
            )

    schema = "doc_id long, th long, cold int, first array<long>, parity array<long>, wide array<long>"
    return bytestext.small_batches(keyed).mapInArrow(bytestext.tidy(pick), schema)


def missed(keyed: DataFrame, nodes: DataFrame, homes: DataFrame) -> DataFrame:
    """All links between different components, by the prefix filter.

    Two sets of which 3/7 of the summed sizes are shared have a first common shingle that
    leaves so many in both, and it is among the ``rarest`` of both. Shingles met once or in one
    component alone need nothing. A frequent one's rows are dealt into cells of about
    CROWDED: its largest component's once each, the others to each of those cells and to
    the cells in which they meet one another. Pairs whose parities differ in more than 1/7 of
    the summed sizes are not 0.75 alike, by few bits first, then by many; the sets of the others confirm.
    """
    keys = F.xxhash64("node").alias("key"), F.xxhash64(F.coalesce("home", "node")).alias("h"), F.col("n_shingles").cast("int").alias("n")
    narrow = nodes.select("node", "n_shingles").join(homes, "node", "left").select(F.col("node.doc_id").alias("doc_id"), F.col("node.th").alias("th"), *keys)
    first = rarest(keyed, *frequent(keyed)).join(narrow.hint("merge"), ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])
    first = settle(first, "rarest")
    rows = first.select("key", "h", "n", "cold", F.posexplode("first").alias("at", "t"))
    rows = rows.select("t", "key", "h", "n", (F.col("n") - F.col("at")).alias("left"), (F.col("at") >= F.col("cold")).alias("hot"))
    hot = rows.where("hot").groupBy("t", "h").agg(F.count(F.lit(1)).alias("c")).groupBy("t").agg(F.sum("c").alias("c"), F.max(F.struct("c", "h")).alias("_l"))
    hot = hot.where(F.col("c") > F.col("_l.c")).select(
        "t", F.col("_l.h").alias("_large"), F.ceil(F.col("_l.c") / CROWDED).alias("_m"), F.ceil((F.col("c") - F.col("_l.c")) / CROWDED).alias("_s")
    )
    rest = F.pmod(F.xxhash64("key"), "_s")
    cell = lambda at, side: F.struct(at.cast("long").alias("cell"), side.cast("long").alias("side"))
    once = F.array(cell(-1 - F.pmod(F.xxhash64("key"), "_m"), F.lit(0)))
    with_large = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1), lambda j: cell(-1 - j, F.lit(1)))
    with_rest = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_s") - 1), lambda j: cell(F.shiftleft(F.least(rest, j), 31) + F.greatest(rest, j), rest))
    cells = F.when(F.col("h") == F.col("_large"), once).otherwise(F.concat(with_large, with_rest))
    dealt = rows.where("hot").join(hot, "t").select("t", "key", "h", "n", "left", F.inline(cells))
    plain = rows.where("NOT hot").select("t", "key", "h", "n", "left", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("side"))
    rows = plain.union(dealt)
    alone = "a.cell >= 0 AND shiftright(a.cell, 31) = (a.cell & 2147483647)"
    common = f"a.t = b.t AND a.cell = b.cell AND a.key < b.key AND a.h != b.h AND (a.side != b.side OR {alone}) AND 7L * least(a.left, b.left) >= 3L * (a.n + b.n)"
    met = settle(rows.alias("a").join(rows.alias("b"), F.expr(common)).select(F.col("a.key").alias("_a"), F.col("b.key").alias("_b")).distinct(), "missed")
    own = lambda side, bits: first.select(F.col("key").alias(f"_{side}"), F.struct("doc_id", "th").alias(side), F.col("n").alias(f"_n{side}"), F.col(bits).alias(f"_p{side}"))
    apart = F.aggregate(F.zip_with("_pa", "_pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    possible = 7 * apart <= F.col("_na") + F.col("_nb")
    some = settle(met.join(own("a", "parity"), "_a").join(own("b", "parity"), "_b").where(possible).select("_a", "_b"), "missed")
    both = (F.size("_pa") > 0) & (F.size("_pb") > 0)
    pairs = settle(some.join(own("a", "wide"), "_a").join(own("b", "wide"), "_b").where(~both | possible).select("a", "b"), "missed")
    discard(keyed.sparkSession, first, met, some)
    texts = settle(texts_of(keyed, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "texts")
    links = settle(confirmed(pairs, texts), "links")
    discard(keyed.sparkSession, pairs, texts)
    return links


def _homes(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and each distinct set's digest with the node its component begins with."""
    spark = keyed.sparkSession
    labelled = settle(signatures(keyed), "signatures")
    nodes = settle(classes(labelled), "classes")
    signed = settle(labelled.select("doc_id", "th", "n_shingles", "d1", "d2"), "signed")
    discard(spark, labelled)
    homes = link(keyed, nodes)
    labelled, nodes = nodes, settle(nodes.select("d1", "d2", "node", "n_shingles"), "nodes")
    discard(spark, labelled)
    homes = joined(homes, missed(keyed, nodes, homes))
    return signed, nodes.join(homes, "node", "left").select("d1", "d2", "node", F.coalesce("home", "node").alias("home"))


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``documents``: doc_id, n_shingles, component_id, kept.

    Words are runs without ASCII white space, A-Z in lower case; shingles are five words;
    documents are linked at a similarity of 0.75. A null or empty text and one of blanks has
    no shingle and is linked with nothing. Equal rows get equal results. A null id never is
    the smallest: it is its component's id only if there is no other, and such rows are kept
    only then. Other columns are not read; an empty table gives an empty one.
    """
    keyed = documents.select(*_key(documents, id_column, text_column))
    signed, homes = _homes(keyed)
    home = homes.select("d1", "d2", F.col("home")["doc_id"].alias("_home"))
    out = signed.select("doc_id", "n_shingles", "d1", "d2").where("n_shingles > 0").join(home, ["d1", "d2"]).select("doc_id", "n_shingles", "_home")
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("_home"))
    known = lambda c: F.when(F.col(c) != NOBODY, F.col(c))
    return out.union(alone).select(known("doc_id").alias("doc_id"), "n_shingles", known("_home").alias("component_id"), (F.col("doc_id") == F.col("_home")).alias("kept"))


def one_of_each(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The first document of each component, with all its columns. Rows that repeat an id and a text count as one document."""
    keyed = documents.select(*_key(documents, id_column, text_column))
    signed, homes = _homes(keyed)
    first = settle(homes.where(F.col("node") == F.col("home")).select("node.*").union(signed.where("n_shingles = 0").select("doc_id", "th")), "kept")
    row = F.struct(*documents.columns).alias("row")
    own = documents.select(row, F.coalesce(F.col(id_column).cast("long"), F.lit(NOBODY)).alias("doc_id"), F.xxhash64(F.col(text_column).cast("string")).alias("th"))
    kept = own.join(first, ["doc_id", "th"], "left_semi").dropDuplicates(["doc_id", "th"])
    return kept.select("row.*")
