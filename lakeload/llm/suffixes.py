"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier in the corpus.
Sorting the suffixes of a whole corpus in one structure is no job for a cluster, so the
corpus is first cut, by content, into strings that can be compared apart:

1. Each window of LENGTH bytes names an anchor, the 50 bytes of it with the smallest hash.
   Equal windows name equal anchors. The windows in a row that name one anchor form a string.
2. Equal strings are kept once, at their first place; all windows of the copies are repeats.
3. Anchors that stand in different strings go on: their strings are dealt out by anchor, each
   task transforms them shard by shard and merges the shards' transforms by refining their
   interleave one symbol at a time. Places that still agree after a window's length are a
   repeated interval; all but its first place are repeats.
4. An anchor of more strings than one task may merge has them cut again by longer anchors, and
   they start over. The longest anchor is the window itself and has one string.
5. The repeats of a document are joined to its text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.session import settle

from . import bytestext

LENGTH = 100
#: Bytes of an anchor: at first, and where an anchor has too many strings.
ANCHORS = (50, 75, 100)
#: Symbols of a window when its first anchor is one symbol.
DEPTH = LENGTH - ANCHORS[0] + 1
#: A collection of strings that is merged at once, and the shards it is made of, in symbols.
COLLECTION, SHARD = 1 << 18, 1 << 16
#: Strings of one anchor beyond which it is common and its strings are cut again.
COMMON = 1 << 14

_GOLDEN, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def windows(data: np.ndarray, bounds: np.ndarray, size: int = ANCHORS[0]):
    """Strings of one anchor each: row, anchor hash, string hash, first window, last window, anchor's place (in ``data``)."""
    none = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3]
    places = len(data) - size + 1
    if len(data) < LENGTH:
        return none
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(bytestext.SYMBOLS[data] * bytestext.powers(bytestext._BASE, len(data)), out=sums[1:])
    inverse = bytestext.powers(bytestext._INVERSE, len(data) + 1)
    hashes = bytestext.mix((sums[size:] - sums[:-size]) * inverse[:places])
    # The first smallest hash of a window's places in a row, by doubling.
    least, where, span = hashes, np.arange(places, dtype=np.int32), 1
    while span <= LENGTH - size:
        step = min(span, LENGTH - size + 1 - span)
        later = least[step:] < least[:-step]
        least, where = np.where(later, least[step:], least[:-step]), np.where(later, where[step:], where[:-step])
        span += step
    begins = np.concatenate([np.arange(b, max(b, e - LENGTH + 1)) for b, e in zip(bounds[:-1], bounds[1:], strict=True)])
    if not len(begins):
        return none
    at = where[begins].astype(np.int64)
    change = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (begins[1:] != begins[:-1] + 1)]))
    low, high, at = begins[change], begins[np.concatenate([change[1:] - 1, [len(begins) - 1]])], at[change]
    whole = (sums[high + LENGTH] - sums[low]) * inverse[low]
    string = bytestext.mix(whole ^ ((high - low).astype(np.uint64) * _GOLDEN) ^ ((at - low).astype(np.uint64) * _OTHER))
    return np.searchsorted(bounds, low, side="right") - 1, hashes[at], string, low, high, at


def _packed(low, high, at) -> np.ndarray:
    """Place in a document, windows less one, and the anchor's distance, in one number."""
    return (low << 16) | ((high - low) << 8) | (at - low)


FOUND = "anchor long, string long, ord long, place long, salt byte, copy boolean"


def _told_apart(found: list[tuple]) -> pa.RecordBatch:
    """The strings of a batch (anchor, string, ord, place): all but the first of equal ones are known for copies and may go anywhere."""
    anchor, string, order, place = (np.concatenate(c) for c in zip(*found, strict=True))
    ranked = np.lexsort([place, order, string, anchor])
    anchor, string, order, place = anchor[ranked], string[ranked], order[ranked], place[ranked]
    copy = np.zeros(len(anchor), bool)
    copy[1:] = (anchor[1:] == anchor[:-1]) & (string[1:] == string[:-1])
    salt = np.where(copy, 1 + (order & 31), 0).astype(np.int8)
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor.view(np.int64)), pa.array(string.view(np.int64)), pa.array(order), pa.array(place), pa.array(salt), pa.array(copy)],
        ["anchor", "string", "ord", "place", "salt", "copy"],
    )


def anchored(documents: DataFrame) -> DataFrame:
    """The strings of all documents (ord, text)."""

    def find(batches):
        for batch in batches:
            data, bounds = bytestext.flat(batch.column(1))
            order, found = batch.column(0).to_numpy(), []
            for begin, end in bytestext.slices(bounds):
                own = bounds[begin : end + 1] - bounds[begin]
                row, anchor, string, low, high, at = windows(data[bounds[begin] : bounds[end]], own)
                first = own[row]
                found.append((anchor, string, order[begin + row], _packed(low - first, high - first, at - first)))
            if found:
                yield _told_apart(found)

    return documents.select("ord", "text").mapInArrow(bytestext.tidy(find), FOUND)


def anchored_again(strings: DataFrame, size: int) -> DataFrame:
    """Strings (anchor, ord, place, bytes) cut by anchors of ``size`` bytes."""

    def find(batches):
        for batch in batches:
            data, bounds = bytestext.flat(batch.column(2).cast(pa.large_binary()).view(pa.large_string()))
            order, place, found = batch.column(0).to_numpy(), batch.column(1).to_numpy(), []
            for begin, end in bytestext.slices(bounds):
                own = bounds[begin : end + 1] - bounds[begin]
                row, anchor, string, low, high, at = windows(data[bounds[begin] : bounds[end]], own, size)
                first = own[row] - (place[begin + row] >> 16)
                found.append((anchor, string, order[begin + row], _packed(low - first, high - first, at - first)))
            if found:
                yield _told_apart(found)

    return bytestext.small_batches(strings).select("ord", "place", "bytes").mapInArrow(bytestext.tidy(find), FOUND)


def collapsed(strings: DataFrame) -> DataFrame:
    """Copies of strings, and the first of each string whose anchor has another string.

    Works on sorted rows as they come: a copy is told by the row before it, and only the first
    row of an anchor is held back until its anchor shows another string, so a group of any size
    passes. What a batch knew for copies was dealt out by salt and passes as it is.
    """

    def pick(batches):
        last, held = (None, None, None), None
        for batch in batches:
            if not len(batch):
                continue
            anchor, string, salt, known = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 4, 5))
            opens = np.concatenate([[(anchor[0], salt[0]) != last[:2]], (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])])
            fresh = opens | np.concatenate([[string[0] != last[2]], string[1:] != string[:-1]])
            group = np.cumsum(opens)
            more = np.bincount(group, fresh & ~opens) > 0
            if held is not None and (more[0] or opens.any()):
                if more[0]:
                    yield _with_copy(held, np.zeros(1, bool))
                held = None
            emit = ~fresh | ~opens | more[group] | known
            if opens.any() and not more[-1]:
                at = int(np.flatnonzero(opens)[-1])
                held = None if emit[at] else batch.slice(at, 1)
            last = anchor[-1], salt[-1], string[-1]
            yield _with_copy(batch.filter(pa.array(emit)), (~fresh | known)[emit])

    return strings.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", "string", "ord", "place").mapInArrow(bytestext.tidy(pick), FOUND)


def _with_copy(batch: pa.RecordBatch, copy: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(copy)], batch.schema.names)


def extracted(documents: DataFrame, strings: DataFrame) -> DataFrame:
    """Add the bytes of strings (anchor, ord, place) to them."""
    wanted = strings.groupBy("ord").agg(F.collect_list(F.struct("anchor", "place")).alias("wanted"))

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for order, text, rows in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                text = unpack.decompress(text)
                for row in rows:
                    low, extra = row["place"] >> 16, (row["place"] >> 8) & 255
                    out.append((row["anchor"], order, row["place"], text[low : low + extra + LENGTH]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, (*[pa.int64()] * 3, pa.binary()), strict=True)],
                ["anchor", "ord", "place", "bytes"],
            )

    joined = documents.join(wanted, "ord").select("ord", "packed", "wanted")
    return joined.mapInArrow(bytestext.tidy(cut), "anchor long, ord long, place long, bytes binary")


def transform(symbols: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order (to a depth of ``depth`` at least), transform, and LF mapping of a shard, by rank doubling.

    Each string of the shard ends with symbol 0; before a string's first symbol stands the end of the one before it.
    """
    n = len(symbols)
    rank, span = symbols.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while span < depth:
        after = np.zeros(n, np.int64)
        after[:-span] = rank[span:] + 1 if span < n else 0
        both = rank * (n + (1 << 16) + 2) + after
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        span *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = order - 1
    return order, np.where(before >= 0, symbols[before], 0), place[before]


def merged(shards: list[np.ndarray], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the shards laid end to end) whose next ``depth`` symbols occur twice or more, and the interval of each.

    The shards' transforms are interleaved and the interleave is refined: in each round every
    row still in play steps to the suffix one symbol longer, by its shard's LF mapping, and
    rows are dealt by that symbol, keeping their order. After a round rows stand in the order
    of one more symbol; neighbours part in the round after their common prefix. A row without
    an equal neighbour has no equal at any greater depth and leaves.
    """
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in shards])])
    suffix, before, lf = [], [], []
    for first, shard in zip(firsts, shards, strict=False):
        order, symbol, step = transform(shard, depth)
        suffix.append(order + first)
        before.append(symbol)
        lf.append(step + first)
    suffix, before, lf = np.concatenate(suffix), np.concatenate(before).astype(np.uint16), np.concatenate(lf)
    rows, block = np.arange(firsts[-1]), np.zeros(firsts[-1], np.int64)
    for _ in range(depth):
        symbol = before[rows]
        dealt = np.argsort(symbol, kind="stable")
        dealt = dealt[np.searchsorted(symbol[dealt], 1) :]  # a string's first symbol has none before it
        symbol, block = symbol[dealt], block[dealt]
        parts = np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])]) if len(dealt) else np.zeros(0, bool)
        block = np.cumsum(parts) - 1
        stay = np.bincount(block, minlength=1)[block] > 1
        rows, block = lf[rows[dealt[stay]]], block[stay]
    return suffix[rows], block


def _repeats(strings: list[tuple], anchor_size: int) -> list[tuple[int, int]]:
    """(ord, start) of the windows of one collection that are not the first of their interval."""
    anchors: dict[int, int] = {}
    parts, owner, offset = [], [], []
    for k, (anchor, _, place, text) in enumerate(strings):
        extra, left = (place >> 8) & 255, place & 255
        code = 257 + anchors.setdefault(anchor, len(anchors))
        raw = np.frombuffer(text, np.uint8).astype(np.uint16) + 1
        parts.append(np.concatenate([raw[:left], np.array([code], np.uint16), raw[left + anchor_size :], np.zeros(1, np.uint16)]))
        size = len(parts[-1])
        owner.append(np.full(size, k, np.int32))
        offset.append(np.where(np.arange(size) <= extra, np.arange(size), -1).astype(np.int16))
    shards, held, total = [], [], 0
    for part in parts:
        held.append(part)
        total += len(part)
        if total >= SHARD:
            shards.append(np.concatenate(held))
            held, total = [], 0
    if held:
        shards.append(np.concatenate(held))
    places, interval = merged(shards, LENGTH - anchor_size + 1)
    owner, offset = np.concatenate(owner)[places], np.concatenate(offset)[places].astype(np.int64)
    window = offset >= 0
    owner, offset, interval = owner[window], offset[window], interval[window]
    order = np.array([s[1] for s in strings], np.int64)[owner]
    start = (np.array([s[2] for s in strings], np.int64) >> 16)[owner] + offset
    ranked = np.lexsort([start, order, interval])
    later = np.concatenate([[False], interval[ranked][1:] == interval[ranked][:-1]]) if len(ranked) else np.zeros(0, bool)
    return order[ranked][later], start[ranked][later]


REPEATS = "ord long, start long, stop long"


def _as_runs(order: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Windows as runs of bytes."""
    ranked = np.lexsort([start, order])
    order, start = order[ranked], start[ranked]
    opens = np.concatenate([[True], (order[1:] != order[:-1]) | (start[1:] > start[:-1] + LENGTH)]) if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(opens)
    last = np.concatenate([first[1:] - 1, [len(order) - 1]]) if len(first) else first
    return pa.RecordBatch.from_arrays([pa.array(order[first]), pa.array(start[first]), pa.array(start[last] + LENGTH)], ["ord", "start", "stop"])


def repeats_by_merge(strings: DataFrame, anchor_size: int = ANCHORS[0]) -> DataFrame:
    """Repeated runs among strings of the same anchor, merged collection by collection as they come."""

    def merge(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if held and row[0] != held[-1][0] and size >= COLLECTION:
                    yield _as_runs(*_repeats(held, anchor_size))
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) - anchor_size + 2
        if held:
            yield _as_runs(*_repeats(held, anchor_size))

    return strings.repartition("anchor").sortWithinPartitions("anchor", "ord", "place").mapInArrow(bytestext.tidy(merge), REPEATS)


def in_order(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """ord, doc_id, text and ``row``, the document as it came.

    ``ord`` is the id where ids are unique; else rows are numbered by id (null last), text hash and place.
    """
    rows = bytestext.small_batches(documents).select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), F.struct(*documents.columns).alias("row")
    )
    twice = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("doc_id IS NULL OR n > 1")
    if twice.isEmpty():
        return rows.select(F.col("doc_id").alias("ord"), "doc_id", "text", "row")
    rows = settle(rows.withColumn("_at", F.monotonically_increasing_id()), "rows")
    blocks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("doc_id").asc_nulls_last(), "_h", "_at"]
    narrow = rows.select("doc_id", F.xxhash64("text").alias("_h"), "_at").repartitionByRange(blocks, *keys).sortWithinPartitions(*keys)
    numbers = settle(narrow.select("_at", F.monotonically_increasing_id().alias("ord")), "order")
    return settle(rows.join(numbers, "_at").select("ord", "doc_id", "text", "row"), "ordered")


def repeats(documents: DataFrame) -> DataFrame:
    """Runs of bytes (ord, start, stop) to be removed from (ord, doc_id, text); runs may overlap."""
    texts, strings, out = packed_texts(documents), anchored(documents), None
    first, more = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255)
    for level, size in enumerate(ANCHORS):
        found = settle(collapsed(strings), "strings")
        runs = found.where("copy").select("ord", first.alias("start"), (first + more + LENGTH).alias("stop"))
        out = runs if out is None else out.union(runs)
        firsts = found.where("NOT copy")
        if size == LENGTH:
            break
        common = settle(firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > COMMON).select("anchor"), "common")
        if common.isEmpty():
            return out.union(repeats_by_merge(extracted(texts, firsts), size))
        out = out.union(repeats_by_merge(extracted(texts, firsts.join(common, "anchor", "left_anti")), size))
        strings = anchored_again(extracted(texts, firsts.join(common, "anchor", "left_semi")), ANCHORS[level + 1])
    return out


def packed_texts(documents: DataFrame) -> DataFrame:
    """The texts' bytes, compressed for their way through shuffles."""

    def pack(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(2).fill_null("").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([packer.compress(t) for t in texts], pa.binary())], ["ord", "doc_id", "packed"])

    return documents.select("ord", "doc_id", "text").mapInArrow(bytestext.tidy(pack), "ord long, doc_id long, packed binary")


def cut_out(text: bytes, runs: np.ndarray) -> tuple[bytes, int]:
    """The text without the runs (start and stop of each), and how many maximal runs that are."""
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    opens = np.concatenate([[True], runs[1:, 0] > reach[:-1]])
    start = runs[opens, 0]
    stop = reach[np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(runs) - 1]])]
    edges = [0, *np.stack([start, stop], axis=1).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), len(start)


def with_kept(documents: DataFrame) -> DataFrame:
    """doc_id, kept (the bytes that stay), n_bytes and n_spans of (ord, doc_id, text)."""
    runs = repeats(documents).groupBy("ord").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    joined = packed_texts(documents).join(runs, "ord", "left").select("doc_id", "packed", "runs", "ord")

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            runs = batch.column(2)
            at, flat = np.append(runs.offsets.to_numpy(), 0)[: len(runs) + 1], runs.values
            pairs = np.stack([flat.field(0).to_numpy(), flat.field(1).to_numpy()], axis=1)
            kept, sizes, spans = [], [], []
            for k, (text, known) in enumerate(zip(batch.column(1).to_pylist(), runs.is_valid().to_pylist(), strict=True)):
                text = unpack.decompress(text)
                sizes.append(len(text))
                left, n = cut_out(text, pairs[at[k] : at[k + 1]]) if known else (text, 0)
                kept.append(left)
                spans.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), batch.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(spans, pa.int64())],
                ["ord", "doc_id", "kept", "n_bytes", "n_spans"],
            )

    return joined.mapInArrow(bytestext.tidy(cut), "ord long, doc_id long, kept binary, n_bytes long, n_spans long")


def deduplicated(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty; texts under LENGTH bytes stay whole. Of equal rows the first keeps
    its text. Rows of equal id follow by a hash of the text, null ids come last. Other columns
    are not read; an empty table gives an empty one.
    """
    kept = with_kept(in_order(documents, id_column, text_column))
    size = F.octet_length("kept").cast("long")
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - size).alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def with_texts_cut(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` with the repeated bytes cut out of their texts, all columns and rows kept.

    A cut may split a character; what is left of it goes too.
    """
    rows = in_order(documents, id_column, text_column)

    def read(batches):
        for batch in batches:
            texts = [b.decode("utf-8", "ignore") for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["ord", "_text"])

    texts = with_kept(rows).select("ord", "kept").mapInArrow(bytestext.tidy(read), "ord long, _text string")
    both = texts.join(rows.select("ord", "row"), "ord")
    return both.select(*[F.col("_text").alias(c) if c == text_column else F.col("row")[c].alias(c) for c in documents.columns])
