"""Benchmark decontamination by SimHash over windows of each item's length.

Every item and every window of as many words gets a 64-bit SimHash of its word shingles.
The items' fingerprints stand in a multi-index of eight 8-bit blocks: two fingerprints that
differ in at most 23 bits differ in at most two bits of some block, so looking up each block
with up to two bits flipped misses none within that radius. What it finds is verified by the
exact weighted shingle similarity, weights being how often a shingle occurs. A document shorter
than an item is a window as a whole, and is compared with the items that share its shingles.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytestext

SIZE, NUMERATOR, DENOMINATOR = 5, 75, 100
#: At a similarity of 0.75 SimHashes differ in 11 bits on average with a deviation of 3; this is four deviations above.
RADIUS = 23
BLOCKS = 8
#: Items that are sent to executors at once; more items are worked off in several passes over the corpus.
ITEMS_AT_ONCE = 20_000

_FLIPS = np.array([0, *[1 << i for i in range(8)], *[(1 << i) | (1 << j) for i, j in itertools.combinations(range(8), 2)]], np.uint8)
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint8)


def simhashes(hashes: np.ndarray, begins: np.ndarray, length: int) -> np.ndarray:
    """SimHash of ``length`` successive shingles from each place, by running sums of their bits."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return np.packbits(2 * (sums[begins + length] - sums[begins]) > length, axis=1).view(">u8").ravel().astype(np.uint64)


@dataclass
class Items:
    """The items of one pass by number: ids, words, shingles with counts, fingerprint, and the indexes over them."""

    ids: list[int]
    words: np.ndarray
    shingles: list[tuple[np.ndarray, np.ndarray]]
    prints: np.ndarray

    def __post_init__(self):
        self.index = {}
        for block in range(BLOCKS):
            for item, value in enumerate((self.prints >> np.uint64(8 * block)).astype(np.uint8)):
                for near in (value ^ _FLIPS).tolist():
                    self.index.setdefault((block, near), []).append(item)
        self.index = {k: np.array(v) for k, v in self.index.items()}
        self.by_size = {size: np.unique(np.concatenate([s for (s, _), w in zip(self.shingles, self.words, strict=True) if min(w, SIZE) == size])) for size in sorted({min(w, SIZE) for w in self.words.tolist()})}
        self.by_length = {n: np.unique(np.concatenate([s for (s, _), w in zip(self.shingles, self.words, strict=True) if w == n])) for n in np.unique(self.words).tolist()}

        order = np.argsort(every := np.concatenate([s for s, _ in self.shingles]), kind="stable")
        self.flat, self.times = every[order], np.concatenate([c for _, c in self.shingles])[order]
        self.owner = np.repeat(np.arange(len(self.shingles)), [len(s) for s, _ in self.shingles])[order]

    def longer(self, hashes: np.ndarray) -> list[tuple[int, float]]:
        """Items with more than these shingles, all of a document, that are similar to them, and how similar."""
        there, times = np.unique(hashes, return_counts=True)
        low, high = np.searchsorted(self.flat, there), np.searchsorted(self.flat, there, side="right")
        take = high - low
        at = np.repeat(low - np.cumsum(take) + take, take) + np.arange(take.sum())
        shared = np.bincount(self.owner[at], np.minimum(np.repeat(times, take), self.times[at]), len(self.words)).astype(np.int64)
        wide = self.words - SIZE + 1
        united = wide + len(hashes) - shared
        found = np.flatnonzero((wide > len(hashes)) & (shared * DENOMINATOR >= united * NUMERATOR))
        return [(int(k), int(shared[k]) / int(united[k])) for k in found]

    def near(self, fingerprint: int, length: int) -> list[int]:
        """Items of ``length`` words within the radius."""
        found = [self.index[k] for b in range(BLOCKS) if (k := (b, (fingerprint >> 8 * b) & 255)) in self.index]
        if not found:
            return []
        found = np.unique(np.concatenate(found))
        found = found[self.words[found] == length]
        apart = _ONES[(self.prints[found] ^ np.uint64(fingerprint)).view(np.uint8).reshape(-1, 8)].sum(axis=1)
        return found[apart <= RADIUS].tolist()

    def similar(self, item: int, hashes: np.ndarray) -> float:
        """Weighted shingle similarity of an item and a window's shingles: shared over united counts."""
        own, counts = self.shingles[item]
        there, times = np.unique(hashes, return_counts=True)
        _, at, to = np.intersect1d(own, there, assume_unique=True, return_indices=True)
        shared = int(np.minimum(counts[at], times[to]).sum())
        return shared / (int(counts.sum()) + len(hashes) - shared)


def read_items(benchmark: DataFrame) -> list[Items]:
    """All items in groups of bounded number. Items without words and repeated items (id and text) are left out."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("text IS NOT NULL").distinct()
    passes, out = -(-rows.count() // ITEMS_AT_ONCE), []
    for k in range(passes):
        table = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).toArrow() if passes > 1 else rows.toArrow()
        data, bounds = bytestext.flat(table.column(1))
        starts, ends, of_row = bytestext.words(data, bounds)
        hashes, begins = bytestext.shingles(bytestext.span_hashes(data, starts, ends), of_row, SIZE)
        full = np.flatnonzero(np.diff(of_row))
        if len(full):
            prints = [simhashes(hashes[begins[r] : begins[r + 1]], np.zeros(1, np.int64), begins[r + 1] - begins[r])[0] for r in full]
            sets = [np.unique(hashes[begins[r] : begins[r + 1]], return_counts=True) for r in full]
            out.append(Items([table.column(0)[int(r)].as_py() for r in full], np.diff(of_row)[full], sets, np.array(prints, np.uint64)))
    return out


def _runs(hashes: np.ndarray, of_row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each word on, and whether they are in one row."""
    n = len(hashes)
    fits = np.zeros(n, bool)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        shifted = np.zeros(n, np.uint64)
        shifted[: n - k] = hashes[k:]
        out = out * np.uint64(bytestext._BASE) + shifted
    last = np.repeat(of_row[1:], np.diff(of_row))
    np.less_equal(np.arange(n) + size, last, out=fits)
    return bytestext.mix(out), fits


def leaks_in(items: Items, column) -> list[tuple[int, int, float, int]]:
    """(row, item, similarity, first word) of the best window for each row and item that reaches the threshold.

    A window can reach it only if enough of its shingles are shingles of an item of its length,
    which is counted first; other windows need no fingerprint.
    """
    best: dict[tuple[int, int], tuple[float, int]] = {}
    data, bounds = bytestext.flat(column)
    for begin, end in bytestext.slices(bounds):
        part = data[bounds[begin] : bounds[end]]
        starts, ends, of_row = bytestext.words(part, bounds[begin : end + 1] - bounds[begin])
        if not len(starts):
            continue
        hashes = bytestext.span_hashes(part, starts, ends)
        for size, known in items.by_size.items():
            runs, fits = _runs(hashes, of_row, size)
            told = np.zeros(1 << 20, bool)
            told[(known >> np.uint64(44)).astype(np.int64)] = True
            hit = np.flatnonzero(told[(runs >> np.uint64(44)).astype(np.int64)] & fits)
            hit = hit[known[np.minimum(np.searchsorted(known, runs[hit]), len(known) - 1)] == runs[hit]]
            if len(hit):
                _windows(items, size, runs, hit, of_row, begin, best)
                if size == SIZE:
                    _short(items, runs, hit, of_row, begin, best)
    return [(row, item, similarity, word) for (row, item), (similarity, word) in best.items()]


def _short(items: Items, runs, hit, of_row, first_row: int, best: dict) -> None:
    """Rows of fewer words than an item, each as one window, if enough of its shingles are items'."""
    wide = np.diff(of_row) - SIZE + 1
    known = np.bincount(np.searchsorted(of_row, hit, side="right") - 1, minlength=len(wide))
    enough = (wide > 0) & (wide + SIZE - 1 < items.words.max()) & (known * DENOMINATOR >= (wide + 1) * NUMERATOR)
    for row in np.flatnonzero(enough).tolist():
        for item, similarity in items.longer(runs[of_row[row] : of_row[row] + wide[row]]):
            best[first_row + row, item] = similarity, 0


def _windows(items: Items, size: int, runs, hit, of_row, first_row: int, best: dict) -> None:
    every, told = hit, runs[hit]
    for length, known in ((n, k) for n, k in items.by_length.items() if min(n, SIZE) == size):
        hit = every[np.isin(told, known)]
        row_of_hit = np.searchsorted(of_row, hit, side="right") - 1
        wide = length - size + 1  # shingles in a window
        least = -(-2 * NUMERATOR * wide // (NUMERATOR + DENOMINATOR))
        low = np.maximum(hit - wide + 1, of_row[row_of_hit])
        high = np.minimum(hit + 1, of_row[row_of_hit + 1] - length + 1)
        low, high = low[low < high], high[low < high]
        if not len(low):
            continue
        ends = np.maximum.accumulate(high)
        fresh = np.maximum(low, np.concatenate([[0], ends[:-1]]))
        take = np.maximum(high - fresh, 0)
        begins = np.repeat(fresh - np.cumsum(take) + take, take) + np.arange(take.sum())
        begins = begins[np.searchsorted(hit, begins + wide) - np.searchsorted(hit, begins) >= least]
        if not len(begins):
            continue
        # Windows of one stretch share their running sums; a gap begins another stretch.
        for stretch in np.split(begins, np.flatnonzero(np.diff(begins) > wide) + 1):
            own = runs[stretch[0] : stretch[-1] + wide]
            for at, fingerprint in zip(stretch.tolist(), simhashes(own, stretch - stretch[0], wide).tolist(), strict=True):
                for item in items.near(fingerprint, length):
                    similarity = items.similar(item, runs[at : at + wide])
                    if similarity * DENOMINATOR >= NUMERATOR:
                        row = int(np.searchsorted(of_row, at, side="right")) - 1
                        key, found = (first_row + row, item), (similarity, -(at - int(of_row[row])))
                        best[key] = max(best.get(key, (0.0, 0)), found)


def leaks(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document and benchmark item of which some window reaches a similarity of 0.75.

    ``similarity`` and ``first_word`` are those of the best, then first, window; ``n_words``
    is the item's length and the window's, but that a document shorter than the item is one
    window. Words are runs without ASCII white space, A-Z in lower case; shingles are
    five words, or all words of an item that has fewer. Null and empty texts, items without
    words and an empty benchmark have no rows; a repeated row of ``documents`` repeats its
    rows. Other columns are not read. No shuffle: items go to the corpus, in groups of a
    bounded number.
    """
    narrow = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"

    def pass_over(items: Items):
        def search(batches):
            for batch in batches:
                found = leaks_in(items, batch.column(1))
                ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([items.ids[f[1]] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64()),
                     pa.array([-f[3] for f in found], pa.int64()), pa.array([int(items.words[f[1]]) for f in found], pa.int64())],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words"],
                )

        return bytestext.small_batches(narrow).mapInArrow(bytestext.tidy(search), schema)

    out = documents.sparkSession.createDataFrame([], schema)
    for items in read_items(benchmark):
        out = out.union(pass_over(items))
    return out


def clean(documents: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, all their columns kept.

    A row is judged by its own text in one pass, so ids need not be unique and nothing is joined.
    """
    out = documents
    for items in read_items(benchmark):
        at = documents.columns.index(text_column)

        def keep(batches, items=items, at=at):
            for batch in batches:
                leaking = np.unique([f[0] for f in leaks_in(items, batch.column(at))]).astype(np.int64)
                mask = np.ones(len(batch), bool)
                mask[leaking] = False
                yield batch.filter(pa.array(mask))

        out = bytestext.small_batches(out).mapInArrow(bytestext.tidy(keep), documents.schema)
    return out
