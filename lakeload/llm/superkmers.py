"""Removal of repeated windows of words by super-k-mers.

A word goes if a window of WINDOW words that covers it also starts in an earlier document.
Each window has a minimiser, the run of m words in it whose hash is smallest. Windows in a row
that share theirs travel as one string (a super-k-mer) to the minimiser's bucket, so equal
windows meet there:

1. Equal strings are kept once, at the first document that has them; all windows of the others
   are repeats. Before they travel, the copies within a batch are told apart already, so a
   string that many documents hold arrives a few times only.
2. Buckets that hold different strings get their words; sorting the strings' windows shows
   which stand in an earlier document.
3. A bucket of more than CROWDED strings is divided first: its strings are cut again by the
   next longer minimiser. The longest is the window itself, whose bucket holds one string.
4. The repeats of a document are joined to its text.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.session import settle

from . import bytestext
from .suffixes import in_order, packed_texts

WINDOW = 13
#: Words of a minimiser, by level; a bucket too large for one goes on to the next.
MINIMISERS = (6, 9, 11, 13)
#: Strings of a bucket that one task sorts at once.
CROWDED = 1 << 16
#: Documents looked at to tell which buckets get most strings, slots they are counted in, and salts of their strings. Balance only.
SAMPLE_DOCUMENTS, SLOT_BITS, SALTS = 20_000, 16, 64

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
ROWS = "bucket long, string long, ord long, place long, salt byte, copy boolean"
REPEATS = "ord long, start long, stop long"


def cut(hashes: np.ndarray, of_row: np.ndarray, m: int):
    """Super-k-mers of rows of word hashes: row, minimiser, string hash, first window (in the row), windows less one."""
    n = np.diff(of_row)
    windows = np.maximum(n - WINDOW + 1, 0)
    total = int(windows.sum())
    if not total:
        return [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * bytestext.powers(bytestext._BASE, len(hashes)), out=sums[1:])
    inverse = bytestext.powers(bytestext._INVERSE, len(hashes) + 1)
    runs = bytestext.mix((sums[m:] - sums[:-m]) * inverse[: len(sums) - m])
    # The first smallest hash of WINDOW - m + 1 runs in a row, by doubling.
    least, where, span, wide = runs, np.arange(len(runs), dtype=np.int64), 1, WINDOW - m + 1
    while span < wide:
        step = min(span, wide - span)
        later = least[step:] < least[:-step]
        least, where = np.where(later, least[step:], least[:-step]), np.where(later, where[step:], where[:-step])
        span += step
    row = np.repeat(np.arange(len(n)), windows)
    begins = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows) + of_row[:-1][row]
    at = where[begins]
    change = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])]))
    low, high = begins[change], begins[np.concatenate([change[1:] - 1, [total - 1]])]
    string = bytestext.mix((sums[high + WINDOW] - sums[low]) * inverse[low] ^ ((high - low).astype(np.uint64) * _GOLDEN))
    row = row[change]
    return row, runs[at[change]], string, low - of_row[row], high - low


def _told_apart(bucket: np.ndarray, string: np.ndarray, order: np.ndarray, place: np.ndarray, hot: np.ndarray | None):
    """A batch of ROWS: copies of strings that an earlier document of the batch holds are marked and dealt anywhere."""
    ranked = np.lexsort([place, order, string, bucket])
    bucket, string, order, place = bucket[ranked], string[ranked], order[ranked], place[ranked]
    opens = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (string[1:] != string[:-1])]) if len(bucket) else np.zeros(0, bool)
    copy = order != order[np.flatnonzero(opens)][np.cumsum(opens) - 1] if len(bucket) else opens
    salt = np.where(copy, SALTS + 1 + (order & 31), 0)
    if hot is not None and len(hot):
        known = hot[np.minimum(np.searchsorted(hot, _slot(bucket)), len(hot) - 1)] == _slot(bucket)
        salt = np.where(~copy & known, 1 + (string % np.uint64(SALTS)).astype(np.int64), salt)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket.view(np.int64)), pa.array(string.view(np.int64)), pa.array(order), pa.array(place), pa.array(salt.astype(np.int8)), pa.array(copy)],
        ["bucket", "string", "ord", "place", "salt", "copy"],
    )


def _slot(bucket: np.ndarray) -> np.ndarray:
    return (bucket >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _of_texts(column, order: np.ndarray):
    """For slices of a text column: bucket, string, ord and place of its super-k-mers."""
    data, bounds = bytestext.flat(column)
    for begin, end in bytestext.slices(bounds):
        own = bounds[begin : end + 1] - bounds[begin]
        part = data[bounds[begin] : bounds[end]]
        starts, ends, of_row = bytestext.words(part, own)
        row, bucket, string, low, more = cut(bytestext.span_hashes(part, starts, ends, bytestext.SYMBOLS), of_row, MINIMISERS[0])
        yield bucket, string, order[begin + row], (low << 8) | more


def hot_slots(documents: DataFrame) -> np.ndarray:
    """Slots of minimisers that get more than a quarter of a task's fair share in a sample. Their strings are salted; no result rests on it."""
    n = documents.count()
    sample = documents.sample(SAMPLE_DOCUMENTS / n, seed=1) if n > SAMPLE_DOCUMENTS else documents

    def count(batches):
        times = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for bucket, string, *_ in _of_texts(batch.column(1), batch.column(0).to_numpy()):
                times += np.bincount(_slot(bucket[np.unique(string, return_index=True)[1]]), minlength=len(times))
        some = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(times[some])], ["slot", "times"])

    counted = sample.select("ord", "text").mapInArrow(bytestext.tidy(count), "slot long, times long").groupBy("slot").agg(F.sum("times").alias("times"))
    table = counted.toArrow()  # at most as many rows as slots
    times = table.column(1).to_numpy()
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return np.sort(table.column(0).to_numpy()[times > max(64, times.sum() / (4 * tasks))])


def super_kmers(documents: DataFrame, hot: np.ndarray) -> DataFrame:
    """The strings of all documents by hash, with their places."""

    def find(batches):
        for batch in batches:
            found = list(_of_texts(batch.column(1), batch.column(0).to_numpy()))
            if found:
                yield _told_apart(*map(np.concatenate, zip(*found, strict=True)), hot)

    return documents.select("ord", "text").mapInArrow(bytestext.tidy(find), ROWS)


def collapsed(strings: DataFrame) -> DataFrame:
    """Copies of strings, and for buckets with different strings those of each string's first document.

    Works on sorted rows as they come; of a bucket only the first document's rows of its first
    string are held back until another string shows. Salted buckets may have others elsewhere,
    so all their firsts go on.
    """

    def pick(batches):
        held, last, many = None, None, False
        for batch in batches:
            if not len(batch):
                continue
            bucket, string, order, salt, copy = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 4, 5))
            n = len(batch)
            opens = np.empty(n, bool)
            opens[1:] = (bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1])
            opens[0] = last is None or (bucket[0], salt[0]) != last[:2]
            fresh = opens.copy()
            fresh[1:] |= string[1:] != string[:-1]
            fresh[0] |= not opens[0] and string[0] != last[2]
            # The first document of each string; before the batch's first change it is the one carried over.
            own = np.cumsum(fresh)
            firsts = np.concatenate([[last[3] if last else 0], order[fresh]])[own]
            repeat = copy | (order != firsts)
            group = np.cumsum(opens)
            different = np.bincount(group, fresh & ~opens, minlength=group[-1] + 1) > 0
            different[0] |= many
            if held is not None and (different[0] or group[-1] > 0):
                if different[0]:
                    yield from held
                held = None
            spread = different[group] | (salt != 0)
            yield _marked(batch, repeat | spread, repeat)
            if not different[-1]:
                wait = (group == group[-1]) & ~repeat & ~spread
                if wait.any():
                    held = [*(held or []), _marked(batch, wait, repeat)]
            last, many = (bucket[-1], salt[-1], string[-1], firsts[-1]), bool(different[-1])

    return strings.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "string", "ord", "place").mapInArrow(bytestext.tidy(pick), ROWS)


def _marked(batch: pa.RecordBatch, rows: np.ndarray, repeat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(repeat)], batch.schema.names).filter(pa.array(rows))


def packed(documents: DataFrame, strings: DataFrame) -> DataFrame:
    """The strings (bucket, ord, place) with their words, joined by blanks."""
    wanted = strings.groupBy("ord").agg(F.collect_list(F.struct("bucket", "place")).alias("wanted"))

    def take(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for order, text, rows in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = unpack.decompress(text).split()
                for row in rows:
                    low = row["place"] >> 8
                    out.append((row["bucket"], order, row["place"], b" ".join(words[low : low + WINDOW + (row["place"] & 255)])))
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 3, pa.binary()), strict=True)], ["bucket", "ord", "place", "words"])

    joined = documents.join(wanted, "ord").select("ord", "packed", "wanted")
    return joined.mapInArrow(bytestext.tidy(take), "bucket long, ord long, place long, words binary")


def sorted_windows(strings: DataFrame) -> DataFrame:
    """Runs of words (ord, start, stop) of the buckets' windows that stand in an earlier document."""

    def count(batches):
        bucket, windows = None, []
        for batch in batches:
            runs = []
            for own, order, place, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if own != bucket:
                    runs += _later(windows)
                    bucket, windows = own, []
                words, low = text.split(b" "), place >> 8
                windows += [(b" ".join(words[k : k + WINDOW]), order, low + k) for k in range(len(words) - WINDOW + 1)]
            yield _runs(runs)
        yield _runs(_later(windows))

    return strings.repartition("bucket").sortWithinPartitions("bucket", "ord", "place").mapInArrow(bytestext.tidy(count), REPEATS)


def _later(windows: list[tuple[bytes, int, int]]) -> list[tuple[int, int]]:
    """(ord, start) of windows whose words a smaller ``ord`` has too."""
    windows.sort()
    out, text, first = [], None, None
    for words, order, start in windows:
        if words != text:
            text, first = words, order
        elif order != first:
            out.append((order, start))
    return out


def _runs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    """Windows as runs of words."""
    found.sort()
    out: list[list[int]] = []
    for order, start in found:
        if out and out[-1][0] == order and start <= out[-1][2]:
            out[-1][2] = start + WINDOW
        else:
            out.append([order, start, start + WINDOW])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 3)], ["ord", "start", "stop"])


def recut(strings: DataFrame, level: int) -> DataFrame:
    """Strings with their words, cut again by the minimiser of ``level``."""

    def find(batches):
        for batch in batches:
            data, bounds = bytestext.flat(batch.column(2).cast(pa.large_binary()).cast(pa.large_string()))
            order, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for begin, end in bytestext.slices(bounds):
                own = bounds[begin : end + 1] - bounds[begin]
                part = data[bounds[begin] : bounds[end]]
                starts, ends, of_row = bytestext.words(part, own)
                row, bucket, string, low, more = cut(bytestext.span_hashes(part, starts, ends, bytestext.SYMBOLS), of_row, MINIMISERS[level])
                yield _told_apart(bucket, string, order[begin + row], (((place[begin + row] >> 8) + low) << 8) | more, None)

    return bytestext.small_batches(strings).select("ord", "place", "words").mapInArrow(bytestext.tidy(find), ROWS)


def repeats(documents: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Runs of words (ord, start, stop) of (ord, doc_id, text) that go; runs may overlap."""
    texts = packed_texts(documents)
    strings, out = super_kmers(documents, hot_slots(documents)), None
    first = F.shiftright("place", 8)
    for level in range(len(MINIMISERS)):
        found = settle(collapsed(strings), "strings")
        runs = found.where("copy").select("ord", first.alias("start"), (first + F.col("place").bitwiseAND(255) + WINDOW).alias("stop"))
        out = runs if out is None else out.union(runs)
        firsts = found.where("NOT copy")
        if MINIMISERS[level] == WINDOW:
            return out
        crowd = settle(firsts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowded).select("bucket"), "crowded")
        if crowd.isEmpty():
            return out.union(sorted_windows(packed(texts, firsts)))
        out = out.union(sorted_windows(packed(texts, firsts.join(crowd, "bucket", "left_anti"))))
        strings = recut(packed(texts, firsts.join(crowd, "bucket", "left_semi")), level + 1)
    return out


def with_words_kept(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept (its words, joined by blanks) of (ord, doc_id, text)."""
    runs = repeats(documents).groupBy("ord").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    joined = packed_texts(documents).join(runs, "ord", "left").select("doc_id", "packed", "runs")

    def keep(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = unpack.decompress(text).split()
                sizes.append(len(words))
                if runs:
                    marks = np.zeros(len(words) + 1, np.int64)
                    for run in runs:
                        marks[run["start"]] += 1
                        marks[run["stop"]] -= 1
                    words = list(itertools.compress(words, (np.cumsum(marks)[:-1] == 0).tolist()))
                removed.append(sizes[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return joined.mapInArrow(bytestext.tidy(keep), "doc_id long, n_words long, n_removed long, kept string")


def without_repeats(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept of every document: its words without those that windows of earlier ones cover.

    Words are stretches without ASCII white space, case as it is; a window is 13 in a row. A
    document is earlier if its id is smaller; rows of equal id follow by a hash of their text,
    then as they come, null ids are last. Windows are judged on the input. What a document repeats of
    itself alone stays. A null text, an empty one and one of blanks have no words; texts under
    13 words stay whole. Other columns are not read; an empty table gives an empty one.
    """
    return with_words_kept(in_order(documents, id_column, text_column))
