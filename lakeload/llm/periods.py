"""Periodic runs of words, found through longest common extensions over a difference cover.

A run of period q and at least four of its lengths covers, for its q, a point of the grid
0, 3q, 6q, … of its document together with the word q further on. So for every period the
grid's points are compared with the words one period on (n/3 (1 + 1/2 + 1/3 + …) points in
all), and where they agree, how far both sides extend gives the run.

How far two places agree is answered without a suffix order of all places: only places whose
number falls in a difference cover modulo PERIOD are sorted. From any two places the same
small step leads to two sorted ones; the words of that step are compared, the rest is a range
minimum over the common prefixes of neighbours, held in a sparse table.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytestext

#: A perfect difference set; every difference modulo 31 is one of two of its numbers.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
#: The fewest periods and words of a run.
TIMES, WORDS = 4, 6
#: Grid points that are looked at in one go.
POINTS = 1 << 20


def _steps() -> np.ndarray:
    """For two places modulo PERIOD the smallest step that leads both into the cover."""
    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True
    place = np.arange(PERIOD)
    both = inside[(place[:, None, None] + place) % PERIOD] & inside[(place[None, :, None] + place) % PERIOD]
    if not both.any(axis=2).all():
        raise ValueError(f"{COVER} is no difference cover modulo {PERIOD}")
    return both.argmax(axis=2)


STEPS = _steps()


class Extensions:
    """How many symbols agree from two places on. The last symbol must occur nowhere else."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.symbols = np.concatenate([symbols, np.full(PERIOD, -1, symbols.dtype)])
        sizes = [max(0, -(-(n - c) // PERIOD)) for c in COVER]
        self.first = np.zeros(PERIOD, np.int64)
        self.first[list(COVER)] = np.cumsum([0, *sizes[:-1]])
        places = np.concatenate([np.arange(c, n, PERIOD) for c in COVER])
        self.ends = np.repeat(np.cumsum(sizes), sizes)
        m = len(places)
        sums = np.zeros(len(self.symbols) + 1, np.uint64)
        factors = bytestext.powers(bytestext._BASE, len(self.symbols))
        np.cumsum(bytestext.mix(self.symbols.astype(np.uint64) + np.uint64(1)) * factors, out=sums[1:])
        blocks = (sums[places + PERIOD] - sums[places]) * bytestext.powers(bytestext._INVERSE, len(self.symbols) + 1)[places]
        # Ranks by 1, 2, 4, … blocks of PERIOD symbols, until all differ.
        ranks = [np.unique(blocks, return_inverse=True)[1]]
        while ranks[-1].max() + 1 < m:
            after = self._at(ranks[-1], np.arange(m), 1 << (len(ranks) - 1)) + 1
            ranks.append(np.unique(ranks[-1] * (m + 1) + after, return_inverse=True)[1])
        self.rank = ranks[-1]
        order = np.argsort(self.rank)
        one, two = order[:-1], order[1:]
        common = np.zeros(max(m - 1, 0), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            a, b = self._at(ranks[level], one, common), self._at(ranks[level], two, common)
            common += np.where((a == b) & (a >= 0), 1 << level, 0)
        # Minima of the neighbours' common blocks over 1, 2, 4, … of them.
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            half = 1 << (len(self.table) - 1)
            self.table.append(np.minimum(self.table[-1][:-half], self.table[-1][half:]))

    def _at(self, ranks: np.ndarray, rows: np.ndarray, further) -> np.ndarray:
        """Ranks of the sorted places some blocks after ``rows``; -1 beyond the end."""
        there = rows + further
        return np.where(there < self.ends[rows], ranks[np.minimum(there, len(ranks) - 1)], -1)

    def _agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Symbols that agree, ``most`` at most (fewer than PERIOD or as many)."""
        out = np.zeros(len(a), np.int64)
        rows = np.arange(len(a))
        for k in range(PERIOD):
            rows = rows[most[rows] > k]
            rows = rows[self.symbols[a[rows] + k] == self.symbols[b[rows] + k]]
            if not len(rows):
                break
            out[rows] += 1
        return out

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For places a and b, a < b each, the number of symbols that agree."""
        step = STEPS[a % PERIOD, b % PERIOD]
        out = self._agree(a, b, step)
        on = np.flatnonzero(out == step)
        a, b = a[on] + step[on], b[on] + step[on]
        ranks = np.stack([self.rank[self.first[x % PERIOD] + x // PERIOD] for x in (a, b)])
        low, high = ranks.min(axis=0), ranks.max(axis=0)
        blocks = np.zeros(len(on), np.int64)
        width = np.frexp((high - low).astype(np.float64))[1] - 1
        for level in np.unique(width):
            rows = np.flatnonzero(width == level)
            blocks[rows] = np.minimum(self.table[level][low[rows]], self.table[level][high[rows] - (1 << level)])
        a, b = a + blocks * PERIOD, b + blocks * PERIOD
        out[on] += blocks * PERIOD + self._agree(a, b, np.full(len(on), PERIOD))
        return out


def runs(symbols: np.ndarray, of_row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start (in the row), length and smallest period of all runs, in the order of row, start and period.

    ``symbols`` are the rows' words end to end, ``of_row`` says where each row begins.
    """
    n = np.diff(of_row)
    _, ids = np.unique(symbols, return_inverse=True)
    # Between rows, before the first and after the last, a symbol that occurs once.
    begins = of_row[:-1] + np.arange(1, len(n) + 1)
    laid = np.zeros(len(ids) + len(n) + 1, np.int64)
    laid[np.concatenate([[0], begins + n])] = len(ids) + np.arange(len(n) + 1)
    laid[np.repeat(begins - of_row[:-1], n) + np.arange(len(ids))] = ids
    periods = np.where(n >= WORDS, n // TIMES, 0)
    row = np.repeat(np.arange(len(n)), periods)
    period = np.arange(len(row)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (n[row] - period - 1) // ((TIMES - 1) * period) + 1
    edges = np.concatenate([[0], np.cumsum(points)])
    found, extend, back, done = [], None, None, 0
    while done < len(row):
        upto = max(done + 1, int(np.searchsorted(edges, edges[done] + POINTS, side="right")) - 1)
        which = np.repeat(np.arange(done, upto), points[done:upto])
        p = period[which]
        at = begins[row[which]] + (np.arange(edges[done], edges[upto]) - edges[which]) * (TIMES - 1) * p
        same = laid[at] == laid[at + p]
        at, p, which = at[same], p[same], which[same]
        # Three periods agree in all, so the next or the one before does too.
        same = (laid[at + 1] == laid[at + p + 1]) | (laid[at - 1] == laid[at + p - 1])
        at, p, which = at[same], p[same], which[same]
        done = upto
        if not len(at):
            continue
        if extend is None:
            extend, back = Extensions(laid), Extensions(laid[::-1])
        last = len(laid) - 1
        ahead, behind = extend(at, at + p), back(last - (at + p - 1), last - (at - 1)) if len(at) else at
        start, length = at - behind, behind + ahead + p
        long = length >= np.maximum(WORDS, TIMES * p)
        found.append(np.stack([row[which][long], start[long], length[long], p[long]]))
    rows, start, length, period = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    order = np.lexsort([period, length, start])
    rows, start, length, period = rows[order], start[order], length[order], period[order]
    # A stretch is met at many points, and with multiples of its period.
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])]) if len(start) else np.zeros(0, bool)
    rows, start, length, period = rows[new], start[new], length[new], period[new]
    order = np.lexsort([period, start])
    return rows[order], (start - begins[rows])[order], length[order], period[order]


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def with_runs(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of every document.

    Words are stretches without ASCII white space, case as it is. A run has a smallest period
    q, at least six words and four periods, and no neighbouring word continues it. ``collapsed``
    joins the words with one blank, without those that a run repeats. A null text, an empty one
    and one of blanks have no words: no runs, an empty ``collapsed``. Documents are looked at one
    by one, so null and repeated ids and repeated rows are just rows; other columns are not
    read; an empty table gives an empty one.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def find(batches):
        for batch in batches:
            data, bounds = bytestext.flat(batch.column(1))
            n_words, counts, parts, texts = [], [], [], []
            for begin, end in bytestext.slices(bounds):
                own = bounds[begin : end + 1] - bounds[begin]
                part = data[bounds[begin] : bounds[end]]
                starts, ends, of_row = bytestext.words(part, own)
                row, start, length, period = runs(bytestext.span_hashes(part, starts, ends, bytestext.SYMBOLS), of_row)
                marks = np.zeros(len(starts) + 1, np.int64)
                np.add.at(marks, of_row[row] + start + period, 1)
                np.add.at(marks, of_row[row] + start + length, -1)
                keep = np.cumsum(marks)[:-1] == 0
                n_words.append(np.diff(of_row))
                counts.append(np.bincount(row, minlength=end - begin))
                parts.append(np.stack([start, length, period]))
                raw = part.tobytes()
                for k in range(end - begin):
                    words = raw[own[k] : own[k + 1]].split()
                    if counts[-1][k]:
                        words = itertools.compress(words, keep[of_row[k] : of_row[k + 1]].tolist())
                    texts.append(b" ".join(words))
            if not len(batch):
                continue
            all_runs = np.concatenate(parts, axis=1)
            each = pa.StructArray.from_arrays([pa.array(c) for c in all_runs], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)), each)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(n_words).astype(np.int64)), lists, pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return bytestext.small_batches(rows).mapInArrow(bytestext.tidy(find), f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Of ``with_runs``: the number of runs, the one of greatest exponent, and digests of all runs and of the collapsed text."""
    better = lambda x, best: x["length"] * best["period"] > best["length"] * x["period"]  # noqa: E731  ties stay with the smaller start and period
    best = F.aggregate("runs", F.element_at("runs", 1), lambda best, x: F.when(better(x, best), x).otherwise(best))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    lines = F.array_join(F.transform("runs", line), "")
    rows = found.withColumn("_best", F.when(F.size("runs") > 0, best))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "_best.start",
        "_best.length",
        "_best.period",
        F.floor(F.expr("1000 * _best.length div _best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def looped(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` with a repetition put into the texts of which the id's CRC ends in 0.

    With h the CRC, g = h / 10 and n words, from word a = g % n on a text repeats its next
    p = 1 + (n - a) / (3 + g % 8) words, up to its length. A text without words stays.
    """
    crc = F.crc32(F.col(id_column).cast("long").cast("string").cast("binary"))
    rows = documents.withColumn("_g", F.floor(crc / 10)).withColumn("_w", F.when(crc % 10 == 0, F.expr(rf"filter(split(`{text_column}`, '[\\x20\\x09-\\x0D]+'), x -> x <> '')")))
    rows = rows.withColumn("_n", F.size("_w")).withColumn("_a", F.when(F.col("_n") > 0, F.expr("_g % _n")))
    rows = rows.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    whole = F.expr("array_join(slice(concat(slice(_w, 1, int(_a)), flatten(array_repeat(slice(_w, int(_a) + 1, int(_p)), int((_n - _a) div _p) + 1))), 1, _n), ' ')")
    return rows.withColumn(text_column, F.when(F.col("_n") > 0, whole).otherwise(F.col(text_column))).select(*documents.columns)
