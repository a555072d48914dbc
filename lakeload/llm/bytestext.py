"""Texts as flat byte arrays: word bounds and hashes of a whole batch at once, without one Python string per row."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Batches are worked on in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19

#: Texts come to Python in Arrow batches of about so many bytes, however long they are.
BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """Set the session's batch size for the Python step that follows on ``df``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


_helds: list[Callable] = []


def held(build: Callable) -> Callable:
    """Keep what ``build`` makes in its worker from task to task, until a step begins that does not name it."""
    kept = functools.lru_cache(maxsize=2)(build)
    _helds.append(kept)
    return kept


def let_go(keeps: Callable | None = None) -> None:
    """Drop what this worker holds, but for ``keeps``."""
    for kept in _helds:
        if kept is not keeps:
            kept.cache_clear()


def tidy(work: Callable, keeps: Callable | None = None) -> Callable:
    """A step over Arrow batches that hands its worker's freed memory back when its task ends, as workers outlive tasks and steps.

    Of what is ``held`` in the worker, only ``keeps`` outlasts the step's beginning.
    """

    def run(batches):
        let_go(keeps)
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


SYMBOLS = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLDEN)
LOWER_SYMBOLS = SYMBOLS[LOWER]


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and where each row begins and ends; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of about ``limit`` bytes each."""
    begin, rows = 0, len(bounds) - 1
    while begin < rows:
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + limit, side="right")) - 1)
        yield begin, end
        begin = end


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the first of its words (one entry more than rows)."""
    inside = ~BLANK[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = bounds[:-1] < bounds[1:]
    first, last = bounds[:-1][full], bounds[1:][full] - 1
    begins[first] = inside[first]
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base², … modulo 2**64; long runs are not kept."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 2 * SLICE_BYTES), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 2 * SLICE_BYTES:
            _powers[base] = known
    return known[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, symbols: np.ndarray = LOWER_SYMBOLS) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, equal for equal bytes wherever they stand."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(symbols[data] * powers(_BASE, len(data)), out=sums[1:])
    spans = (sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return mix(spans ^ ((ends - starts).astype(np.uint64) * _GOLDEN))


def shingles(hashes: np.ndarray, of_row: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words within a row, and for each row where its runs begin.

    A row of fewer words has one run, all of them; a row without words has none.
    """
    n = np.diff(of_row)
    runs = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    begins = np.concatenate([[0], np.cumsum(runs)])
    row = np.repeat(np.arange(len(n)), runs)
    at = np.arange(begins[-1]) - begins[:-1][row] + of_row[:-1][row]
    length = np.minimum(n, size)[row]
    out = length.astype(np.uint64)
    for k in range(size if len(hashes) else 0):
        there = k < length
        out[there] = out[there] * np.uint64(_BASE) + hashes[at[there] + k]
    return mix(out), begins
