"""Repeatable samples: a top-k by hash, which needs no full sort and no random state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SAMPLE_ROWS = 5
PEEK_ROWS = 3
MAX_SAMPLE_ROWS = 1000


def check_sample(n: int) -> None:
    """A sample is looked at on the driver and broadcast, so it has to stay small."""
    if n > MAX_SAMPLE_ROWS:
        raise ValueError(f"a sample may have {MAX_SAMPLE_ROWS} rows, not {n}")


def sample_rows(df: DataFrame, keys: list[str], n: int = SAMPLE_ROWS, seed: str = "1") -> DataFrame:
    """``n`` rows in the order of md5(key, seed)."""
    check_sample(n)
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(seed))
    return df.orderBy(F.md5(text), *keys).limit(n)


def row_from(df: DataFrame, id_column: str, start) -> DataFrame:
    """The first row whose id is at or after ``start``."""
    return df.where(F.col(id_column) >= F.lit(start)).orderBy(id_column).limit(1)


def peek(df: DataFrame, order: list[str], n: int = PEEK_ROWS) -> DataFrame:
    return df.orderBy(*order).limit(n)
