"""Frequency, weight and parallelism codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .literals import find

# Fixed values.
FREQUENCY_BITS = {
    "none": "000", "daily": "101", "weekly": "100", "biweekly": "011",
    "fortnightly": "110", "monthly": "010", "quarterly": "001", "yearly": "111",
}
FREQUENCY_DAYS = {
    "none": 0, "daily": 1, "weekly": 7, "biweekly": 14,
    "fortnightly": 15, "monthly": 30, "quarterly": 90, "yearly": 364,
}
WEIGHT_BITS = {"small": "100", "medium": "010", "heavy": "001"}
DEFAULT_LOAD = "000001"
MEDIUM_FROM_ROWS, HEAVY_ABOVE_ROWS = 2_000_000, 100_000_000
PARALLEL_ABOVE_ROWS = 250_000
# Readers by vendor and weight bits.
READERS = {
    "oracle": {"100": 5, "010": 20, "001": 50},
    "teradata": {"100": 2, "010": 5, "001": 8},
    "db2": {"100": 2, "010": 15, "001": 20},
    "sqlserver": {"100": 2, "010": 15, "001": 20},
    "mysql": {"100": 2, "010": 15, "001": 20},
    "postgresql": {"100": 2, "010": 15, "001": 20},
}
# Readers for a table below the parallel threshold.
FEW_READERS = {"oracle": 2}
VENDORS = ("oracle", "db2", "teradata", "sqlserver", "postgresql", "mysql")


def frequency_bits(name: Column) -> Column:
    return find({"": "000", **FREQUENCY_BITS}, F.coalesce(name, F.lit("")))


def frequency_name(bits: Column) -> Column:
    return find({b: n for n, b in FREQUENCY_BITS.items()}, bits)


def frequency_days(name: Column) -> Column:
    return find(FREQUENCY_DAYS, name)


def weight_bits(name: Column) -> Column:
    return find(WEIGHT_BITS, name)


def weight_name(bits: Column) -> Column:
    return find({b: n for n, b in WEIGHT_BITS.items()}, bits)


def load_class(rows: Column) -> Column:
    """Weight bits from a row count."""
    return (
        F.when(rows < MEDIUM_FROM_ROWS, F.lit("100"))
        .when(rows <= HEAVY_ABOVE_ROWS, F.lit("010"))
        .otherwise(F.lit("001"))
    )


def vendor_of(jdbc_url: Column) -> Column:
    """The vendor a JDBC address names."""
    url = F.lower(jdbc_url)
    found = F.lit(None).cast("string")
    for vendor in reversed(VENDORS):
        found = F.when(url.contains(vendor), F.lit(vendor)).otherwise(found)
    return found


def readers(rows: Column, vendor: Column, asked: Column, load: Column) -> Column:
    """Parallel readers: few for a small table, what was asked if above one, else by vendor and weight."""
    table = {f"{v} {w}": n for v, sizes in READERS.items() for w, n in sizes.items()}
    by_table = find(table, F.concat_ws(" ", vendor, F.coalesce(load, load_class(rows))))
    few = F.coalesce(find(FEW_READERS, vendor), F.lit(1))
    return F.when(rows <= PARALLEL_ABOVE_ROWS, few).when(asked > 1, asked).otherwise(by_table)
