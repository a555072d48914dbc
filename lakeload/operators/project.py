"""Typed projection of landing rows, system columns, and landing-as-text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import names, types

SYSTEM_COLUMNS = ("ingest_timestamp", "incr_ingest_timestamp")
FULL_LOAD_PREFIX = "full_"
STAMP_PATTERN = "%Y%m%d%H%M%S"


@dataclass(frozen=True)
class Field:
    """One source column as the vendor's dictionary describes it."""

    name: str
    data_type: str
    char_length: int | None = None
    precision: int | None = None
    scale: int | None = None


def lake_types(fields: list[Field], vendor: str) -> list[str]:
    """Lake type of each field, worked out on the driver for one table's columns."""
    known = types.pairs()
    found = []
    for f in fields:
        word = "".join(c if c.isalnum() else " " for c in f.data_type.upper()).split()
        lake = known.get(f.data_type.upper().strip()) or known.get(word[0] if word else "", "STRING")
        if lake == "DECIMAL":
            p, s = types.decimal_size(f.precision, f.scale)
            lake = f"DECIMAL({p},{s})"
        elif lake in ("VARCHAR", "CHAR"):
            lake = "STRING" if f.char_length in (None, types.UNBOUNDED) else f"{lake}({f.char_length})"
        found.append(lake)
    return found


def cast_to_lake(col: Column, lake: str, vendor: str) -> Column:
    """Cast that gives NULL, not an error, for text the lake type cannot hold."""
    if lake == "TIMESTAMP_DATE":
        pattern = types.DATE_PATTERNS.get(vendor, types.DEFAULT_DATE_PATTERN)
        return parse_date(col, pattern)
    if lake.startswith("VARCHAR"):
        return F.substring(col.cast("string"), 1, int(lake[8:-1]))
    if lake.startswith("CHAR"):
        size = int(lake[5:-1])
        return F.rpad(F.substring(col.cast("string"), 1, size), size, " ")
    if lake == "TIMESTAMP":
        return col.try_cast("timestamp_ntz")
    return col.try_cast(lake.lower())


def extracted(source: DataFrame, where: str = "") -> DataFrame:
    """The rows of a custom filter under the names the landing area can hold; the filter reaches the scan."""
    kept = source.where(where) if where else source
    return kept.toDF(*[names.clean_for_extract(c) for c in kept.columns])


def parse_date(col: Column, pattern: str) -> Column:
    """Timestamp from text by pattern; text after the pattern's end is left out."""
    clipped = F.substring(col, 1, len(pattern))
    return F.try_to_timestamp(clipped, F.lit(pattern)).cast("timestamp_ntz")


def typed(landing: DataFrame, fields: list[Field], vendor: str) -> DataFrame:
    """One cast per column, from the landing names to the lake names."""
    return landing.select(
        *[
            cast_to_lake(F.col(f"`{names.clean_for_landing(f.name)}`"), lake, vendor).alias(names.clean(f.name))
            for f, lake in zip(fields, lake_types(fields, vendor))
        ]
    )


def create_columns(fields: list[Field], vendor: str) -> str:
    """Column list of the stage table."""
    shown = [lake.replace("TIMESTAMP_DATE", "TIMESTAMP") for lake in lake_types(fields, vendor)]
    return ", ".join(f"`{names.clean(f.name)}` {lake}" for f, lake in zip(fields, shown))


def load_stamp(when, full: bool) -> str:
    """Partition label of a load. Take it once, before extraction."""
    return (FULL_LOAD_PREFIX if full else "") + when.strftime(STAMP_PATTERN)


def with_system_columns(df: DataFrame, ingest_time: str, stamp: str) -> DataFrame:
    return df.withColumns({"ingest_timestamp": F.lit(ingest_time), "incr_ingest_timestamp": F.lit(stamp)})


def without_system_columns(df: DataFrame) -> DataFrame:
    return df.drop(*SYSTEM_COLUMNS)


# Vendor types that land as text whatever the driver offers.
TEXT_TIMESTAMPS = (
    "AT", "DA", "TS", "DATE", "TIMESTAMP", "TIMESTAMP WITH TIME ZONE", "TIMESTAMP WITH LOCAL TIME ZONE",
    "INTERVAL YEAR TO MONTH", "INTERVAL DAY TO SECOND", "TIMESTAMP(6)", "TIMESTAMP(6) WITH TIME ZONE", "TIMESTMP",
    "DATETIME", "TIME", "YEAR",
)
TEXT_LOBS = (
    "CLOB", "DBCLOB", "BLOB", "NCLOB", "TEXT", "NTEXT", "IMAGE", "FILESTREAM", "BFILE", "XMLTYPE", "LONG",
    "LONG RAW", "RAW", "UROWID", "ROWID", "URITYPE", "BINARY_FLOAT", "BINARY_DOUBLE", "OID", "ARRAY", "XID",
    "MACADDR", "UUID", "NAME", "REGPROC", "PG_NODE_TREE", "PG_LSN", "ANYARRAY", "BOX", "BIGSERIAL", "BYTEA",
    "CHARACTER", "CIDR", "CIRCLE", "JSON", "JSONB", "LINE", "LSEG", "POINT", "POLYGON", "REAL", "SMALLSERIAL",
    "SERIAL", "TSQUERY", "TSVECTOR", "TXID_SNAPSHOT",
)
TEXT_TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def lands_as_text(fields: list[Field]) -> list[str]:
    listed = {*TEXT_TIMESTAMPS, *TEXT_LOBS}
    return [f.name for f in fields if f.data_type.upper() in listed]


def land_as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns as text; timestamps keep all six fraction digits."""
    kinds = dict(df.dtypes)

    def as_text(name: str) -> Column:
        col = F.col(f"`{name}`")
        if kinds[name].startswith("timestamp"):
            return F.date_format(col, TEXT_TIMESTAMP_PATTERN)
        return col.cast("string")

    return df.withColumns({c: as_text(c) for c in columns})
