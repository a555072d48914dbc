"""Vendor types and the lake types they become."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .literals import find

# Lake type, then the vendor types stored as it. One list for all vendors.
LAKE_TYPES = {
    "DECIMAL": ("D", "DECIMAL", "DEC", "NUMBER"),
    "VARCHAR": ("CV", "VARCHAR", "VARCHAR2", "NVARCHAR2"),
    "CHAR": ("CF", "CHAR"),
    "TIMESTAMP": ("AT", "DA", "TS", "TIMESTAMP", "TIMESTMP", "DATETIME", "DATETIME2", "SMALLDATETIME"),
    "TIMESTAMP_DATE": ("DATE", "TIMESTAMP_DATE"),
    "INT": ("I", "I1", "N", "INT", "INTEGER", "MEDIUMINT", "BIT"),
    "SMALLINT": ("I2", "SMALLINT"),
    "BIGINT": ("I8", "BIGINT"),
    "TINYINT": ("TINYINT",),
    "FLOAT": ("FLOAT",),
    "DOUBLE": ("F", "DOUBLE", "DOUBLE PRECISION"),
    "BOOLEAN": ("BOOL", "BOOLEAN"),
    "STRING": (
        "A1", "AN", "BF", "BO", "BV", "CO", "DH", "DM", "DS", "DY", "HM", "HS", "HR", "JN", "MI", "MO", "MS", "PD",
        "PM", "PS", "PT", "PZ", "SC", "SZ", "TZ", "UT", "XM", "YM", "YR", "++", "STRING", "NUMERIC", "REAL", "TIME",
        "XML", "BINARY", "VARBINARY", "BINARY_FLOAT", "BINARY_DOUBLE", "INTERVAL", "TIMESTAMP(6) WITH TIME ZONE",
        "TIMESTAMP(6) WITH LOCAL TIME ZONE", "TIMESTAMP WITH TIME ZONE", "TIMESTAMP WITHOUT TIME ZONE",
        "INTERVAL YEAR(2) TO MONTH", "INTERVAL DAY(2) TO SECOND(6)", "GRAPHIC", "VARGRAPHIC", "LONG VARCHAR",
        "LONG VARGRAPHIC", "DECFLOAT", "DBCLOB", "BLOB", "CLOB", "NCLOB", "BFILE", "RAW", "LONG", "LONG RAW",
        "ROWID", "UROWID", "XMLTYPE", "URITYPE", "DATETIMEOFFSET", "UNIQUEIDENTIFIER", "MONEY", "SMALLMONEY", "TEXT",
        "NTEXT", "IMAGE", "CURSOR", "HIERARCHYID", "SQL_VARIANT", "TABLE", "GEOGRAPHY", "GEOMETRY", "NVARCHAR",
        "NCHAR", "YEAR", "LONGTEXT", "LONGBLOB", "MEDIUMTEXT", "MEDIUMBLOB", "TINYTEXT", "TINYBLOB", "OID", "ARRAY",
        "XID", "MACADDR", "UUID", "REGPROC", "PG_NODE_TREE", "PG_LSN", "ANYARRAY", "NAME", "BOX", "BIGSERIAL",
        "BYTEA", "CHARACTER", "CIDR", "CIRCLE", "JSON", "JSONB", "LINE", "LSEG", "POINT", "POLYGON", "SMALLSERIAL",
        "SERIAL", "TSQUERY", "TSVECTOR", "TXID_SNAPSHOT",
    ),
}
# Decimal size where the vendor gives no precision; the scale keeps fractions.
MOST_PRECISION = 38
DEFAULT_PRECISION, DEFAULT_SCALE = MOST_PRECISION, 18
# Length by which dictionaries mark text without a bound; it becomes STRING.
UNBOUNDED = -1
# Pattern of a DATE column's text, by vendor.
DATE_PATTERNS = {"oracle": "yyyy-MM-dd HH:mm:ss"}
DEFAULT_DATE_PATTERN = "yyyy-MM-dd"
# Lake types that carry a length.
SIZED = ("DECIMAL", "VARCHAR", "CHAR")


def pairs() -> dict[str, str]:
    """Vendor type -> lake type."""
    return {t: lake for lake, vendor_types in LAKE_TYPES.items() for t in vendor_types}


def first_word(data_type: Column) -> Column:
    return F.regexp_extract(F.upper(data_type), "([A-Z0-9]+)", 1)


def known_type(data_type: Column) -> Column:
    """Lake type of the full vendor name, else of its first word, else NULL."""
    return F.coalesce(find(pairs(), F.upper(F.trim(data_type))), find(pairs(), first_word(data_type)))


def lake_type(data_type: Column) -> Column:
    """Lake type name: the full vendor name if known, else its first word, else STRING."""
    return F.coalesce(known_type(data_type), F.lit("STRING"))


def is_known_type(data_type: Column) -> Column:
    return known_type(data_type).isNotNull()


def string_length(char_length: Column) -> Column:
    """Declared length; NULL where text has no bound."""
    return F.when(char_length != UNBOUNDED, char_length)


def decimal_size(precision: int | None, scale: int | None) -> tuple[int, int]:
    """Precision and scale of the lake's decimal. A negative scale, zeros before the point, widens the precision."""
    if precision is None:
        return DEFAULT_PRECISION, DEFAULT_SCALE
    scale = scale or 0
    return (precision, scale) if scale >= 0 else (min(MOST_PRECISION, precision - scale), 0)


def declared(lake: Column, char_length: Column, precision: Column, scale: Column) -> Column:
    """The type as a CREATE TABLE column list writes it, such as ``DECIMAL(12,2)``."""
    sized = F.concat(lake, F.lit("("), string_length(char_length).cast("string"), F.lit(")"))
    held = F.coalesce(scale, F.lit(0))
    whole = F.when(precision.isNull(), F.lit(DEFAULT_PRECISION)).otherwise(F.least(F.lit(MOST_PRECISION), precision - F.least(held, F.lit(0))))
    part = F.when(precision.isNull(), F.lit(DEFAULT_SCALE)).otherwise(F.greatest(held, F.lit(0)))
    decimal = F.concat(F.lit("DECIMAL("), whole.cast("string"), F.lit(","), part.cast("string"), F.lit(")"))
    return (
        F.when(lake == "DECIMAL", decimal)
        .when(lake.isin("VARCHAR", "CHAR"), F.coalesce(sized, F.lit("STRING")))
        .when(lake == "TIMESTAMP_DATE", F.lit("TIMESTAMP"))
        .otherwise(lake)
    )
