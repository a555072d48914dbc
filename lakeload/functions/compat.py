"""Which vendor types may stand beside which lake type when schemas are compared."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import types
from .literals import find

# Vendor, lake type, then the vendor types that match it on the way in.
INGEST = {
    ("oracle", "STRING"): (
        "blob", "clob", "nclob", "bfile", "urowid", "rowid", "long", "raw", "long raw", "uritype", "xmltype",
    ),
    ("oracle", "VARCHAR"): ("varchar", "varchar2", "nvarchar2"),
    ("oracle", "CHAR"): ("char", "nchar"),
    ("oracle", "TIMESTAMP"): ("date", "timestamp"),
    ("oracle", "DECIMAL"): ("number",),
    ("oracle", "FLOAT"): ("binary_float", "float"),
    ("oracle", "DOUBLE"): ("binary_double", "double"),
    ("db2", "STRING"): ("time",),
    ("db2", "VARCHAR"): ("varchar",),
    ("db2", "CHAR"): ("char",),
    ("db2", "BOOLEAN"): ("boolean",),
    ("db2", "TIMESTAMP"): ("timestamp", "timestmp", "date"),
    ("db2", "INT"): ("integer",),
    ("db2", "SMALLINT"): ("smallint",),
    ("db2", "BIGINT"): ("bigint",),
    ("db2", "DECIMAL"): ("decimal", "numeric"),
    ("db2", "DOUBLE"): ("double",),
    ("teradata", "STRING"): (
        "a1", "an", "bf", "bo", "bv", "co", "dh", "dm", "ds", "dy", "hm", "hs", "hr", "jn", "mi", "mo", "ms", "pd",
        "pm", "ps", "pt", "pz", "sc", "sz", "tz", "ut", "xm", "ym", "yr", "++",
    ),
    ("teradata", "CHAR"): ("cf",),
    ("teradata", "VARCHAR"): ("cv",),
    ("teradata", "TIMESTAMP"): ("at", "da", "ts"),
    ("teradata", "DECIMAL"): ("d",),
    ("teradata", "INT"): ("i", "i1", "n"),
    ("teradata", "SMALLINT"): ("i2",),
    ("teradata", "BIGINT"): ("i8",),
    ("teradata", "DOUBLE"): ("f",),
    ("sqlserver", "STRING"): (
        "numeric", "real", "nchar", "ntext", "nvarchar", "binary", "varbinary", "image", "cursor", "hierarchyid",
        "sql_variant", "table", "uniqueidentifier", "xml", "money", "smallmoney",
    ),
    ("sqlserver", "CHAR"): ("char",),
    ("sqlserver", "VARCHAR"): ("varchar",),
    ("sqlserver", "TIMESTAMP"): (
        "date", "datetimeoffset", "datetime2", "smalldatetime", "datetime", "time", "timestamp",
    ),
    ("sqlserver", "DECIMAL"): ("decimal", "money", "smallmoney"),
    ("sqlserver", "INT"): ("bit", "int"),
    ("sqlserver", "FLOAT"): ("float",),
    ("sqlserver", "SMALLINT"): ("smallint",),
    ("sqlserver", "TINYINT"): ("tinyint",),
    ("sqlserver", "BIGINT"): ("bigint",),
    ("postgresql", "STRING"): (
        "numeric", "real", "nchar", "ntext", "nvarchar", "binary", "varbinary", "image", "cursor", "hierarchyid",
        "sql_variant", "table", "uniqueidentifier", "xml", "money", "smallmoney", "box", "bigserial", "bytea",
        "character", "cidr", "circle", "json", "jsonb", "line", "lseg", "point", "polygon", "serial", "smallserial",
        "tsquery", "tsvector", "txid_snapshot",
    ),
    ("postgresql", "CHAR"): ("char",),
    ("postgresql", "VARCHAR"): ("varchar",),
    ("postgresql", "TIMESTAMP"): (
        "date", "datetimeoffset", "datetime2", "smalldatetime", "datetime", "time", "timestamp",
    ),
    ("postgresql", "DECIMAL"): ("decimal", "money", "smallmoney"),
    ("postgresql", "INT"): ("bit", "int"),
    ("postgresql", "FLOAT"): ("float",),
    ("postgresql", "SMALLINT"): ("smallint",),
    ("postgresql", "TINYINT"): ("tinyint",),
    ("postgresql", "BIGINT"): ("bigint",),
    ("mysql", "STRING"): (
        "numeric", "char", "text", "blob", "tinyblob", "tinytext", "mediumblob", "mediumtext", "longblob",
        "longtext", "enum", "varchar", "binary", "varbinary", "image", "cursor", "hierarchyid", "sql_variant",
        "table", "uniqueidentifier", "xml",
    ),
    ("mysql", "CHAR"): ("char",),
    ("mysql", "VARCHAR"): ("varchar",),
    ("mysql", "TIMESTAMP"): ("date", "datetime", "time", "timestamp", "year"),
    ("mysql", "DECIMAL"): ("decimal",),
    ("mysql", "INT"): ("bit", "int", "mediumint"),
    ("mysql", "FLOAT"): ("float",),
    ("mysql", "DOUBLE"): ("double",),
    ("mysql", "SMALLINT"): ("smallint",),
    ("mysql", "TINYINT"): ("tinyint",),
    ("mysql", "BIGINT"): ("bigint",),
}

# Vendor, lake type, then the vendor types that match it on the way out.
EXPORT = {
    ("oracle", "STRING"): ("blob", "clob", "nclob", "varchar2", "varchar", "nvarchar2"),
    ("oracle", "CHAR"): ("char", "nchar"),
    ("oracle", "TIMESTAMP"): ("date", "timestamp"),
    ("oracle", "INT"): ("number",),
    ("oracle", "TINYINT"): ("number",),
    ("oracle", "BIGINT"): ("number",),
    ("oracle", "SMALLINT"): ("number",),
    ("oracle", "FLOAT"): ("binary_float", "float"),
    ("oracle", "DOUBLE"): ("binary_double", "double", "float", "number"),
    ("oracle", "DECIMAL"): ("number",),
    ("oracle", "BINARY"): ("raw",),
    ("oracle", "VARCHAR"): (
        "blob", "clob", "nclob", "char", "nchar", "timestamp", "date", "number", "varchar2", "varchar", "nvarchar2",
    ),
    ("oracle", "BOOLEAN"): ("varchar", "varchar2", "nvarchar2"),
    ("db2", "STRING"): ("time", "varchar"),
    ("db2", "VARCHAR"): (
        "varchar", "time", "date", "timestamp", "char", "integer", "boolean", "smallint", "bigint", "decimal",
        "numeric", "double", "real",
    ),
    ("db2", "CHAR"): ("char",),
    ("db2", "BOOLEAN"): ("boolean", "char"),
    ("db2", "TIMESTAMP"): ("timestamp", "timestmp", "date"),
    ("db2", "INT"): ("integer",),
    ("db2", "SMALLINT"): ("smallint",),
    ("db2", "BIGINT"): ("bigint",),
    ("db2", "DECIMAL"): ("decimal", "numeric"),
    ("db2", "DOUBLE"): ("double",),
    ("db2", "FLOAT"): ("real",),
    ("teradata", "STRING"): (
        "a1", "an", "bf", "bo", "bv", "co", "dh", "dm", "ds", "dy", "hm", "hs", "hr", "jn", "mi", "mo", "ms", "pd",
        "pm", "ps", "pt", "pz", "sc", "sz", "tz", "ut", "xm", "ym", "yr", "++", "cv",
    ),
    ("teradata", "CHAR"): ("cf",),
    ("teradata", "VARCHAR"): (
        "a1", "an", "bf", "bo", "bv", "dm", "ds", "dy", "hm", "hs", "co", "dh", "hr", "jn", "mi", "mo", "ms", "pd",
        "pm", "ps", "pt", "pz", "sc", "sz", "cf", "cv", "f", "d", "i1", "i2", "i8", "i",
    ),
    ("teradata", "TIMESTAMP"): ("at", "da", "ts"),
    ("teradata", "DECIMAL"): ("d",),
    ("teradata", "INT"): ("i", "i1", "n"),
    ("teradata", "DOUBLE"): ("f",),
    ("teradata", "TINYINT"): ("i1",),
    ("teradata", "SMALLINT"): ("i2",),
    ("teradata", "BIGINT"): ("i8",),
    ("teradata", "FLOAT"): ("f",),
    ("teradata", "BOOLEAN"): ("cf",),
    ("sqlserver", "STRING"): (
        "numeric", "money", "smallmoney", "real", "nchar", "ntext", "nvarchar", "binary", "varbinary", "image",
        "cursor", "hierarchyid", "sql_variant", "table", "uniqueidentifier", "xml", "text", "varchar",
    ),
    ("sqlserver", "CHAR"): ("char",),
    ("sqlserver", "DOUBLE"): ("real",),
    ("sqlserver", "TIMESTAMP"): (
        "date", "datetimeoffset", "datetime2", "smalldatetime", "datetime", "time", "timestamp",
    ),
    ("sqlserver", "DECIMAL"): ("decimal",),
    ("sqlserver", "INT"): ("bit", "int"),
    ("sqlserver", "FLOAT"): ("float",),
    ("sqlserver", "VARCHAR"): (
        "varchar", "numeric", "smallint", "tinyint", "bigint", "money", "float", "decimal", "bit", "int",
        "smallmoney", "real", "nchar", "ntext", "nvarchar", "binary", "varbinary", "image", "cursor", "hierarchyid",
        "sql_variant", "table", "uniqueidentifier", "xml", "text", "date", "datetimeoffset", "datetime2",
        "smalldatetime", "datetime", "time",
    ),
    ("sqlserver", "SMALLINT"): ("smallint",),
    ("sqlserver", "TINYINT"): ("tinyint",),
    ("sqlserver", "BIGINT"): ("bigint",),
    ("sqlserver", "BOOLEAN"): ("char",),
    ("mysql", "STRING"): (
        "numeric", "char", "text", "blob", "tinyblob", "tinytext", "mediumblob", "mediumtext", "longblob",
        "longtext", "enum", "varchar", "binary", "varbinary", "image", "cursor", "hierarchyid", "sql_variant",
        "table", "uniqueidentifier", "xml",
    ),
    ("mysql", "CHAR"): ("char",),
    ("mysql", "VARCHAR"): (
        "varchar", "numeric", "int", "bigint", "smallint", "mediumint", "tinyint", "float", "double", "decimal",
        "char", "text", "blob", "tinyblob", "tinytext", "mediumblob", "mediumtext", "longblob", "longtext", "enum",
        "binary", "varbinary", "image", "cursor", "hierarchyid", "sql_variant", "table", "uniqueidentifier", "xml",
        "date", "datetime", "time", "timestamp", "year",
    ),
    ("mysql", "TIMESTAMP"): ("date", "datetime", "time", "timestamp", "year"),
    ("mysql", "DECIMAL"): ("decimal",),
    ("mysql", "INT"): ("bit", "int", "mediumint"),
    ("mysql", "FLOAT"): ("float",),
    ("mysql", "DOUBLE"): ("double",),
    ("mysql", "SMALLINT"): ("smallint",),
    ("mysql", "TINYINT"): ("tinyint",),
    ("mysql", "BIGINT"): ("bigint",),
    ("mysql", "BOOLEAN"): ("char",),
}


def allowed(direction: str) -> dict[tuple[str, str], tuple[str, ...]]:
    """(vendor, lake type) -> vendor types that match."""
    return {"ingest": INGEST, "export": EXPORT}[direction]


# Lake types that a sized text may also become, and the day's own type.
TEXT_WITHOUT_BOUND, SAME = "STRING", {"TIMESTAMP_DATE": "TIMESTAMP"}


def is_allowed(vendor: Column, lake: Column, vendor_type: Column, direction: str = "ingest") -> Column:
    """Whether the vendor's type may stand beside the lake's.

    On the way in every type may become what the type map makes of it, and text of any kind
    STRING, besides what is listed.
    """
    entries = {f"{v} {t}": listed for (v, t), listed in allowed(direction).items()}
    listed = F.coalesce(F.array_contains(find(entries, F.concat_ws(" ", vendor, lake)), base_type(vendor_type)), F.lit(False))
    if direction != "ingest":
        return listed
    mapped = types.known_type(vendor_type)
    for one, other in SAME.items():
        mapped = F.when(mapped == one, other).otherwise(mapped)
    text = (lake == TEXT_WITHOUT_BOUND) & mapped.isin("VARCHAR", "CHAR")
    known = vendor.isin(*sorted({v for v, _ in allowed(direction)}))
    return listed | F.coalesce(known & ((mapped == lake) | text), F.lit(False))


def base_type(vendor_type: Column) -> Column:
    """Lower-case type name without a size, so ``TIMESTAMP(6)`` compares as ``timestamp``."""
    return F.lower(F.trim(F.regexp_replace(vendor_type, r"\(.*$", "")))
