"""Options for reading a database table in parallel, and for writing to one."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions import names, types
from ..operators import ranges
from ..operators.catalog import dictionary_query, from_dictionary
from ..operators.project import Field, lands_as_text
from ..operators.registry import DEFAULT_FETCH_SIZE, DEFAULT_MAPPERS

# How each vendor quotes a name.
QUOTES = {"sqlserver": ("[", "]"), "mysql": ("`", "`")}
DEFAULT_QUOTES = ('"', '"')
# Statements that let a bulk read run without holding up the source's own work.
SESSION_STATEMENTS = {
    "oracle": 'BEGIN execute immediate \'alter session set "_serial_direct_read"=true\'; END;',
    "sqlserver": "SET TRANSACTION ISOLATION LEVEL READ UNCOMMITTED",
    "mysql": "SET SESSION TRANSACTION ISOLATION LEVEL READ UNCOMMITTED",
    "db2": "SET CURRENT ISOLATION = UR",
}
# What stands at the head of every request, before the SELECT that Spark builds around a query.
REQUEST_PREFIX = {"teradata": "LOCKING ROW FOR ACCESS"}
# How each vendor deals text keys into buckets; a vendor without one reads them with one reader.
TEXT_BUCKETS = {
    "oracle": "ORA_HASH({column}, {last}) = {bucket}",
    "sqlserver": "ABS(CAST(CHECKSUM({column}) AS BIGINT)) % {buckets} = {bucket}",
    "mysql": "CRC32({column}) % {buckets} = {bucket}",
    "postgresql": "ABS(HASHTEXT({column})::BIGINT) % {buckets} = {bucket}",
    "teradata": "HASHBUCKET(HASHROW({column})) MOD {buckets} = {bucket}",
}
# Types a source has to hand over as text.
TEXT_ONLY_TYPES = {"postgresql": ("xid", "oid", "array", "macaddr")}
CLOB_FROM_XML = {"oracle": ("xmltype", "t.{quoted}.getclobval()")}


@dataclass(frozen=True)
class Source:
    vendor: str
    url: str
    database: str
    table: str
    schema: str | None = None
    user: str | None = None
    password: str | None = None
    fetch_size: int = DEFAULT_FETCH_SIZE
    readers: int = DEFAULT_MAPPERS
    split_by: str | None = None
    check_column: str | None = None
    is_view: bool = False
    where: str = ""

    def full_name(self) -> str:
        parts = [self.database, self.schema, self.table] if self.schema else [self.database, self.table]
        return ".".join(quoted(self.vendor, p) for p in parts)


def quoted(vendor: str, name: str) -> str:
    left, right = QUOTES.get(vendor, DEFAULT_QUOTES)
    return f"{left}{name.replace(right, right * 2)}{right}"


def check_split(source: Source, columns: list[str]) -> None:
    """The split column must exist, and a custom filter may not use the split or check column."""
    if source.split_by and source.split_by not in columns:
        raise ValueError(f"split column {source.split_by} is not one of: {', '.join(columns)}")
    for role, column in (("split", source.split_by), ("check", source.check_column)):
        if column and re.search(rf"(?<![\w$#]){re.escape(column)}(?![\w$#])", source.where, re.IGNORECASE):
            raise ValueError(f"the custom filter may not use the {role} column {column}")


def select_list(vendor: str, fields: list[Field]) -> list[str]:
    """Columns for the extract query: cleaned aliases, XML as text, odd types cast to text."""
    listed = []
    xml_type, xml_text = CLOB_FROM_XML.get(vendor, (None, ""))
    for f in fields:
        expression = quoted(vendor, f.name)
        kind = f.data_type.lower()
        if kind == xml_type:
            expression = xml_text.format(quoted=expression)
        elif kind in TEXT_ONLY_TYPES.get(vendor, ()):
            expression = f"CAST({expression} AS VARCHAR)"
        alias = quoted(vendor, names.clean_for_extract(f.name))
        listed.append(expression if expression == alias else f"{expression} AS {alias}")
    return listed


def extract_query(source: Source, fields: list[Field], increment: str = "") -> str:
    """The SELECT the source database runs, with the custom filter and the increment filter."""
    check_split(source, [f.name for f in fields])
    filters = "".join(f" AND ({f})" for f in (source.where, increment) if f)
    columns = ", ".join(select_list(source.vendor, fields))
    return f"SELECT {columns} FROM {source.full_name()} t WHERE 1=1{filters}"


def object_type_query(source: Source) -> str:
    """SQL that tells whether an Oracle object is a table or a view."""
    owner, name = (x.replace("'", "''").upper() for x in (source.database, source.table))
    return f"SELECT OBJECT_TYPE FROM ALL_OBJECTS WHERE OWNER = '{owner}' AND OBJECT_NAME = '{name}'"


def reader_count(source: Source) -> int:
    """One reader where the source cannot be read by ranges."""
    oracle_query = source.vendor == "oracle" and bool(source.where)
    return 1 if source.is_view or oracle_query or not source.split_by else source.readers


def options(source: Source, query: str, bounds: tuple | None = None) -> dict[str, str]:
    """Spark's JDBC options: batch size, source session, and the key ranges to read in parallel."""
    chosen = {"url": source.url, "dbtable": f"({query}) src", "fetchsize": str(source.fetch_size)}
    if source.user:
        chosen["user"] = source.user
    if source.password:
        chosen["password"] = source.password
    if source.vendor in SESSION_STATEMENTS:
        chosen["sessionInitStatement"] = SESSION_STATEMENTS[source.vendor]
    if source.vendor in REQUEST_PREFIX:
        chosen["prepareQuery"] = REQUEST_PREFIX[source.vendor]
    readers = reader_count(source)
    if readers > 1 and bounds and bounds[0] is not None:
        chosen |= {
            "partitionColumn": names.clean_for_extract(source.split_by),
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(readers),
        }
    return chosen


def bounds_query(source: Source, increment: str = "") -> str:
    column = quoted(source.vendor, source.split_by)
    filters = "".join(f" AND ({f})" for f in (source.where, increment) if f)
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {source.full_name()} t WHERE 1=1{filters}"


def splits_as_text(source: Source, fields: list[Field]) -> bool:
    """Whether the split column is text, which has no ranges to read by."""
    kinds = {f.name: types.pairs().get(f.data_type.upper().strip().split("(")[0], "STRING") for f in fields}
    return kinds.get(source.split_by) in ("VARCHAR", "CHAR", "STRING")


def bucket_filters(source: Source) -> list[str]:
    """One filter for each reader of a text key, over the extract's columns; NULL keys go with the first. Empty without a hash."""
    form, n = TEXT_BUCKETS.get(source.vendor), reader_count(source)
    if not form or n < 2:
        return []
    column = quoted(source.vendor, names.clean_for_extract(source.split_by))
    dealt = [form.format(column=column, last=n - 1, buckets=n, bucket=k) for k in range(n)]
    return [f"({dealt[0]} OR {column} IS NULL)", *dealt[1:]]


def even_filters(source: Source, lake: DataFrame, second: str | None = None) -> list[str]:
    """One filter for each of about as many parts as there are readers, cut to equal rows by the lake's copy of the table.

    A table that was loaded before shows how its keys are spread, at no cost to the vendor's
    database. The parts are open at both ends, so keys that are new there are read as well.
    ``second`` is a column that cuts values of the split column too heavy for one reader.
    """
    n = reader_count(source)
    if n < 2:
        return []
    named = tuple(quoted(source.vendor, names.clean_for_extract(c)) for c in (source.split_by, second or source.split_by))
    held = {c.lower(): c for c in lake.columns}
    split, cut = (held.get(names.clean(c).lower(), c) if c else None for c in (source.split_by, second))
    return ranges.filters(lake, split, n, cut, source.vendor, named)


def read(spark: SparkSession, source: Source, fields: list[Field], increment: str = "", parts: list[str] | None = None) -> DataFrame:
    """Read the table in parallel ranges of its split column, or buckets of a text key; further filters are pushed down.

    ``parts`` are filters of ``even_filters`` that take the place of ranges of equal width.
    Times and large objects arrive as text, as the vendor writes them, but for the split column.
    """
    bounds, by_text = None, bool(source.split_by) and splits_as_text(source, fields)
    if reader_count(source) > 1 and not by_text and not parts:
        one_reader = options(source, bounds_query(source, increment))
        bounds = tuple(spark.read.format("jdbc").options(**one_reader).load().first())
    chosen = options(source, extract_query(source, fields, increment), bounds)
    text = [names.clean_for_extract(name) for name in lands_as_text(fields) if by_text or name != source.split_by]
    filters = bucket_filters(source) if by_text else parts or []
    if filters:
        table, url = chosen.pop("dbtable"), chosen.pop("url")
        if text:
            chosen["customSchema"] = ", ".join(f"`{name}` STRING" for name in text)
        return spark.read.jdbc(url, table, predicates=filters, properties=chosen)
    if text:
        chosen["customSchema"] = ", ".join(f"`{name}` STRING" for name in text)
    return spark.read.format("jdbc").options(**chosen).load()


def read_catalog(spark: SparkSession, source: Source, table: str | None = None) -> DataFrame:
    """Catalog rows of one owner's tables, or of one table, from the vendor's dictionary."""
    query = dictionary_query(source.vendor, source.database, table)
    rows = spark.read.format("jdbc").options(**options(source, query)).load()
    return from_dictionary(source.vendor, rows)


def write_options(url: str, table: str, writers: int, batch: int = DEFAULT_FETCH_SIZE, **login: str) -> dict[str, str]:
    """Spark's JDBC options for a write; it merges partitions down to the number of writers itself."""
    return {"url": url, "dbtable": table, "numPartitions": str(writers), "batchsize": str(batch), **login}
