"""The catalog: one row per column of every source table, whatever the vendor."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions import names, types
from .project import SYSTEM_COLUMNS, Field

# Columns of a catalog.
CATALOG = (
    "vendor STRING, table_name STRING, ordinal INT, column_name STRING, data_type STRING, char_length INT, "
    "num_precision INT, num_scale INT, nullable STRING, is_identity BOOLEAN"
)


@dataclass(frozen=True)
class Dictionary:
    """Where a vendor lists its columns, and which of its columns means what."""

    view: str
    owner: str
    table: str
    ordinal: str
    name: str
    data_type: str
    length: str
    precision: str
    scale: str
    nullable: str | None
    identity: str
    identity_marks: tuple[str, ...] = field(default=("YES",))


# The vendors' own dictionary views and column names.
DICTIONARIES = {
    "oracle": Dictionary(
        "ALL_TAB_COLUMNS", "OWNER", "TABLE_NAME", "COLUMN_ID", "COLUMN_NAME", "DATA_TYPE",
        "CHAR_LENGTH", "DATA_PRECISION", "DATA_SCALE", "NULLABLE", "IDENTITY_COLUMN",
    ),
    "db2": Dictionary(
        "SYSIBM.SYSCOLUMNS", "TBCREATOR", "TBNAME", "COLNO", "NAME", "COLTYPE",
        "LENGTH", "LENGTH", "SCALE", "NULLS", "IDENTITY", ("Y",),
    ),
    "teradata": Dictionary(
        "DBC.COLUMNS", "DatabaseName", "TableName", "ColumnId", "ColumnName", "ColumnType",
        "ColumnLength", "DecimalTotalDigits", "DecimalFractionalDigits", "Nullable", "IdColType", ("GA", "GD"),
    ),
    "sqlserver": Dictionary(
        "INFORMATION_SCHEMA.COLUMNS", "TABLE_CATALOG", "TABLE_NAME", "ORDINAL_POSITION", "COLUMN_NAME", "DATA_TYPE",
        "CHARACTER_MAXIMUM_LENGTH", "NUMERIC_PRECISION", "NUMERIC_SCALE", "IS_NULLABLE",
        "IS_IDENTITY", ("1",),
    ),
    "postgresql": Dictionary(
        "INFORMATION_SCHEMA.COLUMNS", "TABLE_CATALOG", "TABLE_NAME", "ORDINAL_POSITION", "COLUMN_NAME", "DATA_TYPE",
        "CHARACTER_MAXIMUM_LENGTH", "NUMERIC_PRECISION", "NUMERIC_SCALE", "IS_NULLABLE", "IS_IDENTITY",
    ),
    "mysql": Dictionary(
        "INFORMATION_SCHEMA.COLUMNS", "TABLE_SCHEMA", "TABLE_NAME", "ORDINAL_POSITION", "COLUMN_NAME", "DATA_TYPE",
        "CHARACTER_MAXIMUM_LENGTH", "NUMERIC_PRECISION", "NUMERIC_SCALE", None, "EXTRA", ("auto_increment",),
    ),
}
# SQL Server keeps the identity mark outside the view.
IDENTITY_EXPRESSIONS = {
    "sqlserver": "COLUMNPROPERTY(OBJECT_ID(TABLE_SCHEMA + '.' + TABLE_NAME), COLUMN_NAME, 'IsIdentity')",
}


def dictionary_query(vendor: str, owner: str, table: str | None = None, with_owner: bool = False) -> str:
    """SQL that reads the columns of one owner's tables, or of one table, through JDBC; ``with_owner`` names the owner in each row."""
    d = DICTIONARIES[vendor]
    marks = IDENTITY_EXPRESSIONS.get(vendor)
    listed = [d.owner if with_owner else None, d.table, d.ordinal, d.name, d.data_type, d.length, d.precision, d.scale, d.nullable]
    columns = list(dict.fromkeys(c for c in listed if c))
    columns.append(f"{marks} AS {d.identity}" if marks else d.identity)
    quoted = owner.replace("'", "''")
    query = f"SELECT {', '.join(columns)} FROM {d.view} WHERE {d.owner} = '{quoted}'"
    if table is not None:
        escaped = table.replace("'", "''")
        query += f" AND {d.table} = '{escaped}'"
    return query


def from_dictionary(vendor: str, rows: DataFrame) -> DataFrame:
    """A vendor dictionary's rows in the catalog's columns, with ``owner`` where the rows name one."""
    d = DICTIONARIES[vendor]
    owner = [F.trim(F.col(d.owner)).alias("owner")] if d.owner in rows.columns else []
    nullable = F.col(d.nullable).cast("string") if d.nullable else F.lit(None).cast("string")
    return rows.select(
        F.lit(vendor).alias("vendor"),
        *owner,
        F.col(d.table).alias("table_name"),
        F.col(d.ordinal).cast("int").alias("ordinal"),
        F.trim(F.col(d.name)).alias("column_name"),
        F.trim(F.col(d.data_type)).alias("data_type"),
        F.col(d.length).cast("int").alias("char_length"),
        F.col(d.precision).cast("int").alias("num_precision"),
        F.col(d.scale).cast("int").alias("num_scale"),
        nullable.alias("nullable"),
        F.coalesce(F.trim(F.col(d.identity).cast("string")).isin(*d.identity_marks), F.lit(False)).alias("is_identity"),
    )


def lake_catalog(catalog: DataFrame) -> DataFrame:
    """The lake's side of the catalog: clean lower-case names and lake types with their sizes."""
    lake = types.lake_type(F.col("data_type"))
    shown = types.declared(
        lake, F.col("char_length"), F.col("num_precision"), F.col("num_scale")
    )
    described = catalog.select(
        *[c for c in ("vendor", "owner", "table_name") if c in catalog.columns],
        "ordinal",
        F.lower(names.lake_name(F.col("column_name"))).alias("column_name"),
        shown.alias("col_type"),
        types.is_known_type(F.col("data_type")).alias("known_type"),
    )
    return split_sizes(described)


def split_sizes(described: DataFrame) -> DataFrame:
    """``type(len)`` or ``type(precision,scale)`` in its parts."""
    text = F.upper(F.regexp_replace("col_type", r"\s", ""))
    one = F.regexp_extract(text, r"^[A-Z_]+\((\d+)\)$", 1)
    precision = F.regexp_extract(text, r"^[A-Z_]+\((\d+),(\d+)\)$", 1)
    scale = F.regexp_extract(text, r"^[A-Z_]+\((\d+),(\d+)\)$", 2)

    def number(part):
        return F.when(part != "", part.cast("int"))

    return described.withColumns(
        {
            "data_type": F.regexp_replace(text, r"\(.*$", ""),
            "char_length": number(one),
            "num_precision": number(precision),
            "num_scale": number(scale),
        }
    )


def describe_lake(described: DataFrame) -> DataFrame:
    """Columns of lake tables from their descriptions, without the two system columns."""
    kept = described.where(~F.col("column_name").isin(*SYSTEM_COLUMNS))
    return split_sizes(kept).drop("col_type")


# Where Spark keeps the declared type of a CHAR or VARCHAR column.
DECLARED_TEXT = "__CHAR_VARCHAR_TYPE_STRING"


def describe_frame(df: DataFrame, table_name: str, declared: dict[str, str] | None = None) -> DataFrame:
    """The catalog rows of one lake table, in lake types.

    ``declared`` gives lake types by column where they are known; files keep neither CHAR nor VARCHAR.
    """
    spark, known = df.sparkSession, declared or {}

    def lake(f) -> str:
        shown = f.metadata.get(DECLARED_TEXT) or f.dataType.simpleString()
        return known.get(f.name) or ("timestamp" if shown.startswith("timestamp") else shown)

    rows = [(table_name, i, f.name, lake(f)) for i, f in enumerate(df.schema.fields, start=1)]
    shown = spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, col_type string")
    return describe_lake(shown)


def with_measured_precision(catalog: DataFrame, lengths: DataFrame) -> DataFrame:
    """Give numbers without a declared precision the length of their longest value, and scale 0.

    ``lengths`` has table_name, column_name and max_length, as the profile measures them.
    """
    measured = lengths.select("table_name", "column_name", F.col("max_length").alias("_longest"))
    is_number = types.lake_type(F.col("data_type")) == "DECIMAL"
    joined = catalog.join(measured, ["table_name", "column_name"], "left")
    return joined.select(
        *[c for c in catalog.columns if c not in ("num_precision", "num_scale")],
        F.when(is_number, F.coalesce("num_precision", "_longest")).otherwise(F.col("num_precision")).alias("num_precision"),
        F.when(is_number, F.coalesce("num_scale", F.lit(0))).otherwise(F.col("num_scale")).alias("num_scale"),
    ).select(*catalog.columns)


def fields_of(catalog: DataFrame, table_name: str) -> list[Field]:
    """One table's columns in order; bounded by how many columns a table can have."""
    rows = catalog.where(F.col("table_name") == table_name).orderBy("ordinal").collect()
    return [Field(r.column_name, r.data_type, r.char_length, r.num_precision, r.num_scale) for r in rows]
