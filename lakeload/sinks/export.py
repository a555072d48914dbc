"""Export: delimited text, insert, upsert and update-only, to a lake folder or a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.text import FIELD_SEPARATOR, export_line
from ..operators.compare import require_equal_counts
from ..operators.merge import one_per_key, replace_present, upsert
from ..session import size_shuffles
from ..sources.jdbc import quoted, write_options


def write_text(df: DataFrame, path: str, separator: str = FIELD_SEPARATOR, distinct: bool = False) -> DataFrame:
    """One escaped line per row; reads the lines back."""
    rows = df.distinct() if distinct else df
    rows.select(export_line(df.columns, separator).alias("value")).write.mode("overwrite").text(path)
    return df.sparkSession.read.text(path)


def export_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The explicit column list of an export, in the lake table's order."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"not columns of the table: {', '.join(missing)}")
    return df.select(*[c for c in df.columns if c in columns])


def require_empty(target: DataFrame) -> None:
    if not target.isEmpty():
        raise ValueError("the target table already has rows; empty it before an insert export")


def empty_targets(rows: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """The same for many targets at once: for each value of ``by`` among the rows, whether its target has none yet."""
    wanted = rows.select(*by, F.lit(0).alias("_there"))
    both = wanted.unionByName(target.select(*by, F.lit(1).alias("_there"))).groupBy(*by).agg(
        F.min("_there").alias("_wanted"), F.max("_there").alias("_full")
    )
    return both.where("_wanted = 0").select(*by, (F.col("_full") == 0).alias("target_empty"))


# Lake targets. A changed table is written beside the old one and then swapped in.

def insert_rows(df: DataFrame, target: str) -> DataFrame:
    df.write.mode("append").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def staged_insert(df: DataFrame, staging: str, target: str) -> DataFrame:
    """Insert by way of a staging folder, so the target only ever sees a finished export."""
    df.write.mode("overwrite").parquet(staging)
    return insert_rows(df.sparkSession.read.schema(df.schema).parquet(staging), target)


def upsert_rows(target: DataFrame, df: DataFrame, keys: list[str], out: str) -> DataFrame:
    if not keys:
        raise ValueError("an upsert needs its update key")
    size_shuffles(target)
    upsert(target, one_per_key(df, keys), keys).write.parquet(out)
    return df.sparkSession.read.schema(target.schema).parquet(out)


def update_rows(target: DataFrame, df: DataFrame, keys: list[str], out: str) -> DataFrame:
    if not keys:
        raise ValueError("an update needs its update key")
    size_shuffles(target)
    replace_present(target, one_per_key(df, keys), keys).write.parquet(out)
    return df.sparkSession.read.schema(target.schema).parquet(out)


# Database targets.

def insert_jdbc(df: DataFrame, url: str, table: str, writers: int, **login: str) -> None:
    """Append rows over at most ``writers`` connections.

    A retried task can append its rows twice; use a staging table where that matters.
    """
    settings = write_options(url, table, writers, **login)
    df.write.format("jdbc").options(**settings).mode("append").save()


def once_per_key(vendor: str, staging: str, columns: list[str], keys: list[str]) -> str:
    """Staged rows, one for each key: a retried task may have written some twice, and large objects know no DISTINCT."""
    listed = ", ".join(quoted(vendor, c) for c in columns)
    by = ", ".join(quoted(vendor, k) for k in keys)
    return f"(SELECT {listed} FROM (SELECT {listed}, ROW_NUMBER() OVER (PARTITION BY {by} ORDER BY {by}) AS copy_no FROM {staging}) c WHERE copy_no = 1)"


def merge_statement(
    vendor: str, target: str, staging: str, columns: list[str], keys: list[str], insert: bool = True,
    target_names: dict[str, str] | None = None,
) -> str:
    """The one statement that moves a staging table's rows into the target, run in the database.

    ``target_names`` gives the target's own spelling of its columns, from its catalog; both
    tables are taken to use it. A table of key columns alone is only inserted into.
    """
    if not keys:
        raise ValueError("an upsert or update needs its update key")
    spelled = target_names or {}
    q = {c: quoted(vendor, spelled.get(c, c)) for c in columns}
    values = [c for c in columns if c not in keys]
    if not values and not insert:
        raise ValueError("an update needs a column besides its key")
    listed = ", ".join(q.values())
    if vendor in ("postgresql", "mysql") and insert:
        if vendor == "mysql":
            action = "ON DUPLICATE KEY UPDATE " + ", ".join(f"{q[c]} = VALUES({q[c]})" for c in values or keys[:1])
        else:
            changed = ", ".join(f"{q[c]} = EXCLUDED.{q[c]}" for c in values)
            then = f"DO UPDATE SET {changed}" if values else "DO NOTHING"
            action = f"ON CONFLICT ({', '.join(q[k] for k in keys)}) {then}"
        return f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging} s {action}"
    match = " AND ".join(f"t.{q[k]} = s.{q[k]}" for k in keys)
    changed = ", ".join(f"{'' if vendor in ('db2', 'teradata') else 't.'}{q[c]} = s.{q[c]}" for c in values)
    if vendor == "mysql":
        return f"UPDATE {target} t JOIN {staging} s ON {match} SET {changed}"
    if vendor == "postgresql":
        plain = ", ".join(f"{q[c]} = s.{q[c]}" for c in values)
        return f"UPDATE {target} t SET {plain} FROM {staging} s WHERE {match}"
    merge = f"MERGE INTO {target} t USING {staging} s ON ({match})"
    if values:
        merge += f" WHEN MATCHED THEN UPDATE SET {changed}"
    if insert:
        merge += f" WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({', '.join(f's.{c}' for c in q.values())})"
    return merge + (";" if vendor == "sqlserver" else "")


def run_statement(spark: SparkSession, statement: str, url: str, user: str = "", password: str = "") -> int:
    """Run one statement in the target database; the rows themselves stay there."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, user, password)
    try:
        return connection.createStatement().executeLargeUpdate(statement)
    finally:
        connection.close()


def _stage_jdbc(df: DataFrame, url: str, staging: str, writers: int, **login: str) -> None:
    """Fill a staging table anew, so a repeated export does not find its own earlier rows."""
    settings = write_options(url, staging, writers, **login)
    df.write.format("jdbc").options(**settings, truncate="true").mode("overwrite").save()


def merge_jdbc(
    df: DataFrame, vendor: str, url: str, target: str, staging: str, keys: list[str], writers: int,
    insert: bool = True, target_names: dict[str, str] | None = None, **login: str,
) -> int:
    """Load a staging table in parallel, then merge it in the database by one statement.

    The statement reads each staged row once, so rows a retried task wrote twice do no harm.
    """
    spelled = target_names or {}
    named = df.toDF(*[spelled.get(c, c) for c in df.columns])
    _stage_jdbc(named, url, staging, writers, **login)
    own = [spelled.get(k, k) for k in keys]
    statement = merge_statement(vendor, target, once_per_key(vendor, staging, named.columns, own), named.columns, own, insert)
    return run_statement(df.sparkSession, statement, url, login.get("user", ""), login.get("password", ""))


def insert_statement(vendor: str, target: str, staging: str, columns: list[str]) -> str:
    """Move staged rows by column name, whatever order the target's columns have."""
    listed = ", ".join(quoted(vendor, c) for c in columns)
    return f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging}"


def staged_insert_jdbc(df: DataFrame, vendor: str, url: str, target: str, staging: str, writers: int, **login: str) -> int:
    """Insert by way of a staging table, once it holds exactly the exported rows."""
    seen = Observation()
    _stage_jdbc(df.observe(seen, F.count(F.lit(1)).alias("n")), url, staging, writers, **login)
    counting = write_options(url, f"(SELECT COUNT(*) AS n FROM {staging}) s", 1, **login)
    staged = int(df.sparkSession.read.format("jdbc").options(**counting).load().first()[0])
    require_equal_counts(seen.get["n"], staged)
    statement = insert_statement(vendor, target, staging, df.columns)
    return run_statement(df.sparkSession, statement, url, login.get("user", ""), login.get("password", ""))


def compared_columns(catalog: DataFrame) -> DataFrame:
    """The target's columns an export is compared with: all but the identity column."""
    return catalog.where(~F.col("is_identity"))
