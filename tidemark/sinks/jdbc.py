"""Database targets over JDBC. Connection options always come from the caller."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as S
from tidemark.functions.types import database_type
from tidemark.operators.keyed import delete_matching, key_set
from tidemark.session import staging
from tidemark.sources.tables import snapshot

# staged rows that only name a key to delete carry 0
INSERT_MARK = "tm_insert"


def write_options(url: str, table: str, *, batch_size: int = 10000, connections: int = 20,
                  connection: dict[str, str] | None = None) -> dict[str, str]:
    """``connections`` bounds how many tasks write at once."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size),
            "numPartitions": str(connections), **(connection or {})}


def replace(df: DataFrame, url: str, table: str, **kw) -> None:
    """Empty the table and load ``df``, keeping the table's definition.

    The image is written to staging first, so a merge that reads the same table
    has finished reading before the table is emptied. Spark commits per task:
    readers can see the table while it fills.
    """
    with staging(df.sparkSession, "jdbc") as path:
        (snapshot(df, path).write.format("jdbc").mode("overwrite").option("truncate", "true")
         .options(**write_options(url, table, **kw)).save())


def append(df: DataFrame, url: str, table: str, **kw) -> None:
    (df.write.format("jdbc").mode("append").options(**write_options(url, table, **kw)).save())


def staged_rows(rows: DataFrame, keys: Sequence[str],
                deletes: DataFrame | None = None) -> DataFrame:
    """Rows to insert, plus bare keys that are only to be deleted, marked apart."""
    inserts = rows.withColumn(INSERT_MARK, F.lit(1))
    if deletes is None:
        return inserts
    bare = delete_matching(key_set(deletes, keys, null_safe=True), rows, keys, null_safe=True)
    return inserts.unionByName(bare.withColumn(INSERT_MARK, F.lit(0)), allowMissingColumns=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def merge_statements(target: str, staged: str, columns: Sequence[str], keys: Sequence[str],
                     load_type: str, null_safe: bool) -> list[str]:
    """What the database runs in one transaction once the staged table is loaded."""
    S.check_load_type(load_type)
    def same(key: str, or_null: bool) -> str:
        a, b = f"a.{_quoted(key)}", f"b.{_quoted(key)}"
        return f"({a} = {b} OR ({a} IS NULL AND {b} IS NULL))" if or_null else f"{a} = {b}"

    def delete(or_null: bool, more: str = "") -> str:
        where = " AND ".join(same(k, or_null) for k in keys)
        return (f"DELETE FROM {target} AS a WHERE EXISTS "
                f"(SELECT 1 FROM {staged} AS b WHERE {where}{more})")

    if load_type == S.FULL:
        deletes = [f"TRUNCATE TABLE {target}"]
    else:
        # equality alone can be hashed; only staged keys that hold a NULL need the other form
        deletes = [delete(False)]
        if null_safe:
            some_null = " OR ".join(f"b.{_quoted(k)} IS NULL" for k in keys)
            deletes.append(delete(True, f" AND ({some_null})"))
    names = ", ".join(_quoted(c) for c in columns)
    return [*deletes, f"INSERT INTO {target} ({names}) SELECT {names} FROM {staged} "
                    f"WHERE {_quoted(INSERT_MARK)} = 1"]


def create_statement(table: str, schema: T.StructType) -> str:
    """The definition of a table for rows of that schema; one that exists is left as it is."""
    columns = []
    for field in schema:
        try:
            kind = database_type(field.dataType)
        except ValueError as reason:
            raise ValueError(f"column {field.name}: {reason}") from None
        columns.append(f"{_quoted(field.name)} {kind}{'' if field.nullable else ' NOT NULL'}")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def _link(spark: SparkSession, url: str, connection: dict[str, str] | None):
    properties = spark._jvm.java.util.Properties()
    for name, value in (connection or {}).items():
        properties.setProperty(name, value)
    if connection and "driver" in connection:
        spark._jvm.java.lang.Class.forName(connection["driver"])
    return spark._jvm.java.sql.DriverManager.getConnection(url, properties)


def exists(spark: SparkSession, url: str, table: str,
           connection: dict[str, str] | None = None) -> bool:
    """Whether the database's catalog has ``[schema.]table``, in either of its spellings."""
    schema, _, name = table.replace('"', "").rpartition(".")
    link = _link(spark, url, connection)
    try:
        for spelled in dict.fromkeys([(schema, name), (schema.lower(), name.lower()),
                                      (schema.upper(), name.upper())]):
            found = link.getMetaData().getTables(None, spelled[0] or None, spelled[1], None)
            if found.next():
                return True
        return False
    finally:
        link.close()


def create(spark: SparkSession, url: str, table: str, schema: T.StructType,
           connection: dict[str, str] | None = None) -> None:
    run_statements(spark, url, [create_statement(table, schema)], connection)


def run_statements(spark: SparkSession, url: str, statements: Sequence[str],
                   connection: dict[str, str] | None = None) -> list[int]:
    """Run statements in one transaction; returns the rows each one touched."""
    link = _link(spark, url, connection)
    try:
        link.setAutoCommit(False)
        statement = link.createStatement()
        counts = [statement.executeUpdate(text) for text in statements]
        link.commit()
        return counts
    except Exception:
        link.rollback()
        raise
    finally:
        link.close()


def merge(rows: DataFrame, url: str, table: str, keys: Sequence[str], *, load_type: str,
          null_safe: bool, deletes: DataFrame | None = None,
          connection: dict[str, str] | None = None, **kw) -> list[int]:
    """Keyed delete and insert inside the database.

    Spark loads a staged table of this run's own name in parallel; the target
    itself changes in one transaction, and only the incoming rows travel.
    """
    staged = f"{table}_tm_{uuid.uuid4().hex[:10]}"
    (staged_rows(rows, keys, deletes).write.format("jdbc").mode("overwrite")
     .options(**write_options(url, staged, connection=connection, **kw)).save())
    statements = merge_statements(table, staged, rows.columns, keys, load_type, null_safe)
    return run_statements(rows.sparkSession, url, [*statements, f"DROP TABLE {staged}"],
                          connection)
