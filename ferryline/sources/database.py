"""What is asked of a database beside reading and writing rows: its tables, the
bounds of a split, and statements that run together or not at all.

Rows go through Spark's JDBC source and sink, by many tasks. The statements here
are standard SQL and run on one connection of the driver.
"""

from __future__ import annotations

import fnmatch
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import types as T


class Database:
    """Statements on a JDBC URL."""

    def __init__(self, spark: SparkSession, url: str, properties: dict | None = None):
        self.spark, self.url, self.properties = spark, url, dict(properties or {})

    def connect(self):
        jvm = self.spark._jvm
        properties = jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, str(value))
        return jvm.java.sql.DriverManager.getConnection(self.url, properties)

    @contextmanager
    def connection(self):
        opened = self.connect()
        try:
            yield opened
        finally:
            opened.close()

    def run_together(self, statements: list[str]) -> None:
        """All statements in one transaction; the first that fails undoes the others."""
        with self.connection() as connection:
            connection.setAutoCommit(False)
            try:
                statement = connection.createStatement()
                for text in statements:
                    statement.execute(text)
                connection.commit()
            except Exception:
                connection.rollback()
                raise

    def tables(self, pattern: str = "*") -> list[str]:
        """Names (``schema.table``) of the tables and views that match ``schema.name``,
        with ``*`` for any text. From the database's own catalog: what goes wrong
        there is an error, not an absent table."""
        schema, _, name = pattern.rpartition(".")
        with self.connection() as connection:
            found = connection.getMetaData().getTables(None, None, "%", None)
            rows = []
            while found.next():
                rows.append((found.getString("TABLE_SCHEM") or found.getString("TABLE_CAT") or "",
                             found.getString("TABLE_NAME"), found.getString("TABLE_TYPE") or ""))
        return sorted(
            f"{s}.{t}" if s else t for s, t, kind in rows
            if not kind.upper().startswith("SYSTEM")
            and (not schema or fnmatch.fnmatchcase(s.lower(), schema.lower()))
            and fnmatch.fnmatchcase(t.lower(), name.lower()))

    def has_table(self, name: str) -> bool:
        return bool(self.tables(name.replace('"', "").replace("`", "")))


# -- splits --------------------------------------------------------------------------


def literal(value, kind: T.DataType) -> str:
    """A value as standard SQL writes it."""
    if isinstance(kind, T.NumericType):
        return str(value)
    text = str(value).replace("'", "''")
    if isinstance(kind, T.DateType):
        return f"DATE '{text}'"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"TIMESTAMP '{text}'"
    return f"'{text}'"


def bounds_query(table: str, key: str, parts: int) -> str:
    """The smallest key of each of ``parts`` ranges with about as many rows each."""
    return (f"SELECT MIN(k) AS k FROM (SELECT {key} AS k, NTILE({int(parts)}) OVER (ORDER BY {key}) "
            f"AS part FROM {table} WHERE {key} IS NOT NULL) ranges GROUP BY part")


def range_predicates(key: str, bounds: list, kind: T.DataType) -> list[str]:
    """Conditions that together hold for every row once, rows without a key in the
    first range. ``bounds``: where ranges begin; repeated ones collapse."""
    starts = sorted(set(b for b in bounds if b is not None))
    if len(starts) < 2:
        return ["1 = 1"]
    marks = [literal(b, kind) for b in starts[1:]]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{key} < {marks[0]} OR {key} IS NULL", *inner, f"{key} >= {marks[-1]}"]


# -- merges --------------------------------------------------------------------------


def merge_statements(target: str, source: str, keys, columns, strategy: str,
                     delete_missing: bool = False) -> list[str]:
    """Statements that merge table ``source`` into ``target`` by ``keys``. Columns the
    source lacks keep their values. Null keys match nothing, so such rows are only
    ever inserted."""
    match = " AND ".join(f"{source}.{k} = {target}.{k}" for k in keys)
    here = f"EXISTS (SELECT 1 FROM {source} WHERE {match})"
    there = f"EXISTS (SELECT 1 FROM {target} WHERE {match})"
    names = ", ".join(columns)
    values = ", ".join(f"{source}.{c}" for c in columns)
    others = [c for c in columns if c not in keys]
    sets = ", ".join(f"{c} = (SELECT {source}.{c} FROM {source} WHERE {match})" for c in others)
    update = [f"UPDATE {target} SET {sets} WHERE {here}"] if others else []
    insert = f"INSERT INTO {target} ({names}) SELECT {values} FROM {source}"
    new_only = f"{insert} WHERE NOT {there}"
    out = [f"DELETE FROM {target} WHERE NOT {here}"] if delete_missing else []
    return out + {
        "update_insert": [*update, new_only],
        "delete_insert": [f"DELETE FROM {target} WHERE {here}", insert],
        "insert": [new_only],
        "update": update,
    }[strategy]
