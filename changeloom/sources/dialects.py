"""Statements that apply changes to other databases, and a sink that runs them from every partition."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.operators import materialize as M

#: How each dialect quotes names and states an upsert, and where it selects constants from.
QUOTES = {"mysql": "`", "mariadb": "`", "sqlserver": "[]"}
UPSERTS = {"postgres": "conflict", "sqlite": "conflict", "cockroach": "conflict", "duckdb": "conflict", "mysql": "duplicate", "mariadb": "duplicate", "oracle": "merge", "db2": "merge", "sqlserver": "merge"}
CONSTANTS = {"oracle": " FROM DUAL", "db2": " FROM SYSIBM.SYSDUMMY1"}
#: Column types by the engine's type names.
TYPES = {
    "postgres": {"int": "integer", "bigint": "bigint", "double": "double precision", "float": "real", "string": "text", "boolean": "boolean", "binary": "bytea", "timestamp": "timestamp", "date": "date"},
    "mysql": {"int": "int", "bigint": "bigint", "double": "double", "float": "float", "string": "longtext", "boolean": "bit", "binary": "longblob", "timestamp": "datetime(6)", "date": "date"},
    "oracle": {"int": "number(10,0)", "bigint": "number(19,0)", "double": "binary_double", "float": "binary_float", "string": "clob", "boolean": "number(1,0)", "binary": "blob", "timestamp": "timestamp(6)", "date": "date"},
    "sqlserver": {"int": "int", "bigint": "bigint", "double": "float", "float": "real", "string": "varchar(max)", "boolean": "bit", "binary": "varbinary(max)", "timestamp": "datetime2(6)", "date": "date"},
    "db2": {"int": "integer", "bigint": "bigint", "double": "double", "float": "real", "string": "clob", "boolean": "boolean", "binary": "blob", "timestamp": "timestamp(6)", "date": "date"},
}
TYPES |= {"mariadb": TYPES["mysql"], "cockroach": TYPES["postgres"], "sqlite": TYPES["postgres"], "duckdb": TYPES["postgres"] | {"double": "double", "binary": "blob"}}
#: Dialects that take a batch as one array a column.
ARRAYS = ("postgres", "cockroach", "duckdb")
#: Standard names of errors by which a database refuses a value; any other error fails the task.
REFUSALS = frozenset({"IntegrityError", "DataError"})


def quoted(name: str, dialect: str) -> str:
    mark = QUOTES.get(dialect, '"')
    return ".".join(mark[0] + part.replace(mark[-1], mark[-1] * 2) + mark[-1] for part in name.split("."))


def insert(table: str, columns: list[str], dialect: str, rows: str | None = None) -> str:
    names = ", ".join(quoted(c, dialect) for c in columns)
    return f"INSERT INTO {quoted(table, dialect)} ({names}) " + (rows or f"VALUES ({', '.join('?' * len(columns))})")


def _on_conflict(keys: list[str], columns: list[str], dialect: str) -> str:
    q = lambda c: quoted(c, dialect)
    rest = [c for c in columns if c not in keys]
    return f" ON CONFLICT ({', '.join(map(q, keys))}) DO " + (f"UPDATE SET {', '.join(f'{q(c)} = EXCLUDED.{q(c)}' for c in rest)}" if rest else "NOTHING")


def upsert(table: str, keys: list[str], columns: list[str], dialect: str) -> str:
    """Insert or update by key; a row that is its key alone is inserted or left as it is."""
    q = lambda c: quoted(c, dialect)
    rest, kind = [c for c in columns if c not in keys], UPSERTS[dialect]
    if kind == "conflict":
        return insert(table, columns, dialect) + _on_conflict(keys, columns, dialect)
    if kind == "duplicate":
        return insert(table, columns, dialect) + " ON DUPLICATE KEY UPDATE " + ", ".join(f"{q(c)} = VALUES({q(c)})" for c in rest or keys)
    source = ", ".join(f"? AS {q(c)}" for c in columns)
    on = " AND ".join(f"t.{q(c)} = s.{q(c)}" for c in keys)
    matched = f" WHEN MATCHED THEN UPDATE SET {', '.join(f't.{q(c)} = s.{q(c)}' for c in rest)}" if rest else ""
    fresh = f" WHEN NOT MATCHED THEN INSERT ({', '.join(map(q, columns))}) VALUES ({', '.join(f's.{q(c)}' for c in columns)})"
    return f"MERGE INTO {quoted(table, dialect)} t USING (SELECT {source}{CONSTANTS.get(dialect, '')}) s ON ({on}){matched}{fresh}" + (";" if dialect == "sqlserver" else "")


def _rows_of_arrays(types: list[str], dialect: str) -> str:
    arrays = [f"?::{TYPES[dialect].get(t, t)}[]" for t in types]
    return "SELECT " + ", ".join(f"UNNEST({a})" for a in arrays) if dialect == "duckdb" else f"SELECT * FROM UNNEST({', '.join(arrays)})"


def unnest(table: str, keys: list[str], columns: dict[str, str], dialect: str = "postgres", update: bool = True) -> str:
    """One statement for a whole batch: each column comes as one array parameter."""
    return insert(table, list(columns), dialect, _rows_of_arrays(list(columns.values()), dialect)) + (_on_conflict(keys, list(columns), dialect) if update else "")


def delete_unnest(table: str, keys: dict[str, str], dialect: str = "postgres") -> str:
    """One statement that deletes a batch of keys."""
    return f"DELETE FROM {quoted(table, dialect)} WHERE ({', '.join(quoted(k, dialect) for k in keys)}) IN ({_rows_of_arrays(list(keys.values()), dialect)})"


def delete(table: str, keys: list[str], dialect: str) -> str:
    return f"DELETE FROM {quoted(table, dialect)} WHERE " + " AND ".join(f"{quoted(c, dialect)} = ?" for c in keys)


def update(table: str, keys: list[str], columns: list[str], dialect: str) -> str:
    q = lambda c: quoted(c, dialect)
    return f"UPDATE {quoted(table, dialect)} SET {', '.join(f'{q(c)} = ?' for c in columns if c not in keys)} WHERE " + " AND ".join(f"{q(c)} = ?" for c in keys)


def create(table: str, keys: list[str], columns: dict[str, str], dialect: str) -> str:
    body = [f"{quoted(c, dialect)} {TYPES[dialect].get(t, t)}" + " NOT NULL" * (c in keys) for c, t in columns.items()]
    return f"CREATE TABLE {quoted(table, dialect)} ({', '.join(body + ([f'PRIMARY KEY ({", ".join(quoted(k, dialect) for k in keys)})'] if keys else []))})"


def add_columns(table: str, columns: dict[str, str], dialect: str) -> str:
    """New columns are nullable, so that old rows stay valid."""
    word = "" if dialect in ("oracle", "sqlserver") else "COLUMN "
    parts = [f"{quoted(c, dialect)} {TYPES[dialect].get(t, t)}" for c, t in columns.items()]
    if dialect == "oracle":
        return f"ALTER TABLE {quoted(table, dialect)} ADD ({', '.join(parts)})"
    return f"ALTER TABLE {quoted(table, dialect)} " + ("ADD " + ", ".join(parts) if dialect == "sqlserver" else ", ".join(f"ADD {word}{p}" for p in parts))


def database_sink(
    connect: Callable, table: str, keys: list[str], columns: list[str], dialect: str, delete_enabled: bool = True, rows_per_call: int = 500, dead_letters: str | None = None, connections: int | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: each key's last change is upserted or deleted, ``rows_per_call`` rows a transaction, from every partition.

    ``connect()`` opens a DB-API connection on the executor; at most ``connections`` are open at a time.  Databases that take arrays get one statement a call with
    one array a column.  A call that the database refuses is halved until the refused rows are found: they go to the folder ``dead_letters``
    (``batch=<number>``: op, key, value, error) and the others are applied; without that folder the batch fails.  Running a batch
    again leaves the same rows in both.
    """

    def write(batch: DataFrame, number: int) -> None:
        last = M.last_change(batch, keys)
        kinds = {f.name: f.dataType.simpleString() for f in batch.schema["after"].dataType}
        n_keys, whole = len(keys), dialect in ARRAYS
        put = unnest(table, keys, {c: kinds[c] for c in columns}, dialect) if whole else upsert(table, keys, columns, dialect)
        drop = delete_unnest(table, {k: kinds[k] for k in keys}, dialect) if whole else delete(table, keys, dialect)
        rows = last.select((F.col("op") == "d").alias("gone"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(f"after.{c}").alias(f"c{i}") for i, c in enumerate(columns)])
        rows = rows if delete_enabled else rows.where("not gone")
        rows = rows if connections is None else rows.coalesce(connections)

        def run(batches):
            connection = connect()

            def call(sql: str, values: list[list]) -> None:
                if hasattr(connection, "begin"):  # else every statement commits by itself there
                    connection.begin()
                cursor = connection if hasattr(connection, "begin") else connection.cursor()
                cursor.execute(sql, values) if whole else cursor.executemany(sql, list(zip(*values)))
                connection.commit()

            def apply(sql: str, values: list[list], refused: list) -> None:
                """``values`` is one list a column."""
                try:
                    call(sql, values)
                except Exception as e:
                    if dead_letters is None or REFUSALS.isdisjoint(c.__name__ for c in type(e).__mro__):
                        raise
                    connection.rollback()
                    n = len(values[0])
                    if n == 1:
                        refused.append(([v[0] for v in values], f"{type(e).__name__}: {e}"))
                        return
                    for part in (slice(0, n // 2), slice(n // 2, n)):
                        apply(sql, [v[part] for v in values], refused)

            try:
                for arrow in batches:
                    gone, out = arrow.column(0), []
                    for sql, first, some in ((put, 1 + n_keys, arrow.filter(pc.invert(gone))), (drop, 1, arrow.filter(gone))):
                        last_column = arrow.num_columns if sql is put else 1 + n_keys
                        for k in range(0, some.num_rows, rows_per_call):
                            refused: list = []
                            apply(sql, [c.to_pylist() for c in some.slice(k, rows_per_call).columns[first:last_column]], refused)
                            names = columns if sql is put else keys
                            for values, error in refused:
                                value = dict(zip(names, values))
                                out.append(("u" if sql is put else "d", json.dumps({k: value.get(k) for k in keys}, default=str), json.dumps(value, default=str), error))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["op", "key", "value", "error"])
            finally:
                connection.close()

        refused = rows.mapInArrow(run, "op string, key string, value string, error string")
        if dead_letters is None:
            refused.write.format("noop").mode("overwrite").save()
        else:
            refused.write.mode("overwrite").parquet(f"{dead_letters}/batch={number}")

    return write
