"""Data sources over databases of one file: a partitioned scan that takes filters down, and a sink of statements of so many rows.

`spark.dataSource.register(DatabaseFile)`, then `spark.read.format("database_file").option("path", ...).option("table", ...)`: ranges of row numbers are
partitions, and filters on columns become conditions of each range's statement. The file lies where all executors can open it.

`spark.dataSource.register(StatementFiles)`, then `df.write.format("statement_files").option("path", ...).option("table", ...)`: each task writes one file of
insert statements under a hidden name, and the commit names those of the tasks that ended well; what a killed task or a failed job wrote is taken away.
`applied` brings such files into a database in one transaction.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sqlite3
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage,
)

ROWS = 50  # of a statement
#: How a declared column type reads, by what it begins with.
KINDS = (("int", "bigint"), ("real", "double"), ("doub", "double"), ("float", "double"), ("blob", "binary"))
SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def local(path: str) -> str:
    """A path that a program can open; other stores than mounted ones are an error."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise ValueError(f"a database file has to lie on a mounted file system: {path}")
    return path


def opened(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{local(path)}?mode=ro", uri=True)


@dataclass
class Rows(InputPartition):
    first: int
    last: int


class DatabaseFile(DataSource):
    """Options: path, table, and partitions (8)."""

    @classmethod
    def name(cls) -> str:
        return "database_file"

    def schema(self) -> str:
        with opened(self.options["path"]) as db:
            columns = db.execute(f"pragma table_info({quoted(self.options['table'])})").fetchall()
        if not columns:
            raise ValueError(f"no table {self.options['table']}")
        kind = lambda declared: next((k for start, k in KINDS if declared.lower().startswith(start)), "string")
        return ", ".join(f"`{c[1]}` {kind(c[2])}" for c in columns)

    def reader(self, schema: T.StructType) -> DatabaseReader:
        return DatabaseReader(self.options["path"], self.options["table"], [f.name for f in schema], int(self.options.get("partitions", 8)))


class DatabaseReader(DataSourceReader):
    def __init__(self, path: str, table: str, columns: list[str], parts: int):
        self.path, self.table, self.columns, self.parts = path, table, columns, parts
        self.conditions: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of a column with plain values go down; all others are left to Spark."""
        for f in filters:
            column = quoted(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if column and type(f) in SIGNS and isinstance(f.value, (int, float, str)):
                self._take(f"{column} {SIGNS[type(f)]} ?", f.value)
            elif column and isinstance(f, In) and all(isinstance(v, (int, float, str)) for v in f.value):
                self._take(f"{column} in ({', '.join('?' * len(f.value))})", *f.value)
            elif column and isinstance(f, IsNotNull):
                self._take(f"{column} is not null")
            elif column and isinstance(f, IsNull):
                self._take(f"{column} is null")
            elif column and isinstance(f, StringStartsWith):
                self._take(f"substr({column}, 1, ?) = ?", len(f.value), f.value)
            else:
                yield f

    def _take(self, condition: str, *values) -> None:
        self.conditions.append(condition)
        self.values += values

    def partitions(self) -> list[Rows]:
        """Even ranges of row numbers, which the file finds by its own index."""
        with opened(self.path) as db:
            first, last = db.execute(f"select min(rowid), max(rowid) from {quoted(self.table)}").fetchone()
        if first is None:
            return [Rows(0, -1)]
        step = max(1, -(-(last - first + 1) // self.parts))
        return [Rows(a, min(a + step - 1, last)) for a in range(first, last + 1, step)]

    def statement(self) -> str:
        chosen = ", ".join(map(quoted, self.columns)) or "1"
        return f"select {chosen} from {quoted(self.table)} where {' and '.join(['rowid between ? and ?', *self.conditions])}"

    def read(self, partition: Rows) -> Iterator[tuple]:
        with opened(self.path) as db:
            yield from db.execute(self.statement(), [partition.first, partition.last, *self.values])


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


def literal(value) -> str:
    """A value as SQL text."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(value) if isinstance(value, float) else str(value)
    if isinstance(value, (bytes, bytearray)):
        return f"x'{bytes(value).hex()}'"
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return "'" + text.replace("'", "''") + "'"


class StatementFiles(DataSource):
    """Options: path, table, and first_wins (true: insert or ignore; false: insert or replace)."""

    @classmethod
    def name(cls) -> str:
        return "statement_files"

    def writer(self, schema: T.StructType, overwrite: bool) -> StatementWriter:
        return StatementWriter(self.options["path"], self.options["table"], schema.names, self.options.get("first_wins", "true").lower() == "true", overwrite)


class StatementWriter(DataSourceWriter):
    def __init__(self, path: str, table: str, columns: list[str], first_wins: bool, overwrite: bool):
        verb = "ignore" if first_wins else "replace"
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex
        self.head = f"insert or {verb} into {quoted(table)} ({', '.join(map(quoted, columns))}) values\n"

    def _store(self):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{local(self.path)}")
        return store, root

    def write(self, iterator: Iterator) -> Written:
        store, root = self._store()
        store.create_dir(root, recursive=True)
        name, rows, batch = f"part-{uuid.uuid4().hex}.sql", 0, []
        with store.open_output_stream(f"{root}/_{self.job}.{name}") as out:
            for row in iterator:
                batch.append("(" + ", ".join(map(literal, row)) + ")")
                rows += 1
                if len(batch) == ROWS:
                    out.write((self.head + ",\n".join(batch) + ";\n").encode())
                    batch = []
            if batch:
                out.write((self.head + ",\n".join(batch) + ";\n").encode())
        return Written(name, rows)

    def _leftovers(self) -> list[str]:
        from pyarrow import fs

        store, root = self._store()
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return [f.path for f in found if PurePosixPath(f.path).name.startswith(f"_{self.job}.")]

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = self._store()
        if self.overwrite:
            for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if f.path.endswith(".sql") and not PurePosixPath(f.path).name.startswith("_"):
                    store.delete_file(f.path)
        for m in messages:
            if m is not None:
                store.move(f"{root}/_{self.job}.{m.name}", f"{root}/{m.name}")
        self.abort([])

    def abort(self, messages: list) -> None:
        store, _ = self._store()
        for path in self._leftovers():
            store.delete_file(path)


def registered(spark: SparkSession) -> SparkSession:
    """The session with both sources known and filters taken down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (DatabaseFile, StatementFiles):
        spark.dataSource.register(source)
    return spark


def scan(spark: SparkSession, path: str, table: str, partitions: int = 8) -> DataFrame:
    return registered(spark).read.format("database_file").option("path", path).option("table", table).option("partitions", partitions).load()


def write_statements(df: DataFrame, path: str, table: str, first_wins: bool = True, mode: str = "append") -> None:
    registered(df.sparkSession)
    df.write.format("statement_files").option("path", path).option("table", table).option("first_wins", str(first_wins).lower()).mode(mode).save()


def applied(path: str, database: str) -> int:
    """Runs the statements of all committed files against a database file, in the order of their names, in one transaction; how many statements there were. Files are read a statement at a time."""
    from pathlib import Path

    done = 0
    with sqlite3.connect(local(database)) as db:
        for file in sorted(Path(local(path)).glob("part-*.sql")):
            held = ""
            with file.open(encoding="utf-8") as lines:
                for line in lines:
                    held += line
                    if line.endswith(";\n") and sqlite3.complete_statement(held):
                        db.execute(held)
                        held, done = "", done + 1
    return done
