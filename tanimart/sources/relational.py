"""A relational file (SQLite) as a Spark source, read in-process by the tasks.

``spark.read.format("sqlite")`` with the options ``path`` (one file that every
executor can open), ``table`` and, optional, ``columns`` (comma list),
``partitions`` and ``key``.  The table is read in ranges of an integer key: its
rowid, or the given column.  The key's range is known from the key's index
(its two ends), so planning reads no rows; every partition is one indexed range
query that names only the wanted columns, and comparisons that Spark hands down
become part of its WHERE clause (Spark checks them again).

Values keep the declared column kinds: INTEGER and BIGINT are long, REAL, FLOAT
and DOUBLE double, BLOB binary, everything else text; a value that does not fit
its column's kind (SQLite does not enforce kinds) is an error, '' stays ''.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)

from tanimart.session import ship

#: Rows fetched into one Arrow batch, and key values of a partition by default.
BATCH = 10_000
RANGE = 1_000_000
_KINDS = {"INT": T.LongType(), "INTEGER": T.LongType(), "BIGINT": T.LongType(), "SMALLINT": T.LongType(), "REAL": T.DoubleType(), "FLOAT": T.DoubleType(),
          "DOUBLE": T.DoubleType(), "BLOB": T.BinaryType()}
_ARROW = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.BinaryType(): pa.binary(), T.StringType(): pa.string()}
_COMPARE = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _open(path: str) -> sqlite3.Connection:
    """Read-only: a path that does not exist is an error, not a new file."""
    return sqlite3.connect(f"{Path(path.removeprefix('file:')).resolve().as_uri()}?mode=ro", uri=True)


def _name(x: str) -> str:
    return '"' + x.replace('"', '""') + '"'


class Range(InputPartition):
    """Rows with low <= key < high; both None: the rows without a key."""

    def __init__(self, low: int | None, high: int | None):
        super().__init__((low, high))
        self.low, self.high = low, high


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> T.StructType:
        wanted = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        con = _open(self.options["path"])
        try:
            held = con.execute("SELECT name, upper(type) FROM pragma_table_info(?)", [self.options["table"]]).fetchall()
        finally:
            con.close()
        if not held:
            raise ValueError(f"no table {self.options['table']} in {self.options['path']}")
        kinds = dict(held)
        missing = [c for c in wanted if c not in kinds]
        if missing:
            raise ValueError(f"{self.options['table']} has no column {missing}")
        return T.StructType([T.StructField(c, _KINDS.get(kinds[c].split("(")[0].strip(), T.StringType())) for c in wanted or kinds])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SqliteReader(dict(self.options), schema)


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.key = options.get("key")
        self.wanted = int(options.get("partitions", 0))
        self.where: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take what SQL means alike; everything is handed back to be checked again."""
        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else None
            if column not in self.schema.names:
                continue
            plain = lambda v: isinstance(v, (int, float, str)) and not isinstance(v, bool)
            if type(f) in _COMPARE and plain(f.value):
                self.where.append((f"{_name(column)} {_COMPARE[type(f)]} ?", [f.value]))
            elif isinstance(f, In) and len(f.value) <= 500 and all(plain(v) for v in f.value):
                self.where.append((f"{_name(column)} IN ({', '.join('?' * len(f.value))})", list(f.value)))
            elif isinstance(f, (IsNull, IsNotNull)):
                self.where.append((f"{_name(column)} IS {'NOT ' * isinstance(f, IsNotNull)}NULL", []))
        yield from filters

    def _key(self) -> str:
        return _name(self.key) if self.key else "rowid"

    def partitions(self) -> list[InputPartition]:
        con = _open(self.path)
        try:
            # two index look-ups; one query for both would read the whole index
            ends = [con.execute(f"SELECT {f}({self._key()}) FROM {_name(self.table)}").fetchone()[0] for f in ("min", "max")]
            keyless = self.key is not None and con.execute(f"SELECT 1 FROM {_name(self.table)} WHERE {self._key()} IS NULL LIMIT 1").fetchone()
        finally:
            con.close()
        out: list[InputPartition] = [Range(None, None)] if keyless else []
        if ends[0] is not None:
            low, high = ends[0], ends[1] + 1
            parts = max(1, min(self.wanted or -(-(high - low) // RANGE), high - low))
            cuts = [low + (high - low) * i // parts for i in range(parts + 1)]
            out += [Range(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out or [Range(0, 0)]

    def query(self, part: Range) -> tuple[str, list]:
        if part.low is None:
            tests, values = [f"{self._key()} IS NULL"], []
        else:
            tests, values = [f"{self._key()} >= ?", f"{self._key()} < ?"], [part.low, part.high]
        for test, own in self.where:
            tests.append(test)
            values += own
        return f"SELECT {', '.join(_name(c) for c in self.schema.names)} FROM {_name(self.table)} WHERE {' AND '.join(tests)}", values

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(f.name, _ARROW[f.dataType]) for f in self.schema])
        con = _open(self.path)
        try:
            rows = con.execute(*self.query(partition))
            while block := rows.fetchmany(BATCH):
                columns = zip(*block, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)
        finally:
            con.close()


def read_relational(spark: SparkSession, path: str, table: str, columns: list[str] | None = None, key: str | None = None, partitions: int | None = None) -> DataFrame:
    """``table`` of a relational file, its ``columns`` (all by default)."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("sqlite").option("path", path).option("table", table)
    for name, value in (("columns", ",".join(columns or [])), ("key", key), ("partitions", partitions)):
        if value:
            reader = reader.option(name, value)
    return reader.load()
