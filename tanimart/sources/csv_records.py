"""Records of CSV files whose quoted fields may hold line ends, read in splits.

A split of a file starts at a line, but not always at a record: the line may
stand inside a quoted field that an earlier split opened.  Whether a line ends
inside a quoted field depends only on whether it started inside one, so each
split is a map from its start state to its end state.  One pass over the files
that have several splits finds these maps (lines without a quote change
nothing); composing them in file order (one row per split, on the driver)
tells how each split starts.  A second pass puts lines together to records in
every split on its own.  Only a record that crosses a split's edge has pieces
in two tasks; the pieces of a file's edges meet in one group.

Quotes follow the rules of Spark's reader with ``escape='"'``: a quoted field
starts with a quote, two quotes are one, and a single quote that no delimiter
follows turns the rest of the field plain.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanimart.session import ship


def ends_open(line: str, opened: bool) -> bool:
    """Whether a line ends inside a quoted field, given whether it starts in one."""
    at, n = 0, len(line) - line.endswith("\r")
    while True:
        if opened:
            quote = line.find('"', at, n)
            if quote < 0:
                return True
            if line.startswith('"', quote + 1, n):  # two quotes are one
                at = quote + 2
                continue
            comma = line.find(",", quote + 1, n)  # right after it, or the rest is plain
            if comma < 0:
                return False
            at, opened = comma + 1, False
        while at < n and line[at] != '"':
            comma = line.find(",", at, n)
            if comma < 0:
                return False
            at = comma + 1
        if at >= n:
            return False
        at, opened = at + 1, True


def _lines(spark: SparkSession, paths: list[str], key) -> DataFrame:
    """(key, at, value): the lines of every split, in order within it."""
    return spark.read.option("lineSep", "\n").text(paths).select(key.alias("key"), F.col("_metadata.file_block_start").alias("at"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(key, split, first line, line after the last) of a batch's splits."""
    keys, at = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    code = keys.indices.to_numpy()
    edge = np.flatnonzero((code[1:] != code[:-1]) | (at[1:] != at[:-1])) + 1
    bounds = [0, *edge.tolist(), batch.num_rows] if batch.num_rows else []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield keys.dictionary[int(code[a])].as_py(), int(at[a]), a, b


def _quoted(values: pa.Array) -> list[int]:
    return np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False)).tolist()


def _maps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, at, closed, opened): a split's end state for either start state."""
    state: dict = {}
    for batch in batches:
        for key, at, a, b in _runs(batch):
            closed, opened = state.get((key, at), (False, True))
            part = batch.column(2).slice(a, b - a)
            for i in _quoted(part):
                line = part[i].as_py()
                closed, opened = ends_open(line, closed), ends_open(line, opened)
            state[(key, at)] = closed, opened
    rows = [(k, a, c, o) for (k, a), (c, o) in state.items()]
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()), strict=True)], names=["key", "at", "closed", "opened"])


def open_splits(spark: SparkSession, paths: list[str], key) -> tuple[dict[str, set[int]], set[str]]:
    """(splits that start inside a quoted field, by file; files with a split that
    ends inside one).  One row per split comes to the driver."""
    rows = _lines(spark, paths, key).mapInArrow(_maps, "key string, at long, closed boolean, opened boolean").collect()
    starts: dict[str, set[int]] = {}
    crossed, last, now = set(), None, False
    for r in sorted(rows, key=lambda r: (r.key, r.at)):
        now = now if r.key == last else False
        last = r.key
        if now:
            starts.setdefault(r.key, set()).add(r.at)
        now = r.opened if now else r.closed
        if now:
            crossed.add(r.key)
    return starts, crossed


class _Split:
    """The record under construction of one split."""

    def __init__(self, opened: bool):
        self.opened, self.lead, self.parts = opened, opened, []

    def add(self, values: pa.Array) -> tuple[pa.Array, list[str]]:
        """(records that lines of one batch complete, pieces of the record that
        an earlier split started)."""
        before = np.zeros(len(values) + 1, dtype=bool)  # inside a quoted field before a line
        now, last = self.opened, 0
        for i in _quoted(values):
            before[last:i + 1] = now
            now, last = ends_open(values[i].as_py(), now), i + 1
        before[last:] = now
        self.opened = bool(now)
        if not before.any() and not self.parts:
            return values, []
        starts = np.flatnonzero(~before[:-1])
        leads, out = [], []
        first = int(starts[0]) if len(starts) else len(values)
        rest = values.slice(0, first).to_pylist()  # of the record already begun
        if rest or self.parts:
            self.parts += rest
            if first < len(values) or not self.opened:
                (leads if self.lead else out).append("\n".join(self.parts))
                self.parts, self.lead = [], False
        ends = np.append(starts[1:], len(values))
        many = np.flatnonzero(ends - starts > 1)
        whole = values.take(pa.array(starts)).to_pylist() if len(many) or self.opened else None
        if whole is None:
            return pa.concat_arrays([pa.array(out, pa.string()), values.take(pa.array(starts))]), leads
        for k in many.tolist():
            whole[k] = "\n".join(values.slice(int(starts[k]), int(ends[k] - starts[k])).to_pylist())
        if self.opened and whole:  # the last one is not complete
            self.parts = [whole.pop()]
        return pa.array(out + whole, pa.string()), leads


_RECORD = "key string, value string"
_PIECE = "key string, at long, nth int, value string"


def _assemble(starts: dict[str, set[int]], several: set[str], pieces: bool):
    """Arrow stage: complete records of every split but the files' headers, or the
    pieces of records that cross splits (nth 0: up to the split's first record
    end, 1: after its last, 2: the whole split is inside one record)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        headed: set = set()
        found: list = []

        def emit(key: str, records: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key] * len(records), pa.string()), records], names=["key", "value"])

        def body(key: str, at: int, records: pa.Array) -> pa.Array:
            if at == 0 and len(records) and key not in headed:  # the header
                headed.add(key)
                records = records.slice(1)
            return records

        for batch in batches:
            for key, at, a, b in _runs(batch):
                split = held.setdefault((key, at), _Split(at in starts.get(key, ())))
                records, leads = split.add(batch.column(2).slice(a, b - a))
                found += [(key, at, 0, x) for x in leads]
                if not pieces:
                    yield emit(key, body(key, at, records))
        for (key, at), split in held.items():
            if split.parts and key in several:
                found.append((key, at, 2 if split.lead else 1, "\n".join(split.parts)))
            elif split.parts and not pieces:  # a file of one split ends inside quotes
                yield emit(key, body(key, at, pa.array(["\n".join(split.parts)], pa.string())))
        if pieces:
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string()), strict=True)], names=["key", "at", "nth", "value"])

    return run


def _stitched(table: pa.Table) -> pa.Table:
    """The records of one file that cross splits, from their pieces."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("at", "nth", "value", "key")), strict=True), key=lambda r: r[:2])
    out, parts = [], []
    for at, nth, value, _ in rows:
        parts.append(value)
        if nth == 0:  # the record ends here
            out.append((parts, at))
            parts = []
    if parts:
        out.append((parts, -1))
    key = rows[0][3]
    return pa.table({"key": pa.array([key] * len(out), pa.string()), "value": pa.array(["\n".join(p) for p, _ in out], pa.string())})


def records(spark: SparkSession, paths: list[str], key, several: list[str]) -> DataFrame:
    """(key, value): every record but the header of each file, as its text.

    ``key`` is the column that names a line's file, ``several`` the paths that
    may have more than one split.  Blank records are left out."""
    ship(spark)
    starts, crossed = open_splits(spark, several, key) if several else ({}, set())
    many = set(starts) | crossed
    lines = _lines(spark, paths, key)
    out = lines.mapInArrow(_assemble(starts, many, False), _RECORD)
    if many:
        edges = lines.where(F.col("key").isin(sorted(many))).mapInArrow(_assemble(starts, many, True), _PIECE)
        out = out.unionByName(edges.groupBy("key").applyInArrow(_stitched, _RECORD))
    return out.select("key", F.regexp_replace("value", "\r$", "").alias("value")).where(F.trim("value") != "")
