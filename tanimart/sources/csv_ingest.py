"""Raw input batches: discovery, header resolution, all-text CSV reads.

A batch file is read with its header resolved against the canonical input
columns (spaces stripped, aliases applied, unknown names rejected, any order
and any subset allowed).  Values are never type-inferred: every column is
text until the silver layer casts it.
"""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tanimart import config
from tanimart.sources import csv_records


class HeaderError(ValueError):
    """A batch header names a column the input schema does not have."""


def header_columns(header: list[str], columns: list[str] | None = None,
                   aliases: dict[str, str] | None = None) -> list[tuple[int, str]]:
    """(position, canonical column) of every field of a header.

    A lookup from the spelling without outer spaces to the canonical column
    holds the columns themselves and the aliases; a spelling that it does not
    know, or a column that two fields lead to, is an error."""
    columns = config.INPUT_COLUMNS if columns is None else columns
    lookup = {c: c for c in columns} | dict(config.INPUT_COLUMN_ALIASES if aliases is None else aliases)
    pairs: list[tuple[int, str]] = []
    for at, spelling in enumerate(header):
        column = lookup.get(spelling.strip())
        if column not in columns:
            raise HeaderError(f"field {at + 1} of {header} is no input column: {spelling!r}")
        if any(column == c for _, c in pairs):
            raise HeaderError(f"two fields of {header} are {column}")
        pairs.append((at, column))
    return pairs


def align(df: DataFrame, columns: list[str] | None = None,
          aliases: dict[str, str] | None = None) -> DataFrame:
    """Rename a batch's columns to canonical names and add missing ones as NULL text.

    Provenance columns (names starting with '_') pass through unchanged.
    """
    columns = config.INPUT_COLUMNS if columns is None else columns
    own = [c for c in df.columns if not c.startswith("_")]
    meta = [c for c in df.columns if c.startswith("_")]
    source = {column: F.col(f"`{own[at]}`") for at, column in header_columns(own, columns, aliases)}
    return df.select(*[source.get(c, F.lit(None)).cast("string").alias(c) for c in columns], *meta)


def union_batches(batches: list[DataFrame]) -> DataFrame:
    """Concatenate aligned batches by column name."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def list_batch_files(spark: SparkSession, root: str,
                     pattern: str = config.INPUT_KEY_PATTERN) -> list[str]:
    """Paths under ``root`` whose *whole* path matches ``pattern``.

    Uses the cluster file system (Hadoop FS API), so any scheme works.  The
    listing is metadata only; file contents are read by executors.
    """
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(hconf)
    if not fs.exists(path):
        return []
    it = fs.listFiles(path, True)
    rx = re.compile(pattern)  # as key_matches does for a column
    root_uri = fs.makeQualified(path).toString().rstrip("/")
    out = []
    while it.hasNext():
        full = it.next().getPath().toString()
        key = full[len(root_uri) + 1:] if full.startswith(root_uri) else full
        if rx.match(key):
            out.append(full)
    return sorted(out)


def key_matches(key: str, pattern: str = config.INPUT_KEY_PATTERN) -> Column:
    """Whether the whole key in a column matches ``pattern``."""
    return F.col(key).rlike(f"^(?:{pattern})$")


def file_key(spark: SparkSession, path: str) -> str:
    """A file's name as ``_source_file`` holds it (an encoded URI)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:/", fs.makeQualified(p).toUri().toString())


def _source_key() -> Column:
    """``_metadata.file_path`` in the spelling of ``file_key``."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")


#: Bytes of a file read at first for its header.
HEADER_BYTES = 1 << 14


def _first_record(text: str, whole: bool) -> str | None:
    """The first record of a text, None if it may go on behind the text."""
    at, opened = 0, False
    while True:
        end = text.find("\n", at)
        if end < 0:
            return text if whole and text else None
        opened = csv_records.ends_open(text[at:end], opened)
        if not opened:
            return text[:end]
        at = end + 1


def _look(spark: SparkSession, path: str) -> tuple[str, list[str] | None, int]:
    """(file key, header fields, bytes) of a file: only its first bytes are read."""
    jvm, hconf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(hconf)
    stream, size = fs.open(p), fs.getFileStatus(p).getLen()
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hconf).getCodec(p)
        if codec is not None:
            stream, size = codec.createInputStream(stream), 0  # one split, whatever its size
        data, step, record = b"", HEADER_BYTES, None
        while record is None:
            more = bytes(stream.readNBytes(step))
            data, step = data + more, 2 * step
            record = _first_record(data.decode("utf-8", "ignore"), not more)
            if not more:
                break
    finally:
        stream.close()
    fields = next(csv.reader([record.removeprefix("\ufeff").rstrip("\r")]), None) if record else None
    return file_key(spark, path), fields, size


def look(spark: SparkSession, paths: list[str]) -> dict[str, tuple[list[str], int]]:
    """(header fields, bytes) of every file, by file key.

    A bounded read of each file's start, several files at a time; no job."""
    with ThreadPoolExecutor(16) as pool:
        seen = list(pool.map(lambda p: _look(spark, p), paths))
    empty = [key for key, fields, _ in seen if not fields]
    if empty:
        raise HeaderError(f"empty file(s): {empty}")
    return {key: (fields, size) for key, fields, size in seen}


def read_batches(spark: SparkSession, paths: list[str], columns: list[str] | None = None,
                 aliases: dict[str, str] | None = None) -> DataFrame:
    """Batch files as canonical all-text columns plus ``_source_file``.

    All headers are resolved before any data is read, so a bad one fails the
    load before anything is written.  Large files are read in splits, also
    where quoted fields hold line ends (see ``csv_records``); a header must end
    in its file's first split.  Files whose headers have equally many fields are
    one read, so there are at most as many reads as columns, whatever the number
    of files and headers.  A record with another number of fields than its
    header fails the read.  Empty fields, quoted or not, are NULL.
    """
    columns = config.INPUT_COLUMNS if columns is None else columns
    files = look(spark, paths)
    split = min(_bytes(spark, "spark.sql.files.maxPartitionBytes"), _bytes(spark, "spark.sql.files.openCostInBytes"))
    widths: dict[int, list[str]] = {}
    places: dict[str, list[int]] = {}
    for p in paths:
        key = file_key(spark, p)
        header = files[key][0]
        at = {column: k + 1 for k, column in header_columns(header, columns, aliases)}
        places[key] = [at.get(c, 0) for c in columns]
        widths.setdefault(len(header), []).append(p)
    reads = []
    for width, own in sorted(widths.items()):
        several = [p for p in own if files[file_key(spark, p)][1] > split]
        records = csv_records.records(spark, own, _source_key(), several)
        schema = ", ".join(f"c{i} string" for i in range(width))
        row = F.from_csv("value", schema, {"mode": "FAILFAST", "escape": '"', "multiLine": "true"})
        # where each canonical column stands in a file: one row per file
        keys = [file_key(spark, p) for p in own]
        table = spark.createDataFrame(pa.table({"key": keys, "places": pa.array([places[k] for k in keys], pa.list_(pa.int32()))}))
        fields = records.join(F.broadcast(table), "key").select("key", "places", F.array(*[row[f"c{i}"] for i in range(width)]).alias("f"))
        reads.append(fields.select(*[F.when(F.col("places")[i] > 0, F.col("f")[F.col("places")[i] - 1]).alias(c) for i, c in enumerate(columns)],
                                   F.col("key").alias("_source_file")))
    return union_batches(reads)


def _bytes(spark: SparkSession, name: str) -> int:
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)))


def read_batch(spark: SparkSession, path: str, columns: list[str] | None = None,
               aliases: dict[str, str] | None = None) -> DataFrame:
    """One batch file (see ``read_batches``)."""
    return read_batches(spark, [path], columns, aliases)
