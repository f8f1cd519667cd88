"""Sharding by sampled splitters (DataFrame functions only).

Records are ordered by (60 bits of the text's MD5, id), so equal texts are
neighbours.  A size-weighted sample of the keys gives quantile boundaries that
cut the key space into ranges of about equal bytes; a range found overfull is
subdivided with boundaries drawn from its own keys.  Exact sizes of the ranges
then place every record at its exact byte offset in the key order, and a shard
is the part of that order which covers its share of the bytes.  The sample
thus decides only how the work is spread, never the result.

Law: ``bytes``.  A shard's size differs from the others' by less than one
record at each end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_long, save

#: Bytes of narrow rows per range aimed at, and the least number of ranges.
ROWS_PER_RANGE = 100_000
MIN_RANGES = 64
MAX_RANGES = 4096
#: Sampled keys per range.
OVERSAMPLE = 32
#: A range with more than so many times the mean rows or bytes is subdivided.
OVERFULL = 2.0


def _boundaries(sample: DataFrame, ranges: int) -> list:
    """Quantile boundaries of a bounded sample (key, id, tie)."""
    rows = sorted((r.key, r.id, r.tie) for r in sample.select("key", "id", "tie").collect())
    cuts = sorted({rows[i * len(rows) // ranges] for i in range(1, ranges)}) if rows else []
    return cuts


def _position(cuts: list):
    """Number of boundaries at or below the record's key: a binary search in
    constant arrays, log2(boundaries) steps per record."""
    if not cuts:
        return F.lit(0)
    n = len(cuts)
    keys, ids, ties = (F.array(*[F.lit(c[k]).cast("long") for c in cuts]) for k in range(3))
    steps = [1 << b for b in range(n.bit_length() - 1, -1, -1)]

    def step(lo, width):
        at = F.least(lo + width, F.lit(n)) - F.lit(1)
        k, i, t = F.get(keys, at), F.get(ids, at), F.get(ties, at)
        below = (k < F.col("key")) | ((k == F.col("key")) & ((i < F.col("id")) | ((i == F.col("id")) & (t <= F.col("tie")))))
        return F.when((lo + width <= n) & below, lo + width).otherwise(lo)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _draw(records: DataFrame, weight, per_row) -> DataFrame:
    """Poisson sample: a record is drawn with probability weight * per_row, by
    a hash of its key (the same on every run)."""
    u = F.pmod(F.xxhash64("key", "id", "tie", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return records.where(u < weight * per_row)


def place(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with their ``shard`` and ``slot`` (columns of these
    names are replaced), dealt to partitions by shard range and in slot order."""
    rows = save(docs.drop("shard", "slot").withColumn("__tie", F.monotonically_increasing_id()), "shard-rows")
    placed = shard(rows, shards, id_col, text_col, "__tie").select("__tie", "shard", "slot")
    return rows.join(placed, "__tie").drop("__tie").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", tie_col: str | None = None) -> DataFrame:
    """Return (id, size, text_crc32, law, shard, slot, grown_shard).

    size: UTF-8 bytes of the text (null: 0) plus 1; text_crc32 of a null text
    is that of the empty one (0).  A null id sorts before all others.  Repeated
    rows are records of their own (told apart by their place in the written
    key table).  An empty table gives no rows.  Other columns are not read.
    grown_shard is null: the law is ``bytes``.  With ``tie_col`` (a long that
    tells all rows apart) that column is returned as well.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    records = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        as_long(F.md5(text.cast("binary"))).alias("key"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
        (F.monotonically_increasing_id() if tie_col is None else F.col(tie_col)).alias("tie"),
    )
    records = save(records, "shard-keys")
    total = records.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()
    ranges = min(MAX_RANGES, max(MIN_RANGES, shards, -(-total.n // ROWS_PER_RANGE)))
    sample = _draw(records, F.col("size"), F.lit(ranges * OVERSAMPLE / max(1, total.b)))
    cuts = _boundaries(sample, ranges)
    placed = records.withColumn("range", _position(cuts))

    def loads(df):
        return df.groupBy("range").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))

    sizes = loads(placed).collect()  # at most MAX_RANGES rows
    many, heavy = OVERFULL * total.n / ranges, OVERFULL * total.b / ranges
    over = [r for r in sizes if r.rows > max(many, 1000) or r.bytes > heavy and r.rows > 1000]
    if over:
        rate = {r.range: OVERSAMPLE * (1 + max(r.rows / many, r.bytes / heavy)) / r.rows for r in over}
        rates = F.create_map(*[F.lit(x) for kv in rate.items() for x in kv])
        more = _draw(placed.where(F.col("range").isin(list(rate))), F.lit(1.0), rates[F.col("range")])
        own: dict = {}
        for r in more.select("range", "key", "id", "tie").collect():
            own.setdefault(r.range, []).append((r.key, r.id, r.tie))
        for at, keys in own.items():
            keys.sort()
            parts = max(2, len(keys) // OVERSAMPLE + 1)
            cuts += [keys[i * len(keys) // parts] for i in range(1, parts)]
        cuts = sorted(set(cuts))
        placed = records.withColumn("range", _position(cuts))
        sizes = loads(placed).collect()
    rows_before, bytes_before, base = 0, 0, []
    for r in sorted(sizes, key=lambda r: r.range):
        base.append((r.range, rows_before, bytes_before))
        rows_before, bytes_before = rows_before + r.rows, bytes_before + r.bytes
    spark = docs.sparkSession
    base = spark.createDataFrame(base, "range int, rows_before long, bytes_before long")
    inside = Window.partitionBy("range").orderBy("key", "id", "tie")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    per = F.lit(max(1, total.b))
    ordered = (
        placed.join(F.broadcast(base), "range")
        .withColumn("at", F.col("bytes_before") + F.coalesce(F.sum("size").over(before), F.lit(0)))
        .withColumn("rank", F.col("rows_before") + F.row_number().over(inside) - 1)
        # the record's middle byte decides
        .withColumn("shard", F.floor((F.col("at") + F.floor(F.col("size") / 2)) * shards / per).cast("int"))
    )
    # slot: rank less the shard's first rank, from the ranges' shard edges
    edges = save(ordered.groupBy("shard").agg(F.min("rank").alias("first_rank")), "shard-edges")
    return ordered.join(F.broadcast(edges), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("first_rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        *([] if tie_col is None else [F.col("tie").alias(tie_col)]),
    )
