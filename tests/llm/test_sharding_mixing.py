import collections
import math
import zlib

import pytest
from pyspark.sql import functions as F

from tanimart.llm import mixing, sharding

SF = "/root/testdata/sf0.001"


def _law(rows, shards):
    """Sizes near equal: no shard further from the mean than two largest records."""
    total = collections.Counter()
    for r in rows:
        total[r.shard] += r.size
    mean = sum(total.values()) / shards
    most = max((r.size for r in rows), default=0)
    assert all(abs(total[s] - mean) <= 2 * most for s in range(shards))
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_shards_are_equal_in_bytes_and_slots_gapless(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard(docs, 16).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(text)
    for r in rows:
        data = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    _law(rows, 16)


def test_result_is_the_exact_prefix_sum_in_key_order(llm):
    import hashlib

    docs = llm.read.parquet(f"{SF}/documents.parquet")
    key = lambda r: (int(hashlib.md5((r.text or "").encode()).hexdigest()[:15], 16), r.doc_id)
    at, want = 0, {}
    records = sorted(docs.collect(), key=key)
    total = sum(len((r.text or "").encode()) + 1 for r in records)
    for r in records:
        size = len((r.text or "").encode()) + 1
        want[r.doc_id] = (at + size // 2) * 16 // total
        at += size
    assert {r.doc_id: r.shard for r in sharding.shard(docs, 16).collect()} == want


def test_one_hot_text_is_subdivided(llm):
    docs = llm.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    rows = sharding.shard(docs, 4).collect()
    assert len(rows) == 6000
    _law(rows, 4)


def test_sharding_odd_rows(odd_docs, no_docs):
    rows = sharding.shard(odd_docs, 3).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r.size for r in rows if r.doc_id in (4, 5)) == [1, 1]
    _law(rows, 3)
    assert sharding.shard(no_docs, 3).count() == 0
    placed = sharding.place(odd_docs, 3)
    assert set(placed.columns) == set(odd_docs.columns)
    assert sorted((r.doc_id or 0, r.text or "") for r in placed.collect()) == sorted((r.doc_id or 0, r.text or "") for r in odd_docs.collect())
    assert sharding.place(no_docs, 3).count() == 0


def test_poisson_counts_invert_the_distribution(llm):
    rate = 2.5
    cdf = llm.range(1).select(mixing.poisson_cdf(F.lit(rate)).alias("c")).first().c
    want, p = [], math.exp(-rate)
    for k in range(len(cdf)):
        want.append(p + (want[-1] if want else 0))
        p *= rate / (k + 1)
    assert cdf == pytest.approx(want, abs=1e-12)
    assert cdf[-1] > 1 - 1e-15


def test_mixture_follows_the_weights_and_is_repeatable(llm):
    docs = llm.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("source"), F.lit("t").alias("text"))
    first = mixing.mix(docs, {"a": 1.0, "b": 3.0}, total=12000)
    n = {r.source: r.n for r in first.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert n["a"] == pytest.approx(3000, abs=6 * 55) and n["b"] == pytest.approx(9000, abs=6 * 95)
    again = mixing.mix(docs.repartition(7), {"a": 1.0, "b": 3.0}, total=12000)
    pick = lambda df: sorted((r.doc_id, r.mix_copy, r.mix_key) for r in df.collect())
    assert pick(first) == pick(again)
    counts = {(r.doc_id, r.mix_copies) for r in first.collect()}
    assert len(counts) == len({d for d, _ in counts})


def test_high_rates_are_sums_of_pieces(llm):
    docs = llm.range(20).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    n = mixing.mix(docs, {"a": 1.0}, total=20 * 1200.0).count()
    assert n == pytest.approx(24000, abs=6 * 155)


def test_mixing_odd_rows(odd_docs, no_docs):
    out = mixing.mix(odd_docs, total=100)
    assert set(out.columns) == set(odd_docs.columns) | {"mix_copies", "mix_copy", "mix_key"}
    assert 50 < out.count() < 170
    assert out.where("source IS NULL").count() > 0
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(odd_docs, {"nowhere": 1.0}).count() == 0


def test_rows_without_an_id_are_drawn_one_by_one(llm):
    docs = llm.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit("a").alias("source"))
    docs = docs.unionByName(llm.range(500).select((F.col("id") % 5).alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"), F.lit("b").alias("source")))
    for seed in (1, 2, 3):
        n = {r.source: r.n for r in mixing.mix(docs, alpha=1.0, seed=seed).groupBy("source").agg(F.count("*").alias("n")).collect()}
        assert abs(n["a"] - 2000) < 4 * math.sqrt(2000) and abs(n["b"] - 500) < 4 * math.sqrt(500)
