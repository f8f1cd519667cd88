"""Fingerprint bits, packing, bytes, Tanimoto properties."""

import pytest
from pyspark.sql import functions as F

from tanimart import config
from tanimart.functions import fingerprint as fpx
from tanimart.functions import text as tx
from tanimart.operators import fingerprints as fpo

from .helpers import fp_from_bits, fps_frame


def test_pack_unpack_exact_bits(spark):
    bits = [3, 63, 64, 1500, 2047]
    df = spark.createDataFrame([("X", b) for b in bits], "mol_id string, bit int")
    packed = fpo.pack_bits(df)
    row = packed.first()
    assert row.fp == fp_from_bits(bits) and row.n_bits == 5
    assert sorted(r.bit for r in fpo.unpack(packed).collect()) == bits


def test_bytes_are_256_msb_first(spark):
    fps = fps_frame(spark, [("X", [1, 8, 777, 2040])])
    raw = fps.select(fpx.to_bytes("fp").alias("b")).first().b
    assert len(raw) == config.FINGERPRINT_BITS // 8
    on = [i for i in range(2048) if raw[i // 8] >> (7 - i % 8) & 1]
    assert on == [1, 8, 777, 2040]
    stored = fps.select(fpx.to_bytes("fp").alias("b"))
    words = stored.select(fpx.from_bytes("b").alias("fp")).first().fp
    assert words == fp_from_bits([1, 8, 777, 2040])


def test_wrong_length_bytes_fail(spark):
    df = spark.createDataFrame([(bytearray(255),)], "b binary")
    with pytest.raises(Exception, match="256 bytes"):
        df.select(fpx.from_bytes("b")).collect()


def test_fingerprint_deterministic_and_failed_entries(spark):
    mols = spark.createDataFrame([("A", "Hello world, hello!"), ("B", "!!! ---"), ("C", "hello WORLD")],
                                 "mol_id string, text string")
    fps = fpo.fingerprints(mols)
    got = {r.mol_id: (r.fp, r.n_bits) for r in fps.collect()}
    assert set(got) == {"A", "C"}            # B has no feature
    assert got["A"] == got["C"] and got["A"][1] == 2
    assert [r.mol_id for r in fpo.failed_entries(mols).collect()] == ["B"]
    assert fpo.counts(mols).first().asDict() == {"succeeded_rows": 2, "failed_rows": 1}
    again = {r.mol_id: r.fp for r in fpo.fingerprints(mols).collect()}
    assert again["A"] == got["A"][0]


def test_feature_bit_is_md5_prefix_mod_width(spark):
    import hashlib
    words = ["alpha", "beta", "zeta9"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.b for r in df.select(fpx.feature_bit("w").alias("b")).collect()]
    want = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 2048 for w in words]
    assert got == want


def test_tanimoto_properties(spark):
    import random
    rnd = random.Random(1)
    rows = [(f"M{i}", rnd.sample(range(2048), rnd.randint(0, 40))) for i in range(12)]
    fps = fps_frame(spark, rows)
    a = fps.select(F.col("mol_id").alias("a"), F.col("fp").alias("fa"), F.col("n_bits").alias("na"))
    b = fps.select(F.col("mol_id").alias("b"), F.col("fp").alias("fb"), F.col("n_bits").alias("nb"))
    scored = {(r.a, r.b): r.s for r in a.join(b).select(
        "a", "b", fpx.tanimoto("fa", "na", "fb", "nb").alias("s")).collect()}
    sets = {m: set(bits) for m, bits in rows}
    for (x, y), s in scored.items():
        assert 0.0 <= s <= 1.0
        assert s == scored[(y, x)]
        u = sets[x] | sets[y]
        assert s == (len(sets[x] & sets[y]) / len(u) if u else 0.0)
        if x == y and sets[x]:
            assert s == 1.0


def test_base64_roundtrip(spark):
    fps = fps_frame(spark, [("X", [1, 64, 2000])])
    txt = fps.select(fpx.to_base64("fp").alias("t"))
    assert len(txt.first().t) == 344          # 256 bytes in base64
    back = txt.select(fpx.from_base64("t").alias("fp")).first().fp
    assert back == fp_from_bits([1, 64, 2000])


def test_float32_scores_keep_order(spark):
    from tanimart.operators import similarity as sim
    from .helpers import pairs_frame
    df = pairs_frame(spark, [38 / 39, 37 / 38, 0.5, 0.5])
    a = [(r.target_id, r.rank, r.tied_at_cutoff) for r in sim.top_n(df, 3).orderBy("rank").collect()]
    b = [(r.target_id, r.rank, r.tied_at_cutoff) for r in
         sim.top_n(sim.narrow_scores(df), 3).orderBy("rank").collect()]
    assert a == b
    assert sim.narrow_scores(df).schema["score"].dataType.simpleString() == "float"


def test_features_of_all_scripts_and_of_the_caller(spark):
    rows = [("A", "Été, ÜBER größe"), ("B", "Привет мир"), ("C", "x-1")]
    df = spark.createDataFrame(rows, "mol_id string, text string")
    words = {r.mol_id: r.t for r in df.select("mol_id", tx.tokens("text").alias("t")).collect()}
    assert words == {"A": ["été", "über", "größe"], "B": ["привет", "мир"], "C": ["x", "1"]}
    assert {r.mol_id: r.n_bits for r in fpo.fingerprints(df).collect()} == {"A": 3, "B": 2, "C": 2}
    letters = F.split("text", "")
    own = {r.mol_id: r.n_bits for r in fpo.fingerprints(df, features=letters).collect()}
    assert own["C"] == 3
    bits = {(r.mol_id, r.bit) for r in fpo.fingerprint_bits(df, features=letters).collect()}
    assert bits == {(r.mol_id, r.bit) for r in fpo.unpack(fpo.fingerprints(df, features=letters)).collect()}


def test_rows_of_one_id_are_not_merged_and_can_be_refused(spark):
    df = spark.createDataFrame([("A", "one"), ("A", "two three"), ("B", "four")], "mol_id string, text string")
    assert sorted(r.n_bits for r in fpo.fingerprints(df).collect()) == [1, 1, 2]
    with pytest.raises(fpo.DuplicateId, match="A"):
        fpo.require_unique(df)
    assert fpo.require_unique(df.dropDuplicates(["mol_id"])).count() == 2


def test_catalogue_counts_read_whole_texts_of_both_tables(spark, scratch):
    """Texts whose first fragment has no feature count by their words."""
    from tanimart.plans import queries
    docs = [(1, "Some words, and a mark.", "en", "a", 1), (2, "...", "en", "a", 1), (3, "x", "en", "a", 1), (4, " ", "en", "a", 1), (5, None, "en", "a", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, "an item."), (2, "?!")], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert tuple(queries.REGISTRY["catalogue_fingerprint_counts"](spark, scratch).first()) == (3, 4)
    assert tuple(queries.REGISTRY["catalogue_validation_counts"](spark, scratch).first()) == (3, 2)
