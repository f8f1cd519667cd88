"""Typing, validation split, name matching with overrides, audit counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tanimart.functions import text as tx
from tanimart.operators import clean, match, validate

RAW_SCHEMA = ("compound_id string, compound_name string, molecular_weight string, logp string, "
              "ic50_nm string, assay_date string, lab_id string, _source_file string")


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_typed_input_casts_and_guards(spark):
    df = raw(spark, [
        (" 1 ", " Aspirin ", "180.2", "-1.5", "0", "2024-01-15", " L1 ", "f"),
        ("2", "x", "abc", "1e3", "-5", "01/15/2024", "L2", "f"),
        ("3", "   ", "1", "1", "1", "2024-01-01", "L3", "f"),
        ("4", None, "1", "1", "1", "2024-01-01", "L4", "f"),
        (None, "y", "", "", "2.5", "2024-02-30", "L5", "f"),
        ("5", "z", "12f", "0x1p3", "3D", "20240115", "L6", "f"),
        ("6", "v", " .5 ", "-2.", "NaN", "2024-1-5", "L7", "f"),
        ("7", "w", "Infinity", "1e400", "7 8", "2024-01-15 10:00:00", "L8", "f"),
    ])
    rows = {r.compound_name: r for r in clean.typed_input(df).collect()}
    assert set(rows) == {"Aspirin", "x", "y", "z", "v", "w"}
    a = rows["Aspirin"]
    assert (a.compound_id, a.molecular_weight, a.logp, a.ic50_nm, a.lab_id) == ("1", 180.2, -1.5, None, "L1")
    assert a.assay_date == dt.date(2024, 1, 15)
    x = rows["x"]
    assert x.molecular_weight is None and x.logp == 1000.0 and x.ic50_nm is None
    assert x.assay_date == dt.date(2024, 1, 15)
    z, v, w = rows["z"], rows["v"], rows["w"]
    assert (z.molecular_weight, z.logp, z.ic50_nm, z.assay_date) == (None, None, None, dt.date(2024, 1, 15))
    assert (v.molecular_weight, v.logp, v.ic50_nm, v.assay_date) == (0.5, -2.0, None, dt.date(2024, 1, 5))
    assert (w.molecular_weight, w.ic50_nm, w.assay_date) == (None, None, dt.date(2024, 1, 15))
    y = rows["y"]
    assert y.compound_id is None and y.ic50_nm == 2.5 and y.assay_date is None


def dictionary(spark, rows):
    return spark.createDataFrame(rows, "name string, matched_id bigint")


@pytest.mark.parametrize("overrides,expected", [
    ({}, None),
    ({"paracetamol": "acetaminophen"}, 7),
    ({"Paracetamol ": "ACETAMINOPHEN", "aspirin": "nothing"}, 7),
])
def test_overrides(spark, overrides, expected):
    typed = clean.typed_input(raw(spark, [("1", "  PARACETAMOL ", None, None, None, None, None, "f")]))
    d = dictionary(spark, [("Acetaminophen", 7), ("Paracetamol-like", 8)])
    out = match.match_names(typed, d, match.overrides_frame(spark, overrides)).collect()
    assert len(out) == 1 and out[0].matched_id == expected


def test_fanout_and_audit(spark):
    rows = [(str(i), f"name{i % 3}", None, None, None, None, None, "f") for i in range(10)]
    rows += [("x", "  ", None, None, None, None, None, "f"), (None, "name0", None, None, None, None, None, "f")]
    r = raw(spark, rows)
    d = dictionary(spark, [("NAME0", 1), ("name0", 2), ("name1", 3)])   # name0 twice, name2 missing
    matched = match.match_names(clean.typed_input(r), d, match.overrides_frame(spark, {}))
    audit = match.match_audit(r, d, match.overrides_frame(spark, {})).first().asDict()
    # 12 input rows, 1 blank name dropped, 11 kept; name0 rows (4 + NULL-id row = 5) fan out x2
    assert audit == {"total_rows": 12, "kept_rows": 11, "dropped_rows": 1,
                     "output_rows": 16, "unmatched_rows": 3, "fanout_rows": 5}
    null_id = [x for x in matched.collect() if x.compound_id is None]
    assert sorted(x.matched_id for x in null_id) == [1, 2]


def test_validate_split(spark):
    df = spark.createDataFrame([(1, "CCO is fine"), (2, "bad###"), (3, ""), (4, None),
                                (5, "été"), (6, "###"), (7, "  ")], "doc_id int, text string")
    valid, rejected = validate.split(df)
    assert sorted(r.doc_id for r in valid.collect()) == [1, 2, 5]
    assert sorted(r.doc_id for r in rejected.collect()) == [6]
    assert validate.counts(df).first().asDict() == {"valid_rows": 3, "rejected_rows": 1}
    long = F.length("text") > 4
    assert sorted(r.doc_id for r in validate.split(df, long)[0].collect()) == [1, 2]


def test_a_name_on_half_the_rows_is_dealt_to_all_tasks(spark):
    rows = spark.range(8000).select(F.when(F.col("id") % 2 == 0, "Hot Name ").otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("compound_name"), "id")
    names = spark.range(4000).select(F.concat(F.lit("N"), F.col("id").cast("string")).alias("name"), F.col("id").alias("matched_id"))
    names = names.unionByName(spark.createDataFrame([("HOT NAME", -1), ("hot name", -2)], "name string, matched_id long"))
    hot = match.hot_keys(rows.select(tx.normalized_name("compound_name").alias("k")), "k", 8)
    assert list(hot) == ["hot name"] and hot["hot name"] >= 7
    held = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a large dictionary
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = match.match_names(rows, names, match.overrides_frame(spark))
        each = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
    assert sum(each) == 2 * 4000 + 4000  # two entries of the hot name, one row of every other
    assert max(each) <= 2 * sum(each) / len(each)
    got = out.groupBy("id").agg(F.sort_array(F.collect_list("matched_id")).alias("m")).collect()
    assert all(r.m == ([-2, -1] if r.id % 2 == 0 else [r.id] if r.id < 4000 else []) for r in got)


def test_match_without_rows_or_with_null_names(spark):
    typed = spark.createDataFrame([(None,), ("A",)], "compound_name string")
    names = spark.createDataFrame([("a", 1), (None, 2)], "name string, matched_id long")
    assert sorted(map(tuple, match.match_names(typed, names, match.overrides_frame(spark, {})).collect()), key=str) == [("A", 1), (None, None)]
    assert match.match_names(typed.limit(0), names, match.overrides_frame(spark)).count() == 0


def test_clustered_page_opens_only_its_files(spark, scratch):
    from tanimart.operators import paging
    import random
    keys = [*random.Random(1).sample(range(100_000), 5000), *[777] * 30, None]
    df = spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(keys)], "k long, v string").repartition(4)
    zones = paging.write_clustered(df, f"{scratch}/t", "k", file_rows=300).collect()
    assert len(zones) >= 15 and sum(z.rows for z in zones) == 5030
    order = sorted(k for k in keys if k is not None)
    for after, size in ((None, 10), (None, 6000), (50_000, 100), (50_000, 1000), (776, 5), (777, 40), (order[-1], 5), (-5, 1)):
        want = [k for k in order if after is None or k > after][:size]
        assert [r.k for r in paging.clustered_page(spark, f"{scratch}/t", "k", after, size).collect()] == want
        assert [r.k for r in paging.keyset_page(df, "k", after, size).collect()] == want
        files = paging.page_files(spark, f"{scratch}/t", after, size)
        assert len(files) <= 2 + 2 * -(-len(want) // 200) or size > 5000
    assert len(paging.page_files(spark, f"{scratch}/t", 50_000, 100)) <= 2
