"""Warehouse jobs: gate, force, atomic replace, empty guard, ingest, streaming."""

import os

import pytest
from pyspark.sql import functions as F

from tanimart.plans import build
from tanimart.sources import sinks
from tanimart.streaming import file_ingest

from .conftest import SF_SMALL


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_replace_is_atomic_and_guarded(spark, scratch):
    path = f"{scratch}/t"
    assert sinks.replace(spark.range(5), path) == 5
    first = sinks.current_path(spark, path)
    with pytest.raises(sinks.EmptyResult):
        sinks.replace(spark.range(0), path, require_rows=True)
    assert sinks.current_path(spark, path) == first
    assert sinks.read_current(spark, path).count() == 5
    sinks.replace(spark.range(3), path)
    assert sinks.read_current(spark, path).count() == 3


def test_expire_keeps_published_new_and_spared_versions(spark, scratch):
    path = f"{scratch}/t"
    assert sinks.expire(spark, path) == []
    folders = []
    for n in range(1, 6):
        sinks.replace(spark.range(n), path)
        folders.append(sinks.current_path(spark, path))
        os.utime(f"{folders[-1]}/_SUCCESS", (1_000_000 + n, 1_000_000 + n))
    spark.range(9).write.parquet(f"{path}/v-unpublished")  # complete, later than the published one
    os.makedirs(f"{path}/v-unfinished")
    with pytest.raises(ValueError):
        sinks.expire(spark, path, keep=0)
    assert sinks.expire(spark, path, keep=9) == []
    assert sorted(sinks.expire(spark, path, keep=2, spare=(folders[0],))) == sorted(folders[1:3])
    left = {f for f in os.listdir(path) if f.startswith("v-")}
    assert left == {os.path.basename(folders[k]) for k in (0, 3, 4)} | {"v-unpublished", "v-unfinished"}
    assert sinks.read_current(spark, path).count() == 5
    assert sinks.expire(spark, path, keep=1) == [folders[3], folders[0]]


def test_warehouse_expire_spares_the_heads_fingerprints(spark, scratch):
    wh = build.Warehouse(spark, f"{scratch}/wh")
    prints = []
    for n in range(1, 5):
        wh.build("silver.fingerprint", str(n), lambda n=n: spark.range(n))
        prints.append(sinks.current_path(spark, wh.path("silver.fingerprint")))
        os.utime(f"{prints[-1]}/_SUCCESS", (1_000_000 + n, 1_000_000 + n))
    wh.record((build.HEAD, f"{prints[0]}#10", 1))
    assert sorted(build.expire(wh, keep=1)) == sorted(prints[1:3])
    assert os.path.isdir(prints[0]) and wh.read("silver.fingerprint").count() == 4


def test_version_gate_skip_and_force(spark, scratch):
    wh = build.Warehouse(spark, scratch)
    calls = []

    def make():
        calls.append(1)
        return spark.range(4)
    assert not wh.build("silver.t", "37", make).skipped
    assert wh.build("silver.t", "37", make).skipped
    assert not wh.build("silver.t", "37", make, force=True).skipped
    assert not wh.build("silver.t", "38", make).skipped
    assert len(calls) == 3 and wh.last_version("silver.t") == "38"


def test_full_chain_and_empty_fact_guard(spark, scratch):
    wh = build.Warehouse(spark, f"{scratch}/wh")
    write(f"{scratch}/in/batch_01.csv",
          "compound_id,compound_name,IC50_nM\n"
          "1,ITEM#000000001 ,5\n2,  ,7\n3,paracetamol,-1\n4,document#000000007,\n5,item#000000001,2\n")
    out = build.run_all(wh, SF_SMALL, "v1", input_root=f"{scratch}/in")
    matched = {r.compound_id: (r.matched_id, r.ic50_nm) for r in wh.read("silver.matched_input").collect()}
    assert matched == {"1": ("B1", 5.0), "3": (None, None), "4": ("D7", None), "5": ("B1", 2.0)}
    assert out["similarity"].rows == 2 * 10
    fact = wh.read("gold.fact_similarity")
    assert {r.source_id for r in fact.collect()} == {"B1", "D7"}
    assert fact.filter("source_id = target_id").count() == 0
    log = {r.table_name: r.row_count for r in wh.log().collect()}
    assert log["silver.molecule.rejected"] == 0 and log["silver.fingerprint.failed"] == 0
    build.build_similarity(wh, "v1", force=True, store_from=0.1)
    stored = wh.read("gold.similarity")
    assert stored.filter("score < 0.1").count() == 0 and stored.join(fact, ["source_id", "target_id", "score"]).count() > 0
    names = build.register_views(wh)
    assert spark.table("average_similarity_score").count() == 2 and len(names) == 7
    again = build.run_all(wh, SF_SMALL, "v1", input_root=f"{scratch}/in")
    assert all(r.skipped for r in again["mirror"]) and again["similarity"].skipped
    # an empty fact must not replace the dimension
    dim_before = sinks.current_path(spark, wh.path("gold.dim_molecule"))
    sinks.replace(fact.limit(0), wh.path("gold.fact_similarity"))
    with pytest.raises(sinks.EmptyResult):
        build.build_dimension(wh, "v2")
    assert sinks.current_path(spark, wh.path("gold.dim_molecule")) == dim_before


def test_fact_is_kept_up_and_equals_a_rebuild(spark, scratch, monkeypatch):
    wh = build.Warehouse(spark, f"{scratch}/wh")
    header = "compound_id,compound_name\n"
    write(f"{scratch}/in/batch_01.csv", header + "1,item#000000001\n2,document#000000007\n3,\n4,nobody\n")
    build.run_all(wh, SF_SMALL, "v1", input_root=f"{scratch}/in")
    counts = {r.table_name: r.row_count for r in wh.log().collect() if r.table_name.startswith("silver.matched_input")}
    assert counts == {"silver.matched_input": 3, "silver.matched_input.dropped": 1, "silver.matched_input.unmatched": 1, "silver.matched_input.fanout": 0}
    # a smaller catalogue with other texts, and one more source
    near = {r.target_id for r in wh.read("gold.fact_similarity").filter("source_id = 'D7'").collect()}
    docs = wh.read("bronze.documents")
    gone = F.concat(F.lit("D"), "doc_id").isin(sorted(near)[:1])
    less = docs.filter(~gone).withColumn("text", F.when(F.col("doc_id") % 9 == 4, F.reverse("text")).otherwise(F.col("text")))
    sinks.replace(less, wh.path("bronze.documents"))
    build.build_molecules(wh, "v2")
    build.build_fingerprints(wh, "v2")
    write(f"{scratch}/in/batch_02.csv", header + "5,item#000000002\n")
    build.ingest_input_files(wh, f"{scratch}/in")
    build.build_matched_input(wh)
    built = []
    whole = build.sim.maintained
    monkeypatch.setattr(build.sim, "maintained", lambda *a, **k: built.append(1) or whole(*a, **k))
    build.build_similarity(wh, "v2")
    assert built == [1]
    kept = sorted(map(tuple, wh.read("gold.fact_similarity").collect()))
    build.build_similarity(wh, "v2", force=True)
    assert built == [1] and sorted(map(tuple, wh.read("gold.fact_similarity").collect())) == kept
    assert {r[0] for r in kept} == {"B1", "B2", "D7"}


def test_file_ingest_loads_each_file_once(spark, scratch):
    wh = build.Warehouse(spark, f"{scratch}/wh")
    inp = f"{scratch}/in"
    write(f"{inp}/batch_01.csv", "compound_id,compound_name\n1,Customer#000000001\n2,x\n")
    write(f"{inp}/notes.txt", "ignore")
    assert [os.path.basename(p) for p in build.ingest_input_files(wh, inp)] == ["batch_01.csv"]
    assert build.ingest_input_files(wh, inp) == []
    write(f"{inp}/batch_02.csv", "compound_name,IC50_nM\nCustomer#000000002,5\n")
    assert [os.path.basename(p) for p in build.ingest_input_files(wh, inp)] == ["batch_02.csv"]
    raw = spark.read.parquet(wh.path(build.RAW_INPUT))
    assert raw.count() == 3
    write(f"{inp}/batch_03.csv", "compound_id,bogus\n1,2\n")
    with pytest.raises(Exception):
        build.ingest_input_files(wh, inp)
    assert spark.read.parquet(wh.path(build.RAW_INPUT)).count() == 3


def test_input_that_matches_nothing_stops_the_chain(spark, scratch):
    wh = build.Warehouse(spark, f"{scratch}/wh")
    write(f"{scratch}/in/batch_01.csv", "compound_id,compound_name\n1,nobody\n")
    with pytest.raises(sinks.EmptyResult, match="refers to no entry"):
        build.run_all(wh, SF_SMALL, "v1", input_root=f"{scratch}/in")


def test_files_in_a_folder_with_a_space_are_counted(spark, scratch):
    wh = build.Warehouse(spark, f"{scratch}/wh")
    write(f"{scratch}/my dir/batch_01.csv", "compound_id\n1\n2\n")
    write(f"{scratch}/my dir/batch_02.csv", "compound_id\n")
    files = build.ingest_input_files(wh, f"{scratch}/my dir")
    log = wh.log().collect()
    assert sorted((os.path.basename(r.version), r.row_count) for r in log) == [("batch_01.csv", 2), ("batch_02.csv", 0)]
    assert len(files) == 2 and len({r.loaded_at for r in log}) == 1
    assert build.ingest_input_files(wh, f"{scratch}/my dir") == []


def test_streaming_ingest_exactly_once(spark, scratch):
    inp, out, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt"
    write(f"{inp}/batch_01.csv", "compound_id,compound_name\n1,a\n2,b\n")
    write(f"{inp}/skip.csv", "compound_id\n9\n")
    file_ingest.run_once(spark, inp, out, ckpt)
    assert spark.read.parquet(out).count() == 2
    file_ingest.run_once(spark, inp, out, ckpt)
    assert spark.read.parquet(out).count() == 2
    write(f"{inp}/batch_02.csv", "compound_id,IC50_nM\n3,1.5\n")
    file_ingest.run_once(spark, inp, out, ckpt)
    df = spark.read.parquet(out)
    assert df.count() == 3 and df.filter(F.col("ic50_nm") == "1.5").count() == 1
