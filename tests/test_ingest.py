"""Raw batch ingest: discovery, header resolution, CSV reading, idempotency."""

import csv
import io
import os
import random

import pytest

from tanimart.sources import csv_ingest, csv_records


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_header_lookup_strips_applies_aliases_and_rejects():
    assert csv_ingest.header_columns([" lab_id", "IC50_nM ", "collection_date"]) == \
        [(0, "lab_id"), (1, "ic50_nm"), (2, "assay_date")]
    with pytest.raises(csv_ingest.HeaderError, match="field 2"):
        csv_ingest.header_columns(["compound_id", "colour"])
    with pytest.raises(csv_ingest.HeaderError, match="two fields"):
        csv_ingest.header_columns(["ic50_nm", "IC50_nM"])
    aliases = {"substance": "compound_name", "log p": "logp"}
    assert csv_ingest.header_columns(["log p", " substance "], aliases=aliases) == [(0, "logp"), (1, "compound_name")]


def test_discovery_matches_whole_key(spark, scratch):
    write(f"{scratch}/in/batch_01.csv", "compound_id\n1\n")
    write(f"{scratch}/in/batch_02.csv", "compound_id\n2\n")
    write(f"{scratch}/in/readme.txt", "x")
    write(f"{scratch}/in/batch_x/data.csv", "compound_id\n3\n")   # directory name matches too
    write(f"{scratch}/in/other.csv", "compound_id\n4\n")
    found = [os.path.relpath(p.replace("file:", ""), f"{scratch}/in")
             for p in csv_ingest.list_batch_files(spark, f"{scratch}/in")]
    assert found == ["batch_01.csv", "batch_02.csv", "batch_x/data.csv"]
    assert csv_ingest.list_batch_files(spark, f"{scratch}/nothing") == []


def test_read_batch_text_only_quotes_and_provenance(spark, scratch):
    p = f"{scratch}/batch_01.csv"
    write(p, 'compound_id,compound_name,IC50_nM\n'
             '1,"aspirin, plain",12.5\n'
             '2,"",007\n'
             '3,"multi\nline",x\n')
    df = csv_ingest.read_batch(spark, p)
    rows = sorted(df.collect(), key=lambda r: r.compound_id)
    assert df.columns[:7] == ["compound_id", "compound_name", "molecular_weight", "logp",
                              "ic50_nm", "assay_date", "lab_id"]
    assert all(t == "string" for _, t in df.dtypes if _ != "_source_file")
    assert rows[0].compound_name == "aspirin, plain" and rows[0].ic50_nm == "12.5"
    assert rows[1].compound_name is None and rows[1].ic50_nm == "007"   # text kept as text
    assert rows[2].compound_name == "multi\nline"
    assert rows[0].molecular_weight is None
    assert all(r._source_file.endswith("batch_01.csv") for r in rows)


def test_bad_header_fails_before_reading(spark, scratch):
    p = f"{scratch}/batch_bad.csv"
    write(p, "lab_id,colour\n1,2\n")
    with pytest.raises(csv_ingest.HeaderError):
        csv_ingest.read_batch(spark, p)


def test_ragged_row_fails(spark, scratch):
    p = f"{scratch}/batch_ragged.csv"
    write(p, "compound_id,compound_name\n1,a\n2,b,extra\n")
    with pytest.raises(Exception):
        csv_ingest.read_batch(spark, p).collect()


def test_union_of_batches_with_different_headers(spark, scratch):
    write(f"{scratch}/a/batch_1.csv", "compound_name,compound_id\nx,1\n")
    write(f"{scratch}/a/batch_2.csv", "compound_id,collection_date\n2,2024-01-05\n")
    files = csv_ingest.list_batch_files(spark, f"{scratch}/a")
    df = csv_ingest.union_batches([csv_ingest.read_batch(spark, f) for f in files])
    got = sorted((r.compound_id, r.compound_name, r.assay_date) for r in df.collect())
    assert got == [("1", "x", None), ("2", None, "2024-01-05")]


def test_files_with_one_header_are_one_read(spark, scratch):
    for i in range(30):
        head = "compound_id,compound_name" if i % 2 else "compound_name, lab_id"
        write(f"{scratch}/in dir/batch_{i:02d}.csv", f"{head}\n{i},n{i}\n")
    files = csv_ingest.list_batch_files(spark, f"{scratch}/in dir")
    assert len(files) == 30
    df = csv_ingest.read_batches(spark, files)
    rows = df.collect()
    assert sorted({r._source_file for r in rows}) == sorted(csv_ingest.file_key(spark, f) for f in files)
    assert df._jdf.queryExecution().analyzed().toString().count("parquet") == 0
    assert df._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1  # both headers have two fields
    assert {(r.compound_name, r.lab_id) for r in rows if r.compound_id is None} == {(str(i), f"n{i}") for i in range(0, 30, 2)}


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes, so that most records stand near an edge."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "150")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def _fields(rnd):
    parts = ["plain", "a,b", 'say ""hi""'.replace('""', '"'), "two\nlines", "three\n\nlines,\n", "x" * 40, '"', "tail\n", "\nhead", "ünï\r\ncode", "42"]
    return [rnd.choice(parts) + rnd.choice(["", "z"]) for _ in range(3)]


def _files(scratch, seed, n_files, n_rows):
    rnd, want = random.Random(seed), []
    for f in range(n_files):
        names = rnd.sample(["compound_id", "compound_name", "lab_id", " IC50_nM"], 3)
        out = io.StringIO()
        w = csv.writer(out, lineterminator=rnd.choice(["\n", "\r\n"]))
        w.writerow(names)
        for _ in range(n_rows):
            row = _fields(rnd)
            w.writerow(row)
            got = dict(zip([n.strip() for n in names], row, strict=True))
            want.append((f"batch_{f}.csv", got.get("compound_id"), got.get("compound_name"), got.get("IC50_nM"), got.get("lab_id")))
        os.makedirs(scratch, exist_ok=True)
        with open(f"{scratch}/batch_{f}.csv", "w", encoding="utf-8", newline="") as h:
            h.write(out.getvalue())
    return want


def _read(spark, scratch):
    df = csv_ingest.read_batches(spark, csv_ingest.list_batch_files(spark, scratch))
    return df, [(os.path.basename(r._source_file), r.compound_id, r.compound_name, r.ic50_nm, r.lab_id) for r in df.collect()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quoted_files_read_in_many_splits_equal_the_csv_module(spark, scratch, small_splits, seed):
    want = _files(f"{scratch}/in", seed, 3, 120)
    df, got = _read(spark, f"{scratch}/in")
    assert df.rdd.getNumPartitions() > 30
    key = lambda r: tuple(x or "" for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_a_record_over_many_splits(spark, scratch, small_splits):
    long = "line, of a field\n" * 200
    write(f"{scratch}/in/batch_1.csv", f'compound_id,compound_name\n1,"{long}"\n2,b\n3,"{long}"\n')
    _, got = _read(spark, f"{scratch}/in")
    assert sorted((r[1], r[2]) for r in got) == [("1", long), ("2", "b"), ("3", long)]


def test_a_ragged_row_in_a_split_file_fails(spark, scratch, small_splits):
    rows = "".join(f'{i},"a\nb"\n' for i in range(80))
    write(f"{scratch}/in/batch_1.csv", f"compound_id,compound_name\n{rows}7,a,b\n{rows}")
    with pytest.raises(Exception, match="(?i)malformed"):
        _read(spark, f"{scratch}/in")


def test_line_ends_by_the_rules_of_quotes():
    for line, opened, want in [('a,"b', False, True), ('a,"b""', False, True), ('a,"b"""', False, False), ('a"b', False, False), ('b",c', True, False), ("b", True, True),
                               ('","', True, True), ('","', False, False), ('"a" x,"', False, True), ('"a"\r', False, False), ("", True, True), ("", False, False), ('",', True, False), ('""', True, True)]:
        assert csv_records.ends_open(line, opened) is want, (line, opened)


def test_a_thousand_files_are_one_read_without_a_header_job(spark, scratch):
    names = ["compound_id", "compound_name", "lab_id", "logp"]
    for i in range(1000):
        head = random.Random(i).sample(names, 2)
        write(f"{scratch}/in/batch_{i}.csv", ",".join(head) + "\n" + ",".join(f"{h}{i}" for h in head) + "\n")
    files = csv_ingest.list_batch_files(spark, f"{scratch}/in")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    df = csv_ingest.read_batches(spark, files)
    assert len(tracker.getJobIdsForGroup("headers")) <= 1  # Spark's own listing of many paths
    assert str(df._jdf.queryExecution().analyzed()).count("MapInArrow") == 1
    rows = df.collect()
    assert len(rows) == 1000
    for r in rows:
        i = r._source_file.rsplit("_", 1)[1][:-4]
        assert sorted(v for v in (r.compound_id, r.compound_name, r.lab_id, r.logp) if v) == sorted(f"{h}{i}" for h in random.Random(int(i)).sample(names, 2))


def test_a_header_longer_than_the_first_look(spark, scratch):
    pad = " " * 40_000
    write(f"{scratch}/in/batch_1.csv", f'{pad}compound_id,"compound_name{pad}"\n1,a\n')
    _, got = _read(spark, f"{scratch}/in")
    assert [(r[1], r[2]) for r in got] == [("1", "a")]
