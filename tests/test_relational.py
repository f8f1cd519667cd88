"""The relational file source: partitions, pruning, pushdown, mirror."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from tanimart.plans import build
from tanimart.sources import relational, tables

from .conftest import SF_SMALL


def _export(spark, path, names):
    """Tables of the test data as one relational file."""
    con = sqlite3.connect(path)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "REAL"}
    for name in names:
        df = tables.read_table(spark, SF_SMALL, name)
        df = df.select(*[F.col(c).cast("string").alias(c) if t.startswith(("date", "timestamp")) else F.col(c) for c, t in df.dtypes])
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {kinds.get(t, 'TEXT')}' for c, t in df.dtypes)})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(df.columns))})", [tuple(r) for r in df.collect()])
    con.commit()
    con.close()


@pytest.fixture()
def file(spark, scratch):
    _export(spark, f"{scratch}/source.db", ["orders", "documents", "benchmark", "labels"])
    return f"{scratch}/source.db"


def test_exported_table_reads_back_equal(spark, file):
    want = tables.read_table(spark, SF_SMALL, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    got = relational.read_relational(spark, file, "orders", partitions=7)
    assert got.rdd.getNumPartitions() == 7
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_columns_and_filters_reach_the_file(spark, file, monkeypatch):
    df = relational.read_relational(spark, file, "orders", ["o_orderkey", "o_totalprice"], partitions=3)
    few = df.filter((F.col("o_orderkey") > 100) & F.col("o_orderkey").isin(101, 102, 5) & F.col("o_totalprice").isNotNull())
    assert {r.o_orderkey for r in few.collect()} == {r.o_orderkey for r in tables.read_table(spark, SF_SMALL, "orders").filter("o_orderkey IN (101, 102)").collect()}
    reader = relational.SqliteReader({"path": file, "table": "orders"}, df.schema)
    left = list(reader.pushFilters([relational.GreaterThan(("o_orderkey",), 100), relational.In(("o_orderkey",), (101, 5)), relational.IsNotNull(("o_totalprice",)), relational.EqualTo(("other",), 1)]))
    assert len(left) == 4  # Spark checks them again
    assert "isin" not in str(few._jdf.queryExecution().executedPlan()) and "sqlite" in str(few._jdf.queryExecution().executedPlan()).lower()
    text, values = reader.query(relational.Range(3, 9))
    assert text == ('SELECT "o_orderkey", "o_totalprice" FROM "orders" WHERE rowid >= ? AND rowid < ? AND "o_orderkey" > ? AND "o_orderkey" IN (?, ?) AND "o_totalprice" IS NOT NULL')
    assert values == [3, 9, 100, 101, 5]


def test_odd_tables(spark, scratch):
    path = f"{scratch}/odd.db"
    con = sqlite3.connect(path)
    con.execute('CREATE TABLE "odd ""name" ("a b" TEXT, k INTEGER, v REAL, raw BLOB)')
    con.executemany('INSERT INTO "odd ""name" VALUES (?, ?, ?, ?)', [("x", 5, 1.5, b"\x00"), ("", -3, None, None), (None, None, 2.0, b""), ("ü", 10**12, -0.0, b"z")])
    con.execute("CREATE TABLE none (a TEXT)")
    con.execute("CREATE TABLE wrong (n INTEGER)")
    con.execute("INSERT INTO wrong VALUES ('text')")
    con.commit()
    con.close()
    for key, parts in ((None, 2), ("k", 4)):  # rows without a key are a partition of their own
        got = relational.read_relational(spark, path, 'odd "name', key=key, partitions=parts)
        rows = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got.collect()]
        assert sorted(rows, key=str) == sorted([("x", 5, 1.5, b"\x00"), ("", -3, None, None), (None, None, 2.0, b""), ("ü", 10**12, -0.0, b"z")], key=str)
    assert relational.read_relational(spark, path, "none").count() == 0
    with pytest.raises(Exception):
        relational.read_relational(spark, path, "wrong").collect()
    with pytest.raises(Exception, match="no table"):
        relational.read_relational(spark, path, "missing").collect()
    with pytest.raises(Exception, match="no column"):
        relational.read_relational(spark, path, "none", ["b"]).collect()


def test_mirror_from_a_relational_file_equals_the_tables(spark, scratch, file):
    a, b = build.Warehouse(spark, f"{scratch}/a"), build.Warehouse(spark, f"{scratch}/b")
    build.mirror_tables(a, SF_SMALL, "v1")
    out = build.mirror_tables(b, file, "v1")
    assert all(not r.skipped for r in out)
    for name in build.MIRROR:
        one, two = a.read(name), b.read(name)
        assert one.columns == two.columns and one.select([F.col(c).cast("string") for c in one.columns]).exceptAll(two.select([F.col(c).cast("string") for c in two.columns])).count() == 0
        assert one.count() == two.count()
