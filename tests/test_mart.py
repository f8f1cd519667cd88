"""The five views and the scoped dimension on literal rows."""

from pyspark.sql import functions as F

from tanimart.plans import loadlog, mart
from tanimart.operators import paging

FACT = [
    ("S1", "T1", 0.9, 1, False), ("S1", "T2", 0.5, 2, False), ("S1", "T3", 0.4, 3, False),
    ("S2", "T1", 0.8, 1, False), ("S2", "T3", 0.6, 2, True),
]


def fact(spark):
    return spark.createDataFrame(FACT, "source_id string, target_id string, score double, "
                                       "rank int, tied_at_cutoff boolean")


def dim(spark):
    return spark.createDataFrame([
        ("S1", 10, 1, 5), ("S2", 20, None, 5), ("T1", 12, 2, 7), ("T2", 30, 1, 5), ("T3", None, 1, 5),
    ], "mol_id string, n_chars bigint, n_lines int, n_words int")


def test_average_per_source(spark):
    got = {r.source_id: r.avg_score for r in mart.average_per_source(fact(spark)).collect()}
    assert got == {"S1": 0.6, "S2": 0.7}


def test_property_deviation_skips_nulls(spark):
    got = {r.source_id: (r.source_n_chars, r.avg_n_chars_deviation)
           for r in mart.property_deviation(fact(spark), dim(spark)).collect()}
    assert got == {"S1": (10, 11.0), "S2": (20, 8.0)}


def test_neighbor_chain(spark):
    rows = sorted(mart.neighbor_chain(fact(spark)).collect())
    assert [(r.target_id, r.next_target_id, r.second_target_id) for r in rows] == [
        ("T1", "T2", "T2"), ("T2", "T3", "T2"), ("T3", None, "T2"),
        ("T1", "T3", "T3"), ("T3", None, "T3")]


def test_pivot_and_sample(spark):
    slots = mart.sampled_sources(fact(spark), k=10).collect()
    assert sorted(r.source_id for r in slots) == ["S1", "S2"] and sorted(r.slot for r in slots) == [1, 2]
    piv = mart.pivot_sources(fact(spark), k=2)
    assert piv.columns == ["target_id", "source_01", "source_02"]
    by_slot = {r.source_id: f"source_{r.slot:02d}" for r in slots}
    t2 = piv.filter("target_id = 'T2'").first().asDict()
    assert t2[by_slot["S1"]] == 0.5 and t2[by_slot["S2"]] is None


def test_grouped_average_total_vs_genuine_null(spark):
    rows = {(r.source_id, r.n_lines, r.n_words): r.avg_score
            for r in mart.grouped_average(fact(spark), dim(spark)).collect()}
    assert rows[("S1", "TOTAL", "TOTAL")] == 0.6
    assert rows[("TOTAL", "1", "5")] == 0.6
    assert rows[("TOTAL", None, "5")] == 0.7        # genuine NULL stays NULL
    assert rows[("TOTAL", "TOTAL", "5")] == 0.64
    assert rows[("TOTAL", "TOTAL", "TOTAL")] == 0.64
    assert len(rows) == 6


def test_scoped_dimension(spark):
    mols = spark.createDataFrame([
        ("S1", "document", "one two", "en", 7), ("T1", "document", "a\\nb c", "fr", 5),
        ("X", "document", "unused", "en", 6),
    ], "mol_id string, kind string, text string, lang string, n_chars bigint")
    props = spark.createDataFrame([("S1", 1, 0), ("X", 0, 1)], "mol_id string, quality int, toxic int")
    f = fact(spark).filter("source_id = 'S1' AND target_id = 'T1'")
    got = {r.mol_id: r for r in mart.dimension(f, mols, props).collect()}
    assert set(got) == {"S1", "T1"}
    assert (got["S1"].n_words, got["S1"].n_lines, got["S1"].quality) == (2, 1, 1)
    assert (got["T1"].n_words, got["T1"].quality) == (3, None)


def test_load_log_latest_and_upsert(spark):
    import datetime as dt
    t = lambda h: dt.datetime(2024, 1, 1, h)
    log = spark.createDataFrame([
        ("bronze.x", "36", t(1), 10), ("bronze.x", "37", t(2), 11), ("bronze.x", "37", t(3), 12),
        ("silver.y", "37", t(1), 5),
    ], "table_name string, version string, loaded_at timestamp, row_count bigint")
    latest = {r.table_name: (r.version, r.row_count) for r in loadlog.latest_version(log).collect()}
    assert latest == {"bronze.x": ("37", 12), "silver.y": ("37", 5)}
    cur = {(r.table_name, r.version): r.row_count for r in loadlog.current_entries(log).collect()}
    assert cur == {("bronze.x", "36"): 10, ("bronze.x", "37"): 12, ("silver.y", "37"): 5}


def test_keyset_pages_cover_everything(spark):
    df = spark.range(0, 103).select((F.col("id") * 7 % 103).alias("k"))
    seen, last = [], None
    while True:
        page = [r.k for r in paging.keyset_page(df, "k", last, size=25).collect()]
        if not page:
            break
        seen += page
        last = page[-1]
    assert seen == list(range(103))
