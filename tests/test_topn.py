"""Top-N with cutoff-tie flag; all-pairs scoring; plan shape."""

import pytest

from tanimart.operators import similarity as sim

from .helpers import fps_frame, pairs_frame

# (scores in candidate order, N, selected, flagged): all different; a tie that
# the cut splits; a tie inside; a tie before the cut; fewer rows than N; all
# equal; a long tie that begins inside
CASES = [
    ([.61, .44, .33, .12], 2, "AB", ""),
    ([.7, .31, .31, .31], 2, "AB", "B"),
    ([.62, .55, .55], 3, "ABC", ""),
    ([.48, .48, .2, .1], 2, "AB", ""),
    ([.25], 4, "A", ""),
    ([.4, .4, .4, .4], 3, "ABC", "ABC"),
    ([.9, .2, .2, .2, .2], 3, "ABC", "BC"),
]


@pytest.mark.parametrize("scores,n,selected,flagged", CASES)
def test_top_n_tie_cases(spark, scores, n, selected, flagged):
    out = sim.top_n(pairs_frame(spark, scores), n).orderBy("rank").collect()
    assert "".join(r.target_id for r in out) == selected
    assert [r.rank for r in out] == list(range(1, len(selected) + 1))
    assert "".join(r.target_id for r in out if r.tied_at_cutoff) == flagged


def test_top_n_empty(spark):
    empty = spark.createDataFrame([], "source_id string, target_id string, score double")
    assert sim.top_n(empty, 10).count() == 0


def test_top_n_many_zero_ties_stays_bounded(spark):
    # 5 positive scores and 1000 zero-score candidates: rank 6..10 are zeros,
    # flagged because further zeros were cut.
    rows = [("S", f"T{i:04d}", 0.0) for i in range(1000)] + [("S", f"P{i}", 0.5) for i in range(5)]
    df = spark.createDataFrame(rows, "source_id string, target_id string, score double")
    out = sim.top_n(df, 10).orderBy("rank").collect()
    assert len(out) == 10
    assert [r.target_id for r in out[5:]] == [f"T{i:04d}" for i in range(5)]
    assert all(r.tied_at_cutoff for r in out[5:]) and not any(r.tied_at_cutoff for r in out[:5])


def test_top_n_independent_of_partitioning(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"S{s}", f"T{t:03d}", rnd.choice([0.0, 0.25, 0.5, 0.75, 1.0]))
            for s in range(5) for t in range(200)]
    df = spark.createDataFrame(rows, "source_id string, target_id string, score double")
    a = sorted(map(tuple, sim.top_n(df.repartition(1), 10).collect()))
    b = sorted(map(tuple, sim.top_n(df.repartition(13), 10).collect()))
    assert a == b


def test_candidates_of_one_score_are_ordered_by_number(spark):
    ids = ["D10", "D9", "B20", "B3", "D9x", "x"]
    df = spark.createDataFrame([("S", t, 0.5) for t in ids], "source_id string, target_id string, score double")
    out = [r.target_id for r in sim.top_n(df, 6).orderBy("rank").collect()]
    assert out == ["B3", "B20", "D9", "D10", "D9x", "x"]
    cut = sim.top_n(df, 3).orderBy("rank").collect()
    assert [r.target_id for r in cut] == ["B3", "B20", "D9"] and all(r.tied_at_cutoff for r in cut)


def test_similarity_end_to_end(spark):
    fps = fps_frame(spark, [("Q1", [7, 9, 30]), ("N1", [7, 9, 30, 31]), ("N2", [9]), ("N3", [7, 9, 30])])
    fact = sim.nearest(fps.filter("mol_id = 'Q1'"), fps, 10).orderBy("rank").collect()
    assert [(r.target_id, r.score, r.rank) for r in fact] == [("N3", 1.0, 1), ("N1", 0.75, 2), ("N2", 1 / 3, 3)]


def test_zero_overlap_and_empty_fingerprints(spark):
    fps = fps_frame(spark, [("SRC", [5]), ("Z", [7]), ("E", [])])
    pairs = {r.target_id: r.score for r in sim.score_pairs(fps.filter("mol_id = 'SRC'"), fps).collect()}
    assert pairs == {"Z": 0.0, "E": 0.0}
    empty = fps_frame(spark, [("E1", []), ("E2", [])])
    assert [r.score for r in sim.score_pairs(empty.filter("mol_id = 'E1'"), empty).collect()] == [0.0]
    assert sim.nearest(fps, fps.limit(0), 3).count() == 0


def _random_frame(spark):
    import random
    rnd = random.Random(9)
    rows = [(f"M{i}", rnd.sample(range(60), rnd.choice([1, 2, 5, 12, 13, 30, 50]))) for i in range(90)]
    return fps_frame(spark, rows)


def test_banded_top_n_equals_all_pairs(spark, monkeypatch):
    fps = _random_frame(spark)
    want = sorted(map(tuple, sim.top_n(sim.score_pairs(fps, fps), 4).collect()))
    assert sorted(map(tuple, sim.nearest(fps, fps, 4).collect())) == want
    monkeypatch.setattr("tanimart.config.BLOCK_CANDIDATES", 3)   # every band split
    monkeypatch.setattr("tanimart.config.BLOCK_SOURCES", 9)
    assert sorted(map(tuple, sim.nearest(fps, fps, 4).collect())) == want
    assert sorted(map(tuple, sim.nearest(fps, fps, 95).collect())) == sorted(map(tuple, sim.top_n(sim.score_pairs(fps, fps), 95).collect()))


def test_threshold_keeps_exactly_the_pairs_that_reach_it(spark):
    fps = _random_frame(spark)
    every = {tuple(r) for r in sim.score_pairs(fps, fps).collect()}
    assert len(every) == 90 * 89
    assert {tuple(r) for r in sim.score_pairs(fps, fps, least=0.5).collect()} == {p for p in every if p[2] >= 0.5}


def test_plan_is_an_equi_join_with_partial_limit(spark):
    fps = fps_frame(spark, [(f"M{i}", list(range(2 * i + 1))) for i in range(20)])  # several bands
    fact = sim.nearest(fps.filter("mol_id < 'M3'"), fps, 10)
    fact.collect()
    final = fact._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in final and "Cartesian" not in final and "WindowGroupLimit" in final


def test_a_failing_task_fails_materialize(spark):
    from pyspark.sql import functions as F
    from tanimart.session import materialize
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        materialize(bad)
