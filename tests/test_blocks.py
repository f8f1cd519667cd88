"""The block kernel and the upkeep of a top-N against plain Python sets."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tanimart.operators import blocks, bound_index
from tanimart.operators import similarity as sim

from .helpers import fp_from_bits, fps_frame


def _tanimoto(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 0.0


def _number(key):
    digits = ""
    while key and key[-1] in "0123456789":
        digits, key = key[-1] + digits, key[:-1]
    return key, (int(digits) if digits else -1)


def _plain(sources, candidates, n):
    """{(source, target, score, rank, tied)} by sorting every source's candidates."""
    out = set()
    for s, a in sources.items():
        rows = sorted(((-_tanimoto(a, b), *_number(t), t) for t, b in candidates.items() if t != s))
        cut = -rows[n - 1][0] if len(rows) > n else None
        spilled = len(rows) > n and rows[n][0] == rows[n - 1][0]
        for k, (neg, _, _, t) in enumerate(rows[:n]):
            out.add((s, t, -neg, k + 1, spilled and -neg == cut))
    return out


def _entries(rnd, names):
    return {m: rnd.sample(range(40), rnd.choice([0, 1, 1, 2, 3, 8, 12, 30])) for m in names}


def _frame(spark, entries):
    return fps_frame(spark, list(entries.items()))


def _got(df):
    return {tuple(r) for r in df.collect()}


def test_tiles_equal_set_scores():
    rnd = random.Random(2)
    own, other = [rnd.sample(range(2048), rnd.randrange(0, 90)) for _ in range(37)], [rnd.sample(range(2048), rnd.randrange(0, 90)) for _ in range(53)]
    table = lambda rows: pa.table({"fp": pa.array([fp_from_bits(b) for b in rows], pa.list_(pa.int64())), "n_bits": pa.array([len(b) for b in rows], pa.int32())})
    blocks.TILE, held = 200, blocks.TILE
    try:
        got = np.concatenate([s for _, s in blocks.tiles(table(own), table(other))])
    finally:
        blocks.TILE = held
    assert got.tolist() == [[_tanimoto(a, b) for b in other] for a in own]


def test_first_rows_take_ties_in_order():
    s = np.array([0.5, -1.0, 0.7, 0.5, 0.5, 0.7])
    assert sorted(blocks.first_rows(s, 3)) == [0, 2, 5]
    assert sorted(blocks.first_rows(s, 9)) == [0, 2, 3, 4, 5]


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_equals_sorting_all_candidates(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    names = [f"D{i}" for i in rnd.sample(range(200), 70)] + ["B7", "B07", "x", "D"]
    entries = _entries(rnd, names)
    fps = _frame(spark, entries)
    sources = {m: entries[m] for m in names[::3]}
    monkeypatch.setattr("tanimart.config.BLOCK_CANDIDATES", 7)
    monkeypatch.setattr("tanimart.config.BLOCK_SOURCES", 5)
    for n in (1, 4, 80):
        assert _got(sim.nearest(_frame(spark, sources), fps, n)) == _plain(sources, entries, n)


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_maintained_head_equals_a_rebuild(spark, seed):
    rnd = random.Random(seed)
    names = [f"D{i}" for i in range(60)]
    before = _entries(rnd, rnd.sample(names, 45))
    after = {m: b for m, b in before.items() if rnd.random() > 0.1}  # some go
    after |= _entries(rnd, rnd.sample(sorted(after), 3))  # some change
    after |= _entries(rnd, rnd.sample([m for m in names if m not in before], 8))  # some come
    old_sources = rnd.sample(sorted(before), 12)
    new_sources = [m for m in old_sources if m in after][:-1] + rnd.sample([m for m in after if m not in old_sources], 3)
    n = 3
    old, new = _frame(spark, before), _frame(spark, after)
    state = sim.head(_frame(spark, {m: before[m] for m in old_sources}), old, n)
    removed, added = sim.changes(old, new)
    assert {r.mol_id for r in removed.collect()} == {m for m, b in before.items() if set(after.get(m, [-1])) != set(b)}
    assert {r.mol_id for r in added.collect()} == {m for m, b in after.items() if set(before.get(m, [-1])) != set(b)}
    sources = {m: after[m] for m in new_sources}
    kept = sim.maintained(state, _frame(spark, sources), new, removed, added, n)
    assert _got(sim.flagged(kept, n)) == _plain(sources, after, n)
    # the upkeep's own result is a state again
    again = sim.maintained(kept, _frame(spark, sources), new, removed.limit(0), added.limit(0), n)
    assert _got(sim.flagged(again, n)) == _plain(sources, after, n)


def test_maintained_from_nothing_and_to_nothing(spark):
    entries = {"D1": [1, 2], "D2": [2], "D3": [9]}
    fps = _frame(spark, entries)
    nothing = fps.limit(0)
    state = sim.head(nothing, nothing, 2)
    removed, added = sim.changes(nothing, fps)
    full = sim.maintained(state, fps, fps, removed, added, 2)
    assert _got(sim.flagged(full, 2)) == _plain(entries, entries, 2)
    removed, added = sim.changes(fps, nothing)
    assert sim.maintained(full, nothing, nothing, removed, added, 2).count() == 0


@pytest.mark.parametrize("seed", [6, 7, 8])
def test_index_finds_what_sorting_finds(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr("tanimart.config.BLOCK_SOURCES", 5)
    monkeypatch.setattr("tanimart.operators.bound_index.CHUNK_GROUPS", 6)
    names = [f"D{i}" for i in range(120)]
    entries = _entries(rnd, names)
    for c in range(12):  # clusters of near copies, some equal (ties at the cutoff)
        base = rnd.sample(range(2048), 40)
        for k in range(9):
            entries[f"C{c}x{k}"] = base[:40 - k // 3] + rnd.sample(range(2048), k // 3)
    index = bound_index.build(_frame(spark, entries).repartition(3), 4, 3)
    assert index.groups.count() > 3 and index.blocks.agg({"n": "sum"}).first()[0] == len(entries)
    sources = {m: entries[m] for m in rnd.sample(sorted(entries), 25)}
    frame = _frame(spark, sources)
    for n in (2, 5):
        assert _got(bound_index.nearest(frame, index, n)) == _plain(sources, entries, n)
    assert _got(bound_index.nearest(frame.limit(0), index, 2)) == set()


def test_index_skips_blocks_that_cannot_matter(spark):
    rnd = random.Random(1)
    entries = {}
    for c in range(40):
        base = rnd.sample(range(2048), 50)
        entries |= {f"C{c}x{k}": base[:46] + rnd.sample(range(2048), 4) for k in range(16)}
    index = bound_index.build(_frame(spark, entries), 8, 4)
    sources = {m: entries[m] for m in ("C0x0", "C9x1", "C39x2")}
    scored, pairs = bound_index.pairs_scored(_frame(spark, sources), index, 10)
    assert pairs == 3 * 640 and scored < pairs / 2
    assert _got(bound_index.nearest(_frame(spark, sources), index, 10)) == _plain(sources, entries, 10)


def test_index_computes_its_input_once(spark):
    """The range shuffle samples its input: fingerprints behind it were made twice."""
    rnd = random.Random(3)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    fps = _frame(spark, _entries(rnd, [f"D{i}" for i in range(300)]))
    index = bound_index.build(fps.mapInArrow(counted, fps.schema), 8, 4)
    assert index.rows.count() == 300 and seen.value == 300


def test_index_yields_few_rows_per_group(spark):
    """A group yields a source's first rows once, not once per block, and none
    below the source's t."""
    rnd = random.Random(4)
    entries = {f"D{i}": rnd.sample(range(60), 20) for i in range(200)}
    index = bound_index.build(_frame(spark, entries).coalesce(1), 4, 8)
    wanted = index.blocks.select("grp", "block").crossJoin(_frame(spark, {"D3": entries["D3"]}).withColumn("t", F.lit(0.4)))
    asked = wanted.groupBy("mol_id", "fp", "n_bits", "t", "grp").agg(F.collect_set("block").alias("asked"))
    rows = bound_index._scored(asked, index.rows, 1, 3, True).collect()
    held = {r.mol_id: r.grp for r in index.rows.collect()}
    by_group = {}
    for t, b in entries.items():
        if t != "D3" and _tanimoto(entries["D3"], b) >= 0.4:
            by_group.setdefault(held[t], []).append((-_tanimoto(entries["D3"], b), *_number(t), t))
    want = {("D3", r[3], -r[0]) for group in by_group.values() for r in sorted(group)[:3]}
    assert want and len(rows) == len(want) and {tuple(r) for r in rows} == want


def test_empty_index(spark):
    nothing = _frame(spark, {"D1": [1]}).limit(0)
    assert bound_index.nearest(nothing, bound_index.build(nothing), 3).count() == 0
