import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tanimart.llm import ann, chat, quality
from tanimart.llm.queries import QUALITY_LEAST, op3_ann_collisions, op7_chat_perspectives, op9_quality_nbsvm

SF = "/root/testdata/sf0.001"


def _render(rows, participant):
    """Brute force: the whole dialogue as one text, with the masked spans."""
    text, spans = "", []
    for _, name, words in rows:
        if name == participant:
            text += chat.ASSISTANT_HEAD
            spans.append((len(text), len(text) + len(words)))
            text += words + chat.END
        else:
            text += chat.USER_HEAD[0] + name + chat.USER_HEAD[1] + words + chat.END
    return text, spans


def _compare(rows, out):
    talks = {}
    for c, t, who, words in rows:
        talks.setdefault(c, []).append((t, who or "unknown", words or ""))
    got = {}
    for r in out:
        got.setdefault((r.conv_id, r.participant), []).append(r)
    assert set(got) == {(c, w) for c, own in talks.items() for _, w, _ in own}
    for (c, who), own in got.items():
        own.sort(key=lambda r: r.seq)
        turns = sorted(talks[c], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        text, spans = _render(turns, who)
        assert "".join(r.rendered for r in own) == text
        assert [r.seq for r in own] == list(range(len(turns)))
        assert [(r.mask_start, r.mask_end) for r in own if r.mask_start is not None] == spans
        assert all(text[r.char_start:r.char_end] == r.rendered for r in own)
        assert all((r.speaker_as == "assistant") == (r.name == who) for r in own)


def test_perspectives_match_whole_rendering(llm, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)
    rows = [(1, i, ["ann", "bob", "Çelik"][i % 3], f"turn {i} " + "é" * i) for i in range(40)]
    rows += [(2, 0, "ann", "alone"), (3, None, None, None), (3, 1, "bob", ""), (3, 1, "bob", ""), (None, 5, "ann", "x"), (None, 4, "bob", "y" * 50_000)]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("name", F.lit("clash")).withColumn("pid", F.lit("clash"))
    _compare(rows, chat.perspectives(df.repartition(5)).collect())
    assert chat.perspectives(df.where("1 = 0")).count() == 0


def test_perspectives_of_the_table(llm):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in llm.read.parquet(f"{SF}/conversations.parquet").collect()]
    _compare(rows, op7_chat_perspectives(llm, SF).collect())


def test_quality_on_held_out_documents(llm):
    d = "/root/testdata/sf0.01"
    rows = op9_quality_nbsvm(llm, d).collect()
    label = {r.doc_id: r.quality for r in llm.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(rows) == llm.read.parquet(f"{d}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= QUALITY_LEAST)
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert sum(a == b for a, b in held) / len(held) >= 0.95


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(30, 5, replace=False)) for _ in range(60)]
    y = np.array([1.0 if 3 in r or rng.random() < 0.2 else -1.0 for r in rows])
    scale, cost = rng.normal(size=30), np.full(60, 0.7)
    w = quality._svm(rows, scale, y, cost, 3000, 0)
    x = np.zeros((60, 31))
    for i, r in enumerate(rows):
        x[i, r], x[i, 30] = scale[r] / np.sqrt((scale[r] ** 2).sum()), 1
    value = lambda v: v @ v / 2 + (cost * np.maximum(0, 1 - y * (x @ v))).sum()
    assert all(value(w) <= value(w + rng.normal(size=31) * s) + 1e-4 for s in (1e-3, 1e-2, 0.1) for _ in range(50))


def test_quality_odd_rows(llm, odd_docs, no_docs):
    labels = llm.createDataFrame([(1, 1), (2, 1), (4, 0), (5, 0), (11, 0), (12, None)], "doc_id long, quality int")
    model = quality.train(odd_docs.select("doc_id", "text").join(labels, "doc_id"))
    out = quality.score(odd_docs, model).collect()
    assert len(out) == odd_docs.count() and all(0 < r.score < 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (4, 5, 6)}) == 1
    kept = quality.keep(odd_docs, model, 0.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert quality.keep(no_docs, model, 0.5).count() == quality.score(no_docs, model).count() == 0
    empty = quality.train(labels.where("1 = 0").withColumn("text", F.lit("")))
    assert {round(r.score, 6) for r in quality.score(odd_docs, empty).collect()} == {0.5}
    one = quality.train(labels.where("quality = 1").withColumn("text", F.lit("a b")))
    assert all(r.score > 0.5 for r in quality.score(odd_docs, one).collect())


def _brute(rows, k):
    ok = {i: np.array(v, dtype=np.float64) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    return {q: sorted(((-float(ok[q] @ v), i) for i, v in ok.items() if i != q))[:k] for q in ok}


def test_neighbours_reach_the_recall(llm):
    vectors = llm.read.parquet(f"{SF}/embeddings.parquet")
    want = _brute([(r.vec_id, r.embedding) for r in vectors.collect()], 20)
    got = {}
    for r in op3_ann_collisions(llm, SF).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == {q for q in want if q % 20 == 0}
    hits = 0
    for q, own in got.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        score = dict((i, -s) for s, i in want[q])
        hits += sum(r.vec_id in score for r in own)
        assert all(r.score == pytest.approx(score[r.vec_id], abs=1e-12) for r in own if r.vec_id in score)
    assert hits >= 0.9 * 20 * len(got)


def test_neighbours_of_unequal_lengths_in_several_passes(llm, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 40)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.1, 5)).tolist()) for i in range(600)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, hits, n = _brute(rows, 10), 0, 0
    for r in ann.nearest(df, df.where("vec_id % 5 = 0"), 10).collect():
        n += 1
        hits += r.vec_id in {i for _, i in want[r.query_id]}
    assert n == 1200 and hits >= 0.9 * n


def test_neighbours_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0]) for i in (20, 3, 5, 40)] + [(1, [1.0, 2.0, 3.5]), (0, [0.5, 0.0, 0.0]), (2, None), (4, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 1.0]), (7, [inf, 1.0, 1.0]),
                                                            (8, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (9, []), (5, [1.0, 2.0, 3.0])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash")).withColumn("id", F.lit("clash"))
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got[20] == [(1, 15.5), (3, 14.0), (5, 14.0), (40, 14.0), (0, 0.5)]
    assert [i for i, _ in got[40]] == [1, 3, 5, 20, 0] and set(got) == {0, 20, 40}
    assert ann.nearest(df.where("1 = 0"), df, 20).count() == 0
    assert ann.nearest(df, df.where("1 = 0"), 20).count() == 0
