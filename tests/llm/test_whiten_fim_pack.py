import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tanimart.llm import fim, packing, whitening
from tanimart.llm.queries import op11_whiten_cholesky_qr, op12_fim_wavelet, op13_pack_best_fit

SF = "/root/testdata/sf0.001"


# --- whitening ---------------------------------------------------------------

def _plain(rows, k):
    """Brute force: {id: (deviation, whitened up to sign)} and the shares."""
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in fit]) / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    out = {}
    for i, row in x.items():
        y = [n * c - s for c, s in zip(row, sums, strict=True)]
        out[i] = (sum(c * c for c in y), np.array(y) / n @ v / np.sqrt(e))
    return n, out, e / np.trace(cov)


def _agree(got, rows, k):
    n, want, share = _plain(rows, k)
    byid = collections.defaultdict(dict)
    for r in got:
        byid[r.vec_id][r.component] = r
    assert set(byid) == set(want)
    sign = None
    for i, parts in byid.items():
        assert sorted(parts) == list(range(1, k + 1))
        dev, white = want[i]
        mine = np.array([parts[c].whitened for c in range(1, k + 1)])
        if sign is None and np.abs(white).min() > 1e-3:
            sign = np.sign(mine * white)
    for i, parts in byid.items():
        dev, white = want[i]
        mine = np.array([parts[c].whitened for c in range(1, k + 1)])
        assert np.abs(mine * sign - white).max() < 1e-7
        for c, r in parts.items():
            assert (r.n, int(r.deviation)) == (n, dev)
            assert r.explained == pytest.approx(share[c - 1], rel=1e-9)
            assert r.identity_error < 1e-9


def test_whitening_query_matches_plain_eigenvectors(llm):
    rows = [(r.vec_id, r.embedding) for r in llm.read.parquet(f"{SF}/embeddings.parquet").collect()]
    _agree(op11_whiten_cholesky_qr(llm, SF).collect(), rows, 16)


def test_whitening_of_badly_scaled_rows_and_copies(llm):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 6)) * [1e6, 3e4, 1e3, 30, 1.0, 0.2]
    base[:, 3] += base[:, 0]  # far from the axes
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[0].tolist()) for i in range(500)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    got = whitening.whiten(df, 4).collect()
    assert {r.n for r in got} == {400}
    model = whitening.fit(df, components=6)
    x = np.array([[math.floor(64 * c) for c in v] for v in base], dtype=np.float64)
    s = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    assert model.eigenvalues == pytest.approx(s ** 2 / 400, rel=1e-6)  # the Gram matrix would lose the last ones
    assert model.identity_error < 1e-6


def test_whitening_without_full_rank_and_exact_large_deviation(llm):
    rng = np.random.default_rng(6)
    a = rng.integers(-40, 40, size=(60, 3)) * 1.0
    wide = np.column_stack([a, a[:, 0] + a[:, 1], np.full(60, 7.0), np.arange(60) * 2.0 ** 30])
    df = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(wide)], "vec_id long, embedding array<double>")
    got = whitening.whiten(df, 16).collect()
    assert max(r.component for r in got) == 4  # six dimensions, of which two add nothing
    x = [[math.floor(64 * c) for c in v] for v in wide.tolist()]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((60 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in got} == want and max(want.values()) > 1 << 63


def test_whitening_odd_rows(llm):
    kind = "vec_id long, embedding array<float>, n string, x string, component string"
    good = [[0.5, 0.25], [-0.5, 1.0], [0.1, -0.7], [0.1, -0.7]]
    bad = [None, [], [1.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [3e38, 0.0]]
    rows = [(i, v, "a", "b", "c") for i, v in enumerate(good + bad)] + [(None, [0.5, 0.25], None, None, None)]
    got = whitening.whiten(llm.createDataFrame(rows, kind)).collect()
    assert collections.Counter(r.vec_id for r in got) == {0: 2, 1: 2, 2: 2, 3: 2, None: 2}
    assert {r.n for r in got} == {3}
    assert whitening.whiten(llm.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(llm.createDataFrame(rows[:1] * 3, kind)).count() == 0  # no variance
    assert whitening.whiten(llm.createDataFrame(rows[4:6], kind)).count() == 0


# --- fill in the middle --------------------------------------------------------

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def _fim(doc, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc, n, "plain", None, None, text, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return (doc, n, form, len(pre), len(mid), out, text)


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple(str(x) for x in r))


def test_fim_query_matches_plain_cuts(llm):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(*r[:5], sha(r[5]), sha(r[6])) for r in (_fim(r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").collect())]
    got = [tuple(r) for r in op12_fim_wavelet(llm, SF).collect()]
    assert _sorted(got) == _sorted(want)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fim_odd_rows(llm, odd_docs, no_docs):
    out = fim.transform(odd_docs).withColumn("back", fim.restored("fim_text", "form"))
    assert _sorted(tuple(r) for r in out.collect()) == _sorted(_fim(r.doc_id, r.text) for r in odd_docs.collect())
    assert fim.transform(no_docs).count() == 0
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n\tü漢😀<PSM>'") for _ in range(rng.randrange(60))) for _ in range(600)]
    texts += [" ", "a", " a ", "x" * 100_000, "word " * 300_000, "<", "ends with <", "a<P", "<S", "漢 " * 9]
    df = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = fim.transform(df).withColumn("back", fim.restored("fim_text", "form"))
    assert _sorted(tuple(r) for r in out.collect()) == _sorted(_fim(i, t) for i, t in enumerate(texts))
    keep = fim.transform(df, percent=0).select("form").distinct().collect()
    assert [r.form for r in keep] == ["plain"]


def test_wavelet_ranks_equal_counts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        s = rng.integers(0, 5, n).astype(np.uint8)
        m, at = fim.WaveletMatrix(s, fim.CLASS_BITS), np.arange(n + 1)
        for c in range(5):
            assert m.rank(c, at).tolist() == [int((s[:i] == c).sum()) for i in at]


# --- packing -------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def _held(rows, capacity):
    """Every sequence is gapless and no longer than the capacity."""
    own = collections.defaultdict(list)
    for r in rows:
        own[r.sequence_id].append((r.offset, r.length))
    for places in own.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(own)


def test_packing_query_matches_the_tokenizer(llm, tokenizer):
    got = op13_pack_best_fit(llm, SF).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    total = 0
    docs = llm.read.parquet(f"{SF}/documents.parquet").collect()
    assert set(by) == {d.doc_id for d in docs}
    for d in docs:
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
        total += len(ids)
        at = 0
        for k, r in enumerate(sorted(by[d.doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (r.length == 1024 or k == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids) and len(by[d.doc_id]) == -(-len(ids) // 1024)
    n = _held(got, 1024)
    assert -(-total // 1024) <= n <= _best_fit(collections.Counter(r.length for r in got), 1024)


def test_stretches_change_no_ids(llm, tokenizer):
    rng = random.Random(11)
    letters = ["a", "B", "é", "ß", "Ж", "漢", "😀", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x85", "\xa0", " ", "　", " ", "'", "'s", "'ll", ".", "...", "_", "-", "1", "23", "²", "½", "\x00", "\x1c", "\x7f", "é", "<|endoftext|>", "the", " word", " end.\n", "größe", " Ünïcödé", " слово", "×", "ʰ", "ɐ"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(4000)] + ["", " ", "\n", "a\n", "\na", "a \n b", "don't 'tis \n'll"]
    part = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    ids, o = packing.encoded(part, off, tokenizer, tokenizer.model, {}, True)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(o[:-1], o[1:], strict=True)] == want


def test_packing_odd_rows_and_sequences(llm, odd_docs, no_docs, tokenizer):
    assert packing.pack(packing.pieces(no_docs)).count() == 0
    packed = packing.pack(packing.pieces(odd_docs.repartition(3), capacity=64), 64)
    rows = packed.collect()
    _held(rows, 64)
    text = collections.Counter(((r.doc_id, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]))) for r in odd_docs.collect())
    assert sum(r.length for r in rows) == sum(len(ids) * c for (_, ids), c in text.items())
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id].ids[4 * r.offset:4 * (r.offset + r.length)] == r.ids
        assert (r.offset, r.length, r.doc_id, r.piece) in [tuple(x) for x in whole[r.sequence_id].pieces]
    starts = collections.Counter(r.doc_id for r in rows if r.piece == 0)
    assert starts == collections.Counter(r.doc_id for r in odd_docs.collect())


def _best_fit(histogram, capacity):
    """Plain best fit decreasing, one piece at a time."""
    gaps = collections.Counter()
    n = 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            gap = next((g for g in range(length, capacity) if gaps[g]), None)
            if gap is None:
                n, gap = n + 1, capacity
            else:
                gaps[gap] -= 1
            gaps[gap - length] += 1
    return n


@pytest.mark.parametrize("seed", range(12))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 100, 1024])
    histogram = {rng.randrange(1, capacity + 1): rng.randrange(1, 40) for _ in range(rng.randrange(1, 80))}
    patterns = packing.plan(histogram, capacity)
    used = collections.Counter()
    for times, lengths in patterns:
        assert sum(lengths) <= capacity and times > 0
        for x in lengths:
            used[x] += times
    assert used == histogram
    n, least = sum(t for t, _ in patterns), -(-sum(k * v for k, v in histogram.items()) // capacity)
    assert least <= n <= max(_best_fit(histogram, capacity), least + 1)


def test_pair_index_stays_exact():
    rng = random.Random(4)
    counts = packing.Counts({x: rng.randrange(1, 4) for x in range(1, 30)}, 64)
    for _ in range(60):
        lengths = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 4))]
        if counts.times(lengths):
            counts.take(lengths, 1)
        held = (counts.n > 0).astype(int)
        assert counts.pairs.tolist() == np.convolve(held, held)[:65].tolist()


def test_hot_length_is_numbered_across_tasks(llm):
    docs = llm.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "one two three").otherwise(F.concat(F.lit("t "), F.col("id").cast("string"))).alias("text"))
    rows = packing.pack(packing.pieces(docs.repartition(9), capacity=32), 32).collect()
    assert len(rows) == 3000 and len({(r.sequence_id, r.offset) for r in rows}) == 3000
    assert _held(rows, 32) <= _best_fit(collections.Counter(r.length for r in rows), 32)
