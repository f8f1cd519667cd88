import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tanimart.llm import decontam, ngram_join, suffix_dedup
from tanimart.llm.components import components
from tanimart.llm.queries import op2_decontaminate_cgk, op6_suffix_dedup, op8_ngram_join

from ..helpers import plan_text

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.8)) % vocabulary}" for _ in range(n))


def edited(rng, text, share):
    words = text.split()
    for _ in range(int(len(words) * share)):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[at:at + (kind > 0)] = [f"new{rng.randrange(10 ** 6)}"] if kind < 2 else []
    return " ".join(words)


# --- benchmark decontamination

def _words(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def _least(item, words):
    row = [0] * (len(words) + 1)
    for k, w in enumerate(item, 1):
        new = [k]
        for j, x in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def _leaks(docs, items):
    out = {}
    for d, t in docs:
        for i, u in items:
            own = _words(u)
            if len(own) >= decontam.LEAST_WORDS:
                cost = _least(own, _words(t))
                if cost <= int(len(own) * decontam.MOST_EDITS + 1e-9):
                    out[d, i] = min(cost, out.get((d, i), cost))
    return out


def test_edited_items_are_found(llm):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randrange(13, 70))) for i in range(12)]
    docs = [(i, prose(rng, 150)) for i in range(30)]
    for i, (_, t) in enumerate(items * 8):
        docs.append((100 + i, prose(rng, 40) + " " + edited(rng, t, (i % 6) * 0.02) + " " + prose(rng, 30)))
    got = {(r.doc_id, r.item_id): r.edits for r in decontam.matches(llm.createDataFrame(docs, DOC), llm.createDataFrame(items, "item_id long, text string")).collect()}
    want = _leaks(docs, items)
    assert set(got) <= set(want)
    assert len(got) >= 0.97 * len(want)
    assert sum(got[k] == want[k] for k in got) >= 0.97 * len(got)


def test_table_leaks_match_brute_force(llm):
    docs = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    low = {(d, i) for d, t in docs for i, u in items if " ".join(_words(u)) in " ".join(_words(t))}
    got = {(r.doc_id, r.item_id): r.edits for r in op2_decontaminate_cgk(llm, SF).collect()}
    assert low and low <= set(got)
    text, item = dict(docs), dict(items)
    assert got == {k: _least(_words(item[k[1]]), _words(text[k[0]])) for k in got}


def test_decontamination_odd_rows(llm, odd_docs, no_docs, monkeypatch):
    item = " ".join(f"w{i * 7919 % 1009}" for i in range(100, 130))
    bench = llm.createDataFrame([(0, item), (1, None), (2, ""), (3, "two words"), (4, item)], "item_id long, text string").withColumn("edits", F.lit("clash"))
    want = {(d, i, 0) for d in (1, 2, 3) for i in (0, 4)}
    assert {tuple(r) for r in decontam.matches(odd_docs, bench).collect()} == want
    monkeypatch.setattr(decontam, "PASS_BYTES", 100)
    assert {tuple(r) for r in decontam.matches(odd_docs, bench).collect()} == want
    kept = decontam.clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert decontam.matches(no_docs, bench).count() == decontam.clean(no_docs, bench).count() == 0
    assert decontam.matches(odd_docs, bench.where("1 = 0")).count() == 0
    assert decontam.clean(odd_docs, bench.where("1 = 0")).count() == odd_docs.count()


def test_short_items_and_unspaced_scripts_are_found(llm):
    """Items of one to four words, and items without spaces, as verbatim copies and edited."""
    chinese = "今天天气很好我们一起去公园散步然后回家吃饭看电视"
    thai = "ภาษาไทยไม่มีช่องว่างระหว่างคำ"
    hindi = "हिन्दी में शब्दों के बीच स्थान होता है"
    items = [(0, "Yes"), (1, "blue whale"), (2, "the blue whale"), (3, "the big blue whale"), (4, chinese), (5, thai), (6, hindi), (7, "はい"), (8, "whale"), (9, "été — Über"), (10, " ́?!"), (11, "Blue, WHALE!")]
    docs = [(0, "a yes b"), (1, "yesterday"), (2, "see the big blue whale swim"), (3, "the blue"), (4, "whale"), (5, f"前文前文{chinese}后文，abc"), (6, f"我说{chinese[:10]}在{chinese[11:]}了"),
            (7, chinese[:8]), (8, f"ก่อน{thai}หลัง"), (9, f"x {hindi} y"), (10, "abcはいdef"), (11, "un été über"), (12, "́?! blue"), (13, "whale blue"), (14, None), (15, "in the blue whale")]
    want = {(0, 0, 0), (2, 1, 0), (2, 3, 0), (2, 8, 0), (2, 11, 0), (4, 8, 0), (5, 4, 0), (6, 4, 1), (8, 5, 0), (9, 6, 0), (10, 7, 0), (11, 9, 0), (13, 8, 0), (15, 1, 0), (15, 2, 0), (15, 8, 0), (15, 11, 0)}
    docs, items = llm.createDataFrame(docs, DOC).coalesce(1), llm.createDataFrame(items, "item_id long, text string")
    assert {tuple(r) for r in decontam.matches(docs, items).collect()} == want
    assert {r.doc_id for r in decontam.clean(docs, items).collect()} == {1, 3, 7, 12, 14}


def test_words_by_unicode_class():
    """Marks go on with a word, letters of unspaced scripts stand alone, rows are cut apart."""
    import numpy as np

    def cut(*rows):
        data = [r.encode() for r in rows]
        off = np.cumsum([0, *map(len, data)])
        whole = b"".join(data)
        start, end, first = decontam.spans(np.frombuffer(whole, np.uint8), off)
        return [[whole[a:b].decode() for a, b in zip(start[i:j], end[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]

    assert cut("abc", "", "d_e f9") == [["abc"], [], ["d", "e", "f9"]]
    assert cut("été—ét", "́x", "中文ab中", "ก่อa", "", "한국어 말", "𠀀x½") == [["été", "ét"], ["x"], ["中", "文", "ab", "中"], ["ก่", "อ", "a"], [], ["한국어", "말"], ["𠀀", "x½"]]


# --- n-gram Jaccard join

def _shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def _linked(rows, k, num, den):
    sets = [(d, _shingles(t, k)) for d, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return collections.Counter((d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(sets))


def _near_copies(rng):
    rows = []
    for base in range(6):
        text = prose(rng, rng.randrange(20, 160))
        rows += [(len(rows) + 1000 * k, edited(rng, text, k * 0.008)) for k in range(12)]
    rows += [(9000 + i, prose(rng, rng.randrange(1, 90))) for i in range(60)] + [(9900, rows[0][1]), (9901, rows[0][1].upper())]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,num,leaf,block", [(3, 90, 48, 1024), (5, 80, 4, 7), (1, 60, 3, 5)])
def test_components_match_brute_force(llm, monkeypatch, k, num, leaf, block):
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = _near_copies(random.Random(num))
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(llm.createDataFrame(rows, DOC), k, num, 100).collect())
    assert got == _linked(rows, k, num, 100)


def test_tree_bounds_lose_no_pair():
    """Every pair above the threshold survives the dual traversal; sizes over several bitmap widths."""
    import numpy as np

    rng = np.random.default_rng(2)
    sets = []
    for n in (20, 120, 130, 140, 500, 520, 1100):
        base = rng.integers(1, 1 << 62, n, dtype=np.uint64)
        sets += [np.unique(np.where(rng.random(n) < 0.02 * k, rng.integers(1, 1 << 62, n, dtype=np.uint64), base)) for k in range(8)]
    size = np.array([len(s) for s in sets])
    group = ngram_join.Group(size, np.zeros(len(sets), int), np.arange(len(sets)), None, [np.frombuffer(ngram_join.bitmap(s), np.uint64) for s in sets], 80, 100)
    old, ngram_join.LEAF = ngram_join.LEAF, 3
    try:
        found = {(min(i, j), max(i, j)) for i, j, _ in group.pairs()}
    finally:
        ngram_join.LEAF = old
    want = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert want and want <= found
    assert len(found) < 0.3 * len(sets) ** 2 / 2


def test_prefix_rows_are_spread_once(llm, monkeypatch):
    """Tokens are judged in the shuffle that brings their classes together; the
    rows moved a second time to be joined with the tokens that are shared."""
    plans, save = [], ngram_join.save
    monkeypatch.setattr(ngram_join, "save", lambda df, name: plans.append(plan_text(df)) or save(df, name))
    # 7 and 8 share their classes, 9 has one, 10's classes differ too much in size, 11 has three
    prefixes = {1: (20, [7, 8, 11]), 2: (20, [7, 8, 9]), 3: (40, [10, 11]), 4: (20, [10]), 5: (20, [11])}
    classes = llm.createDataFrame([(c, n, p) for c, (n, p) in prefixes.items()], "cls long, n long, prefix array<long>")
    routes = ngram_join._routes(classes, 90, 100)
    plans.append(plan_text(routes))
    assert {tuple(r) for r in routes.collect()} == {(7, 0, -1, 1, 20, 0), (7, 0, -1, 2, 20, 0), (11, 0, -1, 1, 20, 2), (11, 0, -1, 3, 40, 1), (11, 0, -1, 5, 20, 0)}
    assert sum(p.count("Generate posexplode") for p in plans) == 1


def test_join_odd_rows(llm, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(odd_docs, 3, 90, 100).collect())
    assert got == _linked(rows, 3, 90, 100)
    assert ngram_join.join(no_docs).count() == ngram_join.one_of_each(no_docs).count() == 0
    kept = ngram_join.one_of_each(odd_docs, 5, 80, 100)
    assert kept.columns == odd_docs.columns
    # 2, 3 are near 1; 8 equals 7; 12 equals 11; one of the two rows 10 stays
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 4, 5, 6, 7, 9, 10, 11, 13]


def _near(rng, n):
    """A text and two near copies that are near each other only through it."""
    words = [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    return " ".join(words), " ".join([*words[:-4], "a1", "b1", "c1", "d1"]), " ".join(["a2", "b2", "c2", "d2", *words[4:]])


def test_null_id_near_copy_bridges_two_documents(llm):
    bridge, one, two = _near(random.Random(21), 60)
    rows = [(1, one), (2, two), (None, bridge), (4, "something else entirely here"), (None, "one more with no id")]
    assert (2, 58, 1) in _linked(rows, 3, 85, 100) and (2, 58, 2) in _linked(rows[:2], 3, 85, 100)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(llm.createDataFrame(rows, DOC), 3, 85, 100).collect())
    assert got == _linked(rows, 3, 85, 100)


def test_one_of_each_tells_rows_that_share_an_id_apart(llm):
    rng = random.Random(22)
    (a, a1, a2), (b, b1, _), (c, c1, _), (d, d1, _) = (_near(rng, 80) for _ in range(4))
    alone, free = _near(rng, 50)[0], _near(rng, 50)[0]
    rows = [(1, a), (7, a1), (7, alone), (8, b), (8, b1), (None, a2), (None, c), (None, c1), (None, free), (9, d), (None, d1), (10, free), (11, ""), (11, None), (None, ""),
            (12, d), (12, "last one of all texts in here")]
    kept = collections.Counter((r.doc_id, r.text) for r in ngram_join.one_of_each(llm.createDataFrame(rows, DOC), 3, 80, 100).collect())
    sure = [(1, a), (7, alone), (9, d), (10, free), (11, ""), (11, None), (None, ""), (12, "last one of all texts in here")]
    assert all(kept[r] == 1 for r in sure)
    rest = kept - collections.Counter(sure)
    assert sorted(rest.values()) == [1, 1] and {i for i, _ in rest} == {8, None} and {t for _, t in rest} & {b, b1} and {t for _, t in rest} & {c, c1}
    twice = llm.createDataFrame([(None, a)] * 3 + [(5, b)] * 2 + [(5, b1)], DOC)
    assert sorted((r.doc_id or 0) for r in ngram_join.one_of_each(twice, 3, 80, 100).collect()) == [0, 5]


def test_join_query(llm):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").collect()]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in op8_ngram_join(llm, SF).collect())
    assert got == _linked(rows, 3, 90, 100)


def test_star_contraction(llm):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)] + [(7, 7), (300, 300), (41, None)]
    root = {n: n for e in edges for n in e if None not in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    df = llm.createDataFrame(edges * 2, "a long, b long")
    assert {r.node: r.component for r in components(df, "a", "b").collect()} == {n: find(n) for n in root}
    assert components(df.where("1 = 0"), "a", "b").count() == 0


# --- suffix deduplication

def _deduplicated(rows, length):
    """Whole windows in a set, in the order (id, equal texts together)."""
    seen, out = set(), collections.Counter()
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\x01" * length
            seen.add(w)
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def _got(df):
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("hot,symbols,slice_bytes", [(20_000, 1 << 19, 1 << 18), (2, 2000, 1 << 18), (6, 2000, 900)])
def test_removed_spans_match_brute_force(llm, monkeypatch, hot, symbols, slice_bytes):
    monkeypatch.setattr(suffix_dedup, "SLICE", slice_bytes)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "MERGE_SYMBOLS", symbols)
    rng = random.Random(8)
    passages = [prose(rng, n) for n in (20, 30, 60)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(5, 60))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), prose(rng, rng.randrange(1, 20))]
        rows.append((i, " ".join(parts)))
    rows += [(70, "ab" * 400), (71, "x" * 350), (72, rows[5][1] + "é" * 90), (73, rows[5][1]), (74, ("abcdefg" * 30)[:99]), (75, ("abcdefg" * 30)[:110]), (76, prose(rng, 40) * 3)]
    assert _got(suffix_dedup.deduplicate(llm.createDataFrame(rows, DOC).repartition(3))) == _deduplicated(rows, 100)


@pytest.mark.parametrize("width", [2, 4])
def test_merged_transforms_order_all_suffixes(width):
    """Ends first, then by symbols; blocks are equal first symbols."""
    rng = random.Random(1)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))).encode() for _ in range(21)]
    shards = [strings[k::3] for k in range(3)]
    table = suffix_dedup.alphabet(strings)[1] if width == 4 else None
    parts = [suffix_dedup.transform(s, width, table) for s in shards]
    symbols = lambda s: tuple(s[i:i + width] for i in range(0, len(s) // width * width, width))
    for depth in (1, 3, 40):
        z, block = suffix_dedup.interleave(parts, depth, width)
        nth, texts = [0, 0, 0], []
        for k in z.tolist():
            _, owner, at = parts[k]
            texts.append(shards[k][owner[nth[k]]][at[nth[k]]:])
            nth[k] += 1
        ends = sum(len(t) < width for t in texts)
        assert all(len(t) < width for t in texts[:ends]) and ends == sum(min(width, len(s) + 1) for s in strings)
        if depth == 40:
            assert [symbols(t) for t in texts] == sorted(symbols(t) for t in texts)
            assert len(set(block.tolist())) == len(block)
        for i in range(ends + 1, len(texts)):
            if min(len(texts[i]), len(texts[i - 1])) >= width * depth:
                assert (block[i] == block[i - 1]) == (texts[i][:width * depth] == texts[i - 1][:width * depth])


def test_many_symbols_fall_back_to_pairs():
    rng = random.Random(3)
    noise = [rng.randbytes(120) for _ in range(700)]
    assert suffix_dedup.alphabet(noise)[0] == 2 and suffix_dedup.alphabet(noise[:5])[0] == 4
    strings = [*noise, noise[3][10:] + noise[4][:10]]
    masks = suffix_dedup.repeats(strings, [(i, 0, 0) for i in range(701)], [21] * 700 + [21], 100)
    assert not any(m.any() for m in masks[:700]) and masks[700].tolist() == [True] * 11 + [False] * 10


def _brute(strings, windows, length):
    seen, out = set(), []
    for s, n in zip(strings, windows, strict=True):
        out.append([s[p:p + length] in seen or seen.add(s[p:p + length]) or False for p in range(n)])
    return out


@pytest.mark.parametrize("length,depths", [(100, [5]), (60, [3]), (44, [11])])
def test_merge_takes_few_steps(monkeypatch, length, depths):
    """A step per symbol of twenty bytes; of four where the length is no multiple."""
    steps, plain = [], suffix_dedup.interleave
    monkeypatch.setattr(suffix_dedup, "interleave", lambda parts, depth, width: steps.append(depth) or plain(parts, depth, width))
    rng = random.Random(5)
    base = [bytes(rng.choice(b"abcd") for _ in range(160)) for _ in range(5)]
    strings = [rng.choice(base)[:rng.randrange(length, 130)] + rng.choice(base)[:rng.randrange(length, 130)] for _ in range(60)] + [b"ab" * 120, b"x" * 200]
    windows = [len(s) - length + 1 for s in strings]
    masks = suffix_dedup.repeats(strings, [(i, 0, 0) for i in range(len(strings))], windows, length)
    assert [m.tolist() for m in masks] == _brute(strings, windows, length) and steps == depths


def test_symbols_that_share_a_hash_are_not_one(monkeypatch):
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"ab") for _ in range(140)) for _ in range(30)]
    strings.append(strings[4][20:] + strings[7][:20])
    assert suffix_dedup.wide(strings, 20) is not None
    monkeypatch.setattr(suffix_dedup.tk, "BYTE", suffix_dedup.tk.BYTE * 0)
    assert suffix_dedup.wide(strings, 20) is None
    masks = suffix_dedup.repeats(strings, [(i, 0, 0) for i in range(31)], [41] * 31, 100)
    assert [m.tolist() for m in masks] == _brute(strings, [41] * 31, 100)


def test_only_stretches_that_can_repeat_are_merged():
    """No window that another string of the group holds is left out; strings
    that share no more than their minimizer are."""
    rng = random.Random(7)
    noise = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    gram, before, after = noise(32), noise(70), noise(70)
    strings = []
    for _ in range(150):
        left, right = rng.randrange(69), rng.randrange(69)
        own = [rng.randrange(left + 1), rng.randrange(right + 1)]  # bytes of the context that are the same
        s = noise(left - own[0]) + before[70 - own[0]:] + gram + after[:own[1]] + noise(right - own[1])
        if len(s) >= 100:
            strings.append(s)
    strings.append(before[2:] + gram + after[:68])
    windows = [len(s) - 99 for s in strings]
    group = suffix_dedup.grams(suffix_dedup.np.frombuffer(gram, dtype="uint8"))[1]
    groups = suffix_dedup.np.repeat(group, len(strings))
    first, count = suffix_dedup.stretches(strings, groups, suffix_dedup.np.array(windows), 100)
    times = collections.Counter(w for s in strings for w in {s[p:p + 100] for p in range(len(s) - 99)})
    shared = [[p for p in range(n) if times[s[p:p + 100]] > 1] for s, n in zip(strings, windows, strict=True)]
    assert sum(map(len, shared)) > 100
    for own, f, n, w in zip(shared, first.tolist(), count.tolist(), windows, strict=True):
        assert 0 <= f <= f + n <= w and all(f <= p < f + n for p in own)
    assert sum(not n for n in count.tolist()) > len(strings) // 4
    alone = [noise(68) + gram + noise(68) for _ in range(50)]
    assert not suffix_dedup.stretches(alone, groups[:50], suffix_dedup.np.repeat(69, 50), 100)[1].any()
    # a minimizer held twice: the group stays whole
    strings[0] = gram + noise(10) + gram + noise(60)
    assert suffix_dedup.stretches(strings, groups, suffix_dedup.np.array([35, *windows[1:]]), 100)[1].tolist() == [35, *windows[1:]]


@pytest.mark.parametrize("hot,times", [(20_000, 2), (2, 0)])
def test_many_copies_do_not_move_the_texts(llm, monkeypatch, hot, times):
    """Beyond the broadcast bound the looks at all texts have no join, with
    more copies than other rows or less."""
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    looks, live = [], suffix_dedup._live
    monkeypatch.setattr(suffix_dedup, "_live", lambda texts, length: looks.append(plan_text(texts)) or live(texts, length))
    rng = random.Random(12)
    passage = prose(rng, 40)
    rows = [(i, prose(rng, 15) + " " + passage + " " + prose(rng, 15)) for i in range(1, 8)]
    rows += [(i + 20, t) for i, t in rows] * times + [(i + 40, t) for i, t in rows] * times + [(None, rows[2][1]), (0, rows[6][1]), (9, prose(rng, 60)), (10, rows[0][1][30:])]
    assert _got(suffix_dedup.deduplicate(llm.createDataFrame(rows, DOC).repartition(3))) == _deduplicated(rows, 100)
    assert looks and "Join" not in looks[0] and "Exchange hashpartitioning" not in looks[0]


def test_suffix_odd_rows(llm, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert _got(suffix_dedup.deduplicate(odd_docs)) == _deduplicated(rows, 100)
    twice = odd_docs.union(odd_docs)
    assert _got(suffix_dedup.deduplicate(twice)) == _deduplicated(rows * 2, 100)
    assert suffix_dedup.deduplicate(no_docs).count() == 0


@pytest.mark.parametrize("same", [None, 7])
def test_copies_under_a_shared_id_take_no_other_row_along(llm, same):
    """A copy of row 3 under an id (or none) that another text shares."""
    rng = random.Random(11)
    passage, whole = prose(rng, 40), prose(rng, 80)
    other = prose(rng, 20) + " " + passage
    rows = [(1, prose(rng, 30) + " " + passage), (3, whole), (same, whole), (same, other), (9, prose(rng, 10) + " " + other)]
    assert _got(suffix_dedup.deduplicate(llm.createDataFrame(rows, DOC))) == _deduplicated(rows, 100)


def test_suffix_query(llm):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").collect()]
    assert _got(op6_suffix_dedup(llm, SF)) == _deduplicated(rows, 100)
