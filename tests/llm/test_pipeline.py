import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
from tanimart.llm import quality
from tanimart.llm.common import save
from tanimart.llm.queries import QUALITY_LEAST, quality_model

from .test_text_joins import _leaks, _linked, _words

SF = "/root/testdata/sf0.001"


def test_every_stage_on_its_input(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    columns, held = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(llm, docs, SF), "stage")
        held.append([r.asDict() for r in docs.collect()])
        if name != "sharding":
            assert docs.columns == columns
    start = [r.asDict() for r in llm.read.parquet(f"{SF}/documents.parquet").collect()]
    good, single, clean, mixed, shards = held
    ids = lambda rows: {r["doc_id"] for r in rows}

    scores = {r.doc_id: r.score for r in quality.score(llm.read.parquet(f"{SF}/documents.parquet"), quality_model(llm, SF)).collect()}
    assert ids(good) == {d for d, s in scores.items() if s >= QUALITY_LEAST}
    label = {r.doc_id: r.quality for r in llm.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r["doc_id"] in ids(good) for r in start if label.get(r["doc_id"]) == 1)

    member = _linked([(r["doc_id"], r["text"]) for r in good], 5, 80, 100)
    assert ids(single) == {d for d, n, c in member if n == 0 or d == c}

    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    text = {r["doc_id"]: r["text"] for r in single}
    gone = ids(single) - ids(clean)
    assert {d for d, t in text.items() for _, u in items if " ".join(_words(u)) in " ".join(_words(t))} <= gone
    assert {d for d, _ in _leaks([(d, text[d]) for d in gone], items)} == gone

    assert ids(mixed) <= ids(clean) and 0.5 * len(clean) < len(mixed) < 1.6 * len(clean)
    assert {str(r) for r in mixed} <= {str(r) for r in clean}
    same = lambda rows: Counter(str([r[c] for c in columns]) for r in rows)
    assert same(shards) == same(mixed)
    assert {r["shard"] for r in shards} <= set(range(16))
    slots = Counter((r["shard"], r["slot"]) for r in shards)
    assert max(slots.values()) == 1


def test_run_is_all_stages(llm):
    rows = corpus_pipeline.run(llm, SF).count()
    assert rows == corpus_pipeline.run(llm, SF).count() > 0


def test_stages_take_odd_and_empty_tables(llm, odd_docs, no_docs):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(llm, docs, SF)
            assert set(out.columns) == set(docs.columns) | ({"shard", "slot"} if name == "sharding" else set())
            assert out.select(columns).count() <= 2 * docs.count()


def test_operators_do_not_hide_import_errors():
    root = Path(__file__).resolve().parents[2]
    for f in [*(root / "tanimart/llm").glob("*.py"), root / "corpus_pipeline.py"]:
        assert "ImportError" not in f.read_text() and "ModuleNotFoundError" not in f.read_text()


def test_the_rest_imports_without_the_subpackage():
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'tanimart.llm' or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 'flagship_topk' in names and 'pipeline' not in names and not any(n.startswith('op') for n in names), names\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], check=True)
