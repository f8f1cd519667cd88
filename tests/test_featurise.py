"""A caller's own featuriser and validator: state per task, failures counted."""

import pytest
from pyspark.sql import Observation

from tanimart.operators import featurise
from tanimart.operators import fingerprints as fpo
from tanimart.plans.queries import word_featuriser

TEXTS = ["one two", "two  ONE!", "", None, "boom here", "nothing", "ünï 42", "..."]


def _frame(spark):
    return spark.createDataFrame([(f"M{i}", t, i) for i, t in enumerate(TEXTS)], "mol_id string, text string, other int").repartition(3)


def _picky():
    calls = []  # built once per task

    def features(text):
        calls.append(text)
        if "boom" in text:
            raise ValueError(text)
        return None if text == "nothing" else [*text.lower().split(), None, ""]

    return features


def test_failed_rows_have_no_features_and_are_counted(spark):
    rows = {r.mol_id: r for r in featurise.featurised(_frame(spark), _picky).collect()}
    assert rows["M0"].features == ["one", "two", None, ""] and rows["M0"].other == 0
    assert [rows[f"M{i}"].features for i in (3, 4, 5)] == [None, None, None]
    failed = Observation("failed")
    got = featurise.fingerprints(_frame(spark), _picky, failed=failed)
    assert {r.mol_id: r.n_bits for r in got.collect()} == {"M0": 2, "M1": 2, "M6": 2, "M7": 1}
    assert failed.get == {"failed_rows": 4}


def test_own_words_give_the_built_in_fingerprints(spark):
    key = lambda df: sorted((r.mol_id, r.fp, r.n_bits) for r in df.collect())
    assert key(featurise.fingerprints(_frame(spark), word_featuriser)) == key(fpo.fingerprints(_frame(spark)))


def test_validator(spark):
    def make():
        return lambda text: len(text) / len(text.split()) > 2  # raises on empty texts

    rows = {r.mol_id: r.is_valid for r in featurise.validated(_frame(spark), make).collect()}
    assert rows == {"M0": True, "M1": True, "M2": False, "M3": False, "M4": True, "M5": True, "M6": True, "M7": True}


def test_a_factory_that_fails_fails_the_job(spark):
    def make():
        raise RuntimeError("no library")

    with pytest.raises(Exception, match="no library"):
        featurise.featurised(_frame(spark), make).collect()
