"""Mirror scans and the audit of a match."""

from tanimart.operators import clean, match
from tanimart.sources import sinks, tables


def test_mirror_blank_and_null_both_become_null(spark, scratch):
    src = spark.createDataFrame([(4, "X4", "ibuprofen"), (5, "X5", None), (6, "X6", ""), (7, "X7", " ")],
                                "mol_key int, mol_id string, pref_name string")
    out = tables.blank_strings_to_null(src)
    assert sinks.replace(out, f"{scratch}/bronze") == 4
    got = sorted(tuple(r) for r in sinks.read_current(spark, f"{scratch}/bronze").collect())
    assert got == [(4, "X4", "ibuprofen"), (5, "X5", None), (6, "X6", None), (7, "X7", " ")]


def test_mirror_of_empty_table(spark, scratch):
    empty = spark.createDataFrame([], "id int")
    assert sinks.replace(tables.blank_strings_to_null(empty), f"{scratch}/empty") == 0
    assert sinks.read_current(spark, f"{scratch}/empty").count() == 0


def test_audit_counts(spark):
    names = [None, "", "  "] + [f"strange {i}" for i in range(4)] + ["Known A"] * 6 + ["known b "] * 2
    raw = spark.createDataFrame([(str(i), n, None, None, None, None, None, "batch_01.csv") for i, n in enumerate(names)],
                                "compound_id string, compound_name string, molecular_weight string, "
                                "logp string, ic50_nm string, assay_date string, lab_id string, _source_file string")
    dictionary = spark.createDataFrame([("KNOWN A", 1), ("known a", 2), ("known A", 3), ("Known B", 4)], "name string, matched_id bigint")
    overrides = match.overrides_frame(spark, {})
    matched = match.match_names(clean.typed_input(raw), dictionary, overrides)
    audit = match.match_audit(raw, dictionary, overrides).first().asDict()
    assert audit == {"total_rows": 15, "kept_rows": 12, "dropped_rows": 3,
                     "output_rows": 24, "unmatched_rows": 4, "fanout_rows": 12}
    assert matched.count() == 24
