"""Plan shape: pruning, pushdown, partial limits, bounded broadcasts."""

import pytest

import __spark_entry__ as E
from tanimart.plans.queries import REGISTRY as QUERIES

from .conftest import SF_SMALL


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_projected_columns(spark):
    plan = E.queries()["scan_project"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_flagship_limits_before_shuffle_and_joins_on_bands(spark):
    df = E.queries()["flagship_topk"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fingerprints_need_no_exchange(spark):
    plan = executed(E.queries()["fingerprint_bits"](spark, SF_SMALL))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_override_map_is_broadcast(spark):
    plan = executed(E.queries()["name_match"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_log_latest_is_partial_aggregate(spark):
    plan = E.queries()["load_log_latest"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


@pytest.mark.parametrize("name", ["source_lookup", "fingerprint_bits", "fingerprint_roundtrip", "fingerprint_base64"])
def test_a_text_is_hashed_once(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1


@pytest.mark.parametrize("name", ["source_lookup", "source_missing", "sample_sources"])
def test_ids_cut_the_catalogue_before_texts_are_read(spark, name):
    lines = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    reads = [i for i, line in enumerate(lines) if "split(lower(text" in line]
    joins = [i for i, line in enumerate(lines) if "Join LeftSemi" in line]
    assert reads and joins
    for i in reads:
        below = next(k for k in joins if k > i)
        assert depth(lines[below]) > depth(lines[i])
        assert not any("split(lower(text" in line for line in lines[below:] if depth(line) > depth(lines[below]) and line not in [lines[r] for r in reads])


def test_override_map_needs_no_shuffle_of_the_input(spark):
    plan = QUERIES["name_match"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()  # before anything ran
    at = plan.index("BroadcastHashJoin [_ov_key")
    assert "LocalTableScan" in plan[at:] and "Exchange hashpartitioning(_ov_key" not in plan


@pytest.mark.parametrize("name", ["flagship_topk", "matched_topk", "similarity_all_pairs"])
def test_no_lambda_per_pair(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "zip_with" not in plan and "bit_count" not in plan
