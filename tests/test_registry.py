"""All registered queries: same rows as their SQL, and no plan that cannot scale."""

import re

import pytest

import __spark_entry__ as entry
from checks.base import ORACLE, QUERIES
from checks.compare import compare

SMALL = "/root/testdata/sf0.001"

#: A cross-section; ``python -m checks.compare <folder>`` runs every query.
SAMPLE = """
src_csv_lenient src_attach_target dim_decode rebuild_columns join_left_map agg_null_count agg_quantile_nearest
agg_mode agg_n_unique describe_numeric histogram30 profile_ordinal profile_categorical scale_type impute_knn
impute_remaining winsorize standardize encode_ordinal encode_onehot encode_frequency group_rare target_encode
corr_pearson_pairs corr_pearson_wide spearman_dup cramers_v fd_check missing_corr split_simple split_stratified
sample_n mi_rank feature_merge numeric_clean stage1 stage2 stage2_apply prep_report stream_apply
""".split()


def test_contract(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert all(re.match(r"op\d+_", n) or n == "pipeline" for n in set(entry.queries()) - set(QUERIES))


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    status, rows, _, detail = compare(spark, SMALL, name, QUERIES[name], ORACLE.get(name))
    assert status in ("ok", "rows"), detail


@pytest.mark.parametrize("name", ["stage1", "stage2", "numeric_clean", "split_stratified", "encode_ordinal", "encode_frequency", "impute_knn", "spearman_dup"])
def test_plan_has_no_cross_join_and_no_single_task_sort(spark, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Exchange SinglePartition" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["encode_binary"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (\S+)", plan)
    assert schemas and not any("o_totalprice" in s or "c_acctbal" in s for s in schemas)
