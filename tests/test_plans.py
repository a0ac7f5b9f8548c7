"""What the physical plans must look like for large tables."""

import pytest

import __spark_entry__ as entry
from siltbed.operators.checks import plan_text

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(spark, name, mode="formatted"):
    return plan_text(QUERIES[name](spark, SF_DIR), mode)


@pytest.mark.parametrize(
    "name, pushed, columns",
    [
        ("filter_negative", "LessThan(c_acctbal,0.0)", "struct<c_custkey:bigint,c_acctbal:double>"),
        ("eda_first_transfer", "PushedFilters", "struct<l_shipdate:timestamp_ntz>"),
        ("gold_stats", "PushedFilters", "struct<user_id:bigint,value:double>"),
        ("eda_top_tokens", "PushedFilters", "struct<l_partkey:bigint>"),
        ("filter_params", "EqualTo(o_custkey,7)", "struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>"),
    ],
)
def test_scans_are_narrow(spark, name, pushed, columns):
    text = plan(spark, name)
    assert columns in text
    if pushed != "PushedFilters":
        assert pushed in text


@pytest.mark.parametrize(
    "name",
    ["interpolate_neighbors", "gold_stats", "eda_balance_history", "read_as_of", "best_run",
     "missing_report", "df_equal", "merge_update", "merge_insert_new", "flagship_gold", "rec_interactions", "join_broadcast"],
)
def test_no_single_task_and_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_recommendations_join_on_real_keys(spark):
    from siltbed.chain import recommend
    from siltbed.plans.tokens import WALLET, id_pairs

    ids = id_pairs(spark, SF_DIR)
    model = recommend.fit_als(ids.select("wallet_id", "token_id", "n_transfers"), rank=2, max_iter=1)
    for df in (recommend.recommend_als(model, ids, WALLET, 10), recommend.recall_at_k(model, ids, ids)):
        text = plan_text(df, "formatted")
        assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_filter_stays_above_the_window(spark):
    """Broken rows are chosen after their neighbours are known."""
    text = plan(spark, "interpolate_neighbors", "simple")
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "< 0" not in scan and "LessThan" not in scan


def test_neighbours_take_one_sort(spark):
    text = plan(spark, "interpolate_neighbors", "simple")
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and text.count("Window ") == 1


def test_top_k_is_not_a_full_sort(spark):
    for name in ("sort_limit", "eda_top_tokens", "top_k_by_metric"):
        assert "TakeOrderedAndProject" in plan(spark, name)
    assert "WindowGroupLimit" in plan(spark, "rec_eval")
