"""Every registered query against its SQL on the smallest tables, and what the plans may not contain."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no shared tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(name, QUERIES[name], ORACLES[name], spark, FOLDER, con) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert len(QUERIES[name](spark, FOLDER).collect()) > 0


@pytest.mark.parametrize(
    "name,order",
    [
        ("priority_sort", "CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 99 END, o_totalprice DESC, o_orderkey"),
        ("view_sort", "substr(o_orderpriority, 1, 1), o_totalprice, o_orderkey"),
    ],
)
def test_sorted_queries_come_in_order(spark, con, name, order):
    want = [r[0] for r in con.sql(f"SELECT o_orderkey FROM orders ORDER BY {order}").fetchall()]
    assert [r["o_orderkey"] for r in QUERIES[name](spark, FOLDER).collect()] == want


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["row_id", "subgenre", "score", "rank"] and df.count() > 0


FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "CollectLimit"]


@pytest.mark.parametrize("name", ["series_master", "genre_series", "merge_fill", "missing_members", "rank_list_tags", "local_series_match", "edit_candidates", "commercial_bands"])
def test_plans_have_no_cross_join(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]


def test_first_row_per_key_is_cut_before_the_shuffle(spark):
    plan = QUERIES["dedup_first"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["only_new"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_type,PROMO)" in plan and "p_retailprice" not in plan


@pytest.mark.parametrize("name,part", [("distinct_titles", "\\bbook"), ("nested_books", "from_json")])
def test_costly_steps_of_an_array_stand_once(spark, name, part):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(part) == 1
