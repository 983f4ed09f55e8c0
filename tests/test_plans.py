"""What the physical plans must and must not hold."""

import re

import pytest

from sluice.operators import joins
from sluice.plans import catalogue

# Queries that neither train a model nor write anything before they return.
LAZY = ("drop_columns", "drop_columns_lenient", "select_distinct", "rename_columns",
        "typed_columns", "null_row_filter", "funnel_join_pair", "funnel_join_chain",
        "funnel_join_heavy_keys", "join_size", "table_shape", "drop_duplicates",
        "duplicate_audit", "group_count", "funnel_effectiveness", "label_binarize",
        "split_three_way", "weighted_f1", "threshold_sweep", "column_profile_estimated",
        "column_profile")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", LAZY)
def test_no_products_and_no_python(spark, small, name):
    text = plan(catalogue.QUERIES[name](spark, small))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert bad not in text


def test_chain_shuffles_each_table_once(spark, small, no_broadcast):
    parts = [catalogue.standins.crm(spark, small), catalogue.standins.marketing(spark, small),
             catalogue.standins.sales(spark, small)]
    text = plan(joins.join_on_key(parts, "Customer_ID", hot=joins.HotKeys()))
    assert text.count("SortMergeJoin") == 2
    assert text.count("Exchange hashpartitioning") == 3


def test_scans_are_pruned(spark, small):
    text = plan(catalogue.QUERIES["weighted_f1"](spark, small))
    orders = next(line for line in text.splitlines() if "orders.parquet" in line)
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>", orders)
    customer = next(line for line in text.splitlines() if "customer.parquet" in line)
    assert "c_name" not in customer and "c_mktsegment" not in customer


def test_one_split_filters_before_the_join(spark, small):
    train = catalogue._splits(catalogue.standins.leads(spark, small))[0]
    text = plan(train)
    assert text.index("Join") < text.index("md5")


@pytest.mark.parametrize("name", ["drop_duplicates", "duplicate_audit", "threshold_sweep"])
def test_rows_are_reduced_before_the_shuffle(spark, small, name):
    lines = plan(catalogue.QUERIES[name](spark, small)).splitlines()
    first = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert "HashAggregate" in lines[first + 1]
