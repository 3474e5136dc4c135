"""Plan shapes: no row-wise Python, no Cartesian product, broadcast only of fitted state."""

import pytest
from conftest import SMALL

import __spark_entry__ as entry

QUERIES = entry.queries()
# numpy inside tasks: pair moments and nearest neighbours
ARROW = {"correlation_matrix", "target_correlation", "redundant_pairs", "redundant_columns", "rank_auc",
         "nearest_vectors", "knn_classify", "knn_classify_distance", "knn_impute", "knn_impute_distance"}
PLAIN = ["listing", "derived_ratio", "derived_interaction", "missing_profile", "cardinality", "numeric_describe", "median_impute",
         "frequency_encode", "target_encode", "one_hot", "group_zscore", "standard_scale", "stratified_split", "class_weights",
         "confusion_matrix", "classification_report", "vote_soft", "anova_f", *sorted(ARROW)]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_rows_and_no_products(spark, name):
    plan = physical(QUERIES[name](spark, SMALL))
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in ARROW:
        assert "Python" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("name", ["median_impute", "standard_scale", "one_hot", "outlier_clip"])
def test_column_state_needs_no_join_beyond_the_source(spark, name):
    assert physical(QUERIES[name](spark, SMALL)).count("Join") == physical(QUERIES["listing"](spark, SMALL)).count("Join")


def test_split_does_not_shuffle_the_table(spark):
    source, split = physical(QUERIES["to_category"](spark, SMALL)), physical(QUERIES["stratified_split"](spark, SMALL))
    assert split.count("Exchange hashpartitioning") <= source.count("Exchange hashpartitioning")
    assert "Window" not in split


def test_unused_columns_are_not_read(spark):
    plan = physical(QUERIES["missing_flag"](spark, SMALL))
    assert "l_extendedprice" not in plan and "o_orderpriority" not in plan
