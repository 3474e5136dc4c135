"""Every registered query with SQL, on whole tables, in both engines."""

import pytest
from compare import check
from conftest import SMALL

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


# Whole jobs that fit several models or feature tables: up to a minute each. They run with `-m slow`.
SLOW = {"audit_job", "cv_job", "model_pool", "param_search", "predict_job", "rfe", "saved_learners", "stack", "stack_importance", "voting_hard", "voting_soft",
        "voting_labels", "stack_labels", "learner_labels", "text_labels", "pipelines_saved"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_agrees(spark, duck, name):
    problem, _ = check(spark, duck, QUERIES[name], ORACLES[name], SMALL)
    assert problem is None, problem


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(SLOW & set(ORACLES)))
def test_slow_ones_agree(spark, duck, name):
    problem, _ = check(spark, duck, QUERIES[name], ORACLES[name], SMALL)
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() == 6000


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
