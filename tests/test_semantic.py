from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from yearring.operators.semantic import semantic_query
from yearring.plans.semantic_views import VIEWS


@pytest.fixture
def archives(spark):
    users = spark.sql(
        """SELECT * FROM VALUES (1, 'ann', 'A', 'false', true, 1L), (2, 'ann', 'B', 'false', true, 2L), (3, 'bob', 'A', 'true', true, 3L),
           (4, 'bob', 'C', 'true', false, 4L) AS t(user_id, name, default_role, disabled, _is_current, _archive_id)"""
    )
    logins = spark.sql(
        """SELECT * FROM VALUES (1, 'ann', 'YES', true), (2, 'ann', 'NO', true), (3, 'bob', 'NO', true), (4, 'eve', 'NO', true),
           (5, 'ann', 'NO', false) AS t(event_id, user_name, is_success, _is_current)"""
    )
    tables = {"users": users, "login_history": logins}
    return tables.__getitem__


def test_a_doubled_parent_does_not_multiply_facts(archives):
    got = semantic_query(VIEWS["security_analytics"], archives, ["total_logins", "failed_logins"], ["default_role"])
    assert {r["default_role"]: (r["total_logins"], r["failed_logins"]) for r in got.collect()} == {
        "B": (2, 1),
        "A": (1, 1),
        None: (1, 1),
    }


def test_filter_order_and_limit(archives):
    got = semantic_query(
        VIEWS["security_analytics"],
        archives,
        ["total_logins"],
        {"who": "upper(login_user)"},
        filters=["login_success = 'NO'", "user_disabled = 'true' OR user_disabled IS NULL"],
        order_by=[F.desc("who")],
        limit=1,
    )
    assert [tuple(r) for r in got.collect()] == [("EVE", 1)]


def test_unreachable_names_are_refused(archives):
    view = VIEWS["governance_analytics"]
    with pytest.raises(ValueError, match="reached"):
        semantic_query(view, archives, ["total_users"], ["granted_role"])
    with pytest.raises(ValueError, match="no fact table"):
        semantic_query(view, archives, ["total_users"], [], filters=["granted_role = 'x'"])
    with pytest.raises(KeyError):
        semantic_query(view, archives, ["nothing"])


def test_model_is_complete():
    assert len(VIEWS) == 10 and sum(len(v.metrics) for v in VIEWS.values()) == 98
    for view in VIEWS.values():
        for metric in view.metrics:
            assert view.table(metric.table)
        for link in view.relationships:
            assert view.table(link.child) and view.table(link.parent)


def test_questions_without_a_metric(archives):
    got = semantic_query(VIEWS["security_analytics"], archives, [], ["login_user", "default_role"], order_by=["login_user"])
    assert [tuple(r) for r in got.collect()] == [("ann", "B"), ("bob", "A"), ("eve", None)]
    own = semantic_query(VIEWS["security_analytics"], archives, [], {"role": "default_role"}, filters=["user_disabled = 'true'"])
    assert [tuple(r) for r in own.collect()] == [("A",)]
    with pytest.raises(ValueError, match="needs"):
        semantic_query(VIEWS["security_analytics"], archives, [])
