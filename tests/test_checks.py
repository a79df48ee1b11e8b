import datetime as dt

import pytest
from pyspark.sql import functions as F

from seasonmart.operators import checks as ch
from seasonmart.operators.checks import Check
from seasonmart.plans import quality
from seasonmart.sources.sinks import Target
from tests.conftest import rows


@pytest.fixture
def child(spark):
    values = ["a", "a", "b", None, None, "x", "x", "x", "y"]
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k string, n int")


@pytest.fixture
def parent(spark):
    return spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")


def test_single_checks(child, parent):
    assert rows(ch.repeated_values(child, "k")) == [("a", 2), ("x", 3)]
    assert rows(ch.null_rows(child, "k")) == [(None, 3), (None, 4)]
    assert rows(ch.unexpected_values(child, "k", ["a", "b"])) == [("x", 3), ("y", 1)]
    assert rows(ch.orphans(child, "k", parent, "id")) == [("x", 3), ("y", 1)]


def test_many_checks_at_once(child, parent):
    declared = [
        Check("child", "k", ch.UNIQUE),
        Check("child", "k", ch.NOT_NULL),
        Check("child", "n", ch.NOT_NULL),
        Check("child", "k", ch.ACCEPTED_VALUES, values=("a", "x")),
        Check("child", "k", ch.RELATIONSHIPS, parent=("parent", "id")),
        Check("parent", "id", ch.UNIQUE),
        Check("parent", "id", ch.RELATIONSHIPS, parent=("child", "k")),
    ]
    models = {"child": child, "parent": parent}
    failures = ch.check_failures(models, declared)
    assert rows(failures) == [
        ("accepted_values_child_k", "b", 1), ("accepted_values_child_k", "y", 1),
        ("not_null_child_k", None, 2), ("relationships_child_k", "x", 3),
        ("relationships_child_k", "y", 1), ("unique_child_k", "a", 2),
        ("unique_child_k", "x", 3), ("unique_parent_id", "b", 2),
    ]
    summary = ch.check_summary(failures, declared)
    assert rows(summary, "check_name", "failures", "status") == [
        ("accepted_values_child_k", 2, "warn"), ("not_null_child_k", 2, "warn"),
        ("not_null_child_n", 0, "pass"), ("relationships_child_k", 4, "warn"),
        ("relationships_parent_id", 0, "pass"), ("unique_child_k", 2, "warn"),
        ("unique_parent_id", 1, "warn"),
    ]


def test_declared_checks():
    kinds = [c.kind for c in quality.DECLARED_CHECKS]
    assert len(kinds) == 47 and len({c.name for c in quality.DECLARED_CHECKS}) == 47
    assert [kinds.count(k) for k in (ch.UNIQUE, ch.NOT_NULL, ch.ACCEPTED_VALUES, ch.RELATIONSHIPS)] \
        == [3, 31, 6, 7]


@pytest.fixture(scope="module")
def sound(spark):
    """One row per model that violates nothing."""
    row = spark.range(1).select(
        *(F.lit("P1").alias(c) for c in ("player_id", "game_id", "full_name", "team_name")),
        F.lit("TEAM1").alias("team_id"), F.lit("Pitcher").alias("position"),
        F.lit("P").alias("position_abbreviation"), F.lit("National").alias("league"),
        F.lit("East").alias("division"), F.lit(2020).alias("year"), F.lit(1).alias("salary"),
        F.lit(1.0).alias("salary_millions"), F.lit(dt.date(2020, 1, 1)).alias("game_date"),
        F.lit(1).alias("quality_start"), F.lit(True).alias("is_pitcher"),
    )
    return {c.model: row for c in quality.DECLARED_CHECKS}


def test_sound_models_pass(sound):
    assert {r.status for r in quality.run_checks(sound).collect()} == {"pass"}


@pytest.mark.parametrize("check", quality.DECLARED_CHECKS, ids=lambda c: c.name)
def test_each_check_finds_a_planted_violation(sound, check):
    good = sound[check.model]
    kind = good.schema[check.column].dataType
    planted = {
        ch.UNIQUE: F.col(check.column),
        ch.NOT_NULL: F.lit(None),
        ch.ACCEPTED_VALUES: F.lit(None) if kind.typeName() == "boolean" else F.lit("7"),
        ch.RELATIONSHIPS: F.lit("nobody"),
    }[check.kind].cast(kind)
    models = {**sound, check.model: good.union(good.withColumn(check.column, planted))}
    found = {r.check_name: r.failures for r in quality.run_checks(models, [check]).collect()}
    # A boolean has no value outside the list, and null passes.
    expected = 0 if check.kind == ch.ACCEPTED_VALUES and kind.typeName() == "boolean" else 1
    assert found == {check.name: expected}


def test_failures_are_stored_and_do_not_stop_the_run(sound, spark):
    models = {**sound, "stg_teams": sound["stg_teams"].withColumn("league", F.lit("Minor"))}
    summary = quality.run_and_store_checks(models, Target("prod"))
    assert summary.where("status = 'warn'").count() == 1
    assert rows(spark.table("checks.check_failures")) == [
        ("accepted_values_stg_teams_league", "Minor", 1)
    ]


@pytest.mark.parametrize(
    "hours, status", [(0, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error")]
)
def test_freshness(spark, hours, status):
    now = dt.datetime(2024, 2, 1)
    loaded = [(now - dt.timedelta(hours=hours),), (now - dt.timedelta(days=30),), (None,)]
    source = spark.createDataFrame(loaded, "ts timestamp")
    got = ch.source_freshness(source, "ts", now).first()
    assert (got.age_hours, got.status) == (hours, status)


def test_freshness_of_nothing(spark):
    got = ch.source_freshness(spark.createDataFrame([], "ts timestamp"), "ts").first()
    assert (got.max_loaded_at, got.status) == (None, "error")
