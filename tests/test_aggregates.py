"""Metric answers from stored aggregates equal those from the models."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seasonmart.operators.spine import Spine
from seasonmart.plans import aggregates, metrics
from seasonmart.plans.metrics import METRICS, metric_query
from seasonmart.plans.saved_queries import SAVED_QUERIES
from seasonmart.sources import retail, sinks, tables
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"
SPINE = Spine(dt.date(2024, 6, 1), first=2018)
PAY = [m for m, metric in METRICS.items() if metric.source == metrics.SALARIES]
PLAY = [m for m, metric in METRICS.items() if metric.source == metrics.PERFORMANCE]


@pytest.fixture(scope="module")
def models(spark):
    """Facts and roster with nulls, players unknown to the roster, and players listed twice."""
    rng = random.Random(8)
    pick = lambda *of: rng.choice([*of, None])
    day = lambda: (y := pick(2019, 2020, 2021)) and dt.date(y, 1, 1)
    players = [f"P{i}" for i in range(12)]
    pay = [
        (pick(*players), day(), pick(1, 500, 10**9), pick("X", "Y"), pick("N", "A"), pick("E"), pick("C", "P"), pick(True, False))
        for _ in range(150)
    ]
    counts = [m.column for m in METRICS.values() if m.source == metrics.PERFORMANCE]
    play = [
        (pick(*players), day(), pick("Ann", "Bo"), pick("C", "P"), *(Decimal(n) if "innings" in c and n is not None else n for c in counts for n in [pick(0, 1, 7)]))
        for _ in range(150)
    ]
    roster = [
        (p, pick("Ann", "Bo", "Cy"), pick("C", "P"), pick("c", "p"), "X", "N", "E", pick(True, False))
        for p in [*players[:9], *players[:4]]
    ]
    return {
        "fct_player_salaries": spark.createDataFrame(
            pay, "player_id string, season_date date, salary bigint, team_name string, league string, "
            "division string, position string, is_pitcher boolean"),
        "player_performance_analysis": spark.createDataFrame(
            play, "player_id string, season_date date, full_name string, position string, "
            + ", ".join(f"{c} {'decimal(14,1)' if 'innings' in c else 'bigint'}" for c in counts)),
        "dim_roster": spark.createDataFrame(
            roster, "player_id string, full_name string, position string, position_abbreviation string, "
            "team_name string, league string, division string, is_pitcher boolean"),
    }


@pytest.fixture(scope="module")
def stored(models):
    return aggregates.store_aggregates(models, sinks.stage)


REQUESTS = [
    (PAY, ()), (PAY, ("metric_time",)), (PAY, ("player_salary__position", "player_salary__season_date")),
    (PAY, ("player_salary__team_name",)), (PAY, ("player__full_name",)), (PAY, ("player__is_pitcher", "metric_time")),
    (PLAY, ()), (PLAY, ("player_season__position",)), (PLAY, ("player_season__full_name", "metric_time")),
    (PLAY, ("player__position", "player__league")), (PLAY, ("player__full_name", "metric_time")),
    ([*PAY, *PLAY, "salary_per_hit", "win_loss_ratio"], ("player__full_name", "player_season__season_date")),
    (["cumulative_salary", "total_salary"], ("player_salary__league", "metric_time")),
    (["cumulative_home_runs"], ("player_season__full_name", "metric_time")),
    *((list(q.metrics), q.group_by) for q in SAVED_QUERIES.values()),
]


@pytest.mark.parametrize(("names", "group_by"), REQUESTS)
def test_same_answers(models, stored, names, group_by):
    from_models = metric_query(models, names, group_by, SPINE)
    answered = metric_query({}, names, group_by, SPINE, stored)
    assert answered.columns == from_models.columns and answered.dtypes == from_models.dtypes
    assert rows(answered) == rows(from_models)


def test_smallest_that_covers_is_read(models, stored):
    sizes = {a.name: a.rows for a in stored}
    assert sizes["salaries_by_position"] <= sizes["salaries_by_team"]
    by_name = {a.name: a for a in stored}

    def read(source, states, group_by):
        (files,) = {f.rsplit("/", 2)[1].rsplit("-", 1)[0] for f in
                    metrics.source_rows({}, source, states, group_by, stored).inputFiles()}
        return files

    assert read("salaries", ["sum__salary"], ("metric_time",)) == "salaries_by_position"
    assert read("salaries", ["sum__salary"], ("player_salary__team_name",)) == "salaries_by_team"
    assert read("performance", ["sum__total_hits"], ("player__position",)) == "performance_by_roster_group"
    assert read("performance", ["sum__total_hits"], ("player__full_name",)) == "performance_by_player"
    assert {a.source for a in by_name.values()} == {"salaries", "performance"}


def test_requests_that_nothing_covers_read_the_models(models, stored):
    mixed = ("player__full_name", "player_salary__team_name")
    assert not any(metrics.covers(a, "salaries", mixed) for a in stored)
    assert rows(metric_query(models, PAY, mixed, SPINE, stored)) == rows(metric_query(models, PAY, mixed, SPINE))
    with pytest.raises(KeyError):
        metric_query({}, PAY, mixed, SPINE, stored)


def test_listed_twice_counts_only_with_the_roster(models, stored):
    """An aggregate joined to the roster must not answer a request without it, nor the reverse."""
    for a in stored:
        has_roster = any(d.startswith("player__") for d in a.dimensions)
        assert metrics.covers(a, a.source, ("metric_time", "player__position")) <= has_roster
        assert metrics.covers(a, a.source, ("metric_time",)) == (not has_roster)


def test_coarse_aggregates_read_fine_ones(models):
    """Only the first aggregate of each fact and roster use reads a model."""
    asked = []

    class Asked(dict):
        def __getitem__(self, name):
            asked.append(name)
            return super().__getitem__(name)

    aggregates.store_aggregates(Asked(models), sinks.stage)
    assert sorted(asked) == sorted(
        ["fct_player_salaries"] * 2 + ["player_performance_analysis"] * 2 + ["dim_roster"] * 2
    )


def test_one_row_per_player_and_year_meets_the_roster(models):
    """Partial sums per player lie below the roster join."""
    plan = metrics.state_rows(models, "performance", ["sum__total_hits"], ("player__league", "metric_time"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    join, aggregate = text.index("Join LeftOuter"), text.index("Aggregate [player_id")
    assert join < aggregate and text.count("Aggregate") == 1
    assert plan.count() >= models["player_performance_analysis"].select("player_id", "season_date").distinct().count()


def test_facts_are_computed_once(spark, models):
    """Aggregates that lie next to each other read one written fact: its games are not added up for each."""
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    fact = models["player_performance_analysis"]
    counted = fact.withColumn("total_hits", F.udf(count, "long").asNondeterministic()("total_hits"))
    kept = aggregates.kept_aggregates(spark, f"once-{seen.aid}", {**models, "player_performance_analysis": counted})
    assert seen.value == fact.count()
    plain = {a.name: a for a in aggregates.store_aggregates(models, sinks.stage)}
    for a in kept:
        assert (a.rows, a.dimensions) == (plain[a.name].rows, plain[a.name].dimensions)
        assert sorted(map(str, a.table.collect())) == sorted(map(str, plain[a.name].table.collect()))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_kept_by_state_and_without_games_in_the_plan(spark):
    from __spark_entry__ import Models, queries

    state = tables.fingerprint(spark, retail.paths(FOLDER))
    assert state == tables.fingerprint(spark, retail.paths(FOLDER))
    assert state != tables.fingerprint(spark, retail.paths(FOLDER)[:-1])
    first = aggregates.kept_aggregates(spark, state, Models(spark, FOLDER))
    again = aggregates.kept_aggregates(spark, state, {})
    assert again == first
    aggregates._found.clear()  # as in another process of the application
    again = aggregates.kept_aggregates(spark, state, {})
    assert [(a.name, a.rows, a.dimensions) for a in first] == [(a.name, a.rows, a.dimensions) for a in again]
    sinks.release(spark)
    for name in ("salary_per_home_run", "cumulative_home_runs_by_player", "saved_home_run_leaders_by_season",
                 "saved_salary_by_position_and_season"):
        files = queries()[name](spark, FOLDER).inputFiles()
        assert files and not any(part in f for f in files for part in ("lineitem", "orders", "customer"))


def test_published_aggregates(spark, models):
    with sinks.own_target(spark, "aggregates") as target:
        published = aggregates.publish_aggregates(models, target)
        assert len(published) == len(aggregates.AGGREGATES)
        table = spark.table(target.table_name(aggregates.AGGREGATE_SCHEMA, "performance_by_position"))
        assert table.count() == published[-1].rows
