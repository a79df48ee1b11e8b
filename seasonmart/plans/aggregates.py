"""Stored aggregates of the season facts, from which metric queries are answered.

Each holds states that can be added up (sums, counts, maxima) per year and some dimensions. A
request takes the smallest one that covers it and adds up its rows. So most metric queries read a
table of years and positions, or of years and players, and no game.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from seasonmart.plans.metrics import (
    FACT_DIMENSIONS,
    FACT_ENTITIES,
    FACT_MODELS,
    METRICS,
    PERFORMANCE,
    ROSTER_DIMENSIONS,
    ROSTER_ENTITY,
    ROSTER_MODEL,
    ROWS,
    SALARIES,
    SEASON_DATE,
    TIME_DIMENSIONS,
    StoredAggregate,
    canonical,
    merged,
    source_rows,
)
from seasonmart.sources.sinks import Materialize, Scratch, Target, is_kept, keep, kept, publish_table

AGGREGATE_SCHEMA = "aggregate"
YEAR = TIME_DIMENSIONS[0]


@dataclass(frozen=True)
class Aggregate:
    """An aggregate to be stored: a fact, and the dimensions that it is grouped by."""

    name: str
    source: str
    dimensions: tuple[str, ...]


def _roster(*but: str) -> tuple[str, ...]:
    return tuple(f"{ROSTER_ENTITY}__{c}" for c in ROSTER_DIMENSIONS if c not in but)


def _own(source: str, *but: str) -> tuple[str, ...]:
    return tuple(f"{FACT_ENTITIES[source]}__{c}" for c in FACT_DIMENSIONS[source] if c not in but)


#: Finer ones first: those that follow are added up from them.
AGGREGATES = (
    Aggregate("salaries_by_team", SALARIES, (YEAR, *_own(SALARIES))),
    Aggregate("salaries_by_player", SALARIES, (YEAR, *_roster())),
    Aggregate("salaries_by_roster_group", SALARIES, (YEAR, *_roster("full_name"))),
    Aggregate("salaries_by_position", SALARIES, (YEAR, *_own(SALARIES, "team_name"))),
    Aggregate("performance_by_name", PERFORMANCE, (YEAR, *_own(PERFORMANCE))),
    Aggregate("performance_by_player", PERFORMANCE, (YEAR, *_roster())),
    Aggregate("performance_by_roster_group", PERFORMANCE, (YEAR, *_roster("full_name"))),
    Aggregate("performance_by_position", PERFORMANCE, (YEAR, *_own(PERFORMANCE, "full_name"))),
)


def states_of(source: str) -> list[str]:
    """All states that the fact's metrics need."""
    return list(dict.fromkeys(s for m in METRICS.values() if m.source == source for s in m.states))


def store_aggregates(
    models: Mapping[str, DataFrame], write: Materialize, aggregates: Iterable[Aggregate] = AGGREGATES
) -> list[StoredAggregate]:
    """Write aggregates with ``write(rows, name)`` and return them. Coarse ones read finer ones, not the models."""
    stored: list[StoredAggregate] = []
    for a in aggregates:
        states = states_of(a.source)
        rows = source_rows(models, a.source, states, a.dimensions, stored)
        added = rows.groupBy(*map(canonical, a.dimensions)).agg(*merged(states))
        table = write(added, a.name)
        stored.append(StoredAggregate(a.name, a.source, a.dimensions, table, table.count()))
    return stored


def publish_aggregates(
    models: Mapping[str, DataFrame], target: Target = Target(), aggregates: Iterable[Aggregate] = AGGREGATES
) -> list[StoredAggregate]:
    """Rebuild the aggregates as tables, after ``build`` has published the models that they are made of."""
    return store_aggregates(models, lambda df, name: publish_table(df, name, target, AGGREGATE_SCHEMA), aggregates)


def written_facts(
    models: Mapping[str, DataFrame], write: Materialize, aggregates: Iterable[Aggregate] = AGGREGATES
) -> dict[str, DataFrame]:
    """The facts of ``aggregates``, written with ``write`` in the columns that these need, and the roster.

    Several aggregates read a fact: without this each would join and add up the games anew.
    """
    found = {}
    for source in dict.fromkeys(a.source for a in aggregates):
        name = FACT_MODELS[source]
        measured = [s.partition("__")[2] for s in states_of(source) if s != ROWS]
        columns = dict.fromkeys(["player_id", SEASON_DATE, *FACT_DIMENSIONS[source], *measured])
        found[name] = write(models[name].select(*columns), name)
    return {**found, ROSTER_MODEL: models[ROSTER_MODEL]}


# What this process has found already, by session and state: looking into files costs a job each.
_found: dict[tuple[SparkSession, str, str], list[StoredAggregate]] = {}


def kept_aggregates(
    spark: SparkSession, state: str, models: Mapping[str, DataFrame], aggregates: Iterable[Aggregate] = AGGREGATES
) -> list[StoredAggregate]:
    """The aggregates of one state of the raw tables, written once for this application.

    ``state`` names that state, for instance by ``sources.tables.fingerprint``; another state has
    aggregates of its own. They last as long as the application.
    """
    aggregates = list(aggregates)
    names = [a.name for a in aggregates]
    key = (spark, spark.sparkContext.applicationId, f"{state} {' '.join(names)}")
    if key in _found and is_kept(spark, state, "sizes"):
        return _found[key]
    found = kept(spark, state, [*names, "sizes"])
    if found is None:
        with Scratch(spark, "facts") as scratch:
            facts = written_facts(models, scratch.stage, aggregates)
            stored = store_aggregates(facts, lambda df, name: keep(df, state, name), aggregates)
        sizes = [(a.name, a.rows) for a in stored]
        keep(spark.createDataFrame(sizes, "name string, n long").coalesce(1), state, "sizes")
    else:
        rows = {r.name: r.n for r in found["sizes"].collect()}  # a row per aggregate
        stored = [StoredAggregate(a.name, a.source, a.dimensions, found[a.name], rows[a.name]) for a in aggregates]
    _found[key] = stored
    return stored
