"""Metric queries with a name, exported as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from seasonmart.operators.spine import Spine
from seasonmart.plans.metrics import StoredAggregate, metric_query
from seasonmart.sources.sinks import EXPORT_SCHEMA, Target, publish_table


@dataclass(frozen=True)
class SavedQuery:
    metrics: tuple[str, ...]
    group_by: tuple[str, ...]


_PAYROLL = ("total_salary_millions", "average_salary_millions", "contract_count")

# The saved queries with their metrics and dimensions.
SAVED_QUERIES = {
    "salary_by_position_and_season": SavedQuery(
        _PAYROLL, ("player_salary__position", "player_salary__season_date")
    ),
    "salary_by_league_and_season": SavedQuery(
        _PAYROLL, ("player_salary__league", "player_salary__season_date")
    ),
    "pitcher_performance_by_season": SavedQuery(
        ("total_wins", "total_saves", "total_strikeouts_pitched", "average_era",
         "win_loss_ratio"),
        ("player_season__season_date",),
    ),
    "home_run_leaders_by_season": SavedQuery(
        ("total_home_runs", "total_rbi", "salary_per_home_run"),
        ("player__full_name", "player_season__season_date"),
    ),
    "pitcher_cost_efficiency": SavedQuery(
        ("total_wins", "average_era", "total_salary_millions", "salary_per_win"),
        ("player__full_name", "player_season__season_date"),
    ),
}


def saved_query(
    models: Mapping[str, DataFrame],
    name: str,
    spine: Spine = Spine(),
    aggregates: Sequence[StoredAggregate] = (),
) -> DataFrame:
    query = SAVED_QUERIES[name]
    return metric_query(models, query.metrics, query.group_by, spine, aggregates)


def export_saved_query(
    models: Mapping[str, DataFrame],
    name: str,
    target: Target = Target(),
    spine: Spine = Spine(),
    aggregates: Sequence[StoredAggregate] = (),
) -> DataFrame:
    """Run a saved query and rebuild its export table, named like the query."""
    return publish_table(saved_query(models, name, spine, aggregates), name, target, EXPORT_SCHEMA)
