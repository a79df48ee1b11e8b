"""The checks declared on the models, and running them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from seasonmart.functions.columns import LEAGUE_CODES, POSITION_CODES
from seasonmart.operators.checks import (
    ACCEPTED_VALUES,
    NOT_NULL,
    RELATIONSHIPS,
    UNIQUE,
    Check,
    check_failures,
    check_summary,
    tagged_rows,
)
from seasonmart.sources.sinks import CHECK_SCHEMA, Target, publish_table, switch_table, table_location

FAILURE_SCHEMA = CHECK_SCHEMA

# Which columns of which model are unique, never null, limited to a list of
# values, or refer to a player.
_UNIQUE = {"stg_players": "player_id", "stg_teams": "team_id", "dim_roster": "player_id"}
_NOT_NULL = {
    "stg_players": ("player_id", "full_name", "position", "position_abbreviation"),
    "stg_salaries": ("player_id", "year", "salary", "salary_millions"),
    "stg_teams": ("team_id", "team_name", "league", "division"),
    "stg_game_stats": ("game_id", "player_id", "game_date"),
    "int_pitcher_performance_trends": ("player_id", "game_date"),
    "int_player_value_analysis": ("player_id", "year"),
    "dim_roster": ("player_id", "full_name", "position"),
    "fct_player_salaries": ("player_id", "year", "salary", "salary_millions"),
    "player_performance_analysis": ("player_id", "year"),
    "pitcher_salary_analysis": ("player_id", "year", "salary"),
}
_ACCEPTED = {
    ("stg_players", "position"): tuple(POSITION_CODES),
    ("stg_players", "position_abbreviation"): tuple(POSITION_CODES.values()),
    ("stg_teams", "league"): tuple(LEAGUE_CODES),
    ("int_pitcher_performance_trends", "quality_start"): (0, 1),
    ("dim_roster", "is_pitcher"): (True, False),
    ("fct_player_salaries", "is_pitcher"): (True, False),
}
_PLAYER_REFERENCES = {
    "stg_salaries": "stg_players",
    "stg_game_stats": "stg_players",
    "int_pitcher_performance_trends": "stg_players",
    "int_player_value_analysis": "stg_players",
    "fct_player_salaries": "dim_roster",
    "player_performance_analysis": "dim_roster",
    "pitcher_salary_analysis": "dim_roster",
}

DECLARED_CHECKS = (
    *(Check(m, c, UNIQUE) for m, c in _UNIQUE.items()),
    *(Check(m, c, NOT_NULL) for m, columns in _NOT_NULL.items() for c in columns),
    *(Check(m, c, ACCEPTED_VALUES, values=v) for (m, c), v in _ACCEPTED.items()),
    *(
        Check(m, "player_id", RELATIONSHIPS, parent=(p, "player_id"))
        for m, p in _PLAYER_REFERENCES.items()
    ),
)


def _observed(models: Mapping[str, DataFrame]) -> Mapping[str, int]:
    """What was counted while the models were written, if they come from ``build``."""
    return getattr(models, "observed", {})


def run_checks(
    models: Mapping[str, DataFrame], checks: Sequence[Check] = DECLARED_CHECKS
) -> DataFrame:
    """One row per check. Models that ``build`` wrote with the same checks are read for the others only."""
    return check_summary(check_failures(models, checks, _observed(models)), checks)


def run_and_store_checks(
    models: Mapping[str, DataFrame],
    target: Target = Target(),
    checks: Sequence[Check] = DECLARED_CHECKS,
) -> DataFrame:
    """Run checks, store failing values, failing rows and the summary, and return the summary.

    Each check that finds something gets a table of its own with the rows concerned, named like
    the check; one that finds nothing any more loses it. A model's failing rows are found in one
    pass and written at once, a folder per check, whatever the number of checks that fail; those
    folders are the checks' tables. Violations are warnings: the run goes on whatever is found.
    """
    failures = publish_table(
        check_failures(models, checks, _observed(models)), "check_failures", target, FAILURE_SCHEMA
    )
    summary = publish_table(
        check_summary(failures, checks), "check_summary", target, FAILURE_SCHEMA
    )
    spark = summary.sparkSession
    warned = {r.check_name for r in summary.where("status = 'warn'").collect()}  # a row per check
    by_model: dict[str, list[Check]] = {}
    for check in checks:
        if check.name in warned:
            by_model.setdefault(check.model, []).append(check)
        else:
            spark.sql(f"drop table if exists {target.table_name(FAILURE_SCHEMA, check.name)}")
    for model, failing in by_model.items():
        rows = tagged_rows(models[model], failing, failures)
        name = f"failing_rows_{model}"
        publish_table(rows, name, target, FAILURE_SCHEMA, partition_by=["check_name"])
        for check in failing:
            _table_of_check(spark, target, name, check)
    return summary


def _table_of_check(spark: SparkSession, target: Target, name: str, check: Check) -> None:
    """Make one check's folder of a model's failing rows a table."""
    table = target.table_name(FAILURE_SCHEMA, check.name)
    folder = f"{table_location(spark, target.table_name(FAILURE_SCHEMA, name))}/check_name={check.name}"
    new = f"{table}__{uuid.uuid4().hex}"
    columns = spark.table(target.table_name(FAILURE_SCHEMA, name)).drop("check_name").schema
    spark.catalog.createTable(new, folder, "parquet", columns)
    switch_table(spark, table, new)
