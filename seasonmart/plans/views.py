"""Staging models as permanent views: SQL text over the raw tables, for readers in any session.

A view shows the raw rows as they are when it is read. It belongs where raw tables are in the
catalog and staging is cheap to derive again; ``build`` publishes tables, which show one state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from seasonmart.functions.columns import LEAGUE_CODES, POSITION_CODES
from seasonmart.plans.staging import FLAG_YEAR
from seasonmart.sources.schemas import RAW_SCHEMAS
from seasonmart.sources.sinks import LAYER_SCHEMAS, Target


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _decoded(column: str, codes: dict[str, str]) -> str:
    branches = " ".join(f"when {_quoted(k)} then {_quoted(v)}" for k, v in codes.items())
    return f"case {column} {branches} else {column} end"


def _whole_ratio(numerator: str, denominator: str, guard: str | None = None, scale: int | None = None) -> str:
    """As ``functions.columns.guarded_ratio``: a quotient of doubles, cut to a whole number."""
    top = f"cast({numerator} as double)" + (f" * {scale}" if scale else "")
    return f"case when {guard or f'{denominator} > 0'} then cast({top} / ({denominator}) as int) end"


def view_columns(flag_year: int = FLAG_YEAR) -> dict[str, tuple[str, dict[str, str]]]:
    """Each staging model's raw table, and the columns that it adds, as SQL."""
    return {
        "stg_players": ("raw_players", {
            "full_name": "concat(first_name, ' ', last_name)",
            "position_abbreviation": _decoded("position", POSITION_CODES),
        }),
        "stg_teams": ("raw_teams", {
            "full_team_name": "concat(city, ' ', team_name)",
            "league_abbreviation": _decoded("league", LEAGUE_CODES),
        }),
        "stg_salaries": ("raw_salaries", {
            "salary_millions": "salary / 1000000",
            "is_post_covid": f"year >= {int(flag_year)} and year is not null",
        }),
        "stg_game_stats": ("raw_game_stats", {
            "batting_average": _whole_ratio("hits", "at_bats"),
            "on_base_percentage": _whole_ratio("hits + walks", "at_bats + walks", "at_bats > 0"),
            "era": _whole_ratio("earned_runs", "innings_pitched", scale=9),
            "whip": _whole_ratio("hits_allowed + walks_allowed", "innings_pitched", scale=9),
        }),
    }


def view_sql(name: str, raw_schema: str, flag_year: int = FLAG_YEAR) -> str:
    """The query of one staging view."""
    raw, added = view_columns(flag_year)[name]
    columns = [*RAW_SCHEMAS[raw].names, *(f"{text} as {column}" for column, text in added.items())]
    return f"select {', '.join(columns)} from {raw_schema}.{raw}"


def publish_views(
    spark: SparkSession,
    raw_schema: str,
    target: Target = Target("prod"),
    flag_year: int = FLAG_YEAR,
    models: Sequence[str] = ("stg_players", "stg_teams", "stg_salaries", "stg_game_stats"),
) -> list[str]:
    """Create or replace staging views in the schema of their layer and return their full names."""
    schema = target.schema_for(LAYER_SCHEMAS["staging"])
    if schema != "default":
        spark.sql(f"create database if not exists `{schema}`")
    names = []
    for name in models:
        names.append(target.table_name(LAYER_SCHEMAS["staging"], name))
        spark.sql(f"create or replace view {names[-1]} as {view_sql(name, raw_schema, flag_year)}")
    return names
