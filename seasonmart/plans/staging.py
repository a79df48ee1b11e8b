"""Staging models: raw columns plus the first derived ones. One row in, one row out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonmart.functions.columns import (
    LEAGUE_CODES,
    POSITION_CODES,
    decode,
    earned_run_average,
    flag,
    guarded_ratio,
    millions,
)
from seasonmart.sources.schemas import RAW_SCHEMAS

FLAG_YEAR = 2020


def _spaced(*names: str):
    """Null if any part is null, unlike ``concat_ws``."""
    first, second = (F.col(n) for n in names)
    return F.concat(first, F.lit(" "), second)


def stg_players(raw: DataFrame) -> DataFrame:
    return raw.select(
        *RAW_SCHEMAS["raw_players"].names,
        _spaced("first_name", "last_name").alias("full_name"),
        decode(F.col("position"), POSITION_CODES).alias("position_abbreviation"),
    )


def stg_teams(raw: DataFrame) -> DataFrame:
    return raw.select(
        *RAW_SCHEMAS["raw_teams"].names,
        _spaced("city", "team_name").alias("full_team_name"),
        decode(F.col("league"), LEAGUE_CODES).alias("league_abbreviation"),
    )


def stg_salaries(raw: DataFrame, flag_year: int = FLAG_YEAR) -> DataFrame:
    return raw.select(
        *RAW_SCHEMAS["raw_salaries"].names,
        millions(F.col("salary")).alias("salary_millions"),
        flag(F.col("year") >= flag_year, F.col("year")).alias("is_post_covid"),
    )


def stg_game_stats(raw: DataFrame) -> DataFrame:
    at_bats, hits, walks = F.col("at_bats"), F.col("hits"), F.col("walks")
    innings, earned = F.col("innings_pitched"), F.col("earned_runs")
    baserunners = F.col("hits_allowed") + F.col("walks_allowed")
    return raw.select(
        *RAW_SCHEMAS["raw_game_stats"].names,
        guarded_ratio(hits, at_bats).alias("batting_average"),
        guarded_ratio(hits + walks, at_bats + walks, guard=at_bats > 0)
        .alias("on_base_percentage"),
        earned_run_average(earned, innings).alias("era"),
        guarded_ratio(baserunners, innings, scale=9).alias("whip"),
    )
