"""Mart models: roster dimension, the two season fact tables, and the pitcher payroll report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonmart.functions.columns import (
    PITCHER,
    calendar_age,
    earned_run_average,
    flag,
    guarded_ratio,
    millions,
    season_key,
    season_start,
)
from seasonmart.operators.joins import join_group_values
from seasonmart.operators.totals import SEASON_TOTALS, season_totals
from seasonmart.sources.sinks import Materialize, lazy

ROSTER_TEAM = "TEAM1"
FIRST_REPORT_YEAR = 2019


def dim_roster(
    players: DataFrame,
    teams: DataFrame,
    as_of: dt.date | None = None,
    team_id: str = ROSTER_TEAM,
) -> DataFrame:
    """Players with the roster team's attributes; nulls there if the team is not listed.

    The join condition names no player column, so the filtered team side (one row, the team's
    key) is sent to every task. Spark has no other plan for an outer join without an equality.
    """
    team = teams.where(F.col("team_id") == team_id).select(
        "team_name",
        F.col("city").alias("team_city"),
        F.col("state").alias("team_state"),
        "league",
        "division",
    )
    today = F.current_date() if as_of is None else F.lit(as_of)
    return players.join(team, F.lit(True), "left").select(
        "player_id", "full_name", "position", "position_abbreviation", "birth_date", "height",
        "weight", "throws", "bats", *team.columns,
        calendar_age(F.col("birth_date"), today).alias("age"),
        flag(F.col("position") == PITCHER, F.col("position")).alias("is_pitcher"),
    )


def fct_player_salaries(
    salaries: DataFrame, players: DataFrame, teams: DataFrame
) -> DataFrame:
    """Salaries with player and team attributes.

    Both joins keep the salary side and are left to Spark: it broadcasts a dimension it has
    measured as small, and splits a hot team or player of a large one. Players come second, so
    that a later join by player finds the rows partitioned for it.
    """
    named = players.select("player_id", "full_name", "position", "position_abbreviation")
    placed = teams.select("team_id", "team_name", "league", "division")
    return (
        salaries.join(placed, "team_id", "left")
        .join(named, "player_id", "left")
        .select(
            "player_id", "full_name", "position", "position_abbreviation", "year", "salary",
            "salary_millions", "team_name", "league", "division",
            flag(F.col("position") == PITCHER, F.col("position")).alias("is_pitcher"),
            season_start(F.col("year")).alias("season_date"),
        )
    )


def player_performance_analysis(
    games: DataFrame | None,
    players: DataFrame,
    salaries: DataFrame,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Season totals of every player with games, with salary and cost per result.

    Salaries join first: the totals are already partitioned by (player, year). ``totals`` takes
    season totals that are already written.
    """
    if totals is None:
        totals = season_totals(games)
    pay = salaries.select("player_id", "year", "salary", "salary_millions")
    salary = F.col("salary")

    def cost_per(total: str):
        count = F.col(total)
        return guarded_ratio(salary, count, guard=(salary > 0) & (count > 0))

    return (
        totals.join(pay, ["player_id", "year"], "left")
        .join(players.select("player_id", "full_name", "position"), "player_id", "left")
        .select(
            "player_id", "full_name", "position", "year", *SEASON_TOTALS,
            guarded_ratio(F.col("total_hits"), F.col("total_at_bats"))
            .alias("season_batting_average"),
            earned_run_average(F.col("total_earned_runs"), F.col("total_innings_pitched"))
            .alias("season_era"),
            "salary", "salary_millions",
            cost_per("total_hits").alias("cost_per_hit"),
            cost_per("total_home_runs").alias("cost_per_home_run"),
            cost_per("total_wins").alias("cost_per_win"),
            season_start(F.col("year")).alias("season_date"),
        )
    )


def pitcher_salary_analysis(
    salary_facts: DataFrame,
    first_year: int = FIRST_REPORT_YEAR,
    ordered: bool = False,
    materialize: Materialize = lazy,
) -> DataFrame:
    """Pitcher salaries next to the payroll of all pitchers of the year.

    Payroll in millions is summed in whole dollars and divided once, so it does not depend on
    the order in which rows arrive. With ``materialize=stage`` the payroll, a row per year, is
    written before it is joined.
    """
    rows = salary_facts.where(F.col("is_pitcher") & (F.col("year") >= first_year)).select(
        "year", "player_id", "full_name", "salary", "salary_millions"
    )
    by_year = rows.groupBy("year").agg(
        F.count_distinct("player_id").alias("total_pitchers"),
        millions(F.sum("salary")).alias("team_total_salary_millions"),
        millions(F.avg("salary")).alias("team_avg_salary_millions"),
        F.min("salary").alias("min_salary"),
        F.max("salary").alias("max_salary"),
    )
    values = [c for c in by_year.columns if c != "year"]
    payroll = materialize(by_year, "pitcher_payroll")
    report = join_group_values(rows, payroll, [], "year", values)
    return report.orderBy(F.desc("year"), F.desc("salary")) if ordered else report


def with_season_key(facts: DataFrame, name: str) -> DataFrame:
    """Add the surrogate key of a season fact (``player_salary`` or ``player_season``)."""
    return facts.withColumn(name, season_key(F.col("player_id"), F.col("year")))


def literal_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(1).alias("id"))


def pass_through(model: DataFrame) -> DataFrame:
    return model.select("*")
