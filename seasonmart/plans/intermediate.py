"""Intermediate models: pitcher outings with season context, and player value by season."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonmart.functions.columns import (
    PITCHER,
    earned_run_average,
    guarded_ratio,
    per_nine_innings,
)
from seasonmart.operators.joins import join_group_values
from seasonmart.operators.totals import SEASON_TOTALS, multiplied, season_totals, sums
from seasonmart.sources.sinks import Materialize, lazy

# The columns of an outing, its season's totals, and which averages a league has.
OUTING_COLUMNS = [
    "innings_pitched", "earned_runs", "hits_allowed", "walks_allowed", "strikeouts_pitched",
    "win", "loss", "save",
]
OUTING_TOTALS = {
    "season_innings": "innings_pitched",
    "season_earned_runs": "earned_runs",
    "season_strikeouts": "strikeouts_pitched",
    "season_quality_starts": "quality_start",
}
VALUE_TOTALS = [
    name for name in SEASON_TOTALS
    if name not in ("total_runs", "total_hits_allowed", "total_walks_allowed")
]
LEAGUE_AVERAGES = {
    "league_avg_batting": "batting_average",
    "league_avg_era": "era",
    "league_avg_home_runs": "total_home_runs",
    "league_avg_rbi": "total_rbi",
    "league_avg_stolen_bases": "total_stolen_bases",
    "league_avg_wins": "total_wins",
    "league_avg_saves": "total_saves",
}


def _pitcher_seasons(outings: DataFrame, pitchers: DataFrame) -> DataFrame:
    """Season totals of every pitcher, one row per season and listing of the pitcher.

    Games are summed before they meet the players, so only season rows are joined here. A player
    listed more than once has each game counted once per listing, as a join of games and players
    would count it.
    """
    listings = pitchers.groupBy("player_id").agg(F.count(F.lit(1)).alias("listings"))
    seasons = outings.groupBy("player_id", "season").agg(*sums(OUTING_TOTALS))
    totals = seasons.join(listings, "player_id").select(
        "player_id", "season", *multiplied(OUTING_TOTALS, "listings")
    )
    era = earned_run_average(F.col("season_earned_runs"), F.col("season_innings"))
    return totals.withColumn("season_era", era).join(
        pitchers.select("player_id", "full_name"), "player_id"
    )


def int_pitcher_performance_trends(
    games: DataFrame,
    players: DataFrame,
    ordered: bool = False,
    materialize: Materialize = lazy,
) -> DataFrame:
    """Every outing of a pitcher with its rates, next to the totals of that pitcher's season.

    The game rows take part in one join only: names and totals arrive together, on
    (player, season), see ``join_group_values``. With ``materialize=stage`` the season rows are
    written first.
    """
    innings, earned = F.col("innings_pitched"), F.col("earned_runs")
    hits, walks = F.col("hits_allowed"), F.col("walks_allowed")
    strikeouts = F.col("strikeouts_pitched")
    quality = F.when((innings >= 6) & (earned <= 3), 1).otherwise(0)
    score = F.lit(50) + innings * 2 + strikeouts - hits * 2 - walks * 2 - earned * 4
    outings = games.where(innings > 0).select(
        "player_id", "game_date", F.year("game_date").alias("season"), *OUTING_COLUMNS,
        quality.alias("quality_start"),
    )
    pitchers = players.where(F.col("position") == PITCHER)
    season_columns = [*OUTING_TOTALS, "season_era"]
    trends = join_group_values(
        outings,
        materialize(_pitcher_seasons(outings, pitchers), "pitcher_seasons"),
        ["player_id"],
        "season",
        season_columns,
        how="inner",
    ).select(
        "player_id", "full_name", "game_date", *OUTING_COLUMNS,
        per_nine_innings(strikeouts, innings).alias("k_per_9"),
        per_nine_innings(walks, innings).alias("bb_per_9"),
        per_nine_innings(hits, innings).alias("h_per_9"),
        "quality_start",
        score.alias("game_score"),
        *season_columns,
    )
    return trends.orderBy(F.desc("game_date"), F.desc("game_score")) if ordered else trends


def _player_seasons(totals: DataFrame, players: DataFrame) -> DataFrame:
    """Season totals by player, name and position, for players that are listed.

    Joins season rows, not games. Repeated listings are folded into a count first, so neither
    the join nor a task sees the copies.
    """
    people = players.groupBy("player_id", "full_name", "position").agg(
        F.count(F.lit(1)).alias("listings")
    )
    seasons = totals.join(people, "player_id").select(
        "player_id", "full_name", "position", "year", *multiplied(VALUE_TOTALS, "listings")
    )
    return seasons.select(
        "*",
        guarded_ratio(F.col("total_hits"), F.col("total_at_bats")).alias("batting_average"),
        earned_run_average(F.col("total_earned_runs"), F.col("total_innings_pitched"))
        .alias("era"),
    )


def int_player_value_analysis(
    games: DataFrame | None,
    players: DataFrame,
    salaries: DataFrame,
    ordered: bool = False,
    totals: DataFrame | None = None,
    materialize: Materialize = lazy,
) -> DataFrame:
    """Player seasons compared with their position's average, priced by salary.

    With ``materialize=stage`` the season totals are written before use, so that the games are
    read once for both the seasons and the averages over them, and so are the averages.
    ``totals`` takes season totals (``season_totals``) another model uses too.
    """
    if totals is None:
        totals = materialize(season_totals(games), "season_totals")
    seasons = _player_seasons(totals, players)
    averages = materialize(
        seasons.groupBy("year", "position").agg(
            *(F.avg(source).alias(name) for name, source in LEAGUE_AVERAGES.items())
        ),
        "position_averages",
    )
    paid = seasons.join(
        salaries.select("player_id", "year", "salary", "salary_millions"),
        ["player_id", "year"],
        "left",
    )
    rated = join_group_values(paid, averages, ["position"], "year", list(LEAGUE_AVERAGES))

    pitching = F.col("position") == PITCHER
    batting = F.col("position") != PITCHER
    wins, home_runs, salary = F.col("total_wins"), F.col("total_home_runs"), F.col("salary")
    batting_gap = F.col("batting_average") - F.col("league_avg_batting")
    era_gap = F.col("league_avg_era") - F.col("era")
    pitching_value = (
        wins * 3
        + F.col("total_saves") * 2
        + F.col("total_strikeouts_pitched") * F.lit(Decimal("0.1"))
        - F.col("total_earned_runs") * 2
    )
    batting_value = (
        home_runs * 4 + F.col("total_rbi") * 3 + F.col("total_stolen_bases") * 2
        + F.col("total_hits")
    )

    def of_average(gap, average: str):
        return (gap / (F.col(average) * 100 + 1)).cast("int")

    scored = rated.select(
        "player_id", "full_name", "position", "year", *VALUE_TOTALS, "batting_average", "era",
        "salary", "salary_millions", *LEAGUE_AVERAGES,
        of_average(batting_gap, "league_avg_batting").alias("batting_avg_vs_league_pct"),
        of_average(era_gap, "league_avg_era").alias("era_vs_league_pct"),
        F.coalesce(
            guarded_ratio(salary, wins + 1, guard=pitching & (wins > 0)),
            guarded_ratio(salary, home_runs + 1, guard=batting & (home_runs > 0)),
        ).alias("cost_per_primary_stat"),
        F.when(pitching, pitching_value.cast("int")).otherwise(batting_value.cast("int"))
        .alias("value_score"),
    ).withColumn(
        "value_efficiency", guarded_ratio(F.col("value_score"), F.col("salary_millions"))
    )
    return scored.orderBy(F.desc("year"), F.desc("value_efficiency")) if ordered else scored
