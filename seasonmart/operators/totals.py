"""Season aggregates of per-game rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output total -> summed game column.
SEASON_TOTALS = {
    "total_at_bats": "at_bats",
    "total_hits": "hits",
    "total_runs": "runs",
    "total_home_runs": "home_runs",
    "total_rbi": "rbi",
    "total_stolen_bases": "stolen_bases",
    "total_walks": "walks",
    "total_strikeouts": "strikeouts",
    "total_innings_pitched": "innings_pitched",
    "total_earned_runs": "earned_runs",
    "total_hits_allowed": "hits_allowed",
    "total_walks_allowed": "walks_allowed",
    "total_strikeouts_pitched": "strikeouts_pitched",
    "total_wins": "win",
    "total_losses": "loss",
    "total_saves": "save",
}


def sums(columns: Mapping[str, str]) -> list[Column]:
    return [F.sum(source).alias(total) for total, source in columns.items()]


def season_totals(games: DataFrame) -> DataFrame:
    """One row per player and season with the sum of every counting stat.

    Partial sums are formed before the shuffle, so a player with a third of all games costs the
    shuffle one row per map task and season, like any other player.
    """
    return games.groupBy("player_id", F.year("game_date").alias("year")).agg(*sums(SEASON_TOTALS))


def multiplied(names: Iterable[str], copies: str) -> list[Column]:
    """Sums over rows that a join would have repeated ``copies`` times, without repeating them."""
    return [(F.col(name) * F.col(copies)).alias(name) for name in names]
