"""Types of the four raw tables.

Fixed, so that reading text files costs no inference pass and types cannot drift between loads.
Innings are decimal: their sums are exact and do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import types as T

COUNTS = (
    "at_bats", "hits", "runs", "home_runs", "rbi", "stolen_bases", "walks", "strikeouts",
)
PITCHING_COUNTS = (
    "earned_runs", "hits_allowed", "walks_allowed", "strikeouts_pitched", "win", "loss", "save",
)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _INT = T.StringType(), T.IntegerType()

RAW_SCHEMAS = {
    "raw_players": _table(
        player_id=_TEXT, first_name=_TEXT, last_name=_TEXT, position=_TEXT,
        birth_date=T.DateType(), height=_INT, weight=_INT, throws=_TEXT, bats=_TEXT,
    ),
    "raw_teams": _table(
        team_id=_TEXT, team_name=_TEXT, city=_TEXT, state=_TEXT, league=_TEXT, division=_TEXT,
    ),
    "raw_salaries": _table(
        player_id=_TEXT, year=_INT, salary=T.LongType(), team_id=_TEXT,
    ),
    "raw_game_stats": _table(
        game_id=_TEXT, player_id=_TEXT, game_date=T.DateType(), opponent_team_id=_TEXT,
        **{name: _INT for name in COUNTS},
        innings_pitched=T.DecimalType(4, 1),
        **{name: _INT for name in PITCHING_COUNTS},
    ),
}
