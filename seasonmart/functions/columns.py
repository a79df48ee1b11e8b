"""Column expressions shared by the models. All of them stay inside Spark's code generation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The nine field positions with their scorecard codes, and the two leagues.
POSITION_CODES = {
    "Pitcher": "P",
    "Catcher": "C",
    "First Base": "1B",
    "Second Base": "2B",
    "Third Base": "3B",
    "Shortstop": "SS",
    "Left Field": "LF",
    "Center Field": "CF",
    "Right Field": "RF",
}
LEAGUE_CODES = {"National": "NL", "American": "AL"}
PITCHER = "Pitcher"


def decode(column: Column, codes: Mapping[str, str]) -> Column:
    """Replace known values by their code; anything else, null included, passes through."""
    pairs = iter(codes.items())
    value, code = next(pairs)
    branches = F.when(column == value, F.lit(code))
    for value, code in pairs:
        branches = branches.when(column == value, F.lit(code))
    return branches.otherwise(column)


def flag(condition: Column, operand: Column) -> Column:
    """A boolean that is never null: false where the operand of the condition is null.

    Written as a conjunction, not with CASE or ``coalesce``: used as a filter it falls apart into
    two predicates that Catalyst pushes through the joins into the scan.
    """
    return condition & operand.isNotNull()


def guarded_ratio(
    numerator: Column,
    denominator: Column,
    *,
    guard: Column | None = None,
    scale: int | None = None,
    scale_quotient: bool = False,
) -> Column:
    """``numerator / denominator`` cut to a whole number, or null where the guard fails.

    The guard is ``denominator > 0`` unless given. ``scale`` multiplies the numerator, or the
    quotient if ``scale_quotient``; the two differ in the last bit, which truncation can expose.
    The quotient is a double: where SQL divides ``x::float`` by an integer or a decimal, Catalyst
    folds the two widening casts into one, and a 32-bit value never occurs.
    """
    top = numerator.cast("double")
    if scale is not None and not scale_quotient:
        top = top * F.lit(scale)
    value = top / denominator
    if scale is not None and scale_quotient:
        value = value * F.lit(scale)
    return F.when(denominator > 0 if guard is None else guard, value.cast("int"))


def earned_run_average(earned_runs: Column, innings: Column) -> Column:
    return guarded_ratio(earned_runs, innings, scale=9)


def per_nine_innings(count: Column, innings: Column) -> Column:
    return guarded_ratio(count, innings, scale=9, scale_quotient=True)


def season_start(year: Column) -> Column:
    """1 January of a season; the metric time of both fact tables."""
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def season_key(player_id: Column, year: Column) -> Column:
    """Surrogate key of a player-season. Null if either part is null."""
    return F.concat(player_id, F.lit("_"), year.cast("string"))


def calendar_age(birth_date: Column, as_of: Column) -> Column:
    """Difference of calendar years; does not look at the birthday."""
    return F.year(as_of) - F.year(birth_date)


def millions(amount: Column) -> Column:
    return amount / F.lit(1000000)
