"""The yearly time axis, and running totals along it."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonmart.functions.columns import season_start


@dataclass(frozen=True)
class Spine:
    """Years from ``first`` up to but without ``end``, cut to a moving span around ``as_of``.

    The span goes from ten years before the year of ``as_of`` to that year itself. ``as_of`` is a
    date, or None for the current date of the query.
    """

    as_of: dt.date | None = None
    first: int = 2000
    end: int = 2030
    years_back: int = 10

    def now(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)

    def bounds(self, now: Column | None = None) -> tuple[Column, Column]:
        """First and last year of the axis."""
        year = F.year(self.now() if now is None else now)
        return (
            F.greatest(F.lit(self.first), year - F.lit(self.years_back)),
            F.least(F.lit(self.end - 1), year),
        )

    def dates(self, now: Column | None = None) -> Column:
        """The axis as an array of dates, one per year (1 January)."""
        low, high = self.bounds(now)
        years = F.sequence(season_start(low), season_start(high), F.expr("interval 1 year"))
        return F.when(low <= high, years)


def time_spine_yearly(
    spark: SparkSession, spine: Spine = Spine(), last: DataFrame | None = None
) -> DataFrame:
    """The axis as a table, up to now or to the date in the only row and column of ``last``."""
    if last is None:
        return spark.range(1).select(F.explode(spine.dates()).alias("date_year"))
    return last.select(F.explode(spine.dates(F.col(last.columns[0]))).alias("date_year"))


def running_totals(
    totals: DataFrame, year: str, groups: list[str], values: dict[str, str], spine: Spine
) -> DataFrame:
    """All-time running totals per group for every year of the axis.

    ``totals`` has one row per group and year. The result is that of joining each axis year to all
    totals of that year or earlier, without that quadratic join: a running sum, repeated for the
    years up to the group's next row. A group starts with its first year, a year without rows
    carries the last total on, and years before the axis count into its first year.

    A window partition holds one row per year of one group, whatever the number of input rows.
    """
    low, high = spine.bounds()
    by_year = Window.partitionBy(*groups).orderBy("at_year")
    so_far = by_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Rows without a year are left out after the window, not before it: a filter here would reach
    # the scans, and a query that also needs the totals themselves could not share their shuffle.
    dated = totals.withColumn("at_year", F.year(year))
    known = F.col("at_year").isNotNull()
    return (
        dated.select(
            *groups,
            F.when(known, F.greatest("at_year", low)).alias("from_year"),
            F.least(F.lead("at_year").over(by_year) - 1, high).alias("to_year"),
            *(F.sum(F.when(known, F.col(value))).over(so_far).alias(name) for name, value in values.items()),
        )
        .where(F.col("from_year") <= F.col("to_year"))
        .select(
            *groups,
            F.explode(F.sequence("from_year", "to_year")).alias("at_year"),
            *values,
        )
        .withColumn(year, season_start(F.col("at_year")))
        .select(*groups, year, *values)
    )
