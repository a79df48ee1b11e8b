"""Build every model in dependency order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seasonmart.operators.checks import Check, failing_row_count
from seasonmart.operators.spine import Spine, time_spine_yearly
from seasonmart.operators.totals import season_totals
from seasonmart.plans import intermediate, marts, staging
from seasonmart.sources.declared import DECLARED_SOURCES, Source, sources_freshness
from seasonmart.sources.sinks import CHECK_SCHEMA, LAYER_SCHEMAS, Materialize, Scratch, Target, publish_seasons, publish_table
from seasonmart.sources.tables import RawTables


@dataclass(frozen=True)
class Settings:
    """The parameters of the models; ``as_of`` None means the current date."""

    as_of: dt.date | None = None
    flag_year: int = staging.FLAG_YEAR
    first_report_year: int = marts.FIRST_REPORT_YEAR
    roster_team: str = marts.ROSTER_TEAM
    spine_first: int = Spine.first
    spine_end: int = Spine.end

    @property
    def spine(self) -> Spine:
        return Spine(self.as_of, self.spine_first, self.spine_end)


class BuildError(Exception):
    """Some models could not be built. ``failures`` has the errors by model, ``skipped`` the models
    that need them, ``built`` all others, which are published."""

    def __init__(self, failures: dict[str, Exception], skipped: list[str], built: Built):
        errors = "; ".join(f"{name} ({error!s:.300})" for name, error in failures.items())
        super().__init__(f"failed: {errors}; not tried: {', '.join(skipped) or 'none'}")
        self.failures, self.skipped, self.built = failures, skipped, built


class Built(dict[str, DataFrame]):
    """Published models by name. ``observed`` has, by check, the rows found failing while they were
    written, ``freshness`` a row per declared source, if the build was given the sources."""

    def __init__(self):
        super().__init__()
        self.observed: dict[str, int] = {}
        self.freshness: DataFrame | None = None


@dataclass(frozen=True)
class Step:
    """One table of a build: what it is made from, and how. Without a layer it is for the build only.

    ``by_season`` makes the table's seasons partitions, so that readers of some seasons list no
    other files, and single seasons can be rebuilt.
    """

    layer: str | None
    needs: tuple[str, ...]
    make: Callable[..., DataFrame]
    by_season: bool = False


def project_steps(
    spark: SparkSession, raw: RawTables, settings: Settings, materialize: Materialize
) -> dict[str, Step]:
    """All models and the season totals that two of them share, with what each needs."""

    def trends(games: DataFrame, players: DataFrame) -> DataFrame:
        return intermediate.int_pitcher_performance_trends(games, players, materialize=materialize)

    def values(totals: DataFrame, players: DataFrame, salaries: DataFrame) -> DataFrame:
        return intermediate.int_player_value_analysis(
            None, players, salaries, totals=totals, materialize=materialize
        )

    def roster(players: DataFrame, teams: DataFrame) -> DataFrame:
        return marts.dim_roster(players, teams, settings.as_of, settings.roster_team)

    def performance(totals: DataFrame, players: DataFrame, salaries: DataFrame) -> DataFrame:
        return marts.player_performance_analysis(None, players, salaries, totals=totals)

    def payroll(facts: DataFrame) -> DataFrame:
        return marts.pitcher_salary_analysis(facts, settings.first_report_year, materialize=materialize)

    players, salaries, totals = "stg_players", "stg_salaries", "season_totals"
    return {
        "stg_players": Step("staging", (), lambda: staging.stg_players(raw.players)),
        "stg_teams": Step("staging", (), lambda: staging.stg_teams(raw.teams)),
        "stg_salaries": Step("staging", (), lambda: staging.stg_salaries(raw.salaries, settings.flag_year)),
        "stg_game_stats": Step("staging", (), lambda: staging.stg_game_stats(raw.game_stats)),
        "season_totals": Step(None, ("stg_game_stats",), season_totals),
        "int_pitcher_performance_trends": Step("intermediate", ("stg_game_stats", players), trends),
        "int_player_value_analysis": Step("intermediate", (totals, players, salaries), values),
        "dim_roster": Step("marts", (players, "stg_teams"), roster),
        "fct_player_salaries": Step("marts", (salaries, players, "stg_teams"), marts.fct_player_salaries, True),
        "player_performance_analysis": Step("marts", (totals, players, salaries), performance, True),
        "pitcher_salary_analysis": Step("marts", ("fct_player_salaries",), payroll, True),
        "time_spine_yearly": Step("marts", (), lambda: time_spine_yearly(spark, settings.spine)),
        "test": Step("marts", (), lambda: marts.literal_row(spark)),
        "test_2": Step("marts", ("test",), marts.pass_through),
    }


def run_steps(
    steps: Mapping[str, Step], run: Callable[[str, Step], None], workers: int
) -> tuple[dict[str, Exception], list[str]]:
    """Run each step once all that it needs has run, several at a time; the errors, and what they kept from running.

    Each step is a thread of its own that starts Spark jobs; which of their tasks run when is
    Spark's business. An error stops only the steps that need the one that failed.
    """
    waiting, running, done = dict(steps), {}, set()
    failures: dict[str, Exception] = {}
    with ThreadPoolExecutor(workers) as pool:
        while True:
            for name in [n for n, step in waiting.items() if done.issuperset(step.needs)]:
                running[pool.submit(run, name, waiting.pop(name))] = name
            if not running:
                return failures, list(waiting)
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in finished:
                name, error = running.pop(future), future.exception()
                if error is None:
                    done.add(name)
                elif isinstance(error, Exception):
                    failures[name] = error
                else:
                    raise error


def _counted(observation: Observation) -> dict[str, int]:
    """What was counted while a table was written.

    Nothing if Spark found on the way that there is nothing to write and dropped the counting with
    the rest of the plan; the checks then read the empty table.
    """
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def _dealt_by_season(df: DataFrame) -> DataFrame:
    """Rows of a season in few files: tasks hold few seasons each, a large season gets several tasks."""
    return df.hint("rebalance", "year")


def rebuild_seasons(
    spark: SparkSession,
    raw: RawTables,
    seasons: Sequence[int],
    target: Target = Target(),
    settings: Settings = Settings(),
) -> dict[str, DataFrame]:
    """Rebuild some seasons of the marts that are partitioned by season, after ``build``; others are not touched.

    Seasons do not depend on each other there: salaries, totals and payroll are by season. Only
    the raw rows of these seasons are read, and players and teams as they were last published.
    """
    staged = {n: spark.table(target.table_name(LAYER_SCHEMAS["staging"], n)) for n in ("stg_players", "stg_teams")}
    days = [
        (F.col("game_date") >= F.lit(dt.date(y, 1, 1))) & (F.col("game_date") < F.lit(dt.date(y + 1, 1, 1)))
        for y in seasons
    ]
    salaries = raw.salaries.where(F.col("year").isin(list(seasons)))
    games = raw.game_stats.where(reduce(or_, days, F.lit(False)))
    tables = staged | {
        "stg_salaries": staging.stg_salaries(salaries, settings.flag_year),
        "season_totals": season_totals(staging.stg_game_stats(games)),
    }
    rebuilt = {}
    with Scratch(spark, "rebuild_seasons") as scratch:
        for name, step in project_steps(spark, raw, settings, scratch.stage).items():
            if step.by_season:
                rows = step.make(*(tables[n] for n in step.needs))
                tables[name] = publish_seasons(
                    _dealt_by_season(rows), name, seasons, target, LAYER_SCHEMAS[step.layer]
                )
                tables[name] = tables[name].where(F.col("year").isin(list(seasons)))
                rebuilt[name] = spark.table(target.table_name(LAYER_SCHEMAS[step.layer], name))
    return rebuilt


def build(
    spark: SparkSession,
    raw: RawTables,
    target: Target = Target(),
    settings: Settings = Settings(),
    checks: Sequence[Check] = (),
    sources: Mapping[str, DataFrame] | None = None,
    declared: tuple[Source, ...] = DECLARED_SOURCES,
    workers: int = 4,
) -> Built:
    """Publish all models as tables in the schemas of their layers, and return them by name.

    Each model is built on the tables published before it, so all of them show the raw tables as
    of this build, and nothing is computed twice. Models that do not need each other are written
    at the same time, as jobs of ``workers`` threads, each in a scheduler pool named like the
    model (pools share the cluster evenly under ``spark.scheduler.mode=FAIR``). A model that fails
    takes with it only what is built on it: the others are published before ``BuildError`` is raised.

    What ``checks`` of single rows find is counted while the rows are written. With ``sources``, the
    raw tables as they are read, the age of each one ``declared`` is published too. Staging and
    intermediate models are tables too: Spark keeps a view beyond the session only if it is SQL
    text, and a view over tables that were frozen earlier would mix two states of the raw tables.
    """
    built, tables = Built(), {}
    if sources:
        ages = sources_freshness(sources, declared)
        built.freshness = publish_table(ages, "source_freshness", target, CHECK_SCHEMA)
    with Scratch(spark, "build") as scratch:

        def run(name: str, step: Step) -> None:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            df = step.make(*(tables[n] for n in step.needs))
            if step.layer is None:
                tables[name] = scratch.stage(df, name)
                return
            counters = {c.name: failing_row_count(c) for c in checks if c.model == name and c.by_row}
            observation = Observation()
            if counters:
                df = df.observe(observation, *(count.alias(check) for check, count in counters.items()))
            partitions = ["year"] if step.by_season else []
            if partitions:
                df = _dealt_by_season(df)
            tables[name] = publish_table(df, name, target, LAYER_SCHEMAS[step.layer], partition_by=partitions)
            if counters:
                built.observed.update(_counted(observation))

        steps = project_steps(spark, raw, settings, scratch.stage)
        failures, skipped = run_steps(steps, inheritable_thread_target(spark)(run), workers)
    built.update({name: tables[name] for name, step in steps.items() if step.layer and name in tables})
    if failures:
        raise BuildError(failures, skipped, built) from next(iter(failures.values()))
    return built
