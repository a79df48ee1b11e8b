"""Registered queries and the SQL that gives the same results on the same tables."""

from __future__ import annotations

import datetime as dt
import importlib
import uuid
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import season_oracle as oracle
from seasonmart.operators import bitmaps, checks, spine
from seasonmart.plans import intermediate, marts, quality, staging
from seasonmart.plans.aggregates import kept_aggregates
from seasonmart.plans.metrics import StoredAggregate, metric_query
from seasonmart.plans.project import Settings, build, rebuild_seasons
from seasonmart.plans.saved_queries import SAVED_QUERIES, export_saved_query, saved_query
from seasonmart.plans.views import publish_views
from seasonmart.sources import retail, sinks, tables
from seasonmart.sources.declared import sources_freshness

# The models' defaults are set for seasons around the present; the test tables cover 1995 to 2001.
SETTINGS = Settings(
    as_of=dt.date.fromisoformat(oracle.AS_OF),
    flag_year=oracle.FLAG_YEAR,
    first_report_year=oracle.FIRST_YEAR,
    spine_first=oracle.SPINE_FIRST,
    spine_end=oracle.SPINE_END,
)

SALARY_METRICS = (
    "total_salary", "average_salary", "max_salary", "total_salary_millions",
    "average_salary_millions", "contract_count",
)
PERFORMANCE_METRICS = (
    "total_home_runs", "total_hits", "total_runs", "total_rbi", "total_stolen_bases",
    "average_batting_average", "total_wins", "total_losses", "total_saves",
    "total_innings_pitched", "total_strikeouts_pitched", "average_era", "win_loss_ratio",
)
PAYROLL_EXPORT = "salary_by_league_and_season"


class Models(Mapping[str, DataFrame]):
    """The models on the tables of one folder by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = getattr(self, name)()
        return self.built[name]

    def __iter__(self):
        return iter(oracle.MODELS)

    def __len__(self) -> int:
        return len(oracle.MODELS)

    def stg_players(self) -> DataFrame:
        return staging.stg_players(retail.players(self.spark, self.folder))

    def stg_teams(self) -> DataFrame:
        return staging.stg_teams(retail.teams(self.spark, self.folder))

    def stg_salaries(self) -> DataFrame:
        return staging.stg_salaries(
            retail.salaries(self.spark, self.folder), SETTINGS.flag_year
        )

    def stg_game_stats(self) -> DataFrame:
        return staging.stg_game_stats(retail.game_stats(self.spark, self.folder))

    def int_pitcher_performance_trends(self) -> DataFrame:
        return intermediate.int_pitcher_performance_trends(
            self["stg_game_stats"], self["stg_players"], materialize=sinks.stage
        )

    def int_player_value_analysis(self) -> DataFrame:
        return intermediate.int_player_value_analysis(
            self["stg_game_stats"], self["stg_players"], self["stg_salaries"],
            materialize=sinks.stage,
        )

    def dim_roster(self) -> DataFrame:
        return marts.dim_roster(
            self["stg_players"], self["stg_teams"], SETTINGS.as_of, SETTINGS.roster_team
        )

    def fct_player_salaries(self) -> DataFrame:
        return marts.fct_player_salaries(
            self["stg_salaries"], self["stg_players"], self["stg_teams"]
        )

    def player_performance_analysis(self) -> DataFrame:
        return marts.player_performance_analysis(
            self["stg_game_stats"], self["stg_players"], self["stg_salaries"]
        )

    def pitcher_salary_analysis(self) -> DataFrame:
        # The report reads the salary facts as a table, once for the rows and once for the payroll.
        facts = sinks.stage(self["fct_player_salaries"], "fct_player_salaries")
        return marts.pitcher_salary_analysis(
            facts, SETTINGS.first_report_year, materialize=sinks.stage
        )


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines return the same types."""
    return df.select(
        *(
            F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
            for name, kind in df.dtypes
        )
    )


def _model(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return portable(Models(spark, folder)[name])


def _aggregates(spark: SparkSession, folder: str) -> list[StoredAggregate]:
    """The stored aggregates of the folder's tables as they are now, written by the first query that asks."""
    state = tables.fingerprint(spark, retail.paths(folder))
    return kept_aggregates(spark, state, Models(spark, folder))


def _metrics(
    metrics: tuple[str, ...], group_by: tuple[str, ...], spark: SparkSession, folder: str
) -> DataFrame:
    aggregates = _aggregates(spark, folder)
    return portable(metric_query(Models(spark, folder), metrics, group_by, SETTINGS.spine, aggregates))


def _saved(name: str, spark: SparkSession, folder: str) -> DataFrame:
    aggregates = _aggregates(spark, folder)
    return portable(saved_query(Models(spark, folder), name, SETTINGS.spine, aggregates))


def _entity_keys(spark: SparkSession, folder: str) -> DataFrame:
    models = Models(spark, folder)
    facts = {
        "player_salary": models["fct_player_salaries"],
        "player_season": models["player_performance_analysis"],
    }
    keyed = [
        marts.with_season_key(fact.select("player_id", "year"), name).select(
            F.lit(name).alias("entity"), F.col(name).alias("entity_key")
        )
        for name, fact in facts.items()
    ]
    return keyed[0].union(keyed[1])


def _time_spine(spark: SparkSession, folder: str) -> DataFrame:
    """The axis up to the last season that has games."""
    return spine.time_spine_yearly(spark, SETTINGS.spine, retail.last_game(spark, folder))


def _check_unique(spark: SparkSession, folder: str) -> DataFrame:
    return checks.repeated_values(retail.salaries(spark, folder), "player_id")


def _check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    seasons = Models(spark, folder)["int_player_value_analysis"]
    return checks.null_rows(seasons, "era").select("player_id", "year")


def _check_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    players = Models(spark, folder)["stg_players"]
    return checks.unexpected_values(players, "position", ["Pitcher", "Catcher"])


def _check_relationships(spark: SparkSession, folder: str) -> DataFrame:
    """Player seasons without a salary record."""
    models = Models(spark, folder)
    seasons = marts.with_season_key(models["player_performance_analysis"], "player_season")
    paid = marts.with_season_key(models["fct_player_salaries"], "player_salary")
    return checks.orphans(seasons, "player_season", paid, "player_salary")


def _check_summary(spark: SparkSession, folder: str) -> DataFrame:
    """All models built in order as tables, then every declared check run on them."""
    with sinks.own_target(spark, "check_summary") as target:
        raw = retail.raw_tables(spark, folder)
        models = build(spark, raw, target, SETTINGS, quality.DECLARED_CHECKS)
        return sinks.stage(quality.run_checks(models), "check_summary")


# Checks that find something by the nature of the tables, and two that do not.
def _declared(kind: str, model: str, column: str, more: tuple | str) -> checks.Check:
    parent = (more, "player_id") if isinstance(more, str) else None
    return checks.Check(model, column, kind, () if parent else more, parent)


FAILING_CHECKS = tuple(_declared(*check) for check in oracle.FAILING_CHECKS)


def _check_failures(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check_failures(Models(spark, folder), FAILING_CHECKS)


def _check_summary_with_failures(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_checks(Models(spark, folder), FAILING_CHECKS)


def _check_failing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The stored rows of two checks of one model that fail, each from its own table."""
    failing = [_declared(*check) for check in oracle.STORED_CHECKS]
    with sinks.own_target(spark, "failing_rows") as target:
        quality.run_and_store_checks(Models(spark, folder), target, failing)
        stored = [
            spark.table(target.table_name(quality.FAILURE_SCHEMA, check.name)).select(
                F.lit(check.name).alias("check_name"), "player_id", "year", "salary"
            )
            for check in failing
        ]
        return sinks.stage(reduce(DataFrame.union, stored), "failing_rows")


def _source_freshness(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    return checks.source_freshness(events, "ts", dt.datetime(2024, 2, 1))


def _sources_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """The declared sources: two with a column that dates their rows, two by the time of their files."""
    found = sources_freshness(
        retail.sources(spark, folder), retail.DECLARED_SOURCES, dt.datetime.fromisoformat(oracle.LOADS_AS_OF)
    )
    dated = F.col("loaded_by") == "column"
    return found.select(
        "source", "loaded_by", F.when(dated, F.col("age_hours")).alias("age_hours"), "status"
    )


def _season_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """The salary facts after one season's salaries were doubled and that season was rebuilt."""
    raw = retail.raw_tables(spark, folder)
    doubled = F.when(F.col("year") == oracle.REBUILT_SEASON, F.col("salary") * 2).otherwise(F.col("salary"))
    changed = replace(raw, salaries=raw.salaries.withColumn("salary", doubled))
    with sinks.own_target(spark, "season_rebuild") as target:
        build(spark, raw, target, SETTINGS)
        rebuilt = rebuild_seasons(spark, changed, [oracle.REBUILT_SEASON], target, SETTINGS)
        facts = rebuilt["fct_player_salaries"].select("player_id", "year", "salary", "full_name", "team_name")
        return sinks.stage(facts, "season_rebuild")


def _distinct_pitchers(spark: SparkSession, folder: str) -> DataFrame:
    """Paid pitchers by year, by team and in all, from one stored table of bitmaps by year and team."""
    facts = sinks.stage(Models(spark, folder)["fct_player_salaries"], "facts")
    pitchers = facts.where("is_pitcher").select("player_id", "year", "team_name")
    numbers = bitmaps.numbered_values(pitchers, "player_id", sinks.stage)
    stored = sinks.stage(bitmaps.value_bitmaps(pitchers.join(numbers, "player_id"), ["year", "team_name"]), "bitmaps")
    groups = (["year", "team_name"], ["year"], ["team_name"], [])
    counts = [
        bitmaps.distinct_counts(stored, keys, "total_pitchers").select(
            *(F.col(c) if c in keys else F.lit(None).cast(kind).alias(c)
              for c, kind in (("year", "int"), ("team_name", "string"))),
            F.lit("+".join(keys) or "all").alias("level"), "total_pitchers",
        )
        for keys in groups
    ]
    return reduce(DataFrame.union, counts)


def _csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Salaries loaded from a CSV in which some lines are broken: those that fit, and those set apart."""
    path = sinks.scratch_path(spark, "broken_csv")
    salaries = retail.salaries(spark, folder)
    salaries.write.option("header", True).csv(path)
    broken = salaries.where(F.col("salary") % 50 == 0).select(
        "player_id", F.lit("n/a").alias("year"), F.col("salary").cast("string").alias("salary"), "team_id"
    )
    broken.write.option("header", True).mode("append").csv(path)
    loaded = tables.load_csv(spark, path, "raw_salaries", max_bad_share=0.2)
    columns = ["player_id", "year", "salary", "team_id"]
    nothing = [F.lit(None).cast(loaded.rows.schema[c].dataType).alias(c) for c in columns]
    return loaded.rows.select(*columns, F.lit(None).cast("string").alias("bad_line")).union(
        loaded.quarantine.select(*nothing, "line")
    )


def _permanent_view(spark: SparkSession, folder: str) -> DataFrame:
    """Staged players through a view of the catalog, read by another session after more raw rows came in."""
    players = retail.players(spark, folder)
    early = F.col("player_id").endswith("1")
    with sinks.own_target(spark, "permanent_view") as target:
        sinks.publish_table(players.where(early), "raw_players", target)
        (view,) = publish_views(spark, target.schema, target, SETTINGS.flag_year, ["stg_players"])
        other = spark.newSession()
        players.where(~early).write.insertInto(f"{target.schema}.raw_players")
        return sinks.stage(other.table(view), "permanent_view")


def _view_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    name = f"stg_players_{uuid.uuid4().hex}"
    sinks.publish_view(Models(spark, folder)["stg_players"], name)
    return spark.table(name)


def _pass_through(spark: SparkSession, folder: str) -> DataFrame:
    return marts.pass_through(Models(spark, folder)["stg_teams"])


def _table_export(spark: SparkSession, folder: str) -> DataFrame:
    """A saved query exported as a table and read back."""
    with sinks.own_target(spark, "table_export") as target:
        exported = export_saved_query(Models(spark, folder), PAYROLL_EXPORT, target, SETTINGS.spine)
        return sinks.stage(exported, "table_export")


def _table_exports(spark: SparkSession, folder: str) -> DataFrame:
    """All saved queries exported as tables and read back, one row per figure."""
    models, aggregates = Models(spark, folder), _aggregates(spark, folder)
    with sinks.own_target(spark, "table_exports") as target:
        figures = []
        for name, query in SAVED_QUERIES.items():
            export_saved_query(models, name, target, SETTINGS.spine, aggregates)
            table = spark.table(target.table_name(sinks.EXPORT_SCHEMA, name))
            group = [c for c in table.columns if c not in query.metrics and not c.endswith("__year")]
            (year,) = (c for c in table.columns if c.endswith("__year"))
            figures.append(
                table.select(
                    F.lit(name).alias("export"),
                    (F.col(group[0]) if group else F.lit(None).cast("string")).alias("dimension"),
                    F.col(year).alias("season"),
                    *(F.col(m).cast("double").alias(m) for m in query.metrics),
                ).unpivot(["export", "dimension", "season"], list(query.metrics), "metric", "value")
            )
        return sinks.stage(reduce(DataFrame.union, figures), "table_exports")


def _csv_scan(table: str, spark: SparkSession, folder: str) -> DataFrame:
    """A raw table written as CSV with a header and read with the fixed types."""
    path = sinks.scratch_path(spark, table)
    derived = getattr(retail.raw_tables(spark, folder), table.removeprefix("raw_"))
    derived.write.option("header", True).csv(path)
    return portable(tables.read_csv(spark, path, table))


def entry(spark: SparkSession) -> DataFrame:
    """Payroll by position and season on the smallest test tables."""
    return _saved("salary_by_position_and_season", spark, "/root/testdata/sf0.001")


def _training_data(attribute: str) -> dict:
    """What the operators for training data and the pipeline of them register, if they can be imported."""
    found = {}
    for module in ("seasonmart.llm.queries", "corpus_pipeline"):
        try:
            found |= getattr(importlib.import_module(module), attribute)
        except ImportError:
            break
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    time = "metric_time"
    return {
        **{name: partial(_model, name) for name in oracle.MODELS},
        "entity_keys": _entity_keys,
        "time_spine_yearly": _time_spine,
        "salary_metrics_overall": partial(_metrics, SALARY_METRICS, ()),
        **{
            f"salary_metrics_by_{c}": partial(_metrics, SALARY_METRICS, (f"player_salary__{c}",))
            for c in ("league", "division", "position", "team_name", "is_pitcher")
        },
        "salary_metrics_by_roster_position_code": partial(
            _metrics, SALARY_METRICS, ("player__position_abbreviation", time)
        ),
        "performance_metrics_by_position_year": partial(
            _metrics, PERFORMANCE_METRICS, ("player_season__position", time)
        ),
        "performance_metrics_by_full_name": partial(
            _metrics, PERFORMANCE_METRICS, ("player_season__full_name",)
        ),
        "performance_metrics_by_roster_league": partial(
            _metrics, PERFORMANCE_METRICS, ("player__league", "player__is_pitcher")
        ),
        "performance_metrics_by_roster_team": partial(
            _metrics, PERFORMANCE_METRICS, ("player__team_name", "player__division")
        ),
        "cumulative_salary": partial(_metrics, ("cumulative_salary",), (time,)),
        "salary_with_running_total": partial(_metrics, ("total_salary", "cumulative_salary"), (time,)),
        "cumulative_salary_by_team": partial(
            _metrics, ("cumulative_salary",), ("player_salary__team_name", time)
        ),
        "cumulative_home_runs": partial(_metrics, ("cumulative_home_runs",), (time,)),
        "cumulative_home_runs_by_player": partial(
            _metrics, ("cumulative_home_runs",), ("player_season__full_name", time)
        ),
        "salary_per_home_run": partial(
            _metrics, ("salary_per_home_run",), ("player__full_name", time)
        ),
        "salary_per_win": partial(_metrics, ("salary_per_win",), ("player__full_name", time)),
        "salary_per_hit": partial(_metrics, ("salary_per_hit",), ("player__position", time)),
        **{f"saved_{name}": partial(_saved, name) for name in SAVED_QUERIES},
        "check_unique": _check_unique,
        "check_not_null": _check_not_null,
        "check_accepted_values": _check_accepted_values,
        "check_relationships": _check_relationships,
        "check_summary": _check_summary,
        "check_summary_with_failures": _check_summary_with_failures,
        "check_failures": _check_failures,
        "check_failing_rows": _check_failing_rows,
        "source_freshness": _source_freshness,
        "sources_freshness": _sources_freshness,
        "view_roundtrip": _view_roundtrip,
        "permanent_view": _permanent_view,
        "season_rebuild": _season_rebuild,
        "distinct_pitchers": _distinct_pitchers,
        "csv_quarantine": _csv_quarantine,
        "pass_through": _pass_through,
        "table_export": _table_export,
        "table_exports": _table_exports,
        "csv_scan": partial(_csv_scan, "raw_salaries"),
        "csv_scan_games": partial(_csv_scan, "raw_game_stats"),
        **_training_data("QUERIES"),
    }


def oracle_sql() -> dict[str, str]:
    return {**oracle.statements(), **_training_data("SQL")}
