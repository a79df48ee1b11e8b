"""Seasons as partitions, permanent views, ages of sources, quarantined lines, distinct counts by bitmaps."""

import datetime as dt
import os
import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from seasonmart.operators import bitmaps
from seasonmart.plans import staging, views
from seasonmart.plans.marts import pitcher_salary_analysis
from seasonmart.plans.project import Settings, build, rebuild_seasons
from seasonmart.sources import sinks, tables
from seasonmart.sources.declared import DECLARED_SOURCES, Source, sources_freshness
from seasonmart.sources.schemas import RAW_SCHEMAS
from seasonmart.sources.sinks import publish_table
from tests.conftest import rows


@pytest.fixture
def target(spark):
    with sinks.own_target(spark, "loading") as own:
        yield own


@pytest.fixture
def raw_tables(raw):
    return tables.RawTables(
        raw("raw_players", {"position": "Pitcher"}, {"player_id": "B", "position": "Pitcher"}),
        raw("raw_teams", {}),
        raw("raw_salaries", *({"player_id": p, "year": y} for p in "AB" for y in (2019, 2020, 2021, None))),
        raw("raw_game_stats", *({"player_id": p, "game_date": f"{y}-05-01", "hits": 1} for p in "AB" for y in (2019, 2020))),
    )


def written(df):
    """Modification times of a table's files by season folder."""
    found = {}
    for file in df.inputFiles():
        path = file.removeprefix("file://")
        found.setdefault(path.split("year=")[1].split("/")[0], set()).add((path, os.stat(path).st_mtime_ns))
    return found


def test_reports_list_the_files_of_wanted_seasons_only(spark, target, raw_tables):
    built = build(spark, raw_tables, target)
    facts = built["fct_player_salaries"]
    assert written(facts).keys() == {"2019", "2020", "2021", "__HIVE_DEFAULT_PARTITION__"}
    report = pitcher_salary_analysis(facts, 2020)
    assert {f.split("year=")[1][:4] for f in report.inputFiles()} == {"2020", "2021"}
    assert report.count() == 4


def test_rebuilding_a_season_leaves_others_untouched(spark, target, raw_tables):
    built = build(spark, raw_tables, target)
    names = ("fct_player_salaries", "player_performance_analysis", "pitcher_salary_analysis")
    before = {n: written(built[n]) for n in names}
    changed = replace(raw_tables, salaries=raw_tables.salaries.withColumn("salary", F.col("salary") * 3))
    rebuilt = rebuild_seasons(spark, changed, [2020], target, Settings())
    assert rebuilt.keys() == {*names}
    for name, table in rebuilt.items():
        after = written(table)
        assert after.keys() == before[name].keys()
        for season, files in after.items():
            assert (files == before[name][season]) == (season != "2020"), (name, season)
    facts = rebuilt["fct_player_salaries"]
    assert rows(facts.groupBy("year").agg(F.max("salary")).where("year is not null")) == [(2019, 1000), (2020, 3000), (2021, 1000)]
    assert {r.total_hits for r in rebuilt["player_performance_analysis"].collect()} == {1}
    assert {r.max_salary for r in rebuilt["pitcher_salary_analysis"].where("year = 2020").collect()} == {3000}


def test_a_season_without_rows_goes(spark, target, raw_tables):
    build(spark, raw_tables, target)
    fewer = replace(raw_tables, salaries=raw_tables.salaries.where("year <> 2021"))
    facts = rebuild_seasons(spark, fewer, [2021, 2020], target)["fct_player_salaries"]
    assert facts.where("year = 2021").count() == 0 and facts.where("year = 2020").count() == 2
    assert spark.newSession().table(f"{target.schema}.fct_player_salaries").count() == 6


def invented(spark, rng, name):
    def value(field):
        kind = field.dataType.typeName()
        if rng.random() < 0.15:
            return None
        if field.name == "position":
            return rng.choice([*staging.POSITION_CODES, "Owner"])
        if field.name == "league":
            return rng.choice([*staging.LEAGUE_CODES, "Other"])
        if kind == "date":
            return dt.date(rng.randint(2015, 2022), 3, rng.randint(1, 28))
        if kind.startswith("decimal"):
            from decimal import Decimal

            return Decimal(rng.randint(0, 99)) / 10
        return rng.choice(["a", "b'c", ""]) if kind == "string" else rng.choice([0, 1, 2, 7, 2020, 2021])

    schema = RAW_SCHEMAS[name]
    return spark.createDataFrame([tuple(map(value, schema.fields)) for _ in range(80)], schema)


def test_views_equal_the_models_and_follow_the_raw_tables(spark, target):
    rng = random.Random(9)
    raws = {n: publish_table(invented(spark, rng, n), n, target) for n in RAW_SCHEMAS}
    names = views.publish_views(spark, target.schema, target)
    assert [n.split(".")[1] for n in names] == ["stg_players", "stg_teams", "stg_salaries", "stg_game_stats"]
    for full_name, name in zip(names, views.view_columns()):
        raw_name, _ = views.view_columns()[name]
        for _ in range(2):
            model = getattr(staging, name)(spark.table(f"{target.schema}.{raw_name}"))
            seen = spark.newSession().table(full_name)
            assert seen.columns == model.columns and seen.dtypes == model.dtypes
            assert rows(seen) == rows(model)
            invented(spark, rng, raw_name).write.insertInto(f"{target.schema}.{raw_name}")
    assert raws["raw_players"].sparkSession is spark


def test_ages_by_file_time(spark, tmp_path):
    for name, hours in (("raw_players", 1), ("raw_teams", 25), ("raw_salaries", 49), ("raw_game_stats", 2)):
        spark.createDataFrame([], RAW_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}")
        spark.range(3).selectExpr(*(f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in RAW_SCHEMAS[name])).coalesce(
            1).write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        then = time.time() - 3600 * hours
        for file in os.listdir(f"{tmp_path}/{name}"):
            os.utime(f"{tmp_path}/{name}/{file}", (then, then))
    found = sources_freshness({n: df for n, df in zip(RAW_SCHEMAS, vars(tables.parquet_tables(spark, str(tmp_path))).values())})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == 4
    assert {r.source: r.status for r in found.collect()} == {
        "raw_players": "pass", "raw_teams": "warn", "raw_salaries": "error", "raw_game_stats": "pass"
    }
    assert [s.name for s in DECLARED_SOURCES] == [*RAW_SCHEMAS]


def test_ages_by_column_and_own_rule(spark):
    loads = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0),), (dt.datetime(2024, 1, 2, 0),)], "at timestamp")
    found = sources_freshness(
        {"a": loads, "b": loads.where("false")}, (Source("a", "at", 1, 30), Source("b", "at")), dt.datetime(2024, 1, 3, 2)
    )
    assert rows(found, "source", "loaded_by", "age_hours", "status") == [
        ("a", "column", 26.0, "warn"), ("b", "column", None, "error")
    ]


def test_build_reports_ages(spark, target, raw_tables):
    loads = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "at timestamp")
    built = build(spark, raw_tables, target, sources={"raw": loads}, declared=(Source("raw", "at"),))
    assert rows(built.freshness, "source", "status") == [("raw", "error")]
    assert rows(spark.table(f"{target.schema}.source_freshness"), "source") == [("raw",)]


SALARY_HEADER = "player_id,year,salary,team_id\n"


def csv(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_bad_lines_are_set_apart(spark, tmp_path):
    bad = ["P3,20x0,5,T1", "P4,2020", "P5,2020,7,T1,more", "P6,2020,9999999999999999999,T1"]
    path = csv(
        tmp_path, one=SALARY_HEADER + "P1,2020,5,T1\n" + "\n".join(bad) + "\nP2,,,\n",
        two=SALARY_HEADER + "\"P,7\",2021,8,T2\n",
    )
    loaded = tables.load_csv(spark, path, "raw_salaries", max_bad_share=0.6)
    assert rows(loaded.rows) == [("P,7", 2021, 8, "T2"), ("P1", 2020, 5, "T1"), ("P2", None, None, None)]
    assert rows(loaded.quarantine, "line") == sorted((b,) for b in bad)
    assert {r.file.rsplit("/")[-1] for r in loaded.quarantine.collect()} == {"one.csv"}
    # Columns that nobody asks for do not make a line good or bad.
    assert loaded.rows.select("player_id").count() == 3


def test_too_many_bad_lines_end_the_load(spark, tmp_path):
    path = csv(tmp_path, one=SALARY_HEADER + "P1,2020,5,T1\nP2,x,5,T1\n")
    with pytest.raises(tables.TooManyBadLines, match="1 of 2") as raised:
        tables.load_csv(spark, path, "raw_salaries", max_bad_share=0.4)
    assert rows(raised.value.loaded.quarantine, "line") == [("P2,x,5,T1",)]
    assert tables.load_csv(spark, path, "raw_salaries", max_bad_share=0.5).rows.count() == 1


def test_bad_dates_are_set_apart_and_wrong_headers_refused(spark, tmp_path):
    names = RAW_SCHEMAS["raw_players"].names
    good, bad = "A,Ann,Lee,Catcher,1990-02-03,70,180,Left,Left", "B,Bo,Ray,Catcher,1990-13-03,70,180,Left,Left"
    path = csv(tmp_path, players=",".join(names) + f"\n{good}\n{bad}\n")
    loaded = tables.load_csv(spark, path, "raw_players", max_bad_share=1)
    assert rows(loaded.rows, "player_id", "birth_date") == [("A", dt.date(1990, 2, 3))]
    assert rows(loaded.quarantine, "line") == [(bad,)]
    with pytest.raises(Exception, match="(?i)header"):
        tables.load_csv(spark, path, "raw_salaries")


@pytest.mark.parametrize("ranges", [1, 7])
def test_distinct_counts_roll_up(spark, ranges):
    rng = random.Random(ranges)
    data = [(rng.choice([*"abcdef", None]), rng.choice([1, 2, 3, None]), rng.choice([f"p{i}" for i in range(400)] + [None]))
            for _ in range(3000)]
    df = spark.createDataFrame(data, "team string, year int, player string")
    numbers = bitmaps.numbered_values(df, "player", sinks.stage, ranges)
    found = rows(numbers, "number")
    assert [n for n, in sorted(found)] == list(range(len({p for *_, p in data if p})))
    stored = sinks.stage(bitmaps.value_bitmaps(df.join(numbers, "player"), ["team", "year"]), "bitmaps")
    for keys in (["team", "year"], ["team"], ["year"], []):
        exact = df.where("player is not null").groupBy(*keys).agg(F.count_distinct("player").alias("n"))
        assert rows(bitmaps.distinct_counts(stored, keys, "n")) == rows(exact)
    coarse = bitmaps.rolled_up(bitmaps.rolled_up(stored, ["year"]), [])
    assert rows(bitmaps.distinct_counts(coarse, [], "n")) == [(len({p for *_, p in data if p}),)]


def test_numbers_beyond_one_bucket(spark):
    df = spark.range(70_000).select(F.col("id").alias("number"), (F.col("id") % 2).alias("half"))
    stored = bitmaps.value_bitmaps(df, ["half"])
    assert stored.count() == 7  # number 0 has a bucket of its own
    assert rows(bitmaps.distinct_counts(stored, [], "n")) == [(70_000,)]
