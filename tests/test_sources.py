import os

import pytest

from seasonmart.operators.checks import Check
from seasonmart.plans import quality
from seasonmart.plans.metrics import metric_query
from seasonmart.plans.project import Settings, build
from seasonmart.sources import sinks, tables
from seasonmart.sources.schemas import RAW_SCHEMAS
from seasonmart.sources.sinks import Target, publish_table, publish_view, stage
from tests.conftest import rows

CSV = {
    "raw_players": "P1,Ann,Lee,Pitcher,1999-12-31,80,190,Left,Left\n",
    "raw_teams": "TEAM1,Owls,Rome,NY,National,East\n",
    "raw_salaries": "P1,2023,3000000,TEAM1\nP1,2022,,TEAM1\n",
    "raw_game_stats": "G1,P1,2023-09-09,TEAM3,0,0,0,0,0,0,0,0,4.5,1,7,3,9,1,0,0\n",
}


@pytest.fixture
def csv_folder(tmp_path):
    for name, text in CSV.items():
        header = ",".join(RAW_SCHEMAS[name].names)
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{text}")
    return tmp_path


def test_csv_tables(spark, csv_folder):
    raw = tables.csv_tables(spark, str(csv_folder))
    assert raw.game_stats.schema == RAW_SCHEMAS["raw_game_stats"]
    assert rows(raw.salaries, "year", "salary") == [(2022, None), (2023, 3_000_000)]
    assert str(raw.game_stats.first().innings_pitched) == "4.5"


def test_csv_with_another_header_or_a_bad_value_is_refused(spark, csv_folder):
    bad = csv_folder / "raw_salaries.csv"
    bad.write_text("player_id,salary,year,team_id\nP1,2023,1357000,TEAM1\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, str(bad), "raw_salaries").collect()
    bad.write_text("player_id,year,salary,team_id\nP1,soon,1357000,TEAM1\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv(spark, str(bad), "raw_salaries").collect()


def test_parquet_and_catalog_tables(spark, csv_folder, tmp_path):
    raw = tables.csv_tables(spark, str(csv_folder))
    spark.sql("create database if not exists raw")
    frames = (raw.players, raw.teams, raw.salaries, raw.game_stats)
    for name, df in zip(RAW_SCHEMAS, frames, strict=True):
        df.write.parquet(str(tmp_path / name))
        df.write.mode("overwrite").saveAsTable(f"raw.{name}")
    for read in (tables.parquet_tables(spark, str(tmp_path)), tables.catalog_tables(spark)):
        assert rows(read.salaries) == rows(raw.salaries)
        assert rows(read.teams) == rows(raw.teams)


def test_layer_schemas():
    prod, dev = Target("prod"), Target("dev", "dev_ann")
    assert prod.table_name(sinks.LAYER_SCHEMAS["marts"], "x") == "mart.x"
    assert prod.table_name(None, "x") == "default.x"
    assert dev.table_name("mart", "x") == "dev_ann.x"


def test_table_is_rebuilt_in_full(spark):
    target = Target("dev", "dev_tables")
    publish_table(spark.range(3), "t", target)
    assert rows(publish_table(spark.range(5, 7), "t", target)) == [(5,), (6,)]
    assert spark.table("dev_tables.t").count() == 2


def test_table_in_a_folder(spark, tmp_path):
    df = publish_table(spark.range(3), "t2", Target(folder=str(tmp_path)))
    assert rows(df) == [(0,), (1,), (2,)] and (tmp_path / "default" / "t2").is_dir()


def test_bucketed_tables_join_without_a_shuffle(spark):
    frames = [
        publish_table(spark.range(50), f"bucketed_{i}", bucket_by="id", buckets=4) for i in "ab"
    ]
    joined = frames[0].hint("merge").join(frames[1], "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50


def test_view(spark):
    publish_view(spark.range(2), "some_view")
    assert spark.table("some_view").count() == 2


def test_stage_writes_to_the_shared_folder(spark):
    df = stage(spark.range(4).selectExpr("id", "cast(null as string) s"), "x")
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in df.inputFiles())
    assert rows(df) == [(i, None) for i in range(4)]


def test_without_a_shared_folder_the_warehouse_is_used(spark):
    class Session:
        sparkContext = spark.sparkContext

        class conf:
            get = staticmethod({"spark.sql.warehouse.dir": "file:/wh"}.get)

    assert sinks.shared_folder(Session).startswith("file:/wh/seasonmart/")


def test_scratch_is_deleted(spark):
    with sinks.Scratch(spark, "x") as scratch:
        df = scratch.stage(spark.range(4), "numbers")
        assert df.count() == 4
        files = df.inputFiles()
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_build(spark, csv_folder):
    raw = tables.csv_tables(spark, str(csv_folder))
    built = build(spark, raw, Target("prod"), Settings())
    assert len(built) == 13
    assert rows(spark.table("staging.stg_teams"), "full_team_name") == [("Rome Owls",)]
    assert rows(spark.table("mart.player_performance_analysis"), "season_era", "cost_per_win") == [
        (2, 3_000_000)
    ]
    assert rows(spark.table("intermediate.int_player_value_analysis"), "value_score", "value_efficiency") == [
        (1, 0)
    ]
    assert spark.table("mart.pitcher_salary_analysis").count() == 2
    assert spark.table("mart.time_spine_yearly").count() == 11
    assert rows(spark.table("mart.test_2")) == [(1,)]
    assert rows(metric_query(built, ["salary_per_win"], ["player__full_name"])) == [
        ("Ann Lee", 3_000_000.0)
    ]
    warned = quality.run_checks(built).where("status = 'warn'")
    assert rows(warned, "check_name", "failures") == [
        ("not_null_fct_player_salaries_salary", 1),
        ("not_null_fct_player_salaries_salary_millions", 1),
        ("not_null_pitcher_salary_analysis_salary", 1),
        ("not_null_stg_salaries_salary", 1),
        ("not_null_stg_salaries_salary_millions", 1),
    ]


def test_build_again_after_new_games(spark, csv_folder):
    """Published tables show one build, in any session; the next build shows what came since."""
    folder = csv_folder / "raw_game_stats.csv"
    build(spark, tables.csv_tables(spark, str(csv_folder)), Target("prod"))
    with folder.open("a") as file:
        file.write("G2,P1,2023-09-10,TEAM3,0,0,0,0,0,0,0,0,6.0,2,5,1,4,1,0,0\n")
        file.write("G3,P1,2024-04-01,TEAM3,0,0,0,0,0,0,0,0,3.0,0,2,1,4,0,0,0\n")
    other = spark.newSession()
    for games, seasons, innings in ((1, 1, [4.5]), (3, 2, [3.0, 10.5, 10.5])):
        assert other.table("staging.stg_game_stats").count() == games
        trends = other.table("intermediate.int_pitcher_performance_trends")
        assert sorted(r.season_innings for r in trends.collect()) == innings
        assert other.table("intermediate.int_player_value_analysis").count() == seasons
        assert other.table("mart.player_performance_analysis").count() == seasons
        build(spark, tables.csv_tables(spark, str(csv_folder)), Target("prod"))
        other = spark.newSession()


def test_failing_rows_are_stored(spark):
    salaries = spark.createDataFrame(
        [("A", 2020, 1), ("A", 2021, 2), ("B", 2020, None), (None, 2020, 3)],
        "player_id string, year int, salary bigint",
    )
    players = spark.createDataFrame([("A", "Pitcher")], "player_id string, position string")
    declared = [
        Check("s", "player_id", "unique"), Check("s", "salary", "not_null"),
        Check("s", "year", "accepted_values", values=(2020,)),
        Check("s", "player_id", "relationships", parent=("p", "player_id")),
        Check("p", "position", "not_null"),
    ]
    target = Target("prod")
    quality.run_and_store_checks({"s": salaries, "p": players}, target, declared)

    def stored(check):
        return rows(spark.table(f"checks.{check.name}"), "player_id", "year", "salary")

    assert stored(declared[0]) == [("A", 2020, 1), ("A", 2021, 2)]
    assert stored(declared[1]) == stored(declared[3]) == [("B", 2020, None)]
    assert stored(declared[2]) == [("A", 2021, 2)]
    assert not spark.catalog.tableExists(f"checks.{declared[4].name}")


def test_own_target_leaves_nothing(spark):
    with sinks.own_target(spark, "trial") as target:
        df = publish_table(spark.range(3), "t", target)
        assert df.count() == 3
    assert not spark.catalog.databaseExists(target.schema)
    assert not os.path.exists(target.folder.removeprefix("file://"))
