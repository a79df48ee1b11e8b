"""Physical plans: what is scanned, shuffled and split, and that no plan depends on small data."""

import contextlib

import pytest
from pyspark.sql import functions as F

from seasonmart.operators import checks
from seasonmart.operators.totals import season_totals
from seasonmart.plans import intermediate, marts, staging
from seasonmart.plans.metrics import metric_query
from seasonmart.sources.schemas import RAW_SCHEMAS
from seasonmart.sources.sinks import stage

ROWS = 200_000
HOT = "id % 3 = 0"


@contextlib.contextmanager
def settings(spark, **values):
    """Runtime settings for a block."""
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def large_tables(spark):
    """As on tables too large to broadcast, with every partition worth splitting."""
    return settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.shuffle.partitions": "16",
        },
    )


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Raw tables in which one player and one team hold a third of the rows."""
    folder = str(tmp_path_factory.mktemp("raw"))
    player = F.when(F.expr(HOT), "P0").otherwise(F.concat(F.lit("P"), (F.col("id") % 500).cast("string")))

    def write(name, df):
        schema = RAW_SCHEMAS[name]
        full = df.select(
            *(
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)
                .alias(f.name)
                for f in schema.fields
            )
        )
        full.repartition(8).write.parquet(f"{folder}/{name}")
        return spark.read.schema(schema).parquet(f"{folder}/{name}")

    counts = {
        f.name: (F.xxhash64(F.col("id"), F.lit(i)) % 5 + 4) % 5
        for i, f in enumerate(RAW_SCHEMAS["raw_game_stats"].fields[4:])
    }
    games = spark.range(ROWS).select(
        F.concat(F.lit("G"), "id").alias("game_id"),
        player.alias("player_id"),
        F.make_date(2015 + F.when(F.expr(HOT), 0).otherwise(F.col("id") % 5).cast("int"), F.lit(5), F.lit(1))
        .alias("game_date"),
        *(F.abs(c).alias(n) for n, c in counts.items() if n != "innings_pitched"),
        F.lit(5).alias("innings_pitched"),
    )
    salaries = spark.range(ROWS).select(
        F.concat(F.lit("P"), (F.col("id") % 500).cast("string")).alias("player_id"),
        (2000 + F.col("id") / 500).cast("int").alias("year"),
        (F.col("id") * 10).alias("salary"),
        F.when(F.expr(HOT), "TEAM1").otherwise(F.concat(F.lit("TEAM"), (F.col("id") % 90).cast("string")))
        .alias("team_id"),
    )
    players = spark.range(500).select(
        F.concat(F.lit("P"), "id").alias("player_id"), F.lit("Ann").alias("first_name"),
        F.concat(F.lit("L"), "id").alias("last_name"), F.lit("Pitcher").alias("position"),
    )
    teams = spark.range(90).select(
        F.concat(F.lit("TEAM"), "id").alias("team_id"), F.lit("Owls").alias("team_name"),
        F.lit("Rome").alias("city"), F.lit("National").alias("league"),
    )
    return {
        "games": staging.stg_game_stats(write("raw_game_stats", games)),
        "salaries": staging.stg_salaries(write("raw_salaries", salaries)),
        "players": staging.stg_players(write("raw_players", players)),
        "teams": staging.stg_teams(write("raw_teams", teams)),
    }


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after all stages have run and AQE has made its last decision."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


def test_hot_pitcher_is_split(spark, files):
    with large_tables(spark):
        trends = intermediate.int_pitcher_performance_trends(files["games"], files["players"])
        text = final_plan(trends)
        assert "SortMergeJoin(skew=true)" in text and "Broadcast" not in text
        found = trends.agg(F.count("*"), F.count("season_era"), F.count_distinct("player_id"))
        assert tuple(found.first()) == (ROWS, ROWS, 500)


def test_hot_team_is_split(spark, files):
    with large_tables(spark):
        facts = marts.fct_player_salaries(files["salaries"], files["players"], files["teams"])
        assert "SortMergeJoin(skew=true)" in final_plan(facts)
        assert facts.count() == ROWS


def test_hot_year_and_position_are_split(spark, files):
    with large_tables(spark):
        seasons = spark.range(ROWS).select(
            F.concat(F.lit("P"), "id").alias("player_id"),
            F.when(F.expr(HOT), 2000).otherwise(F.col("id") % 20).cast("int").alias("year"),
            F.col("id").alias("salary"), F.lit(1.0).alias("salary_millions"),
            F.lit("x").alias("full_name"), F.lit(True).alias("is_pitcher"),
        )
        report = marts.pitcher_salary_analysis(seasons, first_year=0)
        assert "SortMergeJoin(skew=true)" in final_plan(report)
        assert report.count() == ROWS


def test_written_small_groups_save_the_shuffle_of_detail_rows(files):
    trends = intermediate.int_pitcher_performance_trends(
        files["games"], files["players"], materialize=stage
    )
    value = intermediate.int_player_value_analysis(
        files["games"], files["players"], files["salaries"], materialize=stage
    )
    facts = stage(
        marts.fct_player_salaries(files["salaries"], files["players"], files["teams"]), "facts"
    )
    report = marts.pitcher_salary_analysis(facts, first_year=0, materialize=stage)
    for df in (trends, value, report):
        text = plan(df)
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning(coalesce" not in text
    assert "hashpartitioning" not in plan(trends) + plan(report)


def test_written_large_groups_are_split(spark, files):
    with large_tables(spark):
        trends = intermediate.int_pitcher_performance_trends(
            files["games"], files["players"], materialize=stage
        )
        text = final_plan(trends)
        assert "SortMergeJoin(skew=true)" in text and "Broadcast" not in text


def test_season_totals_are_summed_before_the_shuffle(files):
    text = plan(season_totals(files["games"]))
    assert text.index("HashAggregate") < text.index("Exchange") < text.index("partial_sum")
    assert text.count("Exchange hashpartitioning") == 1


def test_totals_read_only_what_they_sum(files):
    scan = [line for line in plan(season_totals(files["games"])).split("\n") if "FileScan" in line][0]
    assert "game_id" not in scan and "opponent_team_id" not in scan


def test_performance_reuses_the_partitioning_of_the_totals(spark, files):
    with large_tables(spark):
        text = plan(
            marts.player_performance_analysis(files["games"], files["players"], files["salaries"])
        )
    # Totals, salaries, then both sides by player: no shuffle between totals and salary join.
    assert text.count("Exchange") == 4


def test_filters_reach_the_scan(files):
    facts = marts.fct_player_salaries(files["salaries"], files["players"], files["teams"])
    text = plan(marts.pitcher_salary_analysis(facts))
    assert "GreaterThanOrEqual(year,2019)" in text
    assert "EqualTo(position,Pitcher)" in text
    # The flag filter also turns the outer join with the players into an inner one.
    assert "LeftOuter" in text and text.count("LeftOuter") < text.count("Join")
    outings = intermediate.int_pitcher_performance_trends(files["games"], files["players"])
    assert "GreaterThan(innings_pitched,0.0)" in plan(outings)


def test_metric_query_over_both_facts_has_one_aggregation_shuffle(spark, files):
    with large_tables(spark):
        models = {
            "fct_player_salaries": marts.fct_player_salaries(
                files["salaries"], files["players"], files["teams"]
            ).transform(stage, "facts"),
            "player_performance_analysis": marts.player_performance_analysis(
                files["games"], files["players"], files["salaries"]
            ).transform(stage, "play"),
        }
        text = plan(metric_query(models, ["salary_per_hit", "contract_count"], ["metric_time"]))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_cumulative_window_runs_on_yearly_totals(files):
    facts = marts.fct_player_salaries(files["salaries"], files["players"], files["teams"])
    text = plan(
        metric_query({"fct_player_salaries": facts}, ["cumulative_salary"], ["metric_time"])
    )
    window = text.index("Window")
    assert window < text.index("HashAggregate") and "NestedLoop" not in text


def test_checks_read_each_model_once(files):
    declared = [
        checks.Check("games", "player_id", checks.NOT_NULL),
        checks.Check("games", "game_date", checks.NOT_NULL),
        checks.Check("games", "player_id", checks.UNIQUE),
        checks.Check("games", "win", checks.ACCEPTED_VALUES, values=(0, 1)),
        checks.Check("games", "player_id", checks.RELATIONSHIPS, parent=("players", "player_id")),
    ]
    text = plan(checks.check_failures(files, declared))
    assert text.count("raw_game_stats") == 1
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(check_name")


def test_orphans_are_counted_before_the_join(spark, files):
    with large_tables(spark):
        text = plan(checks.orphans(files["games"], "player_id", files["players"], "player_id"))
    assert "LeftAnti" in text and text.index("LeftAnti") < text.index("partial_count")


def test_no_python_or_cartesian_plan(spark, files):
    with large_tables(spark):
        for df in (
            intermediate.int_pitcher_performance_trends(files["games"], files["players"]),
            intermediate.int_player_value_analysis(
                files["games"], files["players"], files["salaries"]
            ),
            marts.fct_player_salaries(files["salaries"], files["players"], files["teams"]),
        ):
            text = plan(df)
            assert not any(w in text for w in ("Python", "Cartesian", "NestedLoop", "Broadcast"))


def test_roster_sends_only_the_team_row(files):
    text = plan(marts.dim_roster(files["players"], files["teams"]))
    assert "BroadcastNestedLoopJoin" in text and "EqualTo(team_id,TEAM1)" in text
