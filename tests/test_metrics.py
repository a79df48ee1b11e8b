import datetime as dt

import pytest

from seasonmart.operators.spine import Spine, time_spine_yearly
from seasonmart.plans.metrics import METRICS, metric_query
from seasonmart.plans.saved_queries import SAVED_QUERIES, export_saved_query, saved_query
from seasonmart.sources.sinks import Target
from tests.conftest import rows

SPINE = Spine(dt.date(2024, 6, 1), first=2018)


def year(n):
    return None if n is None else dt.date(n, 1, 1)


@pytest.fixture
def models(spark):
    def make(pay=(), play=(), roster=()):
        """pay: player, year, salary, team; play: player, year, home runs, wins; roster: id, name."""
        return {
            "fct_player_salaries": spark.createDataFrame(
                [(p, year(y), s, t, "Catcher", t, "East", False) for p, y, s, t in pay],
                "player_id string, season_date date, salary bigint, team_name string, "
                "position string, league string, division string, is_pitcher boolean",
            ),
            "player_performance_analysis": spark.createDataFrame(
                [(p, year(y), h, w, 1, h, h, "Catcher", p) for p, y, h, w in play],
                "player_id string, season_date date, total_home_runs bigint, total_wins bigint, "
                "total_losses bigint, total_hits bigint, total_rbi bigint, position string, "
                "full_name string",
            ),
            "dim_roster": spark.createDataFrame(
                list(roster), "player_id string, full_name string"
            ),
        }

    return make


def test_registry():
    kinds = [m.kind for m in METRICS.values()]
    assert len(kinds) == 24
    assert kinds.count("ratio") == 4 and kinds.count("cumulative") == 2
    assert all(m in METRICS for q in SAVED_QUERIES.values() for m in q.metrics)


def test_simple_metrics_and_fill(models):
    m = models([("A", 2020, 100, "X"), ("B", 2020, 300, "X"), ("A", 2021, None, "X")])
    df = metric_query(
        m, ["total_salary", "average_salary", "max_salary", "contract_count"], ["metric_time"]
    )
    assert rows(df) == [(year(2020), 400, 200.0, 300, 2), (year(2021), 0, None, None, 1)]


def test_no_group_by(models):
    m = models([("A", 2020, 100, "X")], [("A", 2020, 4, 1)])
    df = metric_query(m, ["total_salary", "salary_per_home_run", "cumulative_salary"])
    assert rows(df) == [(100, 25.0, 100)]


def test_cross_fact_rows_of_either_side(models):
    """Null keys match each other, missing sides count as zero, a zero denominator gives null."""
    m = models(
        [("A", 2020, 100, "X"), ("B", 2021, 50, "X"), ("Q", 2020, 7, "X")],
        [("A", 2020, 4, 0), ("C", 2020, 2, 1), ("R", 2020, 7, 1)],
        [("A", "Ann"), ("B", "Bo"), ("C", "Cy")],
    )
    df = metric_query(
        m, ["salary_per_home_run", "salary_per_win", "total_salary"],
        ["player__full_name", "player_season__season_date"],
    )
    assert df.columns[:2] == ["player__full_name", "player_season__season_date__year"]
    assert rows(df) == [
        ("Ann", year(2020), 25.0, None, 100), ("Bo", year(2021), None, None, 50),
        ("Cy", year(2020), 0.0, 0.0, 0), (None, year(2020), 1.0, 7.0, 7),
    ]


def test_namesakes_are_one_group(models):
    m = models(play=[("A", 2020, 4, 0), ("B", 2020, 3, 0)], roster=[("A", "Ann"), ("B", "Ann")])
    assert rows(metric_query(m, ["total_home_runs"], ["player__full_name"])) == [("Ann", 7)]


def test_cumulative_carries_forward_through_gaps(models):
    m = models([("A", 2021, 5, "X"), ("A", 2023, 7, "X"), ("A", 2022, 1, "Y")])
    df = metric_query(
        m, ["cumulative_salary"], ["player_salary__team_name", "metric_time"], SPINE
    )
    assert rows(df) == [
        ("X", year(2021), 5), ("X", year(2022), 5), ("X", year(2023), 12), ("X", year(2024), 12),
        ("Y", year(2022), 1), ("Y", year(2023), 1), ("Y", year(2024), 1),
    ]


def test_cumulative_outside_the_axis(models):
    """Years before the axis count into its first year; later years and null years do not count."""
    m = models([("A", 2010, 5, "X"), ("A", 2012, 2, "X"), ("A", 2026, 7, "X"), ("A", None, 9, "X")])
    spine = Spine(dt.date(2019, 1, 1), first=2018)
    df = metric_query(m, ["cumulative_salary"], ["metric_time"], spine)
    assert rows(df) == [(year(2018), 7), (year(2019), 7)]


def test_cumulative_next_to_simple_and_ratio(models):
    m = models([("A", 2021, 6, "X"), ("A", 2023, 7, "X")], [("A", 2021, 3, 1), ("A", 2022, 2, 1)])
    df = metric_query(
        m, ["total_salary", "cumulative_salary", "cumulative_home_runs", "salary_per_home_run"],
        ["metric_time"], SPINE,
    )
    assert rows(df) == [
        (year(2021), 6, 6, 3, 2.0), (year(2022), 0, 6, 5, 0.0), (year(2023), 7, 13, 5, None),
        (year(2024), 0, 13, 5, None),
    ]


def test_cumulative_equals_the_range_join(models, spark):
    import random

    draw = random.Random(3)
    pay = [(f"P{draw.randrange(9)}", draw.randrange(2012, 2027), draw.randrange(99),
            draw.choice("XYZ")) for _ in range(60)]
    m = models(pay)
    got = metric_query(m, ["cumulative_salary"], ["player_salary__team_name", "metric_time"], SPINE)
    spine, fact = time_spine_yearly(spark, SPINE), m["fct_player_salaries"]
    joined = fact.join(spine, fact.season_date <= spine.date_year)
    expected = joined.groupBy("team_name", "date_year").agg({"salary": "sum"})
    assert rows(got) == rows(expected)


@pytest.mark.parametrize(
    "metrics, group_by",
    [
        (["no_such_metric"], []),
        ([], []),
        (["total_salary", "total_salary"], []),
        (["total_salary"], ["player_salary__full_name"]),
        (["total_salary"], ["player_season__position"]),
        (["salary_per_hit"], ["player_salary__league"]),
        (["total_salary"], ["player__no_such_column"]),
        (["total_salary"], ["metric_time", "player_salary__season_date"]),
        (["total_salary"], ["player_salary__league", "player_salary__league"]),
    ],
)
def test_invalid_requests(models, metrics, group_by):
    with pytest.raises(ValueError):
        metric_query(models(), metrics, group_by)


def test_export(models):
    m = models([("A", 2020, 2_000_000, "X")])
    df = export_saved_query(m, "salary_by_league_and_season", Target("prod"))
    assert rows(df) == [("X", year(2020), 2.0, 2.0, 1)]
    again = models([("A", 2021, 4_000_000, "X")])
    export_saved_query(again, "salary_by_league_and_season", Target("prod"))
    assert rows(df.sparkSession.table("mart.salary_by_league_and_season")) == [
        ("X", year(2021), 4.0, 4.0, 1)
    ]
    assert rows(saved_query(m, "salary_by_position_and_season")) == [
        ("Catcher", year(2020), 2.0, 2.0, 1)
    ]


def test_spine_default_span_is_eleven_years(spark):
    got = [r.date_year for r in time_spine_yearly(spark, Spine(dt.date(2024, 6, 1))).collect()]
    assert got == [dt.date(y, 1, 1) for y in range(2014, 2025)]


@pytest.mark.parametrize(
    "as_of, years",
    [(2005, range(2000, 2006)), (2033, range(2023, 2030)), (2045, []), (1999, [])],
)
def test_spine_is_cut_to_its_ends(spark, as_of, years):
    got = time_spine_yearly(spark, Spine(dt.date(as_of, 1, 1)))
    assert [r.date_year.year for r in got.collect()] == list(years)


def test_spine_of_today(spark):
    assert time_spine_yearly(spark).count() == 11
