import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from seasonmart.operators.totals import season_totals
from seasonmart.plans import intermediate, marts, staging
from tests.conftest import rows


def players(raw, *people):
    return staging.stg_players(raw("raw_players", *people))


def games(raw, *played):
    return staging.stg_game_stats(raw("raw_game_stats", *played))


def salaries(raw, *paid):
    return staging.stg_salaries(raw("raw_salaries", *paid))


def teams(raw, *named):
    return staging.stg_teams(raw("raw_teams", *named))


# Staging


def test_players_null_name_part_and_unknown_position(raw):
    df = players(
        raw,
        {"player_id": "1"},
        {"player_id": "2", "first_name": None},
        {"player_id": "3", "position": "Coach"},
        {"player_id": "4", "position": None},
    )
    assert rows(df, "player_id", "full_name", "position_abbreviation") == [
        ("1", "Ann Lee", "C"), ("2", None, "C"), ("3", "Ann Lee", "Coach"), ("4", "Ann Lee", None),
    ]


def test_teams_league(raw):
    df = teams(raw, {"team_id": "1"}, {"team_id": "2", "league": "American"},
               {"team_id": "3", "league": "Other", "city": None})
    assert rows(df, "team_id", "full_team_name", "league_abbreviation") == [
        ("1", "Rome Owls", "NL"), ("2", "Rome Owls", "AL"), ("3", None, "Other"),
    ]


def test_salaries_flag_and_millions(raw):
    df = salaries(raw, {"player_id": "1", "year": 2019}, {"player_id": "2", "salary": 2_500_000},
                  {"player_id": "3", "year": None, "salary": None})
    assert rows(df, "player_id", "salary_millions", "is_post_covid") == [
        ("1", 0.001, False), ("2", 2.5, True), ("3", None, False),
    ]


def test_game_rates(raw):
    df = games(
        raw,
        {"game_id": "1", "at_bats": 4, "hits": 3, "walks": 2},
        {"game_id": "2", "at_bats": 4, "hits": 4},
        {"game_id": "3", "walks": 3},
        {"game_id": "4", "innings_pitched": 6.2, "earned_runs": 2, "hits_allowed": 5,
         "walks_allowed": 2},
    )
    assert rows(df, "game_id", "batting_average", "on_base_percentage", "era", "whip") == [
        ("1", 0, 0, None, None), ("2", 1, 1, None, None), ("3", None, None, None, None),
        ("4", None, None, 2, 10),
    ]


# Pitcher trends

OUTING = {"innings_pitched": 6, "game_date": "2020-05-01"}


def trends(raw, played, people):
    return intermediate.int_pitcher_performance_trends(games(raw, *played), players(raw, *people))


def test_trends_rates_and_season(raw):
    df = trends(
        raw,
        [
            {**OUTING, "game_id": "1", "strikeouts_pitched": 7, "walks_allowed": 2,
             "hits_allowed": 4, "earned_runs": 3},
            {**OUTING, "game_id": "2", "innings_pitched": 5.9, "earned_runs": 1},
            {**OUTING, "game_id": "3", "game_date": "2021-05-01", "earned_runs": 4},
            {**OUTING, "game_id": "4", "innings_pitched": 0},
        ],
        [{"position": "Pitcher"}],
    )
    assert rows(
        df, "game_date", "k_per_9", "bb_per_9", "h_per_9", "quality_start", "game_score",
        "season_innings", "season_earned_runs", "season_quality_starts", "season_era",
    ) == [
        (dt.date(2020, 5, 1), 0, 0, 0, 0, Decimal("57.8"), Decimal("11.9"), 4, 1, 3),
        (dt.date(2020, 5, 1), 10, 3, 6, 1, Decimal("45.0"), Decimal("11.9"), 4, 1, 3),
        (dt.date(2021, 5, 1), 0, 0, 0, 0, Decimal("46.0"), Decimal("6.0"), 4, 0, 6),
    ]


def test_trends_keep_outings_without_a_date(raw):
    df = trends(raw, [{**OUTING, "game_date": None}, OUTING], [{"position": "Pitcher"}])
    assert rows(df, "game_date", "full_name", "season_innings") == [
        (dt.date(2020, 5, 1), "Ann Lee", Decimal("6.0")), (None, "Ann Lee", None),
    ]


def test_trends_only_for_pitchers(raw):
    df = trends(raw, [OUTING, {**OUTING, "player_id": "B"}, {**OUTING, "player_id": None}],
                [{}, {"player_id": "C", "position": "Pitcher"}])
    assert rows(df) == []


def test_trends_count_a_game_once_per_listing(raw):
    """As joining games with a player that is listed twice does."""
    listed = [{"position": "Pitcher"}, {"position": "Pitcher", "first_name": "Bo"}, {}]
    df = trends(raw, [{**OUTING, "earned_runs": 2}], listed)
    assert rows(df, "full_name", "season_innings", "season_earned_runs", "season_era") == [
        ("Ann Lee", Decimal("12.0"), 4, 3), ("Bo Lee", Decimal("12.0"), 4, 3),
    ]


def test_trends_order(raw):
    df = intermediate.int_pitcher_performance_trends(
        games(raw, OUTING, {**OUTING, "win": 1, "strikeouts_pitched": 3},
              {**OUTING, "game_date": "2021-01-01"}),
        players(raw, {"position": "Pitcher"}),
        ordered=True,
    )
    assert [(r.game_date.year, int(r.game_score)) for r in df.collect()] == [
        (2021, 62), (2020, 65), (2020, 62),
    ]


# Player value

PLAYED = {"game_date": "2020-05-01"}


def value(raw, played, people, paid, **more):
    return intermediate.int_player_value_analysis(
        games(raw, *played), players(raw, *people), salaries(raw, *paid), **more
    )


def test_value_of_batters_and_pitchers(raw):
    df = value(
        raw,
        [
            {**PLAYED, "player_id": "B", "at_bats": 4, "hits": 3, "home_runs": 1, "rbi": 2,
             "stolen_bases": 1},
            {**PLAYED, "player_id": "P", "innings_pitched": 9, "earned_runs": 4, "win": 1,
             "save": 1, "strikeouts_pitched": 3},
        ],
        [{"player_id": "B"}, {"player_id": "P", "position": "Pitcher"}],
        [{"player_id": "B", "salary": 3_000_000}, {"player_id": "P", "salary": 500_001}],
    )
    # The pitcher's 3 + 2 + 0.3 - 8 = -2.7 is cut to -2.
    assert rows(df, "player_id", "value_score", "cost_per_primary_stat", "value_efficiency") == [
        ("B", 15, 1_500_000, 5), ("P", -2, 250_000, -3),
    ]


def test_value_without_salary_or_result(raw):
    df = value(raw, [{**PLAYED, "home_runs": 1}, {**PLAYED, "player_id": "B"}],
               [{}, {"player_id": "B", "position": None}], [{"player_id": "B"}])
    assert rows(
        df, "player_id", "salary", "cost_per_primary_stat", "value_score", "value_efficiency",
        "league_avg_home_runs",
    ) == [("A", None, None, 4, None, 1.0), ("B", 1000, None, 0, 0, None)]


def test_league_average_is_over_seasons_of_a_position(raw):
    df = value(
        raw,
        [{**PLAYED, "player_id": "A", "home_runs": 1}] * 3
        + [{**PLAYED, "player_id": "B", "home_runs": 1, "at_bats": 1, "hits": 1}]
        + [{**PLAYED, "player_id": "C", "home_runs": 9}]
        + [{"game_date": "2021-05-01", "player_id": "A", "home_runs": 7}]
        + [{"game_date": None, "player_id": "A", "home_runs": 5}],
        [{"player_id": "A"}, {"player_id": "B"}, {"player_id": "C", "position": "Shortstop"}],
        [],
    )
    assert rows(df, "player_id", "year", "league_avg_home_runs", "league_avg_batting",
                "batting_avg_vs_league_pct") == [
        ("A", 2020, 2.0, 1.0, None), ("A", 2021, 7.0, None, None), ("A", None, None, None, None),
        ("B", 2020, 2.0, 1.0, 0), ("C", 2020, 9.0, None, None),
    ]


def test_distance_from_the_league_where_one_season_stands_out(raw):
    """Rates are whole numbers, so only a season far from a low average has a distance at all."""
    batters = [{**PLAYED, "player_id": f"B{i}", "at_bats": 1, "hits": 90 * (i == 0)} for i in range(200)]
    pitchers = [
        {**PLAYED, "player_id": f"P{i}", "innings_pitched": 1, "earned_runs": 10 * (i == 0)}
        for i in range(200)
    ]
    listed = [{"player_id": g["player_id"]} for g in batters]
    listed += [{"player_id": g["player_id"], "position": "Pitcher"} for g in pitchers]
    df = value(raw, batters + pitchers, listed, [])
    found = {r[0]: r[1:] for r in rows(df, "player_id", "batting_avg_vs_league_pct", "era_vs_league_pct")}
    # (90 - 0.45) / (45 + 1) = 1.9 and (0.45 - 90) / (45 + 1) = -1.9, cut to whole numbers.
    assert found["B0"] == (1, None) and found["B1"] == (0, None)
    assert found["P0"] == (None, -1) and found["P1"] == (None, 0)


def test_value_groups_repeated_listings(raw):
    df = value(raw, [{**PLAYED, "home_runs": 2}], [{}, {}, {"position": "Shortstop"}], [])
    assert rows(df, "position", "total_home_runs") == [("Catcher", 4), ("Shortstop", 2)]


def test_value_from_written_totals(raw):
    played = [{**PLAYED, "home_runs": 2}, {**PLAYED, "at_bats": 3, "hits": 1}]
    lazy = value(raw, played, [{}], [{}])
    given = intermediate.int_player_value_analysis(
        None, players(raw, {}), salaries(raw, {}), totals=season_totals(games(raw, *played))
    )
    assert rows(lazy) == rows(given) and rows(lazy)


def test_value_order(raw):
    df = value(raw, [{**PLAYED, "home_runs": 1}, {**PLAYED, "player_id": "B", "home_runs": 2},
                     {**PLAYED, "player_id": "C"}, {"game_date": "2021-01-01"}],
               [{}, {"player_id": "B"}, {"player_id": "C"}], [{}, {"player_id": "B"}],
               ordered=True)
    assert [(r.year, r.player_id) for r in df.collect()] == [
        (2021, "A"), (2020, "B"), (2020, "A"), (2020, "C"),
    ]


# Marts


def test_roster_has_one_team_for_all(raw):
    df = marts.dim_roster(
        players(raw, {"birth_date": "1990-12-31"}, {"player_id": "B", "position": "Pitcher"}),
        teams(raw, {}, {"team_id": "TEAM2", "city": "Oslo"}),
        as_of=dt.date(2020, 1, 1),
    )
    assert rows(df, "player_id", "team_city", "age", "is_pitcher") == [
        ("A", "Rome", 30, False), ("B", "Rome", None, True),
    ]


def test_roster_without_the_team(raw):
    df = marts.dim_roster(players(raw, {}), teams(raw, {"team_id": "TEAM2"}))
    assert rows(df, "player_id", "team_name", "league") == [("A", None, None)]


def test_salary_facts_keep_unmatched_salaries(raw):
    df = marts.fct_player_salaries(
        salaries(raw, {}, {"player_id": "X", "team_id": "TEAM9"}, {"player_id": None}),
        players(raw, {"position": "Pitcher"}),
        teams(raw, {}),
    )
    assert rows(df, "player_id", "full_name", "team_name", "is_pitcher", "season_date") == [
        ("A", "Ann Lee", "Owls", True, dt.date(2020, 1, 1)),
        ("X", None, None, False, dt.date(2020, 1, 1)),
        (None, None, "Owls", False, dt.date(2020, 1, 1)),
    ]


def test_performance_costs(raw):
    df = marts.player_performance_analysis(
        games(raw, {**PLAYED, "hits": 3, "at_bats": 4}, {**PLAYED, "home_runs": 1},
              {**PLAYED, "player_id": "X", "hits": 1, "at_bats": 1, "win": 1},
              {"player_id": None}),
        players(raw, {}),
        salaries(raw, {}, {"player_id": "Z"}),
    )
    assert rows(
        df, "player_id", "full_name", "year", "season_batting_average", "cost_per_hit",
        "cost_per_home_run", "cost_per_win", "season_date",
    ) == [
        ("A", "Ann Lee", 2020, 0, 333, 1000, None, dt.date(2020, 1, 1)),
        ("X", None, 2020, 1, None, None, None, dt.date(2020, 1, 1)),
        (None, None, None, None, None, None, None, None),
    ]


def test_pitcher_payroll(raw):
    people = [{"player_id": p, "position": "Pitcher"} for p in "AB"] + [{"player_id": "C"}]
    paid = [
        {"player_id": "A", "salary": 1_000_000}, {"player_id": "A", "salary": 2_000_000},
        {"player_id": "B", "salary": 6_000_000}, {"player_id": "C", "salary": 9_000_000},
        {"player_id": "A", "year": 2018}, {"player_id": "B", "year": None},
    ]
    facts = marts.fct_player_salaries(salaries(raw, *paid), players(raw, *people), teams(raw))
    report = marts.pitcher_salary_analysis(facts, ordered=True)
    assert [tuple(r) for r in report.drop("full_name", "salary_millions").collect()] == [
        (2020, p, s, 2, 9.0, 3.0, 1_000_000, 6_000_000)
        for p, s in (("B", 6_000_000), ("A", 2_000_000), ("A", 1_000_000))
    ]


def test_literal_and_pass_through(spark):
    first = marts.literal_row(spark)
    assert first.dtypes == [("id", "int")]
    assert rows(marts.pass_through(first)) == [(1,)]


def test_season_totals_match_a_plain_sum(raw):
    df = season_totals(games(raw, *[{**PLAYED, "runs": i, "innings_pitched": 0.1} for i in range(9)]))
    assert rows(df, "player_id", "year", "total_runs", "total_innings_pitched") == [
        ("A", 2020, 36, Decimal("0.9")),
    ]
    assert df.select(F.count("*")).first()[0] == 1
