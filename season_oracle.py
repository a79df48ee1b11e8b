"""DuckDB SQL giving the same results as the registered queries, written independently of them.

Every statement reads the retail tables as views. Aggregates and rates are cast explicitly: DuckDB
rounds where Spark truncates, and widens sums.
"""

from __future__ import annotations

from collections.abc import Collection

AS_OF, FLAG_YEAR, FIRST_YEAR = "2001-12-31", 1998, 1998
SPINE_FIRST, SPINE_END = 1990, 2030

# Fixed values, spelled out here so that a wrong code in the models does not go unnoticed.
POSITION_CODES = {
    "Pitcher": "P", "Catcher": "C", "First Base": "1B", "Second Base": "2B", "Third Base": "3B",
    "Shortstop": "SS", "Left Field": "LF", "Center Field": "CF", "Right Field": "RF",
}
LEAGUE_CODES = {"National": "NL", "American": "AL"}

# The declared checks as kind, model, columns, and the values or parent model.
DECLARED_CHECKS = (
    ("unique", "stg_players", "player_id", ()),
    ("unique", "stg_teams", "team_id", ()),
    ("unique", "dim_roster", "player_id", ()),
    ("not_null", "stg_players", "player_id full_name position position_abbreviation", ()),
    ("not_null", "stg_salaries", "player_id year salary salary_millions", ()),
    ("not_null", "stg_teams", "team_id team_name league division", ()),
    ("not_null", "stg_game_stats", "game_id player_id game_date", ()),
    ("not_null", "int_pitcher_performance_trends", "player_id game_date", ()),
    ("not_null", "int_player_value_analysis", "player_id year", ()),
    ("not_null", "dim_roster", "player_id full_name position", ()),
    ("not_null", "fct_player_salaries", "player_id year salary salary_millions", ()),
    ("not_null", "player_performance_analysis", "player_id year", ()),
    ("not_null", "pitcher_salary_analysis", "player_id year salary", ()),
    ("accepted_values", "stg_players", "position", (
        "Pitcher", "Catcher", "First Base", "Second Base", "Third Base", "Shortstop", "Left Field",
        "Center Field", "Right Field")),
    ("accepted_values", "stg_players", "position_abbreviation", (
        "P", "C", "1B", "2B", "3B", "SS", "LF", "CF", "RF")),
    ("accepted_values", "stg_teams", "league", ("National", "American")),
    ("accepted_values", "int_pitcher_performance_trends", "quality_start", (0, 1)),
    ("accepted_values", "dim_roster", "is_pitcher", (True, False)),
    ("accepted_values", "fct_player_salaries", "is_pitcher", (True, False)),
    ("relationships", "stg_salaries", "player_id", "stg_players"),
    ("relationships", "stg_game_stats", "player_id", "stg_players"),
    ("relationships", "int_pitcher_performance_trends", "player_id", "stg_players"),
    ("relationships", "int_player_value_analysis", "player_id", "stg_players"),
    ("relationships", "fct_player_salaries", "player_id", "dim_roster"),
    ("relationships", "player_performance_analysis", "player_id", "dim_roster"),
    ("relationships", "pitcher_salary_analysis", "player_id", "dim_roster"),
)
# Checks that find something on the test tables, and two that do not.
FAILING_CHECKS = (
    ("unique", "stg_salaries", "player_id", ()),
    ("not_null", "int_player_value_analysis", "era", ()),
    ("accepted_values", "stg_players", "position", ("Pitcher", "Catcher")),
    ("relationships", "player_performance_analysis", "player_id", "stg_salaries"),
    ("relationships", "stg_salaries", "player_id", "player_performance_analysis"),
    ("unique", "stg_players", "player_id", ()),
    ("not_null", "stg_players", "position", ()),
    ("accepted_values", "stg_salaries", "team_id", ("TEAM1", "TEAM2", "TEAM3")),
)


#: The exports: dimension, season and metrics of each.
_MONEY = ("total_salary_millions", "average_salary_millions", "contract_count")
_EXPORTS = {
    "salary_by_position_and_season": ("player_salary__position", "player_salary__season_date__year", _MONEY),
    "salary_by_league_and_season": ("player_salary__league", "player_salary__season_date__year", _MONEY),
    "pitcher_performance_by_season": (
        "cast(null as varchar)", "player_season__season_date__year",
        ("total_wins", "total_saves", "total_strikeouts_pitched", "average_era", "win_loss_ratio")),
    "home_run_leaders_by_season": (
        "player__full_name", "player_season__season_date__year",
        ("total_home_runs", "total_rbi", "salary_per_home_run")),
    "pitcher_cost_efficiency": (
        "player__full_name", "player_season__season_date__year",
        ("total_wins", "average_era", "total_salary_millions", "salary_per_win")),
}
#: When the sources' ages are taken, and the season that is rebuilt with other salaries.
LOADS_AS_OF = "2001-11-05T12:00:00"
REBUILT_SEASON = 1998
#: Two of them, of one model, whose failing rows are stored.
STORED_CHECKS = (FAILING_CHECKS[0], FAILING_CHECKS[-1])


def _case(column: str, codes: dict[str, str]) -> str:
    branches = " ".join(f"when '{k}' then '{v}'" for k, v in codes.items())
    return f"case {column} {branches} else {column} end"


def _rate(guard: str, top: str, bottom: str, before: str = "", after: str = "") -> str:
    """Whole part of a guarded quotient."""
    return (
        f"case when {guard} then "
        f"trunc((({top})::double{before} / ({bottom})::double){after})::int end"
    )


_POSITIONS = " ".join(f"when {i} then '{p}'" for i, p in enumerate(POSITION_CODES))

# Summed game columns where the total is not named total_<column>.
_NAMED = {"win": "total_wins", "loss": "total_losses", "save": "total_saves"}
_SUMS = ", ".join(
    f"sum({c})::{'double' if c == 'innings_pitched' else 'bigint'} "
    f"as {_NAMED.get(c, f'total_{c}')}"
    for c in (
        "at_bats", "hits", "runs", "home_runs", "rbi", "stolen_bases", "walks", "strikeouts",
        "innings_pitched", "earned_runs", "hits_allowed", "walks_allowed", "strikeouts_pitched",
        "win", "loss", "save",
    )
)
_SEASON_RATES = ", ".join(
    _rate(f"{bottom} > 0", top, bottom, scale) + " as {}"
    for top, bottom, scale in (
        ("total_hits", "total_at_bats", ""),
        ("total_earned_runs", "total_innings_pitched", " * 9"),
    )
)

_RELATIONS = {
    "raw_teams": ("""
        select 'TEAM' || (s_suppkey + 1)::varchar as team_id, s_name as team_name, n_name as city,
          r_name as state, if(s_suppkey % 2 = 0, 'National', 'American') as league,
          case s_suppkey % 3 when 0 then 'Central' when 1 then 'West' else 'East' end as division
        from supplier, nation, region
        where s_nationkey = n_nationkey and n_regionkey = r_regionkey""", ()),
    "raw_players": (f"""
        select 'P' || c_custkey::varchar as player_id, c_mktsegment as first_name,
          c_name as last_name, case c_custkey % 9 {_POSITIONS} end as position,
          date '1985-01-01' + cast(c_custkey % 3650 as int) as birth_date,
          (70 + c_custkey % 8)::int as height, (180 + c_custkey % 46)::int as weight,
          if(c_custkey % 3 = 0, 'Left', 'Right') as throws,
          if(c_custkey % 4 = 0, 'Left', 'Right') as bats
        from customer""", ()),
    "raw_salaries": ("""
        select 'P' || o_custkey::varchar as player_id, year(o_orderdate)::int as year,
          (sum(round(o_totalprice * 100)::bigint) // 100)::bigint as salary,
          'TEAM' || (o_custkey % 10 + 1)::varchar as team_id
        from orders group by o_custkey, year(o_orderdate)""", ()),
    "lines": ("""
        select 'G' || l_orderkey::varchar || '_' || l_linenumber::varchar as game_id,
          'P' || o_custkey::varchar as player_id, l_shipdate::date as game_date,
          'TEAM' || (l_suppkey + 1)::varchar as opponent_team_id, o_custkey % 9 = 0 as p,
          l_quantity::int as q, l_linenumber as ln, l_partkey::int as pk,
          if(o_custkey % 9 = 0, 0, l_quantity::int % 6) as ab
        from lineitem join orders on l_orderkey = o_orderkey""", ()),
    "raw_games": ("""
        select *, if(p, 0, least(ab, pk % 4)) as h,
          if(p, (q % 10)::decimal(4,1) + (ln % 3)::decimal(4,1) * 0.1::decimal(2,1),
             0)::decimal(4,1) as ip from lines""", ("lines",)),
    "raw_game_stats": ("""
        select game_id, player_id, game_date, opponent_team_id, ab::int as at_bats, h::int as hits,
          if(h > 0, ln % 3, 0)::int as runs, (h > 0 and pk % 7 = 0)::int as home_runs,
          if(h > 0, pk % 3, 0)::int as rbi, (h > 0 and pk % 5 = 0)::int as stolen_bases,
          if(p, 0, ln % 2)::int as walks, (ab - h)::int as strikeouts, ip as innings_pitched,
          if(p, q % 6, 0)::int as earned_runs, if(p, pk % 9, 0)::int as hits_allowed,
          if(p, ln % 4, 0)::int as walks_allowed, if(p, q % 11, 0)::int as strikeouts_pitched,
          (p and q % 6 <= 2)::int as win, (p and q % 6 >= 4)::int as loss,
          (p and pk % 13 = 0)::int as save
        from raw_games""", ("raw_games",)),
    "stg_players": (f"""
        select *, first_name || ' ' || last_name as full_name,
          {_case("position", POSITION_CODES)} as position_abbreviation
        from raw_players""", ("raw_players",)),
    "stg_teams": (f"""
        select *, city || ' ' || team_name as full_team_name,
          {_case("league", LEAGUE_CODES)} as league_abbreviation
        from raw_teams""", ("raw_teams",)),
    "stg_salaries": (f"""
        select *, salary::double / 1000000 as salary_millions,
          coalesce(year >= {FLAG_YEAR}, false) as is_post_covid
        from raw_salaries""", ("raw_salaries",)),
    "stg_game_stats": (f"""
        select * replace (innings_pitched::double as innings_pitched),
          {_rate("at_bats > 0", "hits", "at_bats")} as batting_average,
          {_rate("at_bats > 0", "hits + walks", "at_bats + walks")} as on_base_percentage,
          {_rate("innings_pitched > 0", "earned_runs", "innings_pitched", " * 9")} as era,
          {_rate("innings_pitched > 0", "hits_allowed + walks_allowed", "innings_pitched", " * 9")}
            as whip
        from raw_game_stats""", ("raw_game_stats",)),
    "outings": (f"""
        select g.player_id, full_name, game_date, year(game_date) as season,
          innings_pitched as ip, earned_runs, hits_allowed, walks_allowed, strikeouts_pitched,
          win, loss, save, coalesce(innings_pitched >= 6 and earned_runs <= 3, false)::int as quality_start,
          {_rate("true", "strikeouts_pitched", "innings_pitched", "", " * 9")} as k_per_9,
          {_rate("true", "walks_allowed", "innings_pitched", "", " * 9")} as bb_per_9,
          {_rate("true", "hits_allowed", "innings_pitched", "", " * 9")} as h_per_9,
          (50 + 2 * innings_pitched + strikeouts_pitched
             - 2 * (hits_allowed + walks_allowed) - 4 * earned_runs)::double as game_score
        from raw_game_stats g join stg_players using (player_id)
        where position = 'Pitcher' and innings_pitched > 0""", ("raw_game_stats", "stg_players")),
    "int_pitcher_performance_trends": (f"""
        with season_sums as (
          select player_id, season, sum(ip) as ips, sum(earned_runs) as ers,
            sum(strikeouts_pitched) as ks, sum(quality_start) as qs
          from outings group by all)
        select o.player_id, full_name, game_date, ip::double as innings_pitched, earned_runs,
          hits_allowed, walks_allowed, strikeouts_pitched, win, loss, save,
          k_per_9, bb_per_9, h_per_9, quality_start, game_score,
          ips::double as season_innings, ers::bigint as season_earned_runs,
          ks::bigint as season_strikeouts, qs::bigint as season_quality_starts,
          {_rate("ips > 0", "ers", "ips", " * 9")} as season_era
        from outings o left join season_sums s
          on o.player_id = s.player_id and o.season = s.season""", ("outings",)),
    "totals": (f"""
        select player_id, year(game_date)::int as year, {_SUMS}
        from raw_game_stats group by all""", ("raw_game_stats",)),
    "rates": (f"select *, {_SEASON_RATES.format('ba', 'ra')} from totals", ("totals",)),
    "listed": (f"""
        select g.player_id, full_name, position, year(game_date)::int as year, {_SUMS}
        from raw_game_stats g join stg_players p on p.player_id = g.player_id
        group by all""", ("raw_game_stats", "stg_players")),
    "people": (f"""
        select * exclude (total_runs, total_hits_allowed, total_walks_allowed),
          {_SEASON_RATES.format("batting_average", "era")} from listed""", ("listed",)),
    "league": ("""
        select year, position, avg(batting_average) as league_avg_batting,
          avg(era) as league_avg_era, avg(total_home_runs) as league_avg_home_runs,
          avg(total_rbi) as league_avg_rbi, avg(total_stolen_bases) as league_avg_stolen_bases,
          avg(total_wins) as league_avg_wins, avg(total_saves) as league_avg_saves
        from people group by all""", ("people",)),
    "valued": ("""
        select p.*, s.salary, s.salary_millions, l.* exclude (year, position),
          trunc(if(p.position = 'Pitcher',
            3 * total_wins + 2 * total_saves + 0.1 * total_strikeouts_pitched
              - 2 * total_earned_runs,
            4 * total_home_runs + 3 * total_rbi + 2 * total_stolen_bases + total_hits
          ))::int as value_score
        from people p
          left join stg_salaries s on p.player_id = s.player_id and p.year = s.year
          left join league l on p.year = l.year and p.position = l.position""",
        ("people", "stg_salaries", "league")),
    "int_player_value_analysis": (f"""
        select *,
          trunc((batting_average - league_avg_batting) / (league_avg_batting * 100 + 1))::int
            as batting_avg_vs_league_pct,
          trunc((league_avg_era - era) / (league_avg_era * 100 + 1))::int as era_vs_league_pct,
          case when position = 'Pitcher'
            then {_rate("total_wins > 0", "salary", "total_wins + 1")}
            when position <> 'Pitcher'
            then {_rate("total_home_runs > 0", "salary", "total_home_runs + 1")}
          end as cost_per_primary_stat,
          {_rate("salary_millions > 0", "value_score", "salary_millions")} as value_efficiency
        from valued""", ("valued",)),
    "dim_roster": (f"""
        select player_id, full_name, position, position_abbreviation, birth_date, height, weight,
          throws, bats, team_name, city as team_city, state as team_state, league, division,
          (year(date '{AS_OF}') - year(birth_date))::int as age,
          coalesce(position = 'Pitcher', false) as is_pitcher
        from stg_players left join (from stg_teams where team_id = 'TEAM1') on true""",
        ("stg_players", "stg_teams")),
    "fct_player_salaries": ("""
        select s.player_id, full_name, position, position_abbreviation, year, salary,
          salary_millions, team_name, league, division,
          coalesce(position = 'Pitcher', false) as is_pitcher, make_date(year, 1, 1) as season_date
        from stg_salaries s
          left join stg_players p on p.player_id = s.player_id
          left join stg_teams t on t.team_id = s.team_id""",
        ("stg_salaries", "stg_players", "stg_teams")),
    "player_performance_analysis": (f"""
        select r.* exclude (ba, ra), full_name, position, ba as season_batting_average,
          ra as season_era, salary, salary_millions,
          {_rate("salary > 0 and total_hits > 0", "salary", "total_hits")} as cost_per_hit,
          {_rate("salary > 0 and total_home_runs > 0", "salary", "total_home_runs")}
            as cost_per_home_run,
          {_rate("salary > 0 and total_wins > 0", "salary", "total_wins")} as cost_per_win,
          make_date(r.year, 1, 1) as season_date
        from rates r
          left join stg_players p on p.player_id = r.player_id
          left join stg_salaries s on s.player_id = r.player_id and s.year = r.year""",
        ("rates", "stg_players", "stg_salaries")),
    "pitcher_salary_analysis": (f"""
        with pay as (
          select year, player_id, full_name, salary, salary_millions from fct_player_salaries
          where is_pitcher and year >= {FIRST_YEAR}),
        payroll as (
          select year, count(distinct player_id) as total_pitchers,
            sum(salary)::bigint::double / 1000000 as team_total_salary_millions,
            sum(salary)::bigint::double / count(salary) / 1000000 as team_avg_salary_millions,
            min(salary) as min_salary, max(salary) as max_salary
          from pay group by year)
        select * from pay left join payroll using (year)""", ("fct_player_salaries",)),
    "spine": (f"""
        select make_date(y::int, 1, 1) as date_year, y::int as y
        from range({SPINE_FIRST}, {SPINE_END}) t(y)
        where y between year(date '{AS_OF}') - 10 and year(date '{AS_OF}')""", ()),
}

RAW = ("raw_players", "raw_teams", "raw_salaries", "raw_game_stats")
MODELS = (
    "stg_players", "stg_teams", "stg_salaries", "stg_game_stats",
    "int_pitcher_performance_trends", "int_player_value_analysis", "dim_roster",
    "fct_player_salaries", "player_performance_analysis", "pitcher_salary_analysis",
)


def _with(query: str, *needed: str, given: Collection[str] = ()) -> str:
    """Prefix a query with the relations it needs, in dependency order, but for those given."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in given:
            return
        for parent in _RELATIONS[name][1]:
            add(parent)
        if name not in order:
            order.append(name)

    for name in needed:
        add(name)
    return "with " + ",\n".join(f"{n} as ({_RELATIONS[n][0]})" for n in order) + f"\n{query}"


def _model(name: str) -> str:
    return _with(f"select * from {name}", name)


def on_raw_tables(name: str) -> str:
    """A model's SQL on the four raw tables themselves instead of the retail tables."""
    return _with(f"select * from {name}", name, given=RAW)


# Measures of each fact: metric name -> aggregate.
_PAY = {
    "total_salary": "coalesce(sum(salary), 0)::bigint",
    "average_salary": "sum(salary)::bigint::double / count(salary)",
    "max_salary": "max(salary)",
    "total_salary_millions": "coalesce(sum(salary), 0)::bigint::double / 1000000",
    "average_salary_millions": "sum(salary)::bigint::double / count(salary) / 1000000",
    "contract_count": "count(*)",
}
_PLAY = {
    **{
        m: f"coalesce(sum({m}), 0)::bigint"
        for m in ("total_home_runs", "total_hits", "total_runs", "total_rbi",
                  "total_stolen_bases", "total_wins", "total_losses", "total_saves",
                  "total_strikeouts_pitched")
    },
    "total_innings_pitched": "coalesce(sum(total_innings_pitched::decimal(18,1)), 0)::double",
    "average_batting_average": "avg(season_batting_average)",
    "average_era": "avg(season_era)",
}
_PAY_ALL = tuple(_PAY)
_PLAY_ALL = tuple(_PLAY)


def _grouped(table: str, keys: dict[str, str], measures: list[str]) -> str:
    columns = [f"{e} as {n}" for n, e in keys.items()] + measures
    tail = " group by " + ", ".join(keys.values()) if keys else ""
    return f"select {', '.join(columns)} from {table}{tail}"


def _pay(keys: dict[str, str], metrics=_PAY_ALL) -> str:
    return _with(
        _grouped("fct_player_salaries", keys, [f"{_PAY[m]} as {m}" for m in metrics]),
        "fct_player_salaries",
    )


_WIN_LOSS = "sum(total_wins)::double / nullif(sum(total_losses), 0) as win_loss_ratio"


def _play(keys: dict[str, str], metrics=_PLAY_ALL, table="player_performance_analysis", *more):
    measures = [f"{_PLAY[m]} as {m}" for m in metrics] + [_WIN_LOSS]
    return _with(_grouped(table, keys, measures), "player_performance_analysis", *more)


_ON_ROSTER = "{} f left join (select player_id, {} from dim_roster) d on d.player_id = f.player_id"


def _cumulative(fact: str, metric: str, value: str, group: str | None) -> str:
    """The running total as it is defined: axis years joined to all earlier rows."""
    key, name = (f"f.{group}", f"player_salary__{group}") if group else (None, None)
    if fact == "player_performance_analysis" and group:
        name = f"player_season__{group}"
    columns = (f"{key} as {name}, " if group else "") + "s.date_year as metric_time__year"
    grouping = ", ".join(filter(None, [key, "s.date_year"]))
    return _with(
        f"select {columns}, sum(f.{value})::bigint as {metric} "
        f"from spine s join {fact} f on f.season_date <= s.date_year group by {grouping}",
        fact, "spine",
    )


def _per_player(key: str, time: str, select: str) -> str:
    """Both facts by a roster attribute and year, joined in full on null-safe keys."""
    def side(fact: str, sums: str) -> str:
        rows = _ON_ROSTER.format(fact, f"{key} as who")
        return f"select who, season_date as at, {sums} from {rows} group by all"

    pay = side("fct_player_salaries", "sum(salary)::bigint as pay")
    play = side(
        "player_performance_analysis",
        "sum(total_home_runs) as hr, sum(total_rbi) as rbi, sum(total_wins) as w, "
        "sum(total_hits) as h, avg(season_era) as era",
    )
    return _with(
        f"select coalesce(a.who, b.who) as player__{key}, coalesce(a.at, b.at) as {time}, {select} "
        f"from ({pay}) a full join ({play}) b "
        "on a.who is not distinct from b.who and a.at is not distinct from b.at",
        "fct_player_salaries", "player_performance_analysis", "dim_roster",
    )


def _per(count: str) -> str:
    return f"coalesce(pay, 0)::double / nullif(coalesce({count}, 0), 0)"


def _check(kind: str, model: str, column: str, more=()) -> str:
    """The number of failures of one check."""
    match kind:
        case "unique":
            failing = f"(select {column} from {model} where {column} is not null " \
                      f"group by 1 having count(*) > 1)"
        case "not_null":
            failing = f"{model} where {column} is null"
        case "accepted_values":
            failing = f"(select distinct {column} from {model} where {column} not in ({_list(more)}))"
        case _:
            failing = f"{model} where {column} not in " \
                      f"(select player_id from {more} where player_id is not null)"
    return (
        f"select '{kind}_{model}_{column}' as check_name, '{model}' as model, "
        f"'{column}' as column_name, '{kind}' as kind, count(*)::bigint as failures, "
        f"if(count(*) > 0, 'warn', 'pass') as status from {failing}"
    )


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _summary(checks) -> str:
    return "\nunion all ".join(
        _check(kind, model, column, more)
        for kind, model, columns, more in checks for column in columns.split()
    )


def _failing_values(kind: str, model: str, column: str, more) -> str:
    """The values that violate one check, with their rows."""
    having = ""
    match kind:
        case "unique":
            where, having = f"{column} is not null", "having count(*) > 1"
        case "not_null":
            where = f"{column} is null"
        case "accepted_values":
            where = f"{column} not in ({_list(more)})"
        case _:
            where = f"{column} not in (select player_id from {more} where player_id is not null)"
    return (
        f"select '{kind}_{model}_{column}' as check_name, {column}::varchar as value, "
        f"count(*) as n_records from {model} where {where} group by {column} {having}"
    )


def statements() -> dict[str, str]:
    year = {"metric_time__year": "season_date"}
    pay_year = {"player_salary__season_date__year": "season_date"}
    roster_time = "player_season__season_date__year"
    pitching = ("total_wins", "total_saves", "total_strikeouts_pitched", "average_era")
    payroll = ("total_salary_millions", "average_salary_millions", "contract_count")
    sql = {name: _model(name) for name in MODELS}
    sql |= {
        "entity_keys": _with(
            "select 'player_salary' as entity, player_id || '_' || year::varchar as entity_key "
            "from fct_player_salaries union all "
            "select 'player_season', player_id || '_' || year::varchar "
            "from player_performance_analysis",
            "fct_player_salaries", "player_performance_analysis",
        ),
        "time_spine_yearly": _with(
            f"select make_date(y::int, 1, 1) as date_year from range({SPINE_FIRST}, {SPINE_END}) "
            "t(y), (select year(max(game_date)) as last from raw_game_stats) "
            "where y between last - 10 and last",
            "raw_game_stats",
        ),
        "salary_metrics_overall": _pay({}),
        **{
            f"salary_metrics_by_{c}": _pay({f"player_salary__{c}": c})
            for c in ("league", "division", "position", "team_name", "is_pitcher")
        },
        "salary_metrics_by_roster_position_code": _with(
            _grouped(
                _ON_ROSTER.format("fct_player_salaries", "position_abbreviation as code"),
                {"player__position_abbreviation": "code", **year},
                [f"{_PAY[m]} as {m}" for m in _PAY_ALL],
            ),
            "fct_player_salaries", "dim_roster",
        ),
        "performance_metrics_by_position_year": _play({"player_season__position": "position", **year}),
        "performance_metrics_by_full_name": _play({"player_season__full_name": "full_name"}),
        "performance_metrics_by_roster_league": _play(
            {"player__league": "d.lg", "player__is_pitcher": "d.ip"}, _PLAY_ALL,
            _ON_ROSTER.format("player_performance_analysis", "league as lg, is_pitcher as ip"),
            "dim_roster",
        ),
        "performance_metrics_by_roster_team": _play(
            {"player__team_name": "d.tn", "player__division": "d.dv"}, _PLAY_ALL,
            _ON_ROSTER.format("player_performance_analysis", "team_name as tn, division as dv"),
            "dim_roster",
        ),
        "cumulative_salary": _cumulative(
            "fct_player_salaries", "cumulative_salary", "salary", None),
        "salary_with_running_total": _with(
            "select coalesce(d, yr) as metric_time__year, coalesce(pay, 0)::bigint as total_salary, "
            "running as cumulative_salary "
            "from (select season_date as d, sum(salary) as pay from fct_player_salaries group by 1) "
            "full join (select s.date_year as yr, sum(f.salary)::bigint as running from spine s "
            "join fct_player_salaries f on f.season_date <= s.date_year group by 1) on d = yr",
            "fct_player_salaries", "spine"),
        "cumulative_salary_by_team": _cumulative(
            "fct_player_salaries", "cumulative_salary", "salary", "team_name"),
        "cumulative_home_runs": _cumulative(
            "player_performance_analysis", "cumulative_home_runs", "total_home_runs", None),
        "cumulative_home_runs_by_player": _cumulative(
            "player_performance_analysis", "cumulative_home_runs", "total_home_runs", "full_name"),
        "salary_per_home_run": _per_player(
            "full_name", "metric_time__year", f"{_per('hr')} as salary_per_home_run"),
        "salary_per_win": _per_player(
            "full_name", "metric_time__year", f"{_per('w')} as salary_per_win"),
        "salary_per_hit": _per_player(
            "position", "metric_time__year", f"{_per('h')} as salary_per_hit"),
        "saved_salary_by_position_and_season": _pay(
            {"player_salary__position": "position", **pay_year}, payroll),
        "saved_salary_by_league_and_season": _pay(
            {"player_salary__league": "league", **pay_year}, payroll),
        "saved_pitcher_performance_by_season": _play(
            {"player_season__season_date__year": "season_date"}, pitching),
        "saved_home_run_leaders_by_season": _per_player(
            "full_name", roster_time,
            "coalesce(hr, 0)::bigint as total_home_runs, coalesce(rbi, 0)::bigint as total_rbi, "
            f"{_per('hr')} as salary_per_home_run"),
        "saved_pitcher_cost_efficiency": _per_player(
            "full_name", roster_time,
            "coalesce(w, 0)::bigint as total_wins, era as average_era, "
            "coalesce(pay, 0)::bigint::double / 1000000 as total_salary_millions, "
            f"{_per('w')} as salary_per_win"),
        "check_unique": _with(
            "select player_id as value, count(*) as n_records from raw_salaries "
            "where player_id is not null group by 1 having count(*) > 1",
            "raw_salaries",
        ),
        "check_not_null": _with(
            "select player_id, year from int_player_value_analysis where era is null",
            "int_player_value_analysis",
        ),
        "check_accepted_values": _with(
            "select position as value, count(*) as n_records from stg_players "
            "where position not in ('Pitcher', 'Catcher') group by 1",
            "stg_players",
        ),
        "check_relationships": _with(
            "select player_id || '_' || year::varchar as value, count(*) as n_records "
            "from player_performance_analysis p where not exists (select * from raw_salaries s "
            "where s.player_id = p.player_id and s.year = p.year) group by 1",
            "player_performance_analysis", "raw_salaries",
        ),
        "check_summary": _with(_summary(DECLARED_CHECKS), *MODELS),
        "check_summary_with_failures": _with(_summary(FAILING_CHECKS), *MODELS),
        "check_failures": _with(
            "\nunion all ".join(_failing_values(*check) for check in FAILING_CHECKS), *MODELS),
        "check_failing_rows": _with(
            "select 'unique_stg_salaries_player_id' as check_name, player_id, year, salary "
            "from stg_salaries where player_id in "
            "(select player_id from stg_salaries group by 1 having count(*) > 1) union all "
            "select 'accepted_values_stg_salaries_team_id', player_id, year, salary "
            "from stg_salaries where team_id not in ('TEAM1', 'TEAM2', 'TEAM3')", "stg_salaries"),
        "source_freshness":
            "select max(ts) as max_loaded_at, "
            "(epoch_us(timestamp '2024-02-01') - epoch_us(max(ts))) / 3600000000 as age_hours, "
            "case when epoch_us(timestamp '2024-02-01') - epoch_us(max(ts)) > 172800000000 "
            "then 'error' "
            "when epoch_us(timestamp '2024-02-01') - epoch_us(max(ts)) > 86400000000 then 'warn' "
            "else 'pass' end as status from events",
        "sources_freshness":
            "select source, loaded_by, age_hours, case when age_hours > 48 then 'error' "
            "when age_hours > 24 then 'warn' else 'pass' end as status from ("
            "select 'raw_players' as source, 'file' as loaded_by, null::double as age_hours union all "
            "select 'raw_teams', 'file', null union all "
            f"select 'raw_salaries', 'column', epoch(timestamp '{LOADS_AS_OF}' - max(o_orderdate)) / 3600 from orders "
            f"union all select 'raw_game_stats', 'column', epoch(timestamp '{LOADS_AS_OF}' - max(l_shipdate)) / 3600 "
            "from lineitem)",
        "view_roundtrip": _model("stg_players"),
        "permanent_view": _model("stg_players"),
        "season_rebuild": _with(
            f"select player_id, year, case when year = {REBUILT_SEASON} then salary * 2 else salary end as salary, "
            "full_name, team_name from fct_player_salaries", "fct_player_salaries"),
        "distinct_pitchers": _with(
            "select year, team_name, case when grouping(year, team_name) = 0 then 'year+team_name' "
            "when grouping(year) = 0 then 'year' when grouping(team_name) = 0 then 'team_name' else 'all' end as level, "
            "count(distinct player_id) as total_pitchers from fct_player_salaries where is_pitcher "
            "group by grouping sets ((year, team_name), (year), (team_name), ())", "fct_player_salaries"),
        "csv_quarantine": _with(
            "select player_id, year, salary, team_id, null::varchar as bad_line from raw_salaries union all "
            "select null, null, null, null, concat_ws(',', player_id, 'n/a', salary::varchar, team_id) "
            "from raw_salaries where salary % 50 = 0", "raw_salaries"),
        "pass_through": _model("stg_teams"),
        "table_export": _pay({"player_salary__league": "league", **pay_year}, payroll),
        "csv_scan": _with("select * from raw_salaries", "raw_salaries"),
        "csv_scan_games": _with(
            "select * replace (innings_pitched::double as innings_pitched) from raw_game_stats",
            "raw_game_stats"),
    }
    sql["table_exports"] = "\nunion all ".join(
        f"select '{name}' as export, {dimension} as dimension, {season} as season, "
        f"'{metric}' as metric, {metric}::double as value from ({sql[f'saved_{name}']})"
        for name, (dimension, season, metrics) in _EXPORTS.items() for metric in metrics
    )
    return sql
