"""The four raw baseball tables, derived from a retail star schema.

Lets every model run on any scale of the customer / supplier / orders / lineitem test tables:
a customer is a player, a supplier a team, a customer's orders of a year the salary of a season,
and an order line one game of a player. One position in nine is the pitcher. Lines ship later than
they are ordered, so there are seasons with games and no salary, and the reverse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonmart.functions.columns import POSITION_CODES
from seasonmart.sources.declared import Source
from seasonmart.sources.tables import RawTables


# The columns used of each table. Naming them saves the pass that infers a schema.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, "
              "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_shipdate timestamp_ntz",
}


def _path(folder: str, name: str) -> str:
    return f"{folder}/{name}.parquet"


def paths(folder: str) -> list[str]:
    """Where the tables lie that the raw tables are derived from."""
    return [_path(folder, name) for name in _COLUMNS]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(_path(folder, name))


def _label(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _side(condition: Column) -> Column:
    return F.when(condition, "Left").otherwise("Right")


def players(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    position = F.when(key % 9 == 0, "Pitcher")
    for rest, name in enumerate(list(POSITION_CODES)[1:], start=1):
        position = position.when(key % 9 == rest, name)
    return _table(spark, folder, "customer").select(
        _label("P", key).alias("player_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        position.alias("position"),
        F.date_add(F.lit("1985-01-01").cast("date"), (key % 3650).cast("int")).alias("birth_date"),
        (key % 8 + 70).cast("int").alias("height"),
        (key % 46 + 180).cast("int").alias("weight"),
        _side(key % 3 == 0).alias("throws"),
        _side(key % 4 == 0).alias("bats"),
    )


def teams(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    nations = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        _table(spark, folder, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _label("TEAM", key + 1).alias("team_id"),
            F.col("s_name").alias("team_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.when(key % 2 == 0, "National").otherwise("American").alias("league"),
            F.when(key % 3 == 0, "Central").when(key % 3 == 1, "West").otherwise("East")
            .alias("division"),
        )
    )


def salaries(spark: SparkSession, folder: str) -> DataFrame:
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
    return (
        _table(spark, folder, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(cents.alias("cents"))
        .select(
            _label("P", F.col("o_custkey")).alias("player_id"),
            "year",
            F.expr("cents div 100").alias("salary"),
            _label("TEAM", F.col("o_custkey") % 10 + 1).alias("team_id"),
        )
    )


def game_stats(spark: SparkSession, folder: str) -> DataFrame:
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = _table(spark, folder, "lineitem")
    quantity = F.col("l_quantity").cast("int")
    games = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("G"), "l_orderkey", F.lit("_"), "l_linenumber").alias("game_id"),
        _label("P", F.col("o_custkey")).alias("player_id"),
        F.col("l_shipdate").cast("date").alias("game_date"),
        _label("TEAM", F.col("l_suppkey") + 1).alias("opponent_team_id"),
        (F.col("o_custkey") % 9 == 0).alias("pitching"),
        quantity.alias("q"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").cast("int").alias("pk"),
    )
    q, ln, pk, pitching = (F.col(c) for c in ("q", "ln", "pk", "pitching"))

    def batter(value: Column) -> Column:
        return F.when(pitching, F.lit(0)).otherwise(value)

    def pitcher(value: Column) -> Column:
        return F.when(pitching, value).otherwise(F.lit(0))

    def with_hit(value: Column) -> Column:
        return F.when(F.col("hits") > 0, value).otherwise(F.lit(0))

    def one_if(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0))

    innings = (q % 10).cast("decimal(4,1)") + (ln % 3).cast("decimal(4,1)") / F.lit(10)
    return (
        games.withColumn("at_bats", batter(q % 6))
        .withColumn("hits", batter(F.least(q % 6, pk % 4)))
        .select(
            "game_id", "player_id", "game_date", "opponent_team_id", "at_bats", "hits",
            with_hit(ln % 3).alias("runs"),
            with_hit(one_if(pk % 7 == 0)).alias("home_runs"),
            with_hit(pk % 3).alias("rbi"),
            with_hit(one_if(pk % 5 == 0)).alias("stolen_bases"),
            batter(ln % 2).alias("walks"),
            (F.col("at_bats") - F.col("hits")).alias("strikeouts"),
            pitcher(innings).cast("decimal(4,1)").alias("innings_pitched"),
            pitcher(q % 6).alias("earned_runs"),
            pitcher(pk % 9).alias("hits_allowed"),
            pitcher(ln % 4).alias("walks_allowed"),
            pitcher(q % 11).alias("strikeouts_pitched"),
            one_if(pitching & (q % 6 <= 2)).alias("win"),
            one_if(pitching & (q % 6 >= 4)).alias("loss"),
            one_if(pitching & (pk % 13 == 0)).alias("save"),
        )
    )


# Of the retail tables only orders and their lines are dated; the others go by their files.
DECLARED_SOURCES = (
    Source("raw_players"),
    Source("raw_teams"),
    Source("raw_salaries", "o_orderdate"),
    Source("raw_game_stats", "l_shipdate"),
)


def sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The table that each raw source is loaded from."""
    origins = {"raw_players": "customer", "raw_teams": "supplier", "raw_salaries": "orders", "raw_game_stats": "lineitem"}
    return {name: _table(spark, folder, origin) for name, origin in origins.items()}


def raw_tables(spark: SparkSession, folder: str) -> RawTables:
    return RawTables(
        players(spark, folder),
        teams(spark, folder),
        salaries(spark, folder),
        game_stats(spark, folder),
    )


def last_game(spark: SparkSession, folder: str) -> DataFrame:
    """The date of the last game, in one row; every order line is a game, so no join is needed."""
    lines = _table(spark, folder, "lineitem")
    return lines.agg(F.max("l_shipdate").cast("date").alias("last_game"))
