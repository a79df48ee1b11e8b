import os
import sys
from pathlib import Path

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import pytest

from seasonmart.session import local_session
from seasonmart.sources.schemas import RAW_SCHEMAS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "tests",
        memory="4g",
        **{
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Make a raw table from rows that name only the columns a test is about."""
    base = {
        "raw_players": {
            "player_id": "A", "first_name": "Ann", "last_name": "Lee", "position": "Catcher",
        },
        "raw_teams": {
            "team_id": "TEAM1", "team_name": "Owls", "city": "Rome", "state": "NY",
            "league": "National", "division": "East",
        },
        "raw_salaries": {"player_id": "A", "year": 2020, "salary": 1000, "team_id": "TEAM1"},
        "raw_game_stats": {
            "game_id": "G", "player_id": "A",
            **{f.name: 0 for f in RAW_SCHEMAS["raw_game_stats"].fields[4:]},
        },
    }

    def make(table, *rows):
        schema = RAW_SCHEMAS[table]
        values = [{**base[table], **row} for row in rows]
        return spark.createDataFrame(
            [tuple(_typed(v.get(f.name), f) for f in schema.fields) for v in values], schema
        )

    return make


def _typed(value, field):
    import datetime as dt
    from decimal import Decimal

    if value is None:
        return None
    if field.dataType.typeName() == "decimal":
        return Decimal(str(value))
    if field.dataType.typeName() == "date" and isinstance(value, str):
        return dt.date.fromisoformat(value)
    return value


def rows(df, *columns):
    """The rows as a sorted list of tuples; nulls sort last."""
    found = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in found.collect()), key=lambda r: [(v is None, str(v)) for v in r])
