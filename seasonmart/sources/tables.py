"""Raw table readers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonmart.sources.schemas import RAW_SCHEMAS
from seasonmart.sources.sinks import files, scratch_path


@dataclass(frozen=True)
class RawTables:
    """The four inputs every model starts from."""

    players: DataFrame
    teams: DataFrame
    salaries: DataFrame
    game_stats: DataFrame


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A CSV with a header line, read with the table's fixed types.

    The header is compared with the schema, and a value that does not parse stops the load
    instead of turning into a null.
    """
    return (
        spark.read.schema(RAW_SCHEMAS[table])
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


CORRUPT = "_corrupt_record"


class TooManyBadLines(ValueError):
    """A load was given up: more lines than allowed do not fit the table's types."""


@dataclass(frozen=True)
class Loaded:
    """``rows``: lines that fit the types. ``quarantine``: the others, as (file, line)."""

    rows: DataFrame
    quarantine: DataFrame


def load_csv(spark: SparkSession, path: str, table: str, max_bad_share: float = 0.01, name: str | None = None) -> Loaded:
    """A CSV with a header line, its bad lines set apart instead of ending the load.

    A line is bad if it has too few or too many fields, or one that does not parse. All columns
    are parsed in one pass and written, good and bad lines in folders of their own, so neither is
    parsed again. More bad lines than ``max_bad_share`` of all raise ``TooManyBadLines``; the lines
    are then still there to be looked at, in its ``loaded``.
    """
    schema = RAW_SCHEMAS[table]
    parsed = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
    folder = scratch_path(spark, name or f"load_{table}")
    bad = F.col(CORRUPT).isNotNull()
    parsed.select("*", F.col("_metadata.file_path").alias("_file"), bad.alias("_bad")).write.partitionBy("_bad").parquet(folder)
    staged = spark.read.schema(f"{schema.toDDL()}, {CORRUPT} string, _file string, _bad boolean").parquet(folder)
    loaded = Loaded(
        staged.where("not _bad").select(*schema.names),
        staged.where("_bad").select(F.col("_file").alias("file"), F.col(CORRUPT).alias("line")),
    )
    n_bad, n_all = loaded.quarantine.count(), staged.count()
    if n_bad > max_bad_share * n_all:
        error = TooManyBadLines(f"{n_bad} of {n_all} lines of {path} are bad")
        error.loaded = loaded
        raise error
    return loaded


def csv_tables(spark: SparkSession, folder: str) -> RawTables:
    return RawTables(*(read_csv(spark, f"{folder}/{name}.csv", name) for name in RAW_SCHEMAS))


def parquet_tables(spark: SparkSession, folder: str) -> RawTables:
    return RawTables(
        *(spark.read.schema(s).parquet(f"{folder}/{name}") for name, s in RAW_SCHEMAS.items())
    )


def catalog_tables(spark: SparkSession, schema: str = "raw") -> RawTables:
    return RawTables(*(spark.table(f"{schema}.{name}") for name in RAW_SCHEMAS))


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """A name for the state of some tables, from their files' names, sizes and times; no data is read."""
    state = hashlib.sha256()
    for path in paths:
        for file in sorted(files(spark, path)):
            state.update(repr(file).encode())
    return state.hexdigest()
