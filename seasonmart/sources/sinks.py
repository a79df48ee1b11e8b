"""Publishing results: views, tables, exports, stored check failures, staged intermediates."""

from __future__ import annotations

import atexit
import functools
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The schema of each model layer.
LAYER_SCHEMAS = {"staging": "staging", "intermediate": "intermediate", "marts": "mart"}
EXPORT_SCHEMA = "mart"
CHECK_SCHEMA = "checks"

Materialize = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Target:
    """Where tables go.

    In production every layer has a schema of its own; any other environment puts all of them into
    the one schema of that environment. ``folder`` places table files outside the warehouse
    directory.
    """

    name: str = "dev"
    schema: str = "default"
    folder: str | None = None

    def schema_for(self, custom: str | None) -> str:
        if self.name == "prod" and custom:
            return custom.strip()
        return self.schema

    def table_name(self, custom: str | None, name: str) -> str:
        return f"{self.schema_for(custom)}.{name}"


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A view of this session: Spark can keep a view beyond it for SQL text only, not a DataFrame.

    ``seasonmart.plans.views`` has the staging models as text.
    """
    df.createOrReplaceTempView(name)
    return df


def publish_table(
    df: DataFrame,
    name: str,
    target: Target = Target(),
    custom_schema: str | None = None,
    bucket_by: str | None = None,
    buckets: int = 0,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Rebuild a table in full and return it as read back.

    Rows are written to a folder of their own, a version of the table, and the catalog is switched
    to it when all of them are there: whoever reads the table meanwhile gets the rows before or
    after, and a write that fails changes nothing. The version before is kept for readers that
    have begun, older ones are deleted. A table whose columns, buckets or partitions change, and
    any table with partitions, is switched by dropping the old entry and renaming the new one.

    Files follow the partitions of the last shuffle, which AQE merges to its advisory size and, in
    a skewed join, splits. A later join on ``bucket_by`` between tables with the same number of
    buckets needs no shuffle.
    """
    spark = df.sparkSession
    schema, full_name = target.schema_for(custom_schema), target.table_name(custom_schema, name)
    if schema != "default":
        spark.sql(f"create database if not exists `{schema}`")
    folder = f"{target.folder}/{schema}" if target.folder else spark.catalog.getDatabase(schema).locationUri
    version = f"v-{uuid.uuid4().hex}"
    path, new_name = f"{folder}/{name}/{version}", f"{full_name}__{version[2:]}"
    writer = df.write.format("parquet").option("path", path)
    if buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(new_name)
    except BaseException:
        spark.sql(f"drop table if exists {new_name}")
        remove(spark, path)
        raise
    before = switch_table(spark, full_name, new_name)
    for old in folders(spark, f"{folder}/{name}"):
        if old.startswith("v-") and old != version and not (before or "").endswith(old):
            remove(spark, f"{folder}/{name}/{old}")
    return spark.table(full_name)


def publish_seasons(
    df: DataFrame,
    name: str,
    seasons: Sequence[int],
    target: Target = Target(),
    custom_schema: str | None = None,
    season: str = "year",
) -> DataFrame:
    """Replace some seasons of a table that is partitioned by season; files of other seasons stay as they are.

    ``df`` has the rows of those seasons. One that has no rows any more loses its partition. A
    season changes as a whole, but seasons change one after the other.
    """
    spark, table = df.sparkSession, target.table_name(custom_schema, name)
    place = table_location(spark, table)
    rows = stage(df.where(F.col(season).isin(list(seasons))).select(*spark.table(table).columns), f"{name}_seasons")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(season).parquet(place)
    found = {r[season] for r in rows.select(season).distinct().collect()}  # at most the seasons asked for
    for gone in {*seasons} - found:
        spark.sql(f"alter table {table} drop if exists partition ({season} = {int(gone)})")
        remove(spark, f"{place}/{season}={int(gone)}")
    spark.sql(f"alter table {table} recover partitions")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _definition(spark: SparkSession, name: str) -> tuple[list, str | None]:
    """What has to be equal for a table to change its place only, and that place."""
    rows = spark.sql(f"describe extended {name}").collect()  # a row per column and property
    properties = {r.col_name: r.data_type for r in rows}
    same = [properties.get(p) for p in ("Num Buckets", "Bucket Columns", "Sort Columns")]
    columns = [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(name)]
    return [columns, same], properties.get("Location")


def table_location(spark: SparkSession, name: str) -> str:
    """Where the files of a table lie now."""
    return _definition(spark, name)[1]


def switch_table(spark: SparkSession, name: str, new_name: str) -> str | None:
    """Let ``name`` stand for the files of the table ``new_name``, whose entry goes; the place before, if any."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"alter table {new_name} rename to {name}")
        return None
    (before, old_place), (after, new_place) = _definition(spark, name), _definition(spark, new_name)
    if before == after and not any(is_partition for *_, is_partition in after[0]):
        spark.sql(f"alter table {name} set location '{new_place}'")
        spark.sql(f"drop table {new_name}")
    else:
        spark.sql(f"drop table {name}")
        spark.sql(f"alter table {new_name} rename to {name}")
    spark.catalog.refreshTable(name)
    return old_place


@contextmanager
def own_target(spark: SparkSession, name: str) -> Iterator[Target]:
    """A schema and folder that nobody else uses, both dropped when the ``with`` block ends."""
    schema, folder = f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name)
    try:
        yield Target(schema=schema, folder=folder)
    finally:
        spark.sql(f"drop database if exists `{schema}` cascade")
        remove(spark, folder)


@functools.cache
def _release_at_exit(application: str) -> None:
    atexit.register(_release_active)


def _release_active() -> None:
    spark = SparkSession.getActiveSession()
    if spark and spark.sparkContext._jsc:
        release(spark)
        remove(spark, _kept_folder(spark))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``; without that setting it is the warehouse
    directory, which executors write tables to as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    application = spark.sparkContext.applicationId
    _release_at_exit(application)
    return f"{folder.rstrip('/')}/seasonmart/{application}"


def _kept_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}-kept"


def keep(df: DataFrame, group: str, name: str) -> DataFrame:
    """Write a table that later queries of this application find again with ``kept``."""
    path = f"{_kept_folder(df.sparkSession)}/{group}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_kept(spark: SparkSession, group: str, name: str) -> bool:
    return exists(spark, f"{_kept_folder(spark)}/{group}/{name}/_SUCCESS")


def kept(spark: SparkSession, group: str, names: Sequence[str]) -> dict[str, DataFrame] | None:
    """The tables of a group that were written with ``keep``, or None unless all of them are there."""
    folder = f"{_kept_folder(spark)}/{group}"
    if not all(is_kept(spark, group, name) for name in names):
        return None
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    """A path and the store that it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    store, target = _located(spark, path)
    store.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _located(spark, path)
    return store.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder."""
    store, target = _located(spark, path)
    return [entry.getPath().getName() for entry in store.listStatus(target)] if store.exists(target) else []


def files(spark: SparkSession, path: str) -> Iterator[tuple[str, int, int]]:
    """Path, size and time of change (milliseconds) of each file under a path."""
    store, target = _located(spark, path)
    found = store.listFiles(target, True)
    while found.hasNext():
        file = found.next()
        yield file.getPath().toString(), file.getLen(), file.getModificationTime()


def release(spark: SparkSession) -> None:
    """Delete all that this application has staged; call it once results have been written.

    It also happens when the driver's Python ends.
    """
    remove(spark, shared_folder(spark))


class Scratch:
    """Staged tables of one computation, deleted when the ``with`` block ends.

    What a result still reads after the block is staged with ``stage`` instead.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, scratch_path(spark, name)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        remove(self.spark, f"{self.folder}/{name}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.folder)


def lazy(df: DataFrame, name: str) -> DataFrame:
    """The alternative to ``stage``: leave the DataFrame part of the plan it is used in."""
    return df


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame that several branches of a plan need, and read it back.

    Cuts the lineage with files every executor can reach, so the branches neither recompute the
    input nor lose it with an executor. Unlike ``checkpoint`` the copy is columnar, and its size is
    known before the next plan is made: Spark broadcasts it in a join if that is below its
    threshold, and only then.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
