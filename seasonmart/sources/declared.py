"""The declared raw sources and how fresh they have to be."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonmart.operators.checks import source_freshness
from seasonmart.sources.schemas import RAW_SCHEMAS

FILE_TIME = "_metadata.file_modification_time"


@dataclass(frozen=True)
class Source:
    """A raw table with its freshness rule; without a column of load times, the times of its files count."""

    name: str
    loaded_at: str | None = None
    warn_hours: int = 24
    error_hours: int = 48


# All four raw tables are declared, with one rule.
DECLARED_SOURCES = tuple(Source(name) for name in RAW_SCHEMAS)


def sources_freshness(
    tables: Mapping[str, DataFrame],
    sources: tuple[Source, ...] = DECLARED_SOURCES,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """One row per declared source: source, loaded_by (column or file), max_loaded_at, age_hours, status.

    ``tables`` has each source as it is read from files or the catalog. File times come with the
    rows as hidden columns, so a scan for them reads no data column. A source without rows has no
    age and counts as stale.
    """

    def row(source: Source) -> DataFrame:
        loaded_at = F.col(source.loaded_at or FILE_TIME).cast("timestamp").alias("loaded_at")
        found = source_freshness(
            tables[source.name].select(loaded_at), "loaded_at", as_of, source.warn_hours, source.error_hours
        )
        loaded_by = F.lit("column" if source.loaded_at else "file").alias("loaded_by")
        return found.select(F.lit(source.name).alias("source"), loaded_by, "*")

    return reduce(DataFrame.union, map(row, sources))
