"""Data checks. Each returns what violates it; none fails the run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIQUE, NOT_NULL = "unique", "not_null"
ACCEPTED_VALUES, RELATIONSHIPS = "accepted_values", "relationships"


@dataclass(frozen=True)
class Check:
    """A declared check on one column; ``parent`` is (model, column) of the key referred to."""

    model: str
    column: str
    kind: str
    values: tuple = ()
    parent: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"

    @property
    def by_row(self) -> bool:
        """Whether a row fails or passes by itself, whatever other rows hold."""
        return self.kind in (NOT_NULL, ACCEPTED_VALUES)


def row_fails(check: Check) -> Column:
    """For checks by row: whether a row violates one; null where it has no say."""
    column = F.col(check.column)
    return column.isNull() if check.kind == NOT_NULL else ~column.isin(list(check.values))


def failing_row_count(check: Check) -> Column:
    return F.count(F.when(row_fails(check), 1))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def _value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values found on more than one row, with their row count; nulls are not compared."""
    known = df.where(F.col(column).isNotNull())
    return _value_counts(known, column).where(F.col("n_records") > 1)


def unexpected_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list, with their row count; nulls pass."""
    return _value_counts(df.where(~F.col(column).isin(list(values))), column)


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Values without a parent, with their row count; nulls pass.

    Child rows are counted per value before the join, so the shuffle carries each value once per
    task however many rows refer to it.
    """
    known = child.where(F.col(column).isNotNull())
    keys = parent.select(F.col(parent_column).alias("value"))
    return _value_counts(known, column).join(keys, "value", "left_anti")


def failing_rows(models: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """The rows of a model that violate a check, with all their columns."""
    df = models[check.model]
    if check.by_row:
        return df.where(row_fails(check))
    if check.kind == UNIQUE:
        values = repeated_values(df, check.column)
    else:
        model, parent_column = check.parent
        values = orphans(df, check.column, models[model], parent_column)
    return df.join(values.select(F.col("value").alias(check.column)), check.column, "left_semi")


def tagged_rows(df: DataFrame, checks: Sequence[Check], failures: DataFrame) -> DataFrame:
    """The rows of one model that violate checks, once for each, with the check's name as ``check_name``.

    The model is read once, whatever the number of checks. Rows that fail for the sake of others
    (repeated values, missing parents) are known by their value from ``failures``, the outcome of
    ``check_failures``.
    """
    mark = "failing_value_of_"
    found = []
    for i, check in enumerate(checks):
        if check.by_row:
            fails = row_fails(check)
        else:
            values = failures.where(F.col("check_name") == check.name).select(F.col("value").alias(f"{mark}{i}"))
            df = df.join(values, F.col(check.column).cast("string") == F.col(f"{mark}{i}"), "left")
            fails = F.col(f"{mark}{i}").isNotNull()
        found.append(F.when(fails, check.name))
    columns = [c for c in df.columns if not c.startswith(mark)]
    # A row without a failing check unnests to nothing.
    return df.select(*columns, F.explode(F.array_compact(F.array(*found))).alias("check_name"))


def _observation(check: Check) -> Column:
    """What a row has to say about a check, or null if nothing."""
    column = F.col(check.column)
    concerned = row_fails(check) if check.by_row else column.isNotNull()
    entry = F.struct(
        F.lit(check.name).alias("check_name"), column.cast("string").alias("value")
    )
    return F.when(concerned, entry)


def _observations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Value counts of all checks of one model from a single pass over it.

    Nulls are dropped after unnesting: doing it inside the array takes a lambda, which runs outside
    generated code and more than doubles the time.
    """
    return (
        df.select(F.inline(F.array(*map(_observation, checks))))
        .where(F.col("check_name").isNotNull())
        .groupBy("check_name", "value")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def _parent_keys(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """The keys that relationships checks refer to, each labelled with its (model, column)."""
    return reduce(
        DataFrame.union,
        (
            models[model]
            .select(F.lit(f"{model}.{column}").alias("parent"),
                    F.col(column).cast("string").alias("value"))
            .distinct()
            .withColumn("has_parent", F.lit(True))
            for model, column in dict.fromkeys(c.parent for c in checks)
        ),
    )


def check_failures(
    models: Mapping[str, DataFrame], checks: Sequence[Check], observed: Mapping[str, int] | None = None
) -> DataFrame:
    """Failing values of many checks with their row counts: (check_name, value, n_records).

    Every model is read once, however many checks it has, and its rows are counted per check and
    value before anything is shuffled. ``observed`` has the failing rows of checks that were
    counted while the models were written: those without any are not looked into again, nor are
    nulls, all of one value; only which values are not accepted takes another look.
    """
    observed = observed or {}
    known = [c for c in checks if c.name in observed and (not observed[c.name] or c.kind == NOT_NULL)]
    nulls = [(c.name, None, observed[c.name]) for c in known if observed[c.name]]
    checks = [c for c in checks if c not in known]
    counted = None
    if known:
        spark = models[known[0].model].sparkSession
        counted = spark.createDataFrame(nulls, "check_name string, value string, n_records long")
    if not checks:
        return counted
    failures = _failures_from_models(models, checks)
    return failures if counted is None else failures.union(counted)


def _failures_from_models(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    by_model: dict[str, list[Check]] = {}
    for check in checks:
        by_model.setdefault(check.model, []).append(check)
    seen = reduce(
        DataFrame.union, (_observations(models[m], own) for m, own in by_model.items())
    )

    def of_kind(*kinds: str) -> Column:
        return F.col("check_name").isin([c.name for c in checks if c.kind in kinds])

    failing = of_kind(NOT_NULL, ACCEPTED_VALUES) | of_kind(UNIQUE) & (F.col("n_records") > 1)
    referring = [c for c in checks if c.kind == RELATIONSHIPS]
    if referring:
        parent = F.lit(None).cast("string")
        for model, column in dict.fromkeys(c.parent for c in referring):
            names = [c.name for c in referring if c.parent == (model, column)]
            own = F.col("check_name").isin(names)
            parent = F.when(own, F.lit(f"{model}.{column}")).otherwise(parent)
        seen = seen.withColumn("parent", parent).join(
            _parent_keys(models, referring), ["parent", "value"], "left"
        )
        failing |= F.col("parent").isNotNull() & F.col("has_parent").isNull()
    return seen.where(failing).select("check_name", "value", "n_records")


def check_summary(failures: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: the number of failures and ``pass`` or ``warn``.

    unique and accepted_values count failing values, not_null and relationships failing rows.
    """
    spark = failures.sparkSession
    declared = spark.createDataFrame(
        [(c.name, c.model, c.column, c.kind) for c in checks],
        "check_name string, model string, column_name string, kind string",
    )
    counted = failures.groupBy("check_name").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("n_records").alias("n_rows")
    )
    by_value = F.col("kind").isin(UNIQUE, ACCEPTED_VALUES)
    found = F.when(by_value, F.col("n_values")).otherwise(F.col("n_rows"))
    return declared.join(counted, "check_name", "left").select(
        *declared.columns,
        F.coalesce(found, F.lit(0)).alias("failures"),
        F.when(found > 0, "warn").otherwise("pass").alias("status"),
    )


def source_freshness(
    source: DataFrame,
    loaded_at: str,
    as_of: dt.datetime | None = None,
    warn_hours: int = 24,
    error_hours: int = 48,
) -> DataFrame:
    """Age of the newest row and its verdict: ``pass``, ``warn``, ``error``.

    A source without rows has no age and counts as stale.
    """
    # A literal would turn a naive time into an instant of the Python process's time zone; text is
    # read in the session's, like a source column without a zone.
    now = F.current_timestamp() if as_of is None else F.lit(as_of.isoformat()).cast("timestamp")
    newest = source.agg(F.max(loaded_at).alias("max_loaded_at"))
    loaded = F.col("max_loaded_at").cast("timestamp")
    age = F.unix_micros(now) - F.unix_micros(loaded)

    def older_than(hours: int) -> Column:
        return F.col("age_micros") > hours * 3_600_000_000

    return newest.withColumn("age_micros", age).select(
        "max_loaded_at",
        (F.col("age_micros") / 3_600_000_000).alias("age_hours"),
        F.when(F.col("age_micros").isNull() | older_than(error_hours), "error")
        .when(older_than(warn_hours), "warn")
        .otherwise("pass")
        .alias("status"),
    )
