"""Joins of detail rows to aggregates of themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_group_values(
    detail: DataFrame,
    groups: DataFrame,
    keys: list[str],
    open_key: str,
    values: list[str],
    how: str = "left",
) -> DataFrame:
    """Attach ``values`` of a row's group to detail rows, with nulls where a key is null.

    ``groups`` has the groups' ``keys`` and ``open_key``, which may be null in a row to be kept.

    If ``groups`` is read from files (``sinks.stage``), Spark knows its size before it plans: a small
    one is broadcast and the detail rows are not shuffled at all. Otherwise null open keys are
    what keeps a hot group from ending up in one task. They are matched too, and the values blanked
    afterwards; for such a null-safe key Spark shuffles *both* sides anew, where with plain
    equality it would reuse the partitioning an aggregate already has. A shuffle directly below
    the join is what AQE needs to split a hot group over many tasks, by measured sizes.
    """
    side = groups.withColumnRenamed(open_key, "_group_key")
    for key in keys:
        side = side.withColumnRenamed(key, f"_group_{key}")
    same = F.col(open_key).eqNullSafe(F.col("_group_key"))
    for key in keys:
        same &= F.col(key) == F.col(f"_group_{key}")
    joined = detail.join(side, same, how)
    known = F.col(open_key).isNotNull()
    blanked = {v: F.when(known, F.col(v)) for v in values}
    return joined.drop("_group_key", *(f"_group_{k}" for k in keys)).withColumns(blanked)
