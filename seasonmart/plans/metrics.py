"""Metrics over the two season fact tables, by any declared dimension."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonmart.functions.columns import millions
from seasonmart.operators.spine import Spine, running_totals

SALARIES, PERFORMANCE = "salaries", "performance"


@dataclass(frozen=True)
class Metric:
    """A named measure.

    ``kind`` is sum, average, max or count over a fact column; ratio of two other metrics; or
    cumulative, the all-time running total of another metric. ``fill`` replaces null in the result.
    """

    name: str
    label: str
    kind: str
    source: str | None = None
    column: str | None = None
    fill: int | None = None
    in_millions: bool = False
    inputs: tuple[str, ...] = ()

    @property
    def states(self) -> tuple[str, ...]:
        """What has to be known of a group of rows, in parts that can be added up."""
        match self.kind:
            case "sum":
                return (f"sum__{self.column}",)
            case "average":
                return f"sum__{self.column}", f"n__{self.column}"
            case "max":
                return (f"max__{self.column}",)
            case "count":
                return (ROWS,)
        raise ValueError(f"{self.name} is computed from other metrics")


#: The state that counts rows.
ROWS = "n__rows"


def state_of_row(state: str) -> Column:
    """A state of a single row."""
    kind, _, column = state.partition("__")
    if state == ROWS:
        return F.lit(1).cast("long")
    return F.col(column).isNotNull().cast("long") if kind == "n" else F.col(column)


def merged(states: Iterable[str]) -> list[Column]:
    """States of a group from those of its rows or parts."""
    return [(F.max(s) if s.startswith("max__") else F.sum(s)).alias(s) for s in states]


def _registry() -> dict[str, Metric]:
    # The metrics with their labels, which columns of a result carry as metadata.
    # Amounts in millions are aggregated as whole dollars and scaled once: exact, and independent
    # of row order, where a sum of fractions is neither.
    pay, play = SALARIES, PERFORMANCE

    def total(name: str, label: str, source: str = play, column: str | None = None, **more):
        return Metric(name, label, "sum", source, column or name, fill=0, **more)

    metrics = [
        total("total_salary", "Total Salary", pay, "salary"),
        Metric("average_salary", "Average Salary", "average", pay, "salary"),
        Metric("max_salary", "Max Salary", "max", pay, "salary"),
        total("total_salary_millions", "Total Salary ($M)", pay, "salary", in_millions=True),
        Metric("average_salary_millions", "Average Salary ($M)", "average", pay, "salary",
               in_millions=True),
        Metric("contract_count", "# Contracts", "count", pay, fill=0),
        Metric("cumulative_salary", "Cumulative Salary", "cumulative", inputs=("total_salary",)),
        total("total_home_runs", "Home Runs"),
        total("total_hits", "Hits"),
        total("total_runs", "Runs"),
        total("total_rbi", "RBI"),
        total("total_stolen_bases", "Stolen Bases"),
        Metric("average_batting_average", "Batting Average", "average", play,
               "season_batting_average"),
        total("total_wins", "Wins"),
        total("total_losses", "Losses"),
        total("total_saves", "Saves"),
        total("total_innings_pitched", "Innings Pitched"),
        total("total_strikeouts_pitched", "Pitcher Strikeouts"),
        Metric("average_era", "ERA", "average", play, "season_era"),
        Metric("cumulative_home_runs", "Cumulative Home Runs", "cumulative",
               inputs=("total_home_runs",)),
        Metric("win_loss_ratio", "Win/Loss Ratio", "ratio",
               inputs=("total_wins", "total_losses")),
        Metric("salary_per_home_run", "Salary per HR", "ratio",
               inputs=("total_salary", "total_home_runs")),
        Metric("salary_per_win", "Salary per Win", "ratio", inputs=("total_salary", "total_wins")),
        Metric("salary_per_hit", "Salary per Hit", "ratio", inputs=("total_salary", "total_hits")),
    ]
    return {m.name: m for m in metrics}


METRICS = _registry()


@dataclass(frozen=True)
class StoredAggregate:
    """States of one fact's measures by some dimensions, written as a table of ``rows`` rows."""

    name: str
    source: str
    dimensions: tuple[str, ...]
    table: DataFrame
    rows: int

# The model behind each source, each fact's entity with the columns declared as its
# dimensions, and the roster's.
FACT_MODELS = {SALARIES: "fct_player_salaries", PERFORMANCE: "player_performance_analysis"}
ROSTER_MODEL = "dim_roster"
FACT_ENTITIES = {SALARIES: "player_salary", PERFORMANCE: "player_season"}
FACT_DIMENSIONS = {
    SALARIES: ("team_name", "league", "division", "position", "is_pitcher"),
    PERFORMANCE: ("full_name", "position"),
}
ROSTER_ENTITY = "player"
ROSTER_DIMENSIONS = (
    "full_name", "position", "position_abbreviation", "team_name", "league", "division",
    "is_pitcher",
)
SEASON_DATE = "season_date"
# Both facts aggregate over season_date, so all three names mean the same yearly metric time.
TIME_DIMENSIONS = ("metric_time", *(f"{e}__{SEASON_DATE}" for e in FACT_ENTITIES.values()))


def _measures(names: Sequence[str]) -> list[Metric]:
    """The plain aggregates that the named metrics need, each once."""
    found: dict[str, Metric] = {}
    for name in names:
        if name not in METRICS:
            raise ValueError(f"unknown metric {name!r}")
        metric = METRICS[name]
        for m in [METRICS[i] for i in metric.inputs] or [metric]:
            found[m.name] = m
    return list(found.values())


def _roster_column(dimension: str) -> str | None:
    entity, _, column = dimension.rpartition("__")
    return column if entity == ROSTER_ENTITY else None


def _fact_column(dimension: str, source: str) -> Column:
    """A dimension's value on the rows of one fact, joined to the roster if it needs that."""
    if dimension in TIME_DIMENSIONS:
        return F.col(SEASON_DATE)
    entity, _, column = dimension.rpartition("__")
    if entity == ROSTER_ENTITY and column in ROSTER_DIMENSIONS:
        return F.col(f"roster_{column}")
    if entity == FACT_ENTITIES[source] and column in FACT_DIMENSIONS[source]:
        return F.col(column)
    raise ValueError(f"dimension {dimension!r} is not available for metrics on {source}")


def _output_name(dimension: str) -> str:
    return f"{dimension}__year" if dimension in TIME_DIMENSIONS else dimension


def canonical(dimension: str) -> str:
    """One name for each dimension: all names of the yearly time mean the same."""
    return TIME_DIMENSIONS[0] if dimension in TIME_DIMENSIONS else dimension


def state_rows(
    models: Mapping[str, DataFrame], source: str, states: Sequence[str], group_by: Sequence[str]
) -> DataFrame:
    """Rows of one fact as states, next to the group-by dimensions under their canonical names.

    If a dimension needs the roster, states are first added up per player and own dimensions:
    one row of each meets the roster, however many rows the fact has. A player who is listed twice
    still counts twice, as the states are joined to each listing.
    """
    rows = models[FACT_MODELS[source]]
    columns = {d: _fact_column(d, source).alias(canonical(d)) for d in group_by}
    roster = [c for c in map(_roster_column, group_by) if c]
    own = {canonical(d): column for d, column in columns.items() if not _roster_column(d)}
    values = [state_of_row(s).alias(s) for s in states]
    if not roster:
        return rows.select(*own.values(), *values)
    by_player = rows.select("player_id", *own.values(), *values)
    by_player = by_player.groupBy("player_id", *own).agg(*merged(states))
    attributes = models[ROSTER_MODEL].select(
        "player_id", *(F.col(c).alias(f"roster_{c}") for c in roster)
    )
    dimensions = [column if _roster_column(d) else F.col(canonical(d)) for d, column in columns.items()]
    return by_player.join(attributes, "player_id", "left").select(*dimensions, *states)


def covers(aggregate: StoredAggregate, source: str, group_by: Sequence[str]) -> bool:
    """Whether a request on a fact can be answered from an aggregate.

    It needs all dimensions, and the roster joined or not: a player who is listed twice counts
    twice only where the roster is asked for.
    """
    wanted = {canonical(d) for d in group_by}
    needs_roster = any(_roster_column(d) for d in wanted)
    has_roster = any(_roster_column(d) for d in aggregate.dimensions)
    return aggregate.source == source and needs_roster == has_roster and wanted <= {*aggregate.dimensions}


def source_rows(
    models: Mapping[str, DataFrame],
    source: str,
    states: Sequence[str],
    group_by: Sequence[str],
    aggregates: Sequence[StoredAggregate] = (),
) -> DataFrame:
    """States by dimension from the smallest stored aggregate that covers them, or from the models."""
    covering = [a for a in aggregates if covers(a, source, group_by) and {*states} <= {*a.table.columns}]
    if covering:
        smallest = min(covering, key=lambda a: (a.rows, a.name))
        return smallest.table.select(*map(canonical, group_by), *states)
    return state_rows(models, source, states, group_by)


def _of_source(state: str, source: str) -> str:
    return f"{state}__{source}"


def _from_states(metric: Metric) -> Column:
    """A plain metric from the states of its fact."""
    first, *rest = (F.col(_of_source(s, metric.source)) for s in metric.states)
    value = first.cast("double") / F.nullif(rest[0], F.lit(0)) if rest else first
    return millions(value) if metric.in_millions else value


def _widest(df: DataFrame, states: Sequence[str]) -> DataFrame:
    """Decimal sums in Spark's widest type: each adding up widens them, and there may be one or several."""
    kinds = {s: df.schema[s].dataType for s in states}
    wide = {s: T.DecimalType(38, kind.scale) for s, kind in kinds.items() if isinstance(kind, T.DecimalType)}
    return df.withColumns({s: F.col(s).cast(kind) for s, kind in wide.items()}) if wide else df


def _value(metric: Metric) -> Column:
    """A metric from the aggregated measures: nulls filled first, then ratios taken."""

    def filled(name: str) -> Column:
        fill = METRICS[name].fill
        return F.col(name) if fill is None else F.coalesce(F.col(name), F.lit(fill))

    if metric.kind != "ratio":
        return filled(metric.name)
    numerator, denominator = (filled(name).cast("double") for name in metric.inputs)
    return numerator / F.nullif(denominator, F.lit(0.0))


def metric_query(
    models: Mapping[str, DataFrame],
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    spine: Spine = Spine(),
    aggregates: Sequence[StoredAggregate] = (),
) -> DataFrame:
    """Metrics by dimensions, one row per combination found in any of the facts involved.

    ``models`` holds the two facts and the roster by model name, as ``build`` returns them.
    Dimensions are named ``entity__column``; the yearly time is ``metric_time`` or the
    ``season_date`` of either fact and comes out as ``<name>__year``. ``aggregates`` are stored
    parts of answers, see ``seasonmart.plans.aggregates``: each fact is read from the smallest
    one that covers the request, and from its model only if none does.

    Rows of both facts go into a single aggregation, each with nulls for the other's measures.
    That equals aggregating the facts apart and joining the results in full on null-safe keys, but
    shuffles partial aggregates only, once, and has no join a hot group could end up in.
    """
    measures = _measures(metrics)
    wanted = [METRICS[name] for name in metrics]
    keys = [_output_name(d) for d in group_by]
    times = [_output_name(d) for d in group_by if d in TIME_DIMENSIONS]
    if not wanted or len({*metrics}) < len(metrics):
        raise ValueError("metrics must be given, each once")
    if len({*keys}) < len(keys) or len(times) > 1:
        raise ValueError("a dimension is grouped by twice")
    parts, states = [], []
    for source in FACT_ENTITIES:
        own = list(dict.fromkeys(s for m in measures if m.source == source for s in m.states))
        if own:
            # Both facts have rows to count and a salary: their states keep apart by the fact's name.
            part = source_rows(models, source, own, group_by, aggregates)
            parts.append(part.select(
                *(F.col(canonical(d)).alias(k) for d, k in zip(group_by, keys)),
                *(F.col(s).alias(_of_source(s, source)) for s in own),
            ))
            states += [_of_source(s, source) for s in own]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    added = _widest(rows.groupBy(*keys).agg(*merged(states)), states)
    totals = added.select(*keys, *(_from_states(m).alias(m.name) for m in measures))
    running = {m.name: m.inputs[0] for m in wanted if m.kind == "cumulative"}
    if running and not times:
        # The running total over all time, asked for without a time, is the total.
        totals = totals.withColumns({name: F.col(value) for name, value in running.items()})
    elif running:
        others = [k for k in keys if k not in times]
        cumulative = running_totals(totals, times[0], others, running, spine)
        if len(running) == len(wanted):
            return cumulative.select(
                *keys, *(F.col(m.name).alias(m.name, metadata={"label": m.label}) for m in wanted)
            )
        totals = (
            totals.unionByName(cumulative, allowMissingColumns=True)
            .groupBy(*keys)
            .agg(
                *(
                    F.any_value(name, ignoreNulls=True).alias(name)
                    for name in [*(m.name for m in measures), *running]
                )
            )
        )
    return totals.select(
        *keys, *(_value(m).alias(m.name, metadata={"label": m.label}) for m in wanted)
    )
