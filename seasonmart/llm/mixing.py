"""Operator 4: sample documents so that sources, languages and topics get their target shares."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import fresh, text_or_empty

#: Stands for all values of a dimension that no target names, null included.
OTHERS = "*"
#: As a target: the class keeps its share of all tokens, however little that is.
OBSERVED = None
MAX_ROUNDS, TOLERANCE = 2000, 1e-10
#: Rounds of raking with probabilities bounded by 1, and the share by which a margin may be off.
MAX_BOUNDED_ROUNDS, BOUNDED_TOLERANCE = 300, 1e-9
#: The targets' classes may not give more combinations than this.
MAX_CELLS = 100_000

Targets = Mapping[str, Mapping[str, float | None]]


def n_tokens(text: str) -> Column:
    """Words of a text, as a measure of its tokens: spaces and line feeds plus one, 0 if empty."""
    value = text_or_empty(text)
    breaks = F.lit(0)
    for mark in (" ", "\n"):
        breaks += F.octet_length(value) - F.octet_length(F.replace(value, F.lit(mark), F.lit("")))
    return F.when(value == "", 0).otherwise(breaks + 1).cast("long")


def topic(text: str) -> Column:
    """A coarse topic by marks in the text: 'legal', 'contact', 'empty' or 'prose'."""
    value = text_or_empty(text)

    def has(*marks: str) -> Column:
        return reduce(lambda a, b: a | b, (value.contains(mark) for mark in marks))

    return (
        F.when(F.trim(value) == "", "empty")
        .when(has("icense", "icence", "opyright", "ights reserved"), "legal")
        .when(has("@", "http://", "https://"), "contact")
        .otherwise("prose")
    )


def rake(observed: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """A factor for each cell that gives the table the target shares in every dimension.

    Iterative proportional fitting: the table is scaled to one dimension's targets after the
    other until nothing changes. Classes without any observed weight drop out of their
    dimension's targets. Empty cells get the factor 0.
    """
    fitted = observed / max(observed.sum(), 1e-300)
    axes = range(observed.ndim)
    wanted = []
    for axis, target in zip(axes, targets):
        there = observed.sum(axis=tuple(a for a in axes if a != axis)) > 0
        target = np.where(there, target, 0.0)
        wanted.append(target / max(target.sum(), 1e-300))
    for _ in range(MAX_ROUNDS):
        before = fitted
        for axis, target in zip(axes, wanted):
            now = fitted.sum(axis=tuple(a for a in axes if a != axis))
            step = np.divide(target, now, out=np.zeros_like(target), where=now > 0)
            fitted = fitted * step.reshape([-1 if a == axis else 1 for a in axes])
        if np.abs(fitted - before).max(initial=0) < TOLERANCE:
            break
    total = observed.sum()
    return np.divide(fitted * total, observed, out=np.zeros_like(fitted), where=observed > 0)


def wanted_shares(tokens: np.ndarray, target: list[float | None]) -> np.ndarray:
    """Shares of a dimension's classes: ``OBSERVED`` ones have their part of ``tokens``, others divide the rest."""
    named = np.array([0.0 if t is OBSERVED or n <= 0 else float(t) for t, n in zip(target, tokens)])
    own = np.array([n if t is OBSERVED else 0.0 for t, n in zip(target, tokens)]) / max(tokens.sum(), 1e-300)
    return own + (1 - own.sum()) * named / max(named.sum(), 1e-300)


def _margin(table: np.ndarray, axis: int) -> np.ndarray:
    return table.sum(axis=tuple(a for a in range(table.ndim) if a != axis))


def reachable(capacity: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Targets that classes can hold: what exceeds a class's capacity goes to the others, by their targets."""
    found, free = np.minimum(wanted, capacity), wanted.copy()
    for _ in range(len(wanted)):
        missing = wanted.sum() - found.sum()
        free = np.where(found < capacity, wanted, 0.0)
        if missing <= 0 or free.sum() <= 0:
            break
        found = np.minimum(found + missing * free / free.sum(), capacity)
    return found


def _scales(observed: np.ndarray, factors: np.ndarray, axis: int, target: np.ndarray) -> np.ndarray:
    """For each class of a dimension, what its factors are multiplied by to expect the target's tokens."""
    shape = [-1 if a == axis else 1 for a in range(observed.ndim)]
    low, high = np.full(len(target), -60.0), np.full(len(target), 60.0)
    for _ in range(60):
        middle = (low + high) / 2
        enough = _margin(observed * np.minimum(1, factors * np.exp(middle).reshape(shape)), axis) >= target
        low, high = np.where(enough, low, middle), np.where(enough, middle, high)
    return np.exp(high)


def probabilities(
    observed: np.ndarray, factors: np.ndarray, keep_share: float | None, shares: list[np.ndarray] | None = None
) -> np.ndarray:
    """Each cell's sampling probability, from its raking factor.

    Without ``keep_share`` the scale is the largest that keeps all of them at 1 or below, so that
    expected shares equal the targets. With it, this share of all tokens is expected, and a
    probability that would exceed 1 stays at 1. The cells below 1 are then raked again with those
    at 1 as they are, dimension after dimension, until the margins in ``shares`` are met. Where a
    class has too few tokens, or the cells left cannot balance each other, the margins are as near
    as they get and a warning names the largest miss.
    """
    most = factors.max(initial=0)
    if most <= 0:
        return np.zeros_like(factors)
    if keep_share is None:
        return np.minimum(1, factors / most)
    budget = keep_share * observed.sum()
    fitted = factors / most
    targets = [
        reachable(_margin(np.where(factors > 0, observed, 0), axis), budget * share / max(share.sum(), 1e-300))
        for axis, share in enumerate(shares or [])
    ]
    miss, before = 0.0, math.inf
    for turn in range(MAX_BOUNDED_ROUNDS if targets else 0):
        for axis, target in enumerate(targets):
            step = _scales(observed, fitted, axis, target)
            fitted = np.minimum(fitted * step.reshape([-1 if a == axis else 1 for a in range(observed.ndim)]), 1e6)
        kept = observed * np.minimum(1, fitted)
        miss = max(float(np.abs(_margin(kept, axis) - t).max()) for axis, t in enumerate(targets)) / max(budget, 1e-300)
        # Where margins contradict each other, rounds soon change nothing any more.
        stuck = turn % 20 == 19 and miss > 0.99 * before
        if miss < BOUNDED_TOLERANCE or stuck:
            break
        before = miss if turn % 20 == 19 else before
    wanted = [budget * share / max(share.sum(), 1e-300) for share in shares or []]
    short = max((float(np.abs(t - w).max()) / max(budget, 1e-300) for t, w in zip(targets, wanted)), default=0.0)
    if max(miss, short) > 1e-3:
        warnings.warn(f"target shares are missed by up to {max(miss, short):.4f}: some classes have too few tokens", stacklevel=3)
    low, high = 0.0, 1.0 / fitted[fitted > 0].min()
    for _ in range(200):
        middle = (low + high) / 2
        enough = (observed * np.minimum(1, fitted * middle)).sum() >= budget
        low, high = (low, middle) if enough else (middle, high)
    return np.minimum(1, fitted * high)


def _classed(value: Column, target: Mapping[str, float | None]) -> Column:
    named = [name for name in target if name != OTHERS]
    return F.when(value.isin(named), value).otherwise(F.lit(OTHERS))


def mix(
    docs: DataFrame,
    targets: Targets,
    dimensions: Mapping[str, Column],
    keep_share: float | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 1,
) -> DataFrame:
    """The documents with columns ``mix_*``: tokens, class per dimension, weight, probability, kept.

    ``targets`` has shares per dimension and class (any positive numbers; ``OTHERS`` is what no
    target names, 0 if left out), ``dimensions`` the columns to compare them with. A class whose
    target is ``OBSERVED`` keeps its share of all tokens; the numbers divide what is left. Without
    ``keep_share``, the class furthest below its target limits the whole sample. Tokens are
    summed per combination of classes over all documents; the table has as many cells as the
    targets' sizes multiplied (at most ``MAX_CELLS``), whatever the documents hold, and is fitted
    on the driver. A document is kept if a number drawn from its id and text lies below its
    probability, so the draw does not depend on order or partitions.

    Defined results: a null text has 0 tokens and is sampled like others of its classes; null
    classes belong to ``OTHERS``. Targets of classes without tokens are spread over the others of
    the dimension. A cell without tokens gets probability 0, unless nothing has tokens at all.
    Repeated rows share one draw. A text of any length is one document with all its tokens. An empty
    table stays empty. Columns of the input keep their
    names; ``mix_*`` columns get underscores in front where a name is taken.
    """
    if set(targets) != set(dimensions):
        raise ValueError("targets and dimensions must have the same names")
    names = list(dimensions)
    classes = {d: [*(c for c in targets[d] if c != OTHERS), OTHERS] for d in names}
    shape = [len(classes[d]) for d in names]
    if np.prod(shape) > MAX_CELLS:
        raise ValueError(f"targets have over {MAX_CELLS} combinations")
    column = {c: fresh(docs.columns, f"mix_{c}") for c in ["tokens", *names, "weight", "probability", "kept"]}
    marked = docs.withColumns(
        {column["tokens"]: n_tokens(text)}
        | {column[d]: _classed(dimensions[d].cast("string"), targets[d]) for d in names}
    )

    observed = np.zeros(shape)
    sums = marked.groupBy(*(column[d] for d in names)).agg(F.sum(column["tokens"]).alias("n"))
    for row in sums.collect():
        observed[tuple(classes[d].index(row[i]) for i, d in enumerate(names))] += row.n or 0
    shares = [
        wanted_shares(
            observed.sum(axis=tuple(a for a in range(len(names)) if a != axis)),
            [targets[d].get(c, 0.0) for c in classes[d]],
        )
        for axis, d in enumerate(names)
    ]
    factors = rake(observed, shares)
    chances = probabilities(observed, factors, keep_share, shares)

    # A cell's weight and probability, looked up by its place in the flattened table.
    place = reduce(
        lambda so_far, d: so_far * len(classes[d])
        + F.array_position(F.array(*map(F.lit, classes[d])), F.col(column[d])) - 1,
        names, F.lit(0),
    )
    at = fresh(docs.columns, "mix_cell")
    cells = docs.sparkSession.createDataFrame(
        [(i, float(w), float(p)) for i, (w, p) in enumerate(zip(factors.ravel(), chances.ravel()))],
        f"`{at}` long, `{column['weight']}` double, `{column['probability']}` double",
    )
    key = F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.col(text))
    draw = F.shiftrightunsigned(key, 11) / F.lit(float(1 << 53))
    return (
        marked.withColumn(at, place.cast("long"))
        .join(F.broadcast(cells), at)  # at most MAX_CELLS rows
        .drop(at)
        .withColumn(column["kept"], draw < F.col(column["probability"]))
    )


def sample(docs: DataFrame, targets: Targets, dimensions: Mapping[str, Column], **options) -> DataFrame:
    """The documents that ``mix`` keeps, with their own columns only."""
    mixed = mix(docs, targets, dimensions, **options)
    return mixed.where(fresh(docs.columns, "mix_kept")).select(*(F.col(f"`{c}`") for c in docs.columns))
