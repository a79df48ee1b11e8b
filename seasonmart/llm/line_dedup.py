"""Operator 1: drop the lines that a large share of a site's pages have in common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import fresh
from seasonmart.sources.sinks import Scratch, stage

#: A line on more than this share of its site's pages is boilerplate.
MAX_RATIO = 0.015
#: If it is on this many pages at least: what two pages of a small site share may be chance.
MIN_SEEN = 3


def _key(line: Column) -> Column:
    """128 bits that stand for a line: two hashes with different seeds."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _first_of_equals(ordered: Column) -> Column:
    return F.filter(
        ordered, lambda x, i: (i == 0) | (x != F.element_at(ordered, F.greatest(i, F.lit(1))))
    )


def url_host(url: str) -> Column:
    """The host that a page is grouped by, from its address: in lower case, without port and ``www.``."""
    return F.regexp_replace(F.lower(F.try_parse_url(F.col(url), F.lit("HOST"))), r"^www\.", "")


def boilerplate(
    pages: DataFrame, host: str, text: str, max_ratio: float = MAX_RATIO, min_seen: int = MIN_SEEN
) -> DataFrame:
    """One row per host that has boilerplate: ``host`` and ``lines``, the keys of those lines.

    Pages of a host with the same text are one page: a text that was copied often does not become
    boilerplate of its own. A page counts once for a line however often it repeats it. With r lines
    a page on average, at most r / max_ratio lines of a host can be over the ratio, so an array per
    host is bounded.
    """
    with Scratch(pages.sparkSession, "line_counts") as scratch:
        sited = pages.select(F.col(host).alias("host"), F.col(text).alias("text")).where(
            F.col("host").isNotNull() & F.col("text").isNotNull()
        )
        lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
        keys = sited.select("host", _key(F.col("text")).alias("page"), F.sort_array(F.transform(lines, _key)).alias("keys"))
        # Copies meet in the map tasks first; hosts are spread by the hash of the page.
        distinct = keys.groupBy("host", "page").agg(F.any_value("keys").alias("keys"))
        distinct = scratch.stage(distinct.drop("page"), "pages")
        totals = scratch.stage(distinct.groupBy("host").agg(F.count("*").alias("pages")), "totals")
        counted = (
            distinct.select("host", F.explode(_first_of_equals(F.col("keys"))).alias("line"))
            .groupBy("host", "line")
            .agg(F.count("*").alias("seen"))
            .where(F.col("seen") >= min_seen)
        )
        # Staged, so that the join below shuffles both sides anew and a hot host can be split.
        counted = scratch.stage(counted, "counted")
        found = counted.join(totals, "host").where(F.col("seen") > max_ratio * F.col("pages"))
        return stage(
            found.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines")),
            "boilerplate",
        )


def line_dedup(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_seen: int = MIN_SEEN,
    dropped: str | None = None,
) -> DataFrame:
    """The pages with boilerplate lines taken out of ``text``; all other columns stay as they are.

    A line is what stands between two line feeds, compared exactly. It is boilerplate on a host if
    more than ``max_ratio`` of the host's pages contain it, and ``min_seen`` at least, whatever the
    size of the host. Pages of a host with the same text count as one. ``dropped`` names a column
    for the number of lines taken out of a page. ``url_host`` makes hosts from addresses.

    Defined results: a page with null text or null host stays as it is and counts nowhere. Blank
    lines count nowhere and stay. Every page stays, with an empty text if all its lines go. A line
    at exactly the ratio stays. Texts of any length are cut into lines whole; a text without a line
    feed is one line. Repeated rows are one page in the counts, and all lose the same lines. An
    empty table gives an empty table. Extra columns may have any name.
    """
    rules = boilerplate(pages, host, text, max_ratio, min_seen)
    site, drop = fresh(pages.columns, "_site"), fresh(pages.columns, "_boilerplate")
    rules = rules.toDF(site, drop)
    joined = pages.join(rules, F.col(host) == F.col(site), "left")
    lines = F.split(text, "\n")
    kept = F.filter(
        lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(drop), _key(x))
    )
    has_rules = F.col(drop).isNotNull() & F.col(text).isNotNull()
    result = {text: F.when(has_rules, F.array_join(kept, "\n")).otherwise(F.col(text))}
    if dropped:
        gone = F.when(has_rules, F.size(lines) - F.size(kept)).otherwise(0)
        result = {dropped: gone.cast("long"), **result}
    return joined.withColumns(result).drop(site, drop)
