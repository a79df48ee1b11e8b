"""Publishing: versions of tables, several models at once, checks while writing, failing rows in one pass."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from seasonmart.operators.checks import Check, check_failures, tagged_rows
from seasonmart.plans import marts, project, quality
from seasonmart.plans.project import BuildError, Step, build, run_steps
from seasonmart.sources import retail, sinks
from seasonmart.sources.sinks import Target, publish_table
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture
def target(spark):
    with sinks.own_target(spark, "publishing") as own:
        yield own


def versions(target, name):
    return [f for f in os.listdir(f"{target.folder}/{target.schema}/{name}".removeprefix("file://")) if f.startswith("v-")]


def test_failed_write_leaves_the_old_table(spark, target):
    publish_table(spark.range(3), "t", target)
    broken = spark.range(3).select(F.when(F.col("id") > 1, F.raise_error(F.lit("broken")).cast("long")).otherwise(1).alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish_table(broken, "t", target)
    assert rows(spark.table(f"{target.schema}.t")) == [(0,), (1,), (2,)]
    assert len(versions(target, "t")) == 1
    assert [t.name for t in spark.catalog.listTables(target.schema)] == ["t"]


def test_readers_see_old_or_new_rows_while_a_table_is_rebuilt(spark, target):
    """Counts in other sessions, taken all the time that the table is rebuilt."""
    publish_table(spark.range(10), "t", target)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.newSession().table(f"{target.schema}.t").count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (20, 30, 40):
            publish_table(spark.range(n), "t", target)
    finally:
        stop.set()
        reader.join()
    assert seen and {*seen} <= {10, 20, 30, 40}
    assert spark.newSession().table(f"{target.schema}.t").count() == 40


def test_only_the_version_before_is_kept(spark, target):
    first = publish_table(spark.range(1), "t", target)
    publish_table(spark.range(2), "t", target)
    assert first.count() == 1 and len(versions(target, "t")) == 2
    publish_table(spark.range(3), "t", target)
    assert len(versions(target, "t")) == 2 and spark.table(f"{target.schema}.t").count() == 3


def test_a_table_can_be_rebuilt_from_itself(spark, target):
    publish_table(spark.range(3), "t", target)
    more = publish_table(spark.table(f"{target.schema}.t").union(spark.range(3, 5)), "t", target)
    assert more.count() == 5


def test_changed_columns_buckets_and_partitions(spark, target):
    publish_table(spark.range(3), "t", target)
    assert rows(publish_table(spark.range(2).withColumn("x", F.lit("a")), "t", target)) == [(0, "a"), (1, "a")]
    for n in (4, 8):
        bucketed = publish_table(spark.range(6), "t", target, bucket_by="id", buckets=n)
        assert bucketed.count() == 6
        described = {r.col_name: r.data_type for r in spark.sql(f"describe extended {target.schema}.t").collect()}
        assert described["Num Buckets"] == str(n)
    for n in (3, 5):
        by_part = publish_table(spark.range(n).withColumn("p", F.col("id") % 2), "t", target, partition_by=["p"])
        assert by_part.count() == n and by_part.where("p = 1").count() == n // 2


def test_steps_that_do_not_need_each_other_run_at_once():
    together = threading.Barrier(3, timeout=30)
    done = []

    def run(name, step):
        if name != "last":
            together.wait()
        else:
            assert sorted(done) == ["a", "b", "c"]
        done.append(name)

    steps = {n: Step("x", (), None) for n in "abc"} | {"last": Step("x", ("a", "b", "c"), None)}
    assert run_steps(steps, run, 4) == ({}, [])


def test_an_error_stops_only_what_needs_it():
    done = []

    def run(name, step):
        if name == "bad":
            raise ValueError(name)
        done.append(name)

    steps = {
        "bad": Step("x", (), None), "child": Step("x", ("bad",), None), "grandchild": Step("x", ("child",), None),
        "good": Step("x", (), None), "other": Step("x", ("good",), None),
    }
    failures, skipped = run_steps(steps, run, 2)
    assert [*failures] == ["bad"] and skipped == ["child", "grandchild"] and done == ["good", "other"]


@needs_tables
def test_a_failing_mart_leaves_the_others_published(spark, target, monkeypatch):
    def broken(*_, **__):
        raise RuntimeError("no facts today")

    monkeypatch.setattr(marts, "fct_player_salaries", broken)
    with pytest.raises(BuildError, match="fct_player_salaries") as raised:
        build(spark, retail.raw_tables(spark, FOLDER), target)
    error = raised.value
    assert [*error.failures] == ["fct_player_salaries"] and error.skipped == ["pitcher_salary_analysis"]
    assert len(error.built) == 11
    published = {t.name for t in spark.catalog.listTables(target.schema)}
    assert published == {*error.built}


@needs_tables
def test_staging_models_overlap(spark, target, monkeypatch):
    """All four are being written at some moment."""
    together, publish = threading.Barrier(4, timeout=60), project.publish_table

    def recorded(df, name, *more, **named):
        if name.startswith("stg_"):
            together.wait()
        return publish(df, name, *more, **named)

    monkeypatch.setattr(project, "publish_table", recorded)
    assert len(build(spark, retail.raw_tables(spark, FOLDER), target)) == 13


@needs_tables
def test_checks_by_row_are_counted_while_writing(spark, target):
    strange = Check("stg_players", "throws", "accepted_values", values=("Left",))
    missing = Check("int_player_value_analysis", "era", "not_null")
    checks = [*quality.DECLARED_CHECKS, strange, missing]
    built = build(spark, retail.raw_tables(spark, FOLDER), target, checks=checks)
    by_row = [c for c in checks if c.by_row]
    # No season is recent enough for the report: it has no rows, and Spark counts nothing.
    assert built["pitcher_salary_analysis"].count() == 0
    assert built.observed.keys() == {c.name for c in by_row if c.model != "pitcher_salary_analysis"}
    assert built.observed[missing.name] > 0 and built.observed[strange.name] > 0
    # Without what was counted, the tables are read: same findings.
    assert rows(quality.run_checks(built, checks)) == rows(quality.run_checks(dict(built), checks))
    passing = [c for c in by_row if c is not strange and c.name in built.observed]
    assert check_failures(built, passing, built.observed).inputFiles() == []
    assert check_failures(built, [strange], built.observed).inputFiles() != []


def test_failing_rows_from_one_scan(spark, target):
    salaries = publish_table(
        spark.createDataFrame([("A", 1, 5), ("A", 2, None), ("B", 3, None), (None, 3, 1)], "player_id string, year int, salary long"),
        "salaries", target,
    )
    players = spark.createDataFrame([("A",)], "player_id string")
    checks = [
        Check("s", "player_id", "unique"), Check("s", "salary", "not_null"),
        Check("s", "player_id", "relationships", parent=("p", "player_id")),
        Check("s", "year", "accepted_values", values=(1, 2)),
    ]
    failures = sinks.stage(check_failures({"s": salaries, "p": players}, checks), "failures")
    tagged = tagged_rows(salaries, checks, failures)
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert len([line for line in plan.splitlines() if "Relation" in line and "salary" in line]) == 1
    names = [c.name for c in checks]
    assert sorted(rows(tagged, "check_name", "player_id", "year"), key=str) == sorted([
        (names[0], "A", 1), (names[0], "A", 2), (names[1], "A", 2), (names[1], "B", 3), (names[2], "B", 3),
        (names[3], "B", 3), (names[3], None, 3),
    ], key=str)


def test_tables_of_checks_follow_the_last_run(spark, target):
    check = Check("s", "salary", "not_null")
    broken = spark.createDataFrame([(1, None), (2, 5)], "id long, salary long")
    for data in (broken, broken.union(broken)):
        quality.run_and_store_checks({"s": data}, target, [check])
        assert spark.table(f"{target.schema}.{check.name}").count() == data.where("salary is null").count()
    quality.run_and_store_checks({"s": broken.where("salary > 0")}, target, [check])
    assert not spark.catalog.tableExists(f"{target.schema}.{check.name}")
