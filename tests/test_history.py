from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ebbline.operators import history as hist
from ebbline.sources.schemas import SCHEMAS
from ebbline.sources.runs import append_run, history, latest, runs
from ebbline.sources.tables import read_table

OLD, NEW = dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 2, 9)


def series(spark, values, **extra):
    df = spark.createDataFrame(
        [(d, Decimal(n), Decimal(h), Decimal(h) / Decimal(n)) for d, n, h in values],
        "day_number int, total_net_cash_outflows decimal(38,2), hqla decimal(38,10),"
        " lcr decimal(38,12)",
    )
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


@pytest.fixture()
def baseline(spark, tmp_path):
    path = str(tmp_path / "lcr")
    append_run(series(spark, [(1, 10, 20), (2, 10, 10)]), path, OLD)
    append_run(series(spark, [(3, 8, 12), (1, 10, 9), (2, 10, 15)]), path, NEW)
    return read_table(spark, path, "lcr")


@pytest.fixture()
def scenarios(spark, tmp_path):
    path = str(tmp_path / "what_if")
    for wid, when, h in (("1", OLD, 5), ("2", OLD, 6), ("1", NEW, 7)):
        run = series(spark, [(1, 10, h), (2, 10, h + 1)], what_if_id=wid)
        append_run(run, path, when, "what_if_lcr")
    return read_table(spark, path, "what_if_lcr")


def test_append_keeps_declared_columns_and_types(baseline):
    assert [(f.name, f.dataType) for f in baseline.schema] == [
        (f.name, f.dataType) for f in SCHEMAS["lcr"]
    ]
    assert baseline.count() == 5


def test_append_needs_every_column(spark, tmp_path):
    with pytest.raises(ValueError, match="what_if_id"):
        append_run(series(spark, [(1, 1, 1)]), str(tmp_path / "t"), NEW, "what_if_lcr")


def test_runs_of_one_instant_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "lcr")
    for run_id, h in (("a", 20), ("b", 30)):
        append_run(series(spark, [(1, 10, h), (2, 10, h + 5)]), path, NEW, run_id=run_id)
    history = read_table(spark, path, "lcr")
    assert {r.run_id for r in history.collect()} == {"a", "b"}
    assert [(r.day_number, float(r.hqla)) for r in hist.latest_lcr(history).collect()] == [(1, 30), (2, 35)]
    assert [r.hqla_change for r in hist.lcr_change_analysis(history).collect()] == [None, 5]


def test_a_retried_run_takes_the_place_of_itself(spark, tmp_path):
    path = str(tmp_path / "lcr")
    append_run(series(spark, [(1, 10, 20), (2, 10, 20)]), path, OLD, run_id="007")
    append_run(series(spark, [(1, 10, 30)]), path, NEW, run_id="8")
    append_run(series(spark, [(1, 10, 25)]), path, OLD, run_id="007")
    rows = sorted((r.run_id, float(r.hqla)) for r in read_table(spark, path, "lcr").collect())
    assert rows == [("007", 25), ("8", 30)]
    assert sorted((r.run_id, r.n_rows) for r in runs(spark, path).collect()) == [("007", 1), ("8", 1)]
    append_run(series(spark, [(1, 10, 26)]), path, NEW)
    append_run(series(spark, [(1, 10, 27)]), path, NEW)  # without an id its instant names a run
    assert read_table(spark, path, "lcr").count() == 3


def test_a_run_that_is_not_in_the_manifest_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "lcr")
    append_run(series(spark, [(1, 10, 20)]), path, OLD, run_id="a")
    late = read_table(spark, path, "lcr").withColumn("run_id", F.lit("b")).withColumn("created_timestamp", F.lit(NEW).cast("timestamp_ntz"))
    late.write.mode("append").partitionBy("run_id").parquet(path)  # the writer is lost before it enters the run
    assert read_table(spark, path, "lcr").count() == 2
    assert [r.run_id for r in latest(spark, path).collect()] == ["a"]
    assert [r.run_id for r in history(spark, path).collect()] == ["a"]


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_runs_are_read_from_their_partitions_only(spark, tmp_path):
    path, other = str(tmp_path / "lcr"), str(tmp_path / "what_if")
    for day in range(1, 6):
        created = dt.datetime(2024, 1, day)
        append_run(series(spark, [(1, 10, day), (2, 10, day)]), path, created, run_id=f"run {day}")
        for wid in ("1", "2")[: 1 + day % 2]:
            append_run(series(spark, [(1, 10, day)], what_if_id=wid), other, created, "what_if_lcr")
    one = latest(spark, path)
    each = latest(spark, other, "what_if_lcr")
    assert [float(r.hqla) for r in one.collect()] == [5, 5]
    assert sorted((r.what_if_id, float(r.hqla)) for r in each.collect()) == [("1", 5), ("2", 5)]
    assert [float(r.hqla) for r in latest(spark, other, "what_if_lcr", "2").collect()] == [5]
    for df, files in ((one, 1), (each, 2)):
        text = plan(df).split("== Initial Plan ==")[0]
        assert "Join" not in text and text.count("FileScan") == 2  # the history and, in the subquery, its manifest
        assert re.search(r"PartitionFilters: \[[^]]*Subquery", text)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # metrics are those of the plan then
    try:
        assert read_files(latest(spark, path)) == 1 and read_files(latest(spark, other, "what_if_lcr")) == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def read_files(df) -> int:
    """Files that the scan of the history read, by its metrics."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    (read,) = [scan.metrics().apply("numFiles").value() for scan in scans if "total_net_cash_outflows" in scan.toString()]
    return read


def test_a_history_in_the_catalog(spark):
    name = "lcr_in_the_catalog"
    for table in (name, f"{name}_runs"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    append_run(series(spark, [(1, 10, 20)]), name, OLD, run_id="a")
    append_run(series(spark, [(1, 10, 30), (2, 10, 31)]), name, NEW, run_id="b")
    append_run(series(spark, [(1, 10, 21)]), name, OLD, run_id="a")
    assert sorted((r.run_id, float(r.hqla)) for r in read_table(spark, name, "lcr").collect()) == [("a", 21), ("b", 30), ("b", 31)]
    assert [float(r.hqla) for r in latest(spark, name).orderBy("day_number").collect()] == [30, 31]


def test_rows_without_run_id_are_one_run(spark, tmp_path):
    path = str(tmp_path / "lcr")
    append_run(series(spark, [(1, 10, 20)]), path, OLD)
    bare = read_table(spark, path, "lcr").withColumn("run_id", F.lit(None).cast("string"))
    assert hist.latest_lcr(bare).count() == 1


def test_runs_of_scenarios_of_one_instant_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "what_if")
    for run_id, h in (("a", 5), ("b", 7)):
        append_run(series(spark, [(1, 10, h)], what_if_id="1"), path, NEW, "what_if_lcr", run_id)
    rows = hist.latest_run_per_scenario(read_table(spark, path, "what_if_lcr")).collect()
    assert [float(r.hqla) for r in rows] == [7]


def test_latest_trend(baseline):
    rows = hist.latest_lcr(baseline).collect()
    assert [r.day_number for r in rows] == [1, 2, 3]
    assert [float(r.lcr) for r in rows] == [0.9, 1.5, 1.5]


def test_latest_of_one_scenario_and_of_each(scenarios):
    one = hist.latest_what_if_lcr(scenarios, "1").collect()
    assert [float(r.hqla) for r in one] == [7.0, 8.0]
    each = {(r.what_if_id, r.day_number): float(r.hqla) for r in hist.latest_run_per_scenario(scenarios).collect()}
    assert each == {("1", 1): 7.0, ("1", 2): 8.0, ("2", 1): 6.0, ("2", 2): 7.0}
    assert hist.latest_what_if_lcr(scenarios, "no such id").count() == 0


def test_headline_status_and_headroom(baseline):
    row = hist.headline(hist.latest_lcr(baseline)).first()
    assert (row.status, float(row.headroom)) == ("Non-Compliant", -0.1)
    second = hist.headline(hist.latest_lcr(baseline), day=2).first()
    assert (second.status, float(second.headroom)) == ("Compliant", 0.5)


def test_exactly_the_floor_is_compliant(spark):
    assert hist.headline(series(spark, [(1, 10, 10)])).first().status == "Compliant"
    assert hist.below_floor(series(spark, [(1, 10, 10)])).count() == 0


def test_changes(baseline):
    rows = hist.lcr_change_analysis(baseline).collect()
    assert [r.day_number for r in rows] == [1, 2, 3]
    assert rows[0].hqla_change is None
    assert [float(r.hqla_change) for r in rows[1:]] == [6.0, -3.0]
    assert [float(r.outflows_change) for r in rows[1:]] == [0.0, -2.0]
    assert [float(r.lcr_change) for r in rows[1:]] == [0.6, 0.0]
    assert hist.lcr_change_analysis(baseline, 2).count() == 2


def test_changes_per_scenario(scenarios):
    rows = hist.what_if_change_analysis(scenarios).collect()
    assert sorted((r.what_if_id, r.day_number, r.hqla_change is None) for r in rows) == [
        ("1", 1, True), ("1", 2, False), ("2", 1, True), ("2", 2, False)
    ]


def test_day_filters(baseline):
    trend = hist.latest_lcr(baseline)
    assert [r.day_number for r in hist.within(trend, 2).collect()] == [1, 2]
    assert [r.day_number for r in hist.on_days(trend, 1, 3).collect()] == [1, 3]
    assert [r.day_number for r in hist.below_floor(trend).collect()] == [1]


def test_compare(baseline, scenarios):
    compared = hist.compare_runs(hist.latest_lcr(baseline), hist.latest_run_per_scenario(scenarios))
    have = {(r.what_if_id, r.day_number): float(r.lcr_difference) for r in compared.collect()}
    assert have == {("1", 1): -0.2, ("1", 2): -0.7, ("2", 1): -0.3, ("2", 2): -0.8}


def test_drivers_add_up_and_are_ranked(spark):
    hqla = spark.createDataFrame([(1, 100.0), (5, 90.0)], "day_number int, total_hqla_usd double")
    net = spark.createDataFrame(
        [(1, 40.0, 60.0), (5, 20.0, 55.0)], "day_number int, total_inflow double, total_outflow double"
    )
    rows = hist.lcr_drivers(hqla, net, 1, 5).collect()
    assert sum(r.effect for r in rows) == pytest.approx(90 / 75 - 1)
    assert [r.cause for r in rows] == ["inflow", "hqla", "outflow"]
    assert [r.cause for r in hist.lcr_drivers(hqla, net, 1, 5, k=1).collect()] == ["inflow"]


def test_stamps_do_not_depend_on_the_time_zone(spark, tmp_path):
    path = str(tmp_path / "lcr")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        append_run(series(spark, [(1, 1, 1)]), path, NEW)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert read_table(spark, path, "lcr").first().created_timestamp == NEW
