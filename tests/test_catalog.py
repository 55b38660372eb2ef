"""Registered queries against independent SQL, and the plans Spark makes of them."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from ebbline.operators.projection import cashflow_daily, hqla_daily, hqla_detail
from ebbline.plans.catalog import catalog
from ebbline.sources.reference import reference_table
from ebbline.sources.sample import cash_flows, market_data, positions
from ebbline.sources.tables import overwrite, read_table
from ebbline.sources.testdata import PARTITIONS, StarSchema
from oracle.sql import statements
from tests import fixtures as fx
from tests.check_oracle import connect, mismatch

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog()) == set(statements())
    assert set(catalog()) <= set(driver.queries()) and set(statements()) <= set(driver.oracle_sql())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog()))
def test_query_equals_sql_without_cross_join_or_python(spark, sql, name):
    df = catalog()[name](spark, SF_DIR)
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"(Python|Pandas|Arrow)Eval|MapIn(Pandas|Arrow)|FlatMapGroups", text)
    assert mismatch(df, sql, driver.oracle_sql()[name]) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["day_number", "total_net_cash_outflows", "hqla", "lcr"]
    rows = {r.day_number: r.lcr for r in df.collect()}
    assert len(rows) == 150 and rows[1] == 1.00916502 and rows[150] == 0.99904219


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Model tables on disk, as a user would hold them."""
    base = tmp_path_factory.mktemp("model")
    prices = market_data(spark, fx.TODAY, n_securities=20, n_days=10)
    tables = {
        "positions": positions(spark, fx.TODAY, prices, n=200, n_cash=50, n_securities=20, n_days=10),
        "cash_inflows": cash_flows(spark, fx.TODAY, "inflow", n=100),
        "asset_classifications": reference_table(spark, "asset_classifications", fx.NOON),
    }
    for name, df in tables.items():
        overwrite(df, str(base / name))
    return {name: read_table(spark, str(base / name), name) for name in tables}


def test_filters_and_columns_reach_the_scan(stored):
    hqla = plan(hqla_daily(hqla_detail(stored["positions"], stored["asset_classifications"], fx.NOON), fx.NOON))
    scan = next(line for line in hqla.splitlines() if "FileScan" in line and "position_type" in line)
    assert "EqualTo(position_type,Long)" in scan and "GreaterThanOrEqual(maturity_date,2024-03-10)" in scan
    assert re.search(
        r"ReadSchema: struct<security_type:string,position_type:string,position_value_usd:decimal\(20,2\),maturity_date:date>",
        scan,
    )
    flow = plan(cashflow_daily(stored["cash_inflows"], "inflow", fx.NOON))
    scan = next(line for line in flow.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(maturity_date,2024-03-11)" in scan
    assert "ReadSchema: struct<inflow_amount_usd:decimal(20,2),maturity_date:date>" in scan


def test_rows_are_aggregated_before_any_shuffle(stored):
    for df in (
        hqla_daily(hqla_detail(stored["positions"], stored["asset_classifications"], fx.NOON), fx.NOON),
        cashflow_daily(stored["cash_inflows"], "inflow", fx.NOON),
    ):
        lines = plan(df).splitlines()
        shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
        assert len(shuffles) == 2
        assert all("partial_sum" in lines[i + 1] for i in shuffles)


@pytest.mark.parametrize("name", ["lcr_what_if", "baseline_versus_scenarios", "relationship_orphans"])
def test_queries_start_no_job_while_they_are_built(spark, name):
    catalog()["hqla_detail"](spark, SF_DIR).count()
    context = spark.sparkContext
    context.setJobGroup(f"building {name}", name)
    try:
        catalog()[name](spark, SF_DIR)
        jobs = context.statusTracker().getJobIdsForGroup(f"building {name}")
    finally:
        context._jsc.clearJobGroup()
    assert len(jobs) <= 10  # one per file schema, no counts


def test_a_stored_history_is_made_once(spark):
    """Later queries of a history read its latest run, and nothing of the facts."""
    catalog()["headline"](spark, SF_DIR)
    for name in ("headline", "latest_lcr", "days_below_floor"):
        text = plan(catalog()[name](spark, SF_DIR))
        assert "lineitem" not in text and "Join" not in text and len(re.findall("FileScan", text)) == 2, name
    text = plan(catalog()["what_if_change_analysis"](spark, SF_DIR))
    assert "lineitem" not in text and "Join" not in text and len(re.findall("FileScan", text)) == 2


def test_the_largest_outflows_are_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalog()["largest_outflows_by_counterparty"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [counterparty_id" in text and "LeftSemi" in text and "LeftOuter, BuildRight" in text


def test_orders_find_their_customer_before_line_items_find_their_order(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(StarSchema(spark, SF_DIR).cash_outflows())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.findall(r"SortMergeJoin \[(\w+)#", text) == ["l_orderkey", "o_custkey"]


def test_the_wide_outflow_table_is_gathered_by_amount_before_it_gets_its_days(spark):
    text = plan(catalog()["cash_outflow_projection_wide"](spark, SF_DIR))
    assert "REBALANCE_PARTITIONS_BY_COL" in text and re.search(r"Sort \[outflow_amount_usd#\d+ ASC NULLS FIRST, live_days#\d+ ASC NULLS FIRST\], false", text)
    assert text.index("day_1_outflow_stock") < text.index("Sort [outflow_amount_usd")
    assert "REBALANCE" not in plan(catalog()["cash_outflow_from_wide"](spark, SF_DIR))


def test_line_items_are_dealt_only_if_the_session_asks(spark):
    def shuffled(n):
        return f"hashpartitioning(l_extendedprice#0, l_shipdate#0, {n})" in re.sub(r"#\d+", "#0", plan(StarSchema(spark, SF_DIR).raw("lineitem")))

    assert not shuffled(3)
    spark.conf.set(PARTITIONS, "3")
    try:
        assert shuffled(3)
    finally:
        spark.conf.unset(PARTITIONS)


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_lookups_that_facts_leave_out_resolve(sql, sf_dir):
    """Forecast queries skip these N:1 lookups, which changes no row only if each finds its one."""
    con = connect(sf_dir)
    for left, key, right, own in (
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
    ):
        lost = con.execute(f"SELECT count(*) FROM {left} WHERE {key} IS NULL OR {key} NOT IN (SELECT {own} FROM {right})").fetchone()
        many = con.execute(f"SELECT count(*) - count(DISTINCT {own}) FROM {right}").fetchone()
        assert (lost, many) == ((0,), (0,)), (left, right)
