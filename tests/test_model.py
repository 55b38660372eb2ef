from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ebbline.operators import quality
from ebbline.operators.semantic import MODEL, RELATIONSHIPS, VERIFIED_QUERIES, dimension, drill_across, fact, semantic_query
from ebbline.plans import questions as ask
from ebbline.plans.jobs import Book
from ebbline.sources.schemas import SCHEMAS
from tests import fixtures as fx


@pytest.fixture()
def tables(spark):
    return {
        "positions": fx.positions(
            spark,
            [
                ("P1", "U1", "CASH", "Long", "10.00", None),
                ("P2", "U2", "BOND", "Short", "20.00", fx.day(5)),
                ("P3", "U9", "GOLD", "Long", "30.00", fx.day(200)),
                ("P4", "U1", "CASH", "Long", "40.00", None),
            ],
        ),
        "cash_inflows": fx.flows(
            spark, "inflow", [("I1", "U1", "C1", "1.00", None), ("I2", "U1", None, "2.00", fx.day(-3)),
                              ("I3", "U2", "C1", "4.00", fx.day(89))]
        ),
        "cash_outflows": fx.flows(
            spark, "outflow", [("O1", "U1", "C2", "8.00", fx.day(90)), ("O2", "U2", "C2", "16.00", fx.day(365)),
                               ("O3", "U2", "C7", "32.00", fx.day(179))]
        ),
        "asset_classifications": fx.classes(spark),
        "counterparty_data": fx.counterparties(spark),
        "business_unit_reference": fx.units(spark),
    }


@pytest.fixture()
def book(tables):
    return Book(**tables)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_model_covers_the_declared_tables():
    assert len(MODEL) == 10 and len(RELATIONSHIPS) == 5 and len(VERIFIED_QUERIES) == 2
    for name, table in MODEL.items():
        assert table.columns() <= set(SCHEMAS[name].fieldNames())
        assert set(table.primary_key) <= set(table.dimensions)


def test_names_resolve_by_role_and_without_case():
    assert fact("POSITIONS.Quantity").column == "quantity"
    assert dimension("positions.maturity_date").table == "positions"
    for bad in ("positions.security_type", "nowhere.quantity"):
        with pytest.raises(KeyError):
            fact(bad)


def test_query_along_a_relationship_keeps_unmatched_rows(tables):
    df = semantic_query(tables, ["positions.position_value_usd"], ["asset_classifications.hqla_level"])
    assert rows(df, "hqla_level", "position_value_usd") == [
        ("Level 1", Decimal("50.00")), ("Level 2A", Decimal("20.00")), (None, Decimal("30.00"))
    ]


def test_query_with_filters_on_both_sides(tables):
    df = semantic_query(
        tables,
        ["cash_outflows.outflow_amount_usd"],
        ["business_unit_reference.region"],
        [("counterparty_data.region", lambda c: c == "Asia"), ("cash_outflows.business_unit_id", lambda c: c == "U2")],
    )
    assert rows(df, "region", "outflow_amount_usd") == [("Asia", Decimal("16.00"))]


def test_query_prefixes_shared_names(tables):
    df = semantic_query(
        tables,
        ["cash_outflows.outflow_amount_usd"],
        ["business_unit_reference.region", "counterparty_data.region"],
        aggregate="count",
    )
    assert set(df.columns) == {
        "business_unit_reference_region", "counterparty_data_region", "outflow_amount_usd"
    }


@pytest.mark.parametrize("how, want", [("sum", 56), ("count", 3), ("min", 8), ("max", 32)])
def test_query_aggregates_without_dimensions(tables, how, want):
    df = semantic_query(tables, ["cash_outflows.outflow_amount_usd"], aggregate=how)
    assert df.first().outflow_amount_usd == want


def test_query_equals_join_then_group(tables):
    links = (("business_unit_reference", "business_unit_id"), ("asset_classifications", "security_type"))
    for table, key in links:
        column = next(d for d in MODEL[table].dimensions if d in tables[table].columns and d != key)
        have = semantic_query(tables, ["positions.position_value_usd"], [f"{table}.{column}"])
        want = tables["positions"].join(tables[table], key, "left").groupBy(column).agg(
            F.sum("position_value_usd").alias("position_value_usd")
        )
        assert rows(have, column, "position_value_usd") == rows(want, column, "position_value_usd")


def test_query_needs_a_relationship_and_one_fact_table(tables):
    with pytest.raises(KeyError):
        semantic_query(tables, ["cash_inflows.inflow_amount_usd"], ["business_unit_reference.region"])
    with pytest.raises(ValueError):
        semantic_query(tables, ["cash_inflows.inflow_amount_usd", "positions.quantity"])


def test_orphans_count_nulls_and_unknown_values(tables):
    have = {r.relationship: (r.orphan_count, r.row_count, r.orphan_percent) for r in quality.orphans(tables).collect()}
    assert have == {
        "inflow_counterparty": (1, 3, 33.3333),
        "outflow_business_unit": (0, 3, 0.0),
        "outflow_counterparty": (1, 3, 33.3333),
        "positions_to_asset_security_type": (1, 4, 25.0),
        "position_business_unit": (1, 4, 25.0),
    }
    assert rows(quality.orphan_rows(tables, "position_business_unit"), "position_id") == [("P3",)]


def test_repeated_partners_do_not_change_orphans(tables):
    doubled = {**tables, "counterparty_data": tables["counterparty_data"].unionByName(tables["counterparty_data"])}
    assert quality.orphans(doubled).collect() == quality.orphans(tables).collect()


def test_orphans_of_empty_tables(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert {(r.orphan_count, r.orphan_percent) for r in quality.orphans(empty).collect()} == {(0, 0.0)}


def test_checks_and_summary(spark, tables):
    history = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "run", 1, Decimal(1), Decimal(1), Decimal(1))], SCHEMAS["lcr"]
    )
    given = {**tables, "lcr": history, "hqla_summary": spark.createDataFrame([], SCHEMAS["hqla_summary"])}
    report = quality.check_all(spark, given, history)
    status = {(r.check, r.object): r.status for r in report.collect()}
    assert status["table", "positions"] == "PASS"
    assert status["table", "hqla_summary"] == "WARN"
    assert status["table", "what_if_lcr"] == "FAIL"
    assert status["column", "lcr"] == "PASS"
    assert status["column", "positions"] == "FAIL"
    assert status["relationship", "outflow_business_unit"] == "PASS"
    assert status["relationship", "inflow_counterparty"] == "WARN"
    assert {s for (check, _), s in status.items() if check == "verified query"} == {"PASS"}
    summary = {r.check: (r.passed, r.total, r.result) for r in quality.summary(report).collect()}
    assert summary["verified query"] == (2, 2, "PASS")
    assert summary["relationship"] == (1, 5, "FAIL")


def test_verified_queries_warn_on_empty_history(spark):
    empty = spark.createDataFrame([], SCHEMAS["lcr"])
    assert {r.status for r in quality.check_verified_queries(empty).collect()} == {"WARN"}


def test_duplicate_and_null_keys(spark, tables):
    flows = fx.flows(spark, "inflow", [("A", "U", "C", "1.00", None)] * 3 + [("B", "U", "C", "1.00", None), (None, "U", "C", "1.00", None), (None, "V", "C", "1.00", None)])
    given = {"cash_inflows": flows, "positions": tables["positions"], "cash_outflows": tables["cash_outflows"].limit(0)}
    have = {r.table_name: tuple(r)[1:] for r in quality.duplicate_keys(given).collect()}
    assert have == {
        "cash_inflows": ("inflow_id", 6, 2, 2, 2, "FAIL"),
        "positions": ("position_id", 4, 4, 0, 0, "PASS"),
        "cash_outflows": ("outflow_id", 0, 0, 0, 0, "PASS"),
    }


def test_each_table_is_read_once_for_all_its_checks(spark, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    text = quality.orphans(stored)._jdf.queryExecution().executedPlan().toString()
    for fact_table in ("cash_outflows", "cash_inflows", "positions"):
        assert len([x for x in text.splitlines() if "FileScan" in x and x.count(f"/{fact_table}]")]) == 1


def test_drill_across_keeps_facts_apart(spark, tables):
    found = drill_across(
        tables,
        ["cash_inflows.inflow_amount_usd", "cash_outflows.outflow_amount_usd", "positions.position_value_usd"],
        {"region": ("counterparty_data.region", "business_unit_reference.region")},
    )
    assert found.columns == ["region", "inflow_amount_usd", "outflow_amount_usd", "position_value_usd"]
    assert rows(found, *found.columns) == sorted(
        [("Europe", 5, None, 50), ("Asia", None, 24, 20), (None, 2, 32, 30)], key=str
    )
    whole = drill_across(tables, ["cash_inflows.inflow_amount_usd", "positions.position_value_usd"], {})
    assert rows(whole, *whole.columns) == [(7, 100)]
    held = {**tables, "positions": tables["positions"].withColumn("quantity", F.lit(Decimal("1.2345")).cast("decimal(20,4)"))}
    fine = drill_across(held, ["cash_outflows.outflow_amount_usd", "positions.quantity"], {})
    assert rows(fine, *fine.columns) == [(Decimal("56.00"), Decimal("4.9380"))]
    counted = drill_across(held, ["cash_inflows.inflow_amount_usd", "positions.quantity"], {}, "count")
    assert [t for _, t in counted.dtypes] == ["bigint", "bigint"] and rows(counted, *counted.columns) == [(3, 4)]
    with pytest.raises(KeyError, match="none of"):
        drill_across(tables, ["positions.position_value_usd"], {"kind": ("counterparty_data.counterparty_type",)})
    with pytest.raises(ValueError, match="differ"):
        drill_across(tables, ["positions.quantity"], {"quantity": ("positions.position_type",)})


def test_missing_fields(tables):
    counts = {(r.table_name, r.column_name): r.null_count for r in quality.missing_fields(tables).collect()}
    assert counts["cash_inflows", "counterparty_id"] == 1
    assert counts["positions", "maturity_date"] == 2
    assert sum(counts.values()) == 4  # and the open inflow


def test_flow_breakdowns(book):
    buckets = {(r.direction, r.maturity_bucket): r.amount_usd for r in ask.flows_by_bucket(book, fx.NOON).collect()}
    assert buckets == {
        ("inflow", "open"): 1, ("inflow", "matured"): 2, ("inflow", "0-89"): 4,
        ("outflow", "90-179"): 40, ("outflow", "365+"): 16,
    }
    types = {(r.direction, r.counterparty_type): (r.n_flows, r.amount_usd) for r in ask.flows_by_counterparty_type(book).collect()}
    assert types == {
        ("inflow", "Bank"): (2, 5), ("inflow", None): (1, 2),
        ("outflow", "Corporate"): (2, 24), ("outflow", None): (1, 32),
    }


def test_top_reports(book):
    top = ask.largest_outflows(book, 1).collect()
    assert [(r.counterparty_id, r.counterparty_name, r.outflow_usd) for r in top] == [("C7", None, 32)]
    net = ask.net_outflow_by_unit(book).collect()
    assert [(r.business_unit_id, r.net_outflow_usd) for r in net] == [("U2", 44), ("U1", 5)]
    assert [r.position_id for r in ask.largest_positions(book, 2).collect()] == ["P4", "P3"]
    best = ask.hqla_by_unit(book, fx.NOON, 1).collect()
    assert [(r.business_unit_id, r.hqla_usd) for r in best] == [("U1", 50)]


def test_ties_in_top_reports_follow_the_key(spark, book):
    doubled = spark.createDataFrame(
        [("O1", "U1", "B", Decimal(5), None), ("O2", "U1", "A", Decimal(5), None)], book.cash_outflows.schema
    )
    tied = Book(**{**book.tables(), "cash_outflows": doubled})
    assert [r.counterparty_id for r in ask.largest_outflows(tied, 1).collect()] == ["A"]


def test_scenario_reports(spark):
    rules = fx.rules(
        spark, [("2", "T", "T", "B", "v", 0.1), ("1", "T", "T", "A", "v", 0.1), ("1", "T", "X", "A", "v", 0.1)]
    )
    assert [r.what_if_id for r in ask.scenario_definitions(rules).collect()] == ["1", "2"]
    assert [r.what_if_id for r in ask.scenario_listing(rules).collect()] == ["1", "1", "2"]
    assert [r.what_if_id for r in ask.scenario_ids(rules).collect()] == ["1", "2"]
    assert ask.scenario_rules(rules, "1").count() == 1
