"""Small hand-made books and a plain-Python calculation to compare against."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, SparkSession

NOON = dt.datetime(2024, 3, 10, 12, 0)
MIDNIGHT = dt.datetime(2024, 3, 10)
TODAY = NOON.date()
CENT = Decimal("0.01")


def day(offset: int) -> dt.date:
    return TODAY + dt.timedelta(days=offset)


def positions(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(id, unit, security_type, position_type, value, maturity)"""
    return spark.createDataFrame(
        [(i, u, f"S-{i}", t, p, Decimal(v), m) for i, u, t, p, v, m in rows],
        "position_id string, business_unit_id string, security_id string, security_type string,"
        " position_type string, position_value_usd decimal(20,2), maturity_date date",
    )


def flows(spark: SparkSession, side: str, rows: list[tuple]) -> DataFrame:
    """(id, unit, counterparty, amount, maturity)"""
    return spark.createDataFrame(
        [(i, u, c, Decimal(a), m) for i, u, c, a, m in rows],
        f"{side}_id string, business_unit_id string, counterparty_id string,"
        f" {side}_amount_usd decimal(20,2), maturity_date date",
    )


def classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            ("CASH", "Level 1", Decimal("0.00")),
            ("BOND", "Level 2A", Decimal("15.00")),
            ("EQUITY", "Level 2B", Decimal("33.33")),
        ],
        "security_type string, hqla_level string, haircut_percent decimal(5,2)",
    )


def units(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("U1", "One", "Treasury", "Europe"), ("U2", "Two", "Trading", "Asia")],
        "business_unit_id string, business_unit_name string, business_unit_type string,"
        " region string",
    )


def counterparties(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("C1", "First", "Bank", "Europe"), ("C2", "Second", "Corporate", "Asia")],
        "counterparty_id string, counterparty_name string, counterparty_type string,"
        " region string",
    )


def rules(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(id, ref_tbl, tbl, col, val, factor)"""
    return spark.createDataFrame(
        [(r[0], "test", *r[1:]) for r in rows],
        "what_if_id string, what_if_name string, ref_tbl string, tbl string, col string,"
        " val string, factor double",
    )


def cents(value: Decimal) -> Decimal:
    return value.quantize(CENT, ROUND_HALF_UP)


def plain_hqla(rows: list[tuple], as_of: dt.datetime, n: int, decay: str) -> dict[int, Decimal]:
    """Daily sums of (value after haircut, maturity) rows, one row and day at a time."""
    kept = [(v, m) for v, m in rows if m is None or m >= as_of.date()]
    if not kept:
        return {}
    result = {}
    for i in range(n):
        now = as_of + dt.timedelta(days=i)
        factor = (Decimal(decay) ** i).quantize(Decimal(1).scaleb(-16), ROUND_HALF_UP)
        live = [
            v for v, m in kept if m is None or dt.datetime.combine(m, dt.time()) > now
        ]
        result[i + 1] = sum((cents(v * factor) for v in live), Decimal("0.00"))
    return result


def plain_flow(rows: list[tuple], as_of: dt.datetime, n: int) -> dict[int, Decimal]:
    """Daily sums of (amount, maturity) rows, one row and day at a time."""

    def due(m: dt.date) -> dt.datetime:
        return dt.datetime.combine(m, dt.time())

    kept = [(a, m) for a, m in rows if m is None or due(m) >= as_of]
    if not kept:
        return {}
    return {
        i + 1: sum(
            (a for a, m in kept if m is None or due(m) >= as_of + dt.timedelta(days=i)),
            Decimal("0.00"),
        )
        for i in range(n)
    }


def by_day(df: DataFrame, column: str) -> dict[int, Decimal]:
    rows = df.collect()
    result = {r["day_number"]: r[column] for r in rows}
    assert len(result) == len(rows)
    return result
