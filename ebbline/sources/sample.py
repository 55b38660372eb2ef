"""Sample data of any size: counterparties, market data, positions and cash flows.

Rows come from ``spark.range``, so every table is generated by as many tasks as the
range has partitions.  Values vary with ``seed``; keys, categories and dates depend on
the row number alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.sources.schemas import conform

# Categories cycled by row number, and sizes.
COUNTERPARTY_TYPES = ("Bank", "Corporate", "Sovereign", "Institutional")
CREDIT_RATINGS = ("AAA", "AA", "A", "BBB", "BB")
COUNTERPARTY_REGIONS = ("North America", "Europe", "Asia")
SECURITY_TYPES = (
    "GOVERNMENT_BOND", "GOVERNMENT_BOND", "GOVERNMENT_BOND", "CORPORATE_BOND",
    "CORPORATE_BOND", "EQUITY", "DERIVATIVE", "MONEY_MARKET",
)
UNITS = (
    "US_TRADING", "US_TREASURY", "EU_TRADING", "EU_TREASURY", "ASIA_TRADING",
    "ASIA_TREASURY", "GLOBAL", "INVESTMENT_BANKING", "WEALTH_MANAGEMENT",
)
POSITION_TYPES = ("Long", "Short")
CASH_TYPES = ("CASH", "CENTRAL_BANK_RESERVES")
FLOW_TYPES = ("DEPOSIT", "LOAN_REPAYMENT", "INTEREST_PAYMENT", "OTHER")

N_COUNTERPARTIES = 2_000
N_SECURITIES = 10_000
N_MARKET_DAYS = 365
N_POSITIONS = 500_000
N_CASH_POSITIONS = 80_000
N_FLOWS = 100_000


def _cycle(values: Sequence[str]) -> Column:
    labels = F.array(*[F.lit(v) for v in values])
    return F.element_at(labels, (F.col("id") % len(values) + 1).cast("int"))


def _key(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def _uniform(low: float, high: float, seed: int) -> Column:
    return F.lit(low) + F.rand(seed) * F.lit(high - low)


def _days_after(today: dt.date, days: Column) -> Column:
    return F.date_add(F.lit(today), days.cast("int"))


def counterparties(spark: SparkSession, today: dt.date, n: int = N_COUNTERPARTIES) -> DataFrame:
    """Counterparties with type, rating and region cycled by row number."""
    rows = spark.range(n).select(
        _key("CP_", F.col("id"), 6).alias("counterparty_id"),
        F.concat(F.lit("Counterparty "), (F.col("id") + 1).cast("string")).alias(
            "counterparty_name"
        ),
        _cycle(COUNTERPARTY_TYPES).alias("counterparty_type"),
        _cycle(CREDIT_RATINGS).alias("credit_rating"),
        _cycle(COUNTERPARTY_REGIONS).alias("region"),
    )
    return conform(rows, "counterparty_data", F.lit(today))


def market_data(
    spark: SparkSession,
    today: dt.date,
    seed: int = 0,
    n_securities: int = N_SECURITIES,
    n_days: int = N_MARKET_DAYS,
) -> DataFrame:
    """One price per security and day: a base price with a daily jitter.

    Each security row produces its own days, so no cross join is planned.  The base is
    drawn in a step of its own: next to the explode it would be drawn once per day.
    """
    rows = (
        spark.range(n_securities)
        .select(
            _key("SEC_", F.col("id"), 6).alias("security_id"),
            _cycle(SECURITY_TYPES).alias("security_type"),
            _uniform(100.0, 1000.0, seed).cast("decimal(20,4)").alias("base"),
        )
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(n_days - 1))).alias("back"))
        .select(
            "security_id",
            "security_type",
            (F.col("base") * _uniform(0.98, 1.0199, seed + 1)).alias("price_usd"),
            F.date_sub(F.lit(today), F.col("back")).alias("market_date"),
        )
    )
    return conform(rows, "market_data", F.lit(today))


def positions(
    spark: SparkSession,
    today: dt.date,
    prices: DataFrame,
    seed: int = 0,
    n: int = N_POSITIONS,
    n_cash: int = N_CASH_POSITIONS,
    n_securities: int = N_SECURITIES,
    n_days: int = N_MARKET_DAYS,
) -> DataFrame:
    """Positions priced on their position date, united with cash positions."""
    held = spark.range(n).select(
        _key("POS_", F.col("id"), 8).alias("position_id"),
        _cycle(UNITS).alias("business_unit_id"),
        _key("SEC_", F.col("id") % n_securities, 6).alias("security_id"),
        _cycle(POSITION_TYPES).alias("position_type"),
        (F.lit(1) + _uniform(1.0, 5.01, seed) * 99).cast("decimal(20,4)").alias("quantity"),
        _days_after(today, -(F.col("id") % n_days)).alias("position_date"),
        F.when(F.col("id") % 3 != 0, _days_after(today, F.col("id") % 730)).alias(
            "maturity_date"
        ),
    )
    quotes = prices.select(
        "security_id", F.col("market_date").alias("position_date"), "security_type", "price_usd"
    )
    priced = held.join(quotes, ["security_id", "position_date"]).withColumn(
        "position_value_usd", F.col("quantity") * F.col("price_usd")
    )
    cash = spark.range(n_cash).select(
        _key("POS_", F.col("id") + n, 8).alias("position_id"),
        _cycle(UNITS).alias("business_unit_id"),
        _key("CASH_", F.col("id"), 6).alias("security_id"),
        _cycle(CASH_TYPES).alias("security_type"),
        F.lit("Long").alias("position_type"),
        F.lit(1).alias("quantity"),
        _uniform(10_000.0, 9_910_000.0, seed + 2).alias("position_value_usd"),
        _days_after(today, -(F.col("id") % n_days)).alias("position_date"),
    )
    now = F.lit(today)
    return (
        conform(priced, "positions", now).unionByName(conform(cash, "positions", now)).distinct()
    )


def cash_flows(
    spark: SparkSession,
    today: dt.date,
    direction: str,
    seed: int = 0,
    n: int = N_FLOWS,
    n_counterparties: int = N_COUNTERPARTIES,
) -> DataFrame:
    """Inflows or outflows whose maturities fall into fixed shares of buckets.

    By the last digit of the row number: 0 open, 1-3 within 90 days, 4-6 within
    180 days, 7-8 within a year, 9 beyond.
    """
    side = direction.lower()
    row = F.col("id")
    digit = row % 10
    maturity = (
        F.when(digit == 0, F.lit(None).cast("date"))
        .when(digit < 4, _days_after(today, row % 90))
        .when(digit < 7, _days_after(today, 90 + row % 90))
        .when(digit < 9, _days_after(today, 180 + row % 185))
        .otherwise(_days_after(today, 365 + row % 365))
    )
    gross = _uniform(1_000_000.0, 991_000_000.0, seed).cast("decimal(20,2)")
    divisor = F.floor(_uniform(1200.0, 1601.0, seed + 1)).cast("decimal(4,0)")
    rows = spark.range(n).select(
        _key(f"{side.upper()}_", row, 8).alias(f"{side}_id"),
        _cycle(UNITS).alias("business_unit_id"),
        _key("CP_", row % n_counterparties, 6).alias("counterparty_id"),
        _cycle(FLOW_TYPES).alias(f"{side}_type"),
        (gross / divisor).alias(f"{side}_amount_usd"),
        maturity.alias("maturity_date"),
        _days_after(today, -(row % 365)).alias("position_date"),
    )
    return conform(rows, f"cash_{side}s", F.lit(today))
