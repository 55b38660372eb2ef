"""Reference rows of the model: asset classes, currencies, units, scenarios, rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ebbline.functions.calendar import instant
from ebbline.sources.inline import inline_table

# The reference rows.
ASSET_CLASSES = [
    ("CASH", "Level 1", "0.00", "Cash and central bank reserves", "Basel III Article 416"),
    ("CENTRAL_BANK_RESERVES", "Level 1", "0.00", "Central bank reserves", "Basel III Article 416"),
    ("GOVERNMENT_BONDS_AAA", "Level 1", "0.00", "Government bonds rated AAA", "Basel III Article 416"),
    ("GOVERNMENT_BONDS_AA", "Level 1", "0.00", "Government bonds rated AA", "Basel III Article 416"),
    ("GOVERNMENT_BONDS_A", "Level 1", "0.00", "Government bonds rated A", "Basel III Article 416"),
    ("CORPORATE_BONDS_AA", "Level 2A", "15.00", "Corporate bonds rated AA", "Basel III Article 417"),
    ("COVERED_BONDS_AA", "Level 2A", "15.00", "Covered bonds rated AA", "Basel III Article 417"),
    ("MUNICIPAL_BONDS_AA", "Level 2A", "15.00", "Municipal bonds rated AA", "Basel III Article 417"),
    ("CORPORATE_BONDS_A", "Level 2A", "15.00", "Corporate bonds rated A", "Basel III Article 417"),
    ("CORPORATE_BONDS_BBB", "Level 2B", "25.00", "Corporate bonds rated BBB", "Basel III Article 418"),
    ("EQUITIES_MAIN_INDEX", "Level 2B", "25.00", "Equities included in main stock index", "Basel III Article 418"),
    ("EQUITIES_OTHER", "Level 2B", "50.00", "Other equities", "Basel III Article 418"),
    ("COVERED_BONDS_BBB", "Level 2B", "25.00", "Covered bonds rated BBB", "Basel III Article 418"),
]
CURRENCIES = [
    ("USD", "US Dollar", True, "1.000000"),
    ("EUR", "Euro", True, "0.920000"),
    ("GBP", "British Pound", True, "0.790000"),
    ("JPY", "Japanese Yen", True, "150.000000"),
    ("CHF", "Swiss Franc", True, "0.880000"),
    ("CAD", "Canadian Dollar", True, "1.350000"),
    ("AUD", "Australian Dollar", True, "1.500000"),
    ("CNY", "Chinese Yuan", True, "7.200000"),
    ("HKD", "Hong Kong Dollar", False, "7.800000"),
    ("SGD", "Singapore Dollar", False, "1.350000"),
]
BUSINESS_UNITS = [
    ("GLOBAL", "Global Bank", "Group", "Global"),
    ("US_TREASURY", "US Treasury", "Treasury", "North America"),
    ("EU_TREASURY", "EU Treasury", "Treasury", "Europe"),
    ("ASIA_TREASURY", "Asia Treasury", "Treasury", "Asia"),
    ("US_TRADING", "US Trading", "Trading", "North America"),
    ("EU_TRADING", "EU Trading", "Trading", "Europe"),
    ("ASIA_TRADING", "Asia Trading", "Trading", "Asia"),
    ("INVESTMENT_BANKING", "Investment Banking", "Investment Banking", "Global"),
    ("WEALTH_MANAGEMENT", "Wealth Management", "Wealth Management", "Global"),
]
STRESS_SCENARIOS = [
    ("BASEL_STANDARD", "Basel III Standard Scenario", "Basel III", "Standard Basel III stress scenario"),
    ("MARKET_CRISIS", "Market Crisis Scenario", "Custom", "Severe market stress scenario"),
    ("LIQUIDITY_CRISIS", "Liquidity Crisis Scenario", "Custom", "Extreme liquidity stress scenario"),
]
# (what_if_id, what_if_name, ref_tbl, tbl, col, val, factor)
WHAT_IF_RULES = [
    ("1", "TEST", "COUNTERPARTY_DATA", "COUNTERPARTY_DATA", "REGION", "Europe", -0.1),
    ("1", "TEST", "COUNTERPARTY_DATA", "COUNTERPARTY_DATA", "COUNTERPARTY_TYPE", "Institutional", -0.15),
    ("1", "TEST", "POSITIONS", "ASSET_CLASSIFICATIONS", "SECURITY_TYPE", "GOVERNMENT_BONDS_AAA", -0.05),
    ("1", "TEST", "POSITIONS", "ASSET_CLASSIFICATIONS", "SECURITY_TYPE", "EQUITIES_MAIN_INDEX", -0.1),
    ("1", "TEST", "POSITIONS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Treasury", -0.05),
    ("1", "TEST", "CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Treasury", -0.02),
    ("1", "TEST", "CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE", "REGION", "North America", -0.1),
    ("1", "TEST", "CASH_OUTFLOWS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Treasury", -0.01),
    ("1", "TEST", "CASH_OUTFLOWS", "BUSINESS_UNIT_REFERENCE", "REGION", "North America", -0.05),
    ("2", "TEST2", "COUNTERPARTY_DATA", "COUNTERPARTY_DATA", "REGION", "Europe", -0.1),
    ("2", "TEST2", "COUNTERPARTY_DATA", "COUNTERPARTY_DATA", "REGION", "Asia", -0.15),
    ("2", "TEST2", "COUNTERPARTY_DATA", "COUNTERPARTY_DATA", "COUNTERPARTY_TYPE", "Institutional", -0.15),
    ("2", "TEST2", "COUNTERPARTY_DATA", "COUNTERPARTY_DATA", "COUNTERPARTY_TYPE", "Bank", -0.05),
    ("2", "TEST2", "POSITIONS", "ASSET_CLASSIFICATIONS", "SECURITY_TYPE", "GOVERNMENT_BONDS_AAA", -0.05),
    ("2", "TEST2", "POSITIONS", "ASSET_CLASSIFICATIONS", "SECURITY_TYPE", "EQUITIES_MAIN_INDEX", -0.1),
    ("2", "TEST2", "POSITIONS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Treasury", -0.05),
    ("2", "TEST2", "CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Investment Banking", -0.02),
    ("2", "TEST2", "CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Trading", -0.1),
    ("2", "TEST2", "CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE", "REGION", "Europe", -0.2),
    ("2", "TEST2", "CASH_OUTFLOWS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Trading", -0.01),
    ("2", "TEST2", "CASH_OUTFLOWS", "BUSINESS_UNIT_REFERENCE", "REGION", "Europe", -0.05),
]

RULE_COLUMNS = ("what_if_id", "what_if_name", "ref_tbl", "tbl", "col", "val", "factor")

_TABLES = {
    "asset_classifications": (
        ("security_type", "hqla_level", "haircut_percent", "description", "regulatory_basis"),
        ASSET_CLASSES,
    ),
    "currency_reference": (
        ("currency_code", "currency_name", "is_major_currency", "fx_rate_usd"),
        CURRENCIES,
    ),
    "business_unit_reference": (
        ("business_unit_id", "business_unit_name", "business_unit_type", "region"),
        BUSINESS_UNITS,
    ),
    "stress_scenarios": (
        ("scenario_id", "scenario_name", "scenario_type", "description"),
        STRESS_SCENARIOS,
    ),
    "what_if_definitions_lookup": (RULE_COLUMNS, WHAT_IF_RULES),
}


def reference_table(spark: SparkSession, table: str, now: dt.datetime) -> DataFrame:
    """One of the five reference tables, stamped with ``now``."""
    columns, rows = _TABLES[table]
    return inline_table(spark, table, columns, rows, instant(now))
