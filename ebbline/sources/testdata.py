"""The model tables read out of a TPC-H-like star schema.

Facts come from lineitem and orders, dimensions from customer, part, supplier, nation
and region.  Unit, counterparty and security type are N:1 lookups over foreign keys of
that schema, so a lookup whose columns are not asked for is left out of the plan
without changing any row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.money import MONEY
from ebbline.plans.jobs import Book
from ebbline.sources.inline import inline_table
from ebbline.sources.reference import RULE_COLUMNS

AS_OF = dt.datetime(1998, 6, 1, 12, 0, 0)

# Fixed values of the binding: asset classes by part type (PROMO stays unclassified),
# category cycles, the share of a price that flows, and two scenarios of this library.
ASSET_CLASSES = [
    ("ECONOMY", "Level 1", "0.00"),
    ("STANDARD", "Level 1", "0.00"),
    ("MEDIUM", "Level 2A", "15.00"),
    ("LARGE", "Level 2B", "25.00"),
    ("SMALL", "Level 2B", "50.00"),
]
UNIT_TYPES = ("Treasury", "Trading", "Investment Banking", "Wealth Management")
RATINGS = ("AAA", "AA", "A", "BBB", "BB")
FLOW_SHARE = Decimal("0.195")
# Setting of the session: partitions to deal line items to when they are read, for a file
# whose one row group would be one task.  Unset, the scan is left as it is.
PARTITIONS = "ebbline.lineitem.partitions"
DEAL_BY = ("l_extendedprice", "l_shipdate")
# Rules for the cases that matter: one given twice, ids hit by two rules, equal factors of
# two rules, factors above 1, a value that nothing has and one filed under another column.
RULES = [
    ("1", "DOWNTURN", "POSITIONS", "ASSET_CLASSIFICATIONS", "SECURITY_TYPE", "LARGE", -0.22),
    ("1", "DOWNTURN", "POSITIONS", "ASSET_CLASSIFICATIONS", "SECURITY_TYPE", "LARGE", -0.22),
    ("1", "DOWNTURN", "CASH_OUTFLOWS", "BUSINESS_UNIT_REFERENCE", "REGION", "AMERICA", 0.08),
    ("1", "DOWNTURN", "CASH_OUTFLOWS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Wealth Management", 0.03),
    ("1", "DOWNTURN", "COUNTERPARTY_DATA", "COUNTERPARTY_DATA", "COUNTERPARTY_TYPE", "MACHINERY", -0.17),
    ("1", "DOWNTURN", "CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE", "REGION", "MIDDLE EAST", -0.26),
    ("1", "DOWNTURN", "CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE", "REGION", "NOWHERE", -0.5),
    ("2", "REGIONAL", "COUNTERPARTY_DATA", "COUNTERPARTY_DATA", "REGION", "AFRICA", -0.31),
    ("2", "REGIONAL", "COUNTERPARTY_DATA", "COUNTERPARTY_DATA", "REGION", "HOUSEHOLD", -0.07),
    ("2", "REGIONAL", "CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Investment Banking", -0.12),
    ("2", "REGIONAL", "POSITIONS", "BUSINESS_UNIT_REFERENCE", "REGION", "EUROPE", -0.06),
    ("2", "REGIONAL", "POSITIONS", "BUSINESS_UNIT_REFERENCE", "BUSINESS_UNIT_TYPE", "Trading", -0.06),
]
# Scenario 3 has one rule per region, market segment and part type found in the data.
DERIVED_ID, DERIVED_NAME = "3", "MARKETWIDE"


def _unit(nation_key: str) -> Column:
    return F.concat(F.lit("BU_"), F.col(nation_key).cast("string"))


def _cycle(values: Sequence[str], number: Column) -> Column:
    labels = F.array(*[F.lit(v) for v in values])
    return F.element_at(labels, (number % len(values) + 1).cast("int"))


class StarSchema:
    """Model tables over the Parquet files of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            scan = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            partitions = self.spark.conf.get(PARTITIONS, None)
            if partitions and name == "lineitem":
                scan = scan.repartition(int(partitions), *DEAL_BY)
            self._raw[name] = scan
        return self._raw[name]

    def _regions(self) -> DataFrame:
        return self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    def business_unit_reference(self) -> DataFrame:
        return self._regions().select(
            _unit("n_nationkey").alias("business_unit_id"),
            F.col("n_name").alias("business_unit_name"),
            _cycle(UNIT_TYPES, F.col("n_nationkey")).alias("business_unit_type"),
            F.col("r_name").alias("region"),
        )

    def counterparty_data(self) -> DataFrame:
        return (
            self.raw("customer")
            .join(self._regions(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").cast("string").alias("counterparty_id"),
                F.col("c_name").alias("counterparty_name"),
                F.col("c_mktsegment").alias("counterparty_type"),
                _cycle(RATINGS, F.col("c_custkey")).alias("credit_rating"),
                F.col("r_name").alias("region"),
            )
        )

    def asset_classifications(self) -> DataFrame:
        return inline_table(
            self.spark,
            "asset_classifications",
            ("security_type", "hqla_level", "haircut_percent"),
            ASSET_CLASSES,
        ).select("security_type", "hqla_level", "haircut_percent")

    def what_if_definitions_lookup(self) -> DataFrame:
        counterparty, rows = "COUNTERPARTY_DATA", ("ref_tbl", "tbl", "col", "val", "factor")
        regions = self.raw("region").select(
            F.lit(counterparty), F.lit(counterparty), F.lit("REGION"), "r_name",
            (F.col("r_regionkey") + 1) * F.lit(-0.01),
        )
        segments = self.raw("customer").select("c_mktsegment").distinct().select(
            F.lit(counterparty), F.lit(counterparty), F.lit("COUNTERPARTY_TYPE"),
            "c_mktsegment", F.lit(-0.02),
        )
        types = self.raw("part").select("p_type").distinct().select(
            F.lit("POSITIONS"), F.lit("ASSET_CLASSIFICATIONS"), F.lit("SECURITY_TYPE"),
            "p_type", F.lit(-0.03),
        )
        derived = (
            regions.toDF(*rows).union(segments.toDF(*rows)).union(types.toDF(*rows))
        ).select(F.lit(DERIVED_ID).alias("what_if_id"), F.lit(DERIVED_NAME).alias("what_if_name"), "*")
        written = inline_table(
            self.spark, "what_if_definitions_lookup", RULE_COLUMNS, RULES
        ).select(*RULE_COLUMNS)
        return written.unionByName(derived)

    def positions(self, units: bool = True) -> DataFrame:
        lines = self.raw("lineitem").join(
            self.raw("part").select("p_partkey", F.col("p_type").alias("security_type")),
            F.col("l_partkey") == F.col("p_partkey"),
        )
        if units:
            lines = lines.join(
                self.raw("supplier").select("s_suppkey", _unit("s_nationkey").alias("business_unit_id")),
                F.col("l_suppkey") == F.col("s_suppkey"),
            )
        return lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("position_id"),
            *(["business_unit_id"] if units else []),
            F.col("l_partkey").cast("string").alias("security_id"),
            "security_type",
            F.when(F.col("l_returnflag") == "R", "Short").otherwise("Long").alias("position_type"),
            F.col("l_quantity").cast("decimal(20,4)").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("position_value_usd"),
            F.to_date("l_shipdate").alias("position_date"),
            F.when(F.col("l_linenumber") != 1, F.to_date("l_shipdate")).alias("maturity_date"),
        )

    def cash_inflows(self, units: bool = True) -> DataFrame:
        orders = self.raw("orders")
        if units:
            orders = orders.join(
                self.raw("customer").select("c_custkey", _unit("c_nationkey").alias("business_unit_id")),
                F.col("o_custkey") == F.col("c_custkey"),
            )
        return orders.select(
            F.col("o_orderkey").cast("string").alias("inflow_id"),
            *(["business_unit_id"] if units else []),
            F.col("o_custkey").cast("string").alias("counterparty_id"),
            F.col("o_orderpriority").alias("inflow_type"),
            (F.col("o_totalprice").cast(MONEY) * F.lit(FLOW_SHARE)).cast(MONEY).alias("inflow_amount_usd"),
            F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("maturity_date"),
            F.to_date("o_orderdate").alias("position_date"),
        )

    def cash_outflows(self, units: bool = True, counterparties: bool = True) -> DataFrame:
        lines = self.raw("lineitem")
        owner = []
        if units or counterparties:
            # Orders find their customer before line items find their order: the longer side is shuffled once.
            orders = self.raw("orders").select("o_orderkey", "o_custkey")
            owner.append(F.col("o_custkey").cast("string").alias("counterparty_id"))
            if units:
                owner.append(F.col("business_unit_id"))
                orders = orders.join(
                    self.raw("customer").select("c_custkey", _unit("c_nationkey").alias("business_unit_id")),
                    F.col("o_custkey") == F.col("c_custkey"),
                )
            lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        open_ended = (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 2)
        return lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("outflow_id"),
            *owner,
            F.col("l_returnflag").alias("outflow_type"),
            (F.col("l_extendedprice").cast(MONEY) * F.lit(FLOW_SHARE)).cast(MONEY).alias("outflow_amount_usd"),
            F.when(~open_ended, F.to_date("l_shipdate")).alias("maturity_date"),
            F.to_date("l_shipdate").alias("position_date"),
        )

    def facts(self, units: bool = False, counterparties: bool = False) -> Book:
        """The tables a baseline forecast reads, with the lookups that are asked for."""
        return Book(
            positions=self.positions(units),
            cash_inflows=self.cash_inflows(units),
            cash_outflows=self.cash_outflows(units, counterparties),
            asset_classifications=self.asset_classifications(),
        )

    def book(self, units: bool = True) -> Book:
        """All model tables but the scenario rules."""
        return replace(
            self.facts(units, counterparties=True),
            counterparty_data=self.counterparty_data(),
            business_unit_reference=self.business_unit_reference(),
        )

    def book_with_rules(self) -> Book:
        """All model tables."""
        return replace(
            self.book(), what_if_definitions_lookup=self.what_if_definitions_lookup()
        )
