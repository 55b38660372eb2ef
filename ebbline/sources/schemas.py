"""Declared schemas of the model tables and conformance of inputs to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.functions.money import MONEY, RATIO, STORED_HQLA, TOTAL


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(5,2)": T.DecimalType(5, 2),
    "decimal(15,6)": T.DecimalType(15, 6),
    "decimal(20,2)": MONEY,
    "decimal(20,4)": T.DecimalType(20, 4),
    "decimal(32,10)": T.DecimalType(32, 10),
    "decimal(38,2)": TOTAL,
}


def _table(*fields: str) -> T.StructType:
    """Build a schema from ``name type`` strings; a trailing ``!`` means NOT NULL.

    (Parsing a DDL string would need a running session at import time.)
    """
    schema = T.StructType()
    for field in fields:
        name, kind = field.rstrip("!").split(" ")
        schema.add(name, _TYPES[kind], not field.endswith("!"))
    return schema


# Tables, columns and types of the model.
SCHEMAS: dict[str, T.StructType] = {
    "counterparty_data": _table(
        "counterparty_id string!", "counterparty_name string!", "counterparty_type string",
        "credit_rating string", "region string", "is_active boolean",
        "created_date timestamp_ntz",
    ),
    "business_unit_reference": _table(
        "business_unit_id string!", "business_unit_name string!",
        "business_unit_type string", "region string", "is_active boolean",
        "created_date timestamp_ntz",
    ),
    "asset_classifications": _table(
        "security_type string!", "hqla_level string!", "haircut_percent decimal(5,2)!",
        "description string", "regulatory_basis string", "created_date timestamp_ntz",
    ),
    "currency_reference": _table(
        "currency_code string!", "currency_name string!", "is_major_currency boolean",
        "fx_rate_usd decimal(15,6)", "last_updated timestamp_ntz",
    ),
    "stress_scenarios": _table(
        "scenario_id string!", "scenario_name string!", "scenario_type string",
        "description string", "is_active boolean", "created_date timestamp_ntz",
    ),
    "what_if_definitions_lookup": _table(
        "what_if_id string!", "what_if_name string!", "ref_tbl string!", "tbl string!",
        "col string!", "val string!", "factor double!", "created_date timestamp_ntz",
    ),
    "positions": _table(
        "position_id string!", "business_unit_id string!", "security_id string!",
        "security_type string!", "position_type string!", "quantity decimal(20,4)!",
        "position_value_usd decimal(20,2)!", "position_date date!", "maturity_date date",
        "created_date timestamp_ntz",
    ),
    "cash_inflows": _table(
        "inflow_id string!", "business_unit_id string!", "counterparty_id string!",
        "inflow_type string!", "inflow_amount_usd decimal(20,2)!", "maturity_date date",
        "position_date date!", "created_date timestamp_ntz",
    ),
    "cash_outflows": _table(
        "outflow_id string!", "business_unit_id string!", "counterparty_id string!",
        "outflow_type string!", "outflow_amount_usd decimal(20,2)!", "maturity_date date",
        "position_date date!", "created_date timestamp_ntz",
    ),
    "market_data": _table(
        "security_id string!", "security_type string", "price_usd decimal(20,4)",
        "market_date date!", "created_date timestamp_ntz",
    ),
    "hqla_summary": _table("day_number int", "total_hqla_usd decimal(38,2)"),
    "hqla_detail": _table("maturity_date date", "total_hqla_usd decimal(32,10)"),
    "net_cashflow_projections": _table(
        "day_number int", "total_inflow decimal(38,2)", "total_outflow decimal(38,2)",
        "net_position decimal(38,2)", "abs_net_position decimal(38,2)",
    ),
    "lcr": T.StructType(
        [
            T.StructField("created_timestamp", T.TimestampNTZType()),
            T.StructField("run_id", T.StringType()),
            T.StructField("day_number", T.IntegerType()),
            T.StructField("total_net_cash_outflows", TOTAL),
            T.StructField("hqla", STORED_HQLA),
            T.StructField("lcr", RATIO),
        ]
    ),
}
SCHEMAS["what_if_lcr"] = T.StructType(
    [T.StructField("what_if_id", T.StringType()), *SCHEMAS["lcr"].fields]
)

# The manifests of run histories, and what keys a history's partitions.
SCHEMAS["lcr_runs"] = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("created_timestamp", T.TimestampNTZType()),
        T.StructField("n_rows", T.LongType()),
    ]
)
SCHEMAS["what_if_lcr_runs"] = T.StructType(
    [T.StructField("what_if_id", T.StringType()), *SCHEMAS["lcr_runs"].fields]
)
RUN_KEYS = {"lcr": ("run_id",), "what_if_lcr": ("what_if_id", "run_id")}
STORED_BY_RUN = {*RUN_KEYS, *(f"{table}_runs" for table in RUN_KEYS)}

# Column defaults.  Timestamps default to the ``now`` of the caller.
DEFAULT_TRUE = {"is_active"}
DEFAULT_FALSE = {"is_major_currency"}
DEFAULT_NOW = {"created_date", "last_updated", "created_timestamp"}


def conform(
    df: DataFrame, table: str, now: Column | None = None, enforce: bool = True
) -> DataFrame:
    """Project ``df`` onto the declared columns: cast, default and check NOT NULL.

    Columns that are absent are filled with their declared default or NULL.  A NULL in
    a NOT NULL column fails the query that reads it.  Names match without case.
    Enforce on the way in; reading with ``enforce=False`` leaves columns bare, so that
    filters on them still reach the scan.
    """
    present = {c.lower(): c for c in df.columns}

    def column(field: T.StructField) -> Column:
        name = field.name
        if name in present:
            value = F.col(present[name]).cast(field.dataType)
        elif name in DEFAULT_TRUE or name in DEFAULT_FALSE:
            value = F.lit(name in DEFAULT_TRUE)
        elif name in DEFAULT_NOW and now is not None:
            value = now.cast(field.dataType)
        elif field.nullable:
            value = F.lit(None).cast(field.dataType)
        else:
            raise ValueError(f"{table}: required column {name} is missing")
        if enforce and not field.nullable:
            broken = F.raise_error(F.lit(f"{table}.{name} is NULL")).cast(field.dataType)
            value = F.when(value.isNull(), broken).otherwise(value)
        return value.alias(name)

    return df.select(*[column(f) for f in SCHEMAS[table].fields])


def missing_and_extra(df: DataFrame, declared: set[str]) -> tuple[set[str], set[str]]:
    """Declared columns absent from ``df`` and columns of ``df`` not declared."""
    actual = {c.lower() for c in df.schema.fieldNames()}
    return declared - actual, actual - declared
