"""Business questions over a book and its forecasts, each a parameterised DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.calendar import maturity_bucket
from ebbline.functions.money import TOTAL
from ebbline.operators.projection import hqla_detail
from ebbline.plans.jobs import Book


def hqla_by(book: Book, as_of: dt.datetime, key: str) -> DataFrame:
    """HQLA after haircut by a position or asset-class column (security type, level)."""
    detail = hqla_detail(book.positions, book.asset_classifications, as_of, (key,))
    return detail.groupBy(key).agg(F.sum("total_hqla_usd").cast(TOTAL).alias("hqla_usd"))


def hqla_by_unit(book: Book, as_of: dt.datetime, k: int | None = None) -> DataFrame:
    """HQLA by business unit, largest first; ``k`` keeps the top units.

    Units are named after the sums are made, so only one row per unit is joined.
    """
    sums = hqla_by(book, as_of, "business_unit_id")
    names = book.business_unit_reference.select("business_unit_id", "business_unit_name")
    named = sums.join(names, "business_unit_id").select(
        "business_unit_id", "business_unit_name", "hqla_usd"
    )
    return _top(named, "hqla_usd", "business_unit_id", k=k)


def _top(df: DataFrame, value: str, *ties: str, k: int | None) -> DataFrame:
    """Largest values first, ties by key; the limit turns this into a top-k."""
    ordered = df.orderBy(F.col(value).desc(), *ties)
    return ordered if k is None else ordered.limit(k)


def largest_outflows(book: Book, k: int = 10) -> DataFrame:
    """Counterparties with the largest outflows, by total.

    The top k are chosen before names are looked up, so k bounds both broadcasts.
    """
    sums = book.cash_outflows.groupBy("counterparty_id").agg(
        F.sum("outflow_amount_usd").cast(TOTAL).alias("outflow_usd")
    )
    top = _top(sums, "outflow_usd", "counterparty_id", k=k)
    names = book.counterparty_data.select(
        "counterparty_id", "counterparty_name", "counterparty_type"
    )
    # A left join can only broadcast its right side, so the names are cut to the top's first.
    named = names.join(F.broadcast(top.select("counterparty_id")), "counterparty_id", "left_semi")
    return top.join(F.broadcast(named), "counterparty_id", "left").select(
        "counterparty_id", "counterparty_name", "counterparty_type", "outflow_usd"
    ).orderBy(F.col("outflow_usd").desc(), "counterparty_id")


def net_outflow_by_unit(book: Book, k: int | None = None) -> DataFrame:
    """Outflow minus inflow per business unit over all flows, largest first."""
    inflow = book.cash_inflows.groupBy("business_unit_id").agg(
        F.sum("inflow_amount_usd").alias("inflow")
    )
    outflow = book.cash_outflows.groupBy("business_unit_id").agg(
        F.sum("outflow_amount_usd").alias("outflow")
    )
    zero = F.lit(0).cast(TOTAL)
    net = inflow.join(outflow, "business_unit_id", "full").select(
        "business_unit_id",
        F.coalesce("inflow", zero).cast(TOTAL).alias("inflow_usd"),
        F.coalesce("outflow", zero).cast(TOTAL).alias("outflow_usd"),
    )
    gap = (F.col("outflow_usd") - F.col("inflow_usd")).cast(TOTAL)
    return _top(
        net.withColumn("net_outflow_usd", gap), "net_outflow_usd", "business_unit_id", k=k
    )


def positions_like(book: Book, pattern: str = "GOVERNMENT%") -> DataFrame:
    """Positions whose security type matches; the default asks for government bonds."""
    return book.positions.filter(F.col("security_type").like(pattern)).select(
        "position_id", "security_id", "security_type", "position_type",
        "position_value_usd", "maturity_date",
    )


def largest_positions(book: Book, k: int = 10) -> DataFrame:
    """Top k positions by value; equal values by id and security."""
    columns = ("position_id", "security_id", "security_type", "position_value_usd")
    return _top(
        book.positions.select(*columns),
        "position_value_usd", "position_id", "security_id", "security_type", k=k,
    )


def exposure_by_security_type(book: Book) -> DataFrame:
    """Position count and value by security type, split into long and short."""
    value = F.col("position_value_usd")

    def side(kind: str) -> Column:
        held = F.when(F.col("position_type") == kind, value).otherwise(F.lit(0))
        return F.sum(held).cast(TOTAL).alias(f"{kind.lower()}_usd")

    return book.positions.groupBy("security_type").agg(
        F.count(F.lit(1)).alias("n_positions"),
        side("Long"),
        side("Short"),
        F.sum(value).cast(TOTAL).alias("exposure_usd"),
    )


def counterparties_by_type(book: Book) -> DataFrame:
    """Number of counterparties of each type."""
    return book.counterparty_data.groupBy("counterparty_type").agg(
        F.count(F.lit(1)).alias("n_counterparties")
    )


def hqla_over(daily_hqla: DataFrame, horizon: int = 30) -> DataFrame:
    """Sum of daily HQLA over the first ``horizon`` days."""
    return daily_hqla.filter(F.col("day_number") <= horizon).agg(
        F.sum("total_hqla_usd").cast(TOTAL).alias("total_hqla_usd"),
        F.count(F.lit(1)).alias("n_days"),
    )


def flows_by(
    flows: DataFrame, direction: str, key: Column | str, name: str
) -> DataFrame:
    """Count and amount of one flow side by a column or expression."""
    column = F.col(key) if isinstance(key, str) else key
    return flows.groupBy(column.alias(name)).agg(
        F.count(F.lit(1)).alias("n_flows"),
        F.sum(f"{direction}_amount_usd").cast(TOTAL).alias("amount_usd"),
    )


def _sides(book: Book) -> tuple[tuple[str, DataFrame], ...]:
    return ("inflow", book.cash_inflows), ("outflow", book.cash_outflows)


def _both(parts: dict[str, DataFrame]) -> DataFrame:
    first, second = (
        df.select(F.lit(side).alias("direction"), "*") for side, df in parts.items()
    )
    return first.unionByName(second)


def flows_by_unit(book: Book) -> DataFrame:
    """Both sides by business unit."""
    return _both(
        {s: flows_by(f, s, "business_unit_id", "business_unit_id") for s, f in _sides(book)}
    )


def flows_by_type(book: Book) -> DataFrame:
    """Both sides by flow type."""
    return _both({s: flows_by(f, s, f"{s}_type", "flow_type") for s, f in _sides(book)})


def flows_by_bucket(book: Book, as_of: dt.datetime) -> DataFrame:
    """Both sides by days to maturity."""
    bucket = maturity_bucket(F.col("maturity_date"), as_of)
    return _both({s: flows_by(f, s, bucket, "maturity_bucket") for s, f in _sides(book)})


def flows_by_counterparty_type(book: Book) -> DataFrame:
    """Both sides by counterparty type.

    Flows are summed per counterparty before the lookup, so a hot counterparty is one
    row per task by then.
    """
    types = book.counterparty_data.select("counterparty_id", "counterparty_type")

    def by_type(side: str, flows: DataFrame) -> DataFrame:
        sums = flows_by(flows, side, "counterparty_id", "counterparty_id")
        return (
            sums.join(types, "counterparty_id", "left")
            .groupBy("counterparty_type")
            .agg(
                F.sum("n_flows").alias("n_flows"),
                F.sum("amount_usd").cast(TOTAL).alias("amount_usd"),
            )
        )

    return _both({s: by_type(s, f) for s, f in _sides(book)})


def scenario_definitions(rules: DataFrame) -> DataFrame:
    """Distinct rules of all scenarios, in reading order."""
    return (
        rules.select("what_if_id", "what_if_name", "ref_tbl", "col", "val", "factor")
        .distinct()
        .orderBy("what_if_id", "ref_tbl", "col")
    )


def scenario_listing(rules: DataFrame) -> DataFrame:
    """All rules with their target table, repeats included."""
    return rules.select(
        "what_if_id", "what_if_name", "ref_tbl", "tbl", "col", "val", "factor"
    ).orderBy("what_if_id", "ref_tbl", "col")


def scenario_ids(rules: DataFrame) -> DataFrame:
    """Ids of the scenarios that have rules."""
    return rules.select("what_if_id").distinct().orderBy("what_if_id")


def scenario_rules(rules: DataFrame, what_if_id: str) -> DataFrame:
    """Definitions of one scenario."""
    return scenario_definitions(
        rules.filter(F.col("what_if_id").cast("string") == str(what_if_id))
    )
