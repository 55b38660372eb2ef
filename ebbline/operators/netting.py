"""Netting of the two flow sides and the coverage ratio per forecast day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.money import STORED_HQLA, TOTAL, coverage_ratio


def net_cashflow(
    inflow: DataFrame, outflow: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Both sides per day with their net position.

    Amounts of both sides are stored positive and the net position is their sum.
    A side without rows counts as 0.
    """
    zero = F.lit(0).cast(TOTAL)
    joined = inflow.join(outflow, [*by, "day_number"], "full").select(
        *by,
        "day_number",
        F.coalesce("total_inflow", zero).cast(TOTAL).alias("total_inflow"),
        F.coalesce("total_outflow", zero).cast(TOTAL).alias("total_outflow"),
    )
    net = (F.col("total_inflow") + F.col("total_outflow")).cast(TOTAL)
    return joined.select(
        "*", net.alias("net_position"), F.abs(net).cast(TOTAL).alias("abs_net_position")
    )


def lcr(
    net: DataFrame, hqla: DataFrame, by: Sequence[str] = (), on_zero: str = "raise"
) -> DataFrame:
    """(by.., day_number, total_net_cash_outflows, hqla, lcr) for days on both sides."""
    return (
        net.select(*by, "day_number", F.col("abs_net_position").alias("total_net_cash_outflows"))
        .join(
            hqla.select(*by, "day_number", F.col("total_hqla_usd").alias("hqla")),
            [*by, "day_number"],
        )
        .select(
            *by,
            "day_number",
            "total_net_cash_outflows",
            F.col("hqla").cast(STORED_HQLA).alias("hqla"),
            coverage_ratio(F.col("hqla"), F.col("total_net_cash_outflows"), on_zero).alias("lcr"),
        )
    )
