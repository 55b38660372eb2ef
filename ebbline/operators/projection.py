"""HQLA valuation and the daily projection of HQLA and cash flows.

Two routes lead from rows to daily totals.

*Daily* operators are what jobs use.  They never build per-day columns and shuffle
at most ``n_days + 1`` rows per task (and per value of ``by``).

*Wide* operators give the row-level table with one column per forecast day, for
users who want to inspect it, and the unpivoting summary of such a table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.calendar import CASH_FLOW, POSITION, live_days, survives
from ebbline.functions.money import (
    DETAIL,
    TIE_BAND,
    TOTAL,
    after_haircut,
    decay_curve,
    decay_in_cents,
    with_cents,
)

N_DAYS = 150
BASELINE_DECAY = 0.9999
SCENARIO_DECAY = 0.99

# Task-level sums of single days are kept as two longs, cents = high * 2^32 + low with 0 <= low < 2^32,
# which cannot overflow below two billion rows per task.
_LOW_BITS = 32

# Days that one row of the daily route's aggregate holds, and how many rows (2^16) it adds up.
_DAYS_TOGETHER = 15
_RUN_BITS = 16

# USD, and cells, from which on digits are kept apart, and the cents that their upper part counts.
_LIMB = 10**9
_UPPER_UNIT = 10**3

# Days of a wide table that one aggregate adds up, as decimals and as longs.
_BLOCK = 50
_CENTS_BLOCK = 75

# A wide table in cents: rows of this many USD or more are two rows, of high and of low digits,
# so a cell has at most 12 digits and so many rows (2^20) can be added up in a long.
_SPLIT_USD = 10**10
_HIGH_USD = 10**8
_ROWS_BITS = 20


def hqla_detail(
    positions: DataFrame,
    asset_classes: DataFrame,
    as_of: dt.datetime,
    by: Sequence[str] = (),
) -> DataFrame:
    """Long, unmatured, classified positions as (by.., maturity_date, total_hqla_usd)."""
    held = positions.filter(
        (F.col("position_type") == "Long")
        & survives(F.col("maturity_date"), as_of, POSITION)
    )
    from_classes = [c for c in by if c not in positions.columns]
    classes = asset_classes.select(
        "security_type", "haircut_percent", *[c for c in from_classes if c != "security_type"]
    )
    return held.join(classes, "security_type").select(
        *by,
        "maturity_date",
        after_haircut(F.col("position_value_usd"), F.col("haircut_percent")).alias(
            "total_hqla_usd"
        ),
    )


def hqla_daily(
    detail: DataFrame,
    as_of: dt.datetime,
    n_days: int = N_DAYS,
    decay: float = BASELINE_DECAY,
    by: Sequence[str] = (),
) -> DataFrame:
    """Decayed HQLA per forecast day as (by.., day_number, total_hqla_usd).

    Each row's value is rounded to cents on each day before it is summed, so rows
    are expanded inside the map stage, by blocks of days, and aggregated there.

    Day 0 marks that a group has rows at all: such a group shows every day, with 0
    where nothing is alive, and an empty input shows none.
    """
    curve = decay_curve(decay, n_days)
    rows = detail.select(
        *by,
        F.col("total_hqla_usd").cast(DETAIL).alias("value"),
        live_days(F.col("maturity_date"), as_of, n_days, POSITION).alias("live"),
    )
    in_blocks = min(curve) >= 0 and max(curve) <= 1
    usd = (_days_in_blocks if in_blocks else _days_one_by_one)(rows, curve, by)
    return (
        usd.select(*by, "usd", F.explode(_spine(n_days)).alias("day_number"))
        .groupBy(*by, "day_number")
        .agg(F.sum("usd").cast(TOTAL).alias("total_hqla_usd"))
    )


def _days_in_blocks(rows: DataFrame, curve: list[Decimal], by: Sequence[str]) -> DataFrame:
    """(by.., day_number, usd): the days' sums of each task, for factors from 0 to 1.

    A row is laid out over blocks of days and not over days, so that it looks for its group once
    for a block.  A cell is a double product, rounded, unless it lies within ``TIE_BAND`` of a tie;
    then, and for large values, it is made of longs, see ``_decayed_digits``.  Cells are whole
    numbers below 10^11 and 2^16 of them at most are added up, so a double holds the sum exactly.
    """
    width = min(_DAYS_TOGETHER, len(curve))
    held = F.greatest(F.least(F.col("live") + 1, F.lit(1)), F.ceil(F.col("live") / width).cast("int"))
    blocks = F.slice(_factor_blocks(curve, width), F.lit(1), held)
    split = _in_digits(rows, "value").select("*", F.posexplode(blocks).alias("block", "factors"))
    products = [F.expr(f"rough * get(factors.rates, {i})").alias(f"product_{i}") for i in range(width)]
    laid_out = split.select("*", (F.col("live") - F.lit(width) * F.col("block")).alias("left"), *products)
    sums = [F.expr(f"SUM({_decayed_cell(i)})").alias(f"cents_{i}") for i in range(width)]
    per_task = laid_out.groupBy(*by, "block", "rows", "unit").agg(*sums)
    # Day 0 of the first block, which each row has, stands for rows at all.
    cells = F.array(F.when(F.col("block") == 0, F.lit(0.0)), *[F.col(f"cents_{i}") for i in range(width)])
    day = F.lit(width) * F.col("block") + F.col("at")
    usd = (F.col("cents").cast("long").cast("decimal(19,0)") * F.col("unit").cast("decimal(13,0)")).cast("decimal(32,0)") * F.lit(Decimal("0.01"))
    return (
        per_task.select(*by, "block", "unit", F.posexplode(cells).alias("at", "cents"))
        .where(F.col("cents").isNotNull() & (day <= len(curve)))
        .select(*by, day.alias("day_number"), usd.alias("usd"))
    )


def _factor_blocks(curve: list[Decimal], width: int) -> Column:
    """Blocks of ``width`` days: ``rates``, 100 times each day's factor as doubles, and ``digits``,
    its upper and lower eight digits as longs."""
    padded = [*curve, *[Decimal(0)] * (-len(curve) % width)]
    blocks = []
    for first in range(0, len(padded), width):
        block = padded[first : first + width]
        rates = ", ".join(f"{float(factor * 100)!r}D" for factor in block)
        digits = ", ".join(f"{n}L" for factor in block for n in divmod(int(factor.scaleb(16)), 10**8))
        blocks.append(f"named_struct('rates', array({rates}), 'digits', array({digits}))")
    return F.expr(f"array({', '.join(blocks)})")


def _in_digits(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``value`` as a double, ``rough``, and in parts that all have its sign: ``high`` in
    10^9 USD, ``whole`` USD below, millionths, and half of a cent in units of 10^-14 cents.

    Rows from 10^9 USD on have no ``rough`` and come four times, for nine digits of a cell each: one
    of a cell stands for ``unit`` cents.  ``rows`` numbers runs of 2^16 of them within a task.
    """
    return (
        rows.withColumn("rough", F.col(value).cast("double"))
        .withColumn("high", F.expr(f"CASE WHEN abs(rough) < {_LIMB - 1}D OR rough IS NULL THEN 0L ELSE {value} div {_LIMB}BD END"))
        .withColumn("millionths", F.expr(f"CASE WHEN rough IS NULL THEN 0L ELSE CAST(CASE WHEN high = 0 THEN {value} ELSE {value} % {_LIMB}BD END * 1000000BD AS BIGINT) END"))
        .withColumn("whole", F.expr("millionths div 1000000L"))
        .withColumn("micros", F.expr("millionths % 1000000L"))
        .withColumn("half", F.expr("CASE WHEN high < 0 OR millionths < 0 THEN -50000000000000L ELSE 50000000000000L END"))
        .withColumn("rough", F.expr("CASE WHEN high = 0 THEN rough END"))
        .withColumn("unit", F.expr(f"explode(CASE WHEN high = 0 THEN array(1L) ELSE array(1L, {_LIMB}L, {_UPPER_UNIT}L, {_UPPER_UNIT * _LIMB}L) END)"))
        .withColumn("skip", F.expr(f"CASE WHEN unit = {_LIMB} OR unit = {_UPPER_UNIT * _LIMB} THEN {_LIMB}L ELSE 1L END"))
        .withColumn("keep", F.expr(f"CASE WHEN high = 0 THEN {_LIMB**2}L ELSE {_LIMB}L END"))
        .withColumn("rows", F.shiftright(F.monotonically_increasing_id(), _RUN_BITS))
        .drop(value, "millionths")
    )


def _decayed_cell(i: int) -> str:
    """The cell of the block's day ``i``, a whole number of ``unit`` cents as a double."""
    near = f"rint(product_{i})"
    exact = _decayed_digits(f"get(factors.digits, {2 * i})", f"get(factors.digits, {2 * i + 1})")
    return f"CASE WHEN left <= {i} THEN 0D WHEN abs(product_{i} - {near}) < {0.5 - TIE_BAND}D THEN {near} ELSE CAST({exact} AS DOUBLE) END"


def _decayed_digits(upper: str, lower: str) -> str:
    """A row of ``_in_digits`` times a factor of at most 1, rounded half-up to cents, exactly and in
    longs; the factor is ``upper`` / 10^8 + ``lower`` / 10^16.

    ``high`` times ``upper`` is whole ``_UPPER_UNIT`` cents.  All else is added up in cents, and its
    rests in units of 10^-14 cents: no sum passes 10^18.
    """
    rest = (
        f"(whole * {upper} % 1000000L) * 100000000L + (high * {lower} % 100000L) * 1000000000L"
        f" + whole * {lower} + micros * {upper} * 100L + micros * {lower} div 1000000L"
    )
    cents = f"whole * {upper} div 1000000L + high * {lower} div 100000L + ({rest} + half) div 100000000000000L"
    return f"(CASE WHEN unit = 1 OR unit = {_LIMB} THEN {cents} ELSE high * {upper} END) div skip % keep"


def _days_one_by_one(rows: DataFrame, curve: list[Decimal], by: Sequence[str]) -> DataFrame:
    """As ``_days_in_blocks``, for any curve: rows are laid out over their days."""
    rough = rows.withColumn("rough", F.col("value").cast("double"))
    days = F.slice(decay_in_cents(curve), F.lit(1), F.col("live") + F.lit(1))
    laid_out = rough.select(*by, "value", "rough", F.posexplode(days).alias("day_number", "rate"))
    split, cents, large = with_cents(laid_out, curve)
    per_task = split.withColumn("task", F.spark_partition_id()).groupBy(*by, "day_number", "task").agg(
        F.sum(F.shiftright(cents, _LOW_BITS)).alias("high"),
        F.sum(cents.bitwiseAND(F.lit(2**_LOW_BITS - 1))).alias("low"),
        F.sum(large).alias("large"),
    )
    usd = (
        (
            F.col("high").cast("decimal(20,0)") * F.lit(Decimal(2**_LOW_BITS))
            + F.col("low").cast("decimal(20,0)")
        )
        * F.lit(Decimal("0.01"))
    ).cast("decimal(28,2)") + (F.coalesce("large", F.lit(0)).cast("decimal(32,0)") * F.lit(Decimal("0.01"))).cast("decimal(34,2)")
    return per_task.select(*by, "day_number", usd.alias("usd"))


def _spine(n_days: int):
    """The marker day 0 stands for every day; any other day stands for itself."""
    day = F.col("day_number")
    return F.when(day == 0, F.sequence(F.lit(1), F.lit(n_days))).otherwise(F.array(day))


def cashflow_daily(
    flows: DataFrame,
    direction: str,
    as_of: dt.datetime,
    n_days: int = N_DAYS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Outstanding flow per forecast day as (by.., day_number, total_<direction>).

    Flows are not decayed or rounded, so they are first summed by how long they live
    and only those ``n_days + 1`` sums are laid out over the days.  With ``by`` there are
    such sums for each group; they are added up from the longest life down and each total
    then stands for the days since the next shorter life, so what is shuffled are the
    lives that a group has, not its days.
    """
    side = direction.lower()
    buckets = (
        flows.filter(survives(F.col("maturity_date"), as_of, CASH_FLOW))
        .select(
            *by,
            live_days(F.col("maturity_date"), as_of, n_days, CASH_FLOW).alias("live"),
            F.col(f"{side}_amount_usd").alias("amount"),
        )
        .groupBy(*by, "live")
        .agg(F.sum("amount").alias("amount"))
    )
    if by:
        return _days_of_lives(buckets, f"total_{side}", n_days, by)
    day = F.col("day_number")
    return (
        buckets.select(
            *by,
            "live",
            "amount",
            F.explode(F.sequence(F.lit(1), F.lit(n_days))).alias("day_number"),
        )
        .groupBy(*by, "day_number")
        .agg(
            F.sum(F.when(day <= F.col("live"), F.col("amount")).otherwise(F.lit(0)))
            .cast(TOTAL)
            .alias(f"total_{side}")
        )
    )


def _days_of_lives(buckets: DataFrame, total: str, n_days: int, by: Sequence[str]) -> DataFrame:
    """Daily totals of (by.., live, amount): a day has the amounts that live at least as long."""
    longer = Window.partitionBy(*by).orderBy(F.col("live").desc())
    alive = F.sum("amount").over(longer.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = buckets.select(*by, "live", alive.cast(TOTAL).alias("alive"), F.lead("live", 1, 0).over(longer).alias("shorter"), F.lag("live").over(longer).isNull().alias("longest"))
    zero = F.lit(0).cast(TOTAL)

    def span(first: Column, last: Column, value: Column) -> Column:
        days = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.transform(days, lambda d: F.struct(d.alias("day_number"), value.alias(total)))

    own = span(F.col("shorter") + 1, F.col("live"), F.col("alive"))
    after = F.when(F.col("longest"), span(F.col("live") + 1, F.lit(n_days), zero))
    return summed.select(*by, F.inline(F.concat(own, F.coalesce(after, span(F.lit(1), F.lit(0), zero)))))


@dataclass(frozen=True)
class WideCents:
    """A wide table whose day columns are whole cents as longs: the rows and a SQL expression
    for each day column, so that a sum of one is compiled as a method of its own."""

    rows: DataFrame
    days: dict[str, str]

    def table(self) -> DataFrame:
        """The rows with their day columns; one of a cell stands for ``unit`` cents."""
        return self.rows.selectExpr("*", *[f"{cell} AS {name}" for name, cell in self.days.items()]).drop("live_days", "rows", *_PARTS)


def hqla_projection(
    detail: DataFrame,
    as_of: dt.datetime,
    n_days: int = N_DAYS,
    decay: float = BASELINE_DECAY,
    in_cents: bool = False,
) -> DataFrame | WideCents:
    """Row-level wide table: the detail columns and one decayed column per day.

    ``in_cents`` gives the same table in whole cents.
    """
    value, curve = "CAST(total_hqla_usd AS DECIMAL(24,6))", decay_curve(decay, n_days)
    rows = detail.withColumn("live_days", live_days(F.col("maturity_date"), as_of, n_days, POSITION))
    money = [f"CAST({value} * {factor:f}BD AS DECIMAL(38,2))" for factor in curve]
    if in_cents:
        if max(curve) > 1:
            raise ValueError("a wide table in cents is for values that don't grow")
        cells = [_cents_of(exact, _decayed_cents(factor)) for exact, factor in zip(money, curve, strict=True)]
        return WideCents(_in_parts(rows, value), {f"day_{day}_total_hqla_usd": f"CASE WHEN live_days >= {day} THEN {cell} ELSE 0L END" for day, cell in enumerate(cells, start=1)})
    return rows.selectExpr(
        "*",
        *[
            f"CASE WHEN live_days >= {day} THEN {cell} ELSE CAST(0 AS DECIMAL(38,2)) END AS day_{day}_total_hqla_usd"
            for day, cell in enumerate(money, start=1)
        ],
    ).drop("live_days")


def cashflow_projection(
    flows: DataFrame, direction: str, as_of: dt.datetime, n_days: int = N_DAYS, in_cents: bool = False, gathered: bool = False
) -> DataFrame | WideCents:
    """Row-level wide table: all columns of the surviving flows and one per day.

    ``in_cents`` gives the same table in whole cents.  ``gathered`` is for a table that is stored:
    rows of equal amounts and lives lie side by side, so that a columnar file holds an amount once
    for a day and not once for each row.  A partition that a hot amount makes too large is split.
    """
    side, maturity = direction.lower(), F.col("maturity_date")
    rows = flows.filter(survives(maturity, as_of, CASH_FLOW)).withColumn("live_days", live_days(maturity, as_of, n_days, CASH_FLOW))
    if gathered:
        rows = rows.hint("rebalance", f"{side}_amount_usd").sortWithinPartitions(f"{side}_amount_usd", "live_days")
    if in_cents:
        amount = f"CAST({side}_amount_usd AS DECIMAL(20,2))"
        parts = _in_parts(rows, amount).withColumn("cents", F.expr(_cents_of(amount, "whole * 100L + micros div 10000L")))
        return WideCents(parts, {f"day_{day}_{side}_stock": f"CASE WHEN live_days >= {day} THEN cents ELSE 0L END" for day in range(1, n_days + 1)})
    return rows.selectExpr(
        "*",
        *[f"CASE WHEN live_days >= {day} THEN {side}_amount_usd ELSE 0 END AS day_{day}_{side}_stock" for day in range(1, n_days + 1)],
    ).drop("live_days")


# What the cells of a wide table in cents are made of, beside the unit.
_PARTS = ("usual", "whole", "micros", "half", "cents")


def _in_parts(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``unit``, the cents that one of a cell stands for, and the parts of ``value``:
    whole USD, millionths, and half of a cent in units of 10^-14 cents, all with its sign.

    Rows from ``_SPLIT_USD`` on aren't ``usual``: they come twice, for their high and their low digits.
    ``rows`` numbers runs of 2^20 of them.
    """
    return (
        rows.withColumn("usual", F.expr(f"coalesce(abs({value}) < {_SPLIT_USD}, false)"))
        .withColumn("whole", F.expr(f"CASE WHEN usual THEN coalesce(CAST({value} AS BIGINT), 0L) ELSE 0L END"))
        .withColumn("micros", F.expr(f"CASE WHEN usual THEN coalesce(CAST(({value} - CAST(whole AS DECIMAL(11,0))) * 1000000 AS BIGINT), 0L) ELSE 0L END"))
        .withColumn("half", F.expr("CASE WHEN whole < 0 OR micros < 0 THEN -50000000000000L ELSE 50000000000000L END"))
        .withColumn("unit", F.expr(f"explode(CASE WHEN abs({value}) >= {_SPLIT_USD} THEN array(1L, {_HIGH_USD * 100}L) ELSE array(1L) END)"))
        .withColumn("rows", F.shiftright(F.monotonically_increasing_id(), _ROWS_BITS))
    )


def _cents_of(exact: str, usual: str) -> str:
    """A cell in cents: of its parts for ``usual`` rows, else digits of the decimal ``exact``."""
    high = f"{exact} div {_HIGH_USD}BD"
    low = f"CAST(({exact} % {_HIGH_USD}BD) * 100 AS BIGINT)"
    return f"CASE WHEN usual THEN {usual} WHEN unit = 1 THEN {low} ELSE {high} END"


def _decayed_cents(factor: Decimal) -> str:
    """The value times ``factor`` rounded half-up to cents, exactly and in longs.

    The factor is ``upper`` / 10^8 + ``lower`` / 10^16.  Whole USD times ``upper`` give whole cents
    and a rest; rest and other products are added up in units of 10^-14 cents, below 10^18 + 10^17.
    """
    upper, lower = divmod(int(factor.scaleb(16)), 10**8)
    rest = f"(whole * {upper}L % 1000000L) * 100000000L + whole * {lower}L + micros * {upper * 100}L + micros * {lower}L div 1000000L"
    return f"whole * {upper}L div 1000000L + ({rest} + half) div 100000000000000L"


def wide_summary(
    projection: DataFrame | WideCents, day_suffix: str, total: str, n_days: int = N_DAYS
) -> DataFrame:
    """Daily totals of a wide table, (day_number, <total>).

    The columns are added up first and the sums are unpivoted, so the rows are never
    multiplied by the number of days.  Columns are added up in blocks, since Spark compiles
    an aggregate of at most 100 columns; a block reads and computes its own days only.
    """
    in_cents = isinstance(projection, WideCents)
    add_up, size = (_summed_cents, _CENTS_BLOCK) if in_cents else (_summed_money, _BLOCK)
    blocks = [range(first, min(first + size, n_days + 1)) for first in range(1, n_days + 1, size)]
    parts = [add_up(projection, [f"day_{day}_{day_suffix}" for day in block]) for block in blocks]
    return (
        reduce(DataFrame.unionByName, parts)
        .filter(F.col("amount").isNotNull())
        .select(
            F.regexp_extract("day_raw", r"(\d+)", 1).cast("int").alias("day_number"),
            F.col("amount").alias(total),
        )
    )


def _summed_money(projection: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sums of day columns of decimals as (day_raw, amount)."""
    sums = projection.agg(*[F.expr(f"CAST(SUM({c}) AS DECIMAL(38,2)) AS {c}") for c in columns])
    return sums.unpivot([], list(columns), "day_raw", "amount")


def _summed_cents(projection: WideCents, columns: Sequence[str]) -> DataFrame:
    """Sums of day columns of cents as (day_raw, amount) in USD.

    At most 2^20 rows are added up in a long, then decimals are.
    """
    sums = projection.rows.groupBy("rows", "unit").agg(*[F.expr(f"SUM({projection.days[c]}) AS {c}") for c in columns])
    cents = F.col("cents").cast("decimal(19,0)") * F.col("unit").cast("decimal(11,0)")
    return (
        sums.unpivot(["unit"], list(columns), "day_raw", "cents")
        .groupBy("day_raw")
        .agg((F.sum(cents).cast("decimal(36,0)") * F.lit(Decimal("0.01"))).cast(TOTAL).alias("amount"))
    )
