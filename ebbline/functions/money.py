"""Decimal types and the money arithmetic shared by all operators."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stored money, per-position value after haircut, daily totals, ratio.
MONEY = T.DecimalType(20, 2)
DETAIL = T.DecimalType(24, 6)
TOTAL = T.DecimalType(38, 2)
STORED_HQLA = T.DecimalType(38, 10)
RATIO = T.DecimalType(38, 12)

# One rule's factor is kept at two decimals; products of rules at twelve.  FACTOR times
# RULE_FACTOR needs 36 digits, so no product overflows before its cast is checked.
RULE_FACTOR = T.DecimalType(12, 2)
FACTOR = T.DecimalType(23, 12)

DECAY_SCALE = 16

# Operands below this many USD are divided as decimals, whose quotient has 14 decimals;
# larger ones as doubles, which hold a ratio to 15 digits.
_RATIO_OPERAND = T.DecimalType(24, 2)
_RATIO_LIMIT = Decimal(10) ** 22


def fitted(value: Column, to: T.DecimalType, what: str) -> Column:
    """Cast that fails the query if the value doesn't fit, whatever the ANSI setting."""
    cast = value.try_cast(to)
    lost = F.raise_error(F.lit(f"{what} doesn't fit {to.simpleString()}")).cast(to)
    return F.when(value.isNotNull() & cast.isNull(), lost).otherwise(cast)


def times_factor(amount: Column, factor: Column) -> Column:
    """Money times a factor, rounded half-up to cents from the exact product.

    The whole and the fractional part of the factor have its sign and are multiplied
    apart, each exactly; the first product has no part of a cent.
    """
    whole = F.when(factor < 0, F.ceil(factor)).otherwise(F.floor(factor)).cast("decimal(11,0)")
    part = (factor - whole).cast("decimal(12,12)")
    usd = amount.cast(MONEY)
    return fitted(usd * whole + (usd * part).cast("decimal(22,2)"), MONEY, "stressed amount")


# Below these an amount in cents times a millionth of a factor fits a long.
_LONG_AMOUNT_USD = 10**10
_LONG_FACTOR = 8


def with_factor(rows: DataFrame, amount: str, factor: str) -> tuple[DataFrame, Column]:
    """``rows`` with what this column needs: the amount :func:`times_factor`, or as it is if there is
    no factor.

    Usual amounts and factors are multiplied as longs: cents times whole millionths, and cents times
    the six digits below, whose rests are rounded together.  All others take decimals.  The steps are
    separate projections so that each is evaluated once per row.
    """
    usual = f"CASE WHEN {factor} IS NULL THEN false ELSE abs({factor}) < {_LONG_FACTOR} AND abs({amount}) < {_LONG_AMOUNT_USD} END"
    longs = (
        rows.withColumn("stress_usual", F.expr(usual))
        .withColumn("stress_cents", F.expr(f"CASE WHEN stress_usual THEN CAST(CAST({amount} AS DECIMAL(20,2)) * 100 AS BIGINT) END"))
        .withColumn("stress_trillionths", F.expr(f"CASE WHEN stress_usual THEN CAST({factor} * 1000000000000BD AS BIGINT) END"))
        .withColumn("stress_upper", F.expr("stress_cents * (stress_trillionths div 1000000L)"))
        .withColumn("stress_lower", F.expr("stress_cents * (stress_trillionths % 1000000L)"))
    )
    half = "CASE WHEN stress_upper < 0 OR stress_lower < 0 THEN -500000000000L ELSE 500000000000L END"
    rounded = F.expr(f"stress_upper div 1000000L + ((stress_upper % 1000000L) * 1000000L + stress_lower + {half}) div 1000000000000L")
    by_longs = (rounded.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast(MONEY)
    by_decimals = times_factor(F.col(amount), F.col(factor))
    return longs, F.when(F.col(factor).isNull(), F.col(amount).cast(MONEY)).when(F.col("stress_upper").isNotNull(), by_longs).otherwise(by_decimals)


def decay_curve(decay: float, n_days: int) -> list[Decimal]:
    """``decay ** offset`` for offsets 0..n_days-1, held at 16 decimals."""
    base = Decimal(str(decay))
    step = Decimal(1).scaleb(-DECAY_SCALE)
    return [(base**i).quantize(step, ROUND_HALF_UP) for i in range(n_days)]


def after_haircut(value: Column, haircut_percent: Column) -> Column:
    """Position value net of its haircut; exact, because 2 + 4 decimals fit in 6.

    Any stored money fits: 18 digits before the point, three more for a negative haircut.
    """
    kept = (F.lit(100) - haircut_percent.cast("decimal(5,2)")) * F.lit(Decimal("0.01"))
    return (value.cast(MONEY) * kept.cast("decimal(8,4)")).cast(DETAIL)


def coverage_ratio(hqla: Column, outflows: Column, on_zero: str = "raise") -> Column:
    """HQLA over net outflows at 8 decimals, stored as decimal(38,12).

    A zero denominator fails the query by default (as it does in ANSI SQL);
    ``on_zero="null"`` yields NULL instead.
    """
    if on_zero not in ("raise", "null"):
        raise ValueError(f"on_zero must be 'raise' or 'null', not {on_zero!r}")
    limit = F.lit(_RATIO_LIMIT).cast(TOTAL)
    if on_zero == "null":
        outflows = F.nullif(outflows, F.lit(0).cast(TOTAL))
    exact = F.round(hqla.cast(_RATIO_OPERAND) / outflows.cast(_RATIO_OPERAND), 8).cast(RATIO)
    wide = F.round(hqla.cast("double") / outflows.cast("double"), 8).cast(RATIO)
    return F.when((F.abs(hqla) < limit) & (F.abs(outflows) < limit), exact).otherwise(wide)


def decay_in_cents(curve: list[Decimal]) -> Column:
    """Array of 0.0 for day 0 and ``100 * decay`` for each forecast day, as doubles."""
    return F.expr(f"array(0D, {', '.join(f'{float(d * 100)!r}D' for d in curve)})")


def decay_exact(curve: list[Decimal]) -> Column:
    """Array of the decay factors as decimals, day 1 first."""
    return F.expr(f"array({', '.join(f'{d:f}BD' for d in curve)})")


# Below this value a double product is known to 0.0004 cents, so its rounding to
# cents is certain unless it lies within TIE_BAND of half a cent.
_DOUBLE_SAFE_USD = 1.0e10
# Cents of smaller values fit a long.
_LONG_SAFE_USD = Decimal(10) ** 16
TIE_BAND = 1.0e-3


def with_cents(rows: DataFrame, curve: list[Decimal]) -> tuple[DataFrame, Column, Column]:
    """``rows`` with what these two columns need: ``value * decay(day_number)`` rounded half-up
    to whole cents, as a long, and the same as a decimal for the values that a long may not hold.

    ``rows`` has ``value`` (decimal), ``rough``, the same as a double, ``day_number`` and
    ``rate``, the day's element of :func:`decay_in_cents`.  Equal to casting the decimal
    product to two decimals, but the decimal path is taken only for values too large for a
    double or products too close to a tie; everything else stays in primitive arithmetic.
    The steps are separate projections so that each is evaluated once per row.  The two columns
    are handed out to be summed as they are: Spark compiles each sum as a method of its own, and
    in the method of the projections their decimals may be too long for the JIT compiler.
    """
    approx = rows.withColumn("approx", F.col("rough") * F.col("rate"))
    split = approx.withColumn("whole", F.floor("approx"))
    part = F.col("approx") - F.col("whole")
    certain = (F.abs("approx") < F.lit(_DOUBLE_SAFE_USD * 100)) & (
        F.abs(part - F.lit(0.5)) > F.lit(TIE_BAND)
    )
    rounded = F.col("whole") + F.when(part > 0.5, F.lit(1)).otherwise(F.lit(0))
    decay = F.element_at(decay_exact(curve), F.col("day_number"))
    by_decimal = (_exact_cents(F.col("value"), decay) * F.lit(100)).cast("decimal(38,0)")
    fits = F.abs("value") < F.lit(_LONG_SAFE_USD)
    small = F.when(certain, rounded).when(fits, by_decimal.cast("long")).otherwise(F.lit(0))
    return split, small, F.when(~certain & ~fits, by_decimal)


def _exact_cents(value: Column, decay: Column) -> Column:
    """``value * decay`` rounded half-up to cents without an inexact step.

    Whole USD and the rest have the value's sign.  The first product is cut to cents, and
    what is cut joins the second before it is rounded.
    """
    usd = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("decimal(18,0)")
    product = usd * decay  # decimal(36,16)
    positive = F.abs(product)
    cut = F.signum(product.cast("double")).cast("decimal(1,0)") * (F.floor(positive * F.lit(100).cast("decimal(3,0)")).cast("decimal(22,0)") * F.lit(Decimal("0.01"))).cast("decimal(23,2)")
    rest = (product - cut).cast("decimal(18,16)") + ((value - usd).cast("decimal(6,6)") * decay).cast("decimal(24,22)")
    return (cut + rest.cast("decimal(5,2)")).cast(TOTAL)
