"""What-if scenarios: factors from rules, and facts restated by factors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.money import FACTOR, RULE_FACTOR, fitted, with_factor


def _matches(
    dim: DataFrame,
    rules: DataFrame,
    id_col: str,
    match_cols: Sequence[str],
    ref_tbl: str,
    tbl: str,
    what_if_ids: Sequence[str],
) -> DataFrame:
    """(id, what_if_id, factor, times): each rule factor an entity collects.

    A rule hits a dimension row if any of the match columns holds its value; the
    rule's own column name plays no part.  The row's distinct values are exploded so
    that the test is an equi-join.  Equal factors are counted before they are
    collected, which bounds the later list by the number of rules.
    """
    wanted = rules.filter(
        F.col("what_if_id").cast("string").isin([str(i) for i in what_if_ids])
        & (F.col("ref_tbl") == ref_tbl)
        & (F.col("tbl") == tbl)
    ).select(
        F.col("what_if_id").cast("string").alias("what_if_id"),
        "val",
        fitted(F.col("factor") + F.lit(1), RULE_FACTOR, "rule factor").alias("factor"),
    )
    values = dim.select(
        id_col, F.explode(F.array_distinct(F.array(*match_cols))).alias("val")
    )
    return (
        values.join(wanted, "val")
        .groupBy(id_col, "what_if_id", "factor")
        .agg(F.count(F.lit(1)).alias("times"))
    )


def _product(factors: Column) -> Column:
    """Product of an array of (factor, times), taken in ascending factor order.

    A power is taken in decimals, by squaring and multiplying along the binary digits of its
    exponent: exact to 12 decimals, of which six equal factors need no more.
    """

    def power(entry: Column) -> Column:
        once = entry["factor"].cast(FACTOR)

        def step(acc: Column, digit: Column) -> Column:
            square = fitted(acc * acc, FACTOR, "factor")
            return F.when(digit == "1", fitted(square * once, FACTOR, "factor")).otherwise(square)

        many = F.aggregate(F.split(F.bin(entry["times"]), "(?<=.)(?=.)"), F.lit(1).cast(FACTOR), step)
        return F.when(entry["times"] == 1, once).otherwise(many)

    return F.aggregate(
        F.sort_array(factors),
        F.lit(1).cast(FACTOR),
        lambda acc, entry: fitted(acc * power(entry), FACTOR, "factor"),
    )


def scenario_factors(
    dim: DataFrame,
    rules: DataFrame,
    id_col: str,
    match_cols: Sequence[str],
    ref_tbl: str,
    tbl: str,
    what_if_ids: Sequence[str],
) -> DataFrame:
    """(what_if_id, id, factor) for the entities that at least one rule hits."""
    return (
        _matches(dim, rules, id_col, match_cols, ref_tbl, tbl, what_if_ids)
        .groupBy("what_if_id", id_col)
        .agg(_product(F.collect_list(F.struct("factor", "times"))).alias("factor"))
    )


# Where the five factor kinds come from: the fact or dimension a rule is filed under,
# the dimension it matches, that dimension's key and its matchable columns.
FACTOR_KINDS = {
    "inflow_unit": (
        "CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE",
        "business_unit_id", ("region", "business_unit_type"),
    ),
    "outflow_unit": (
        "CASH_OUTFLOWS", "BUSINESS_UNIT_REFERENCE",
        "business_unit_id", ("region", "business_unit_type"),
    ),
    "counterparty": (
        "COUNTERPARTY_DATA", "COUNTERPARTY_DATA",
        "counterparty_id", ("region", "counterparty_type"),
    ),
    "position_unit": (
        "POSITIONS", "BUSINESS_UNIT_REFERENCE",
        "business_unit_id", ("region", "business_unit_type"),
    ),
    "security_type": (
        "POSITIONS", "ASSET_CLASSIFICATIONS",
        "security_type", ("security_type",),
    ),
}

# Fixed value: the dimensions that hold a bank's own units and classes and not its clients.
REFERENCE_TABLES = ("BUSINESS_UNIT_REFERENCE", "ASSET_CLASSIFICATIONS")

# Amount column of each fact and the two factor kinds applied to it.
STRESSED_FACTS = {
    "cash_inflows": ("inflow_amount_usd", ("counterparty", "inflow_unit")),
    "cash_outflows": ("outflow_amount_usd", ("counterparty", "outflow_unit")),
    "positions": ("position_value_usd", ("position_unit", "security_type")),
}


def factors_of_kind(
    kind: str, dims: dict[str, DataFrame], rules: DataFrame, what_if_ids: Sequence[str]
) -> DataFrame:
    """:func:`scenario_factors` for one of :data:`FACTOR_KINDS`."""
    ref_tbl, tbl, id_col, match_cols = FACTOR_KINDS[kind]
    return scenario_factors(
        dims[tbl.lower()], rules, id_col, match_cols, ref_tbl, tbl, what_if_ids
    )


@dataclass(frozen=True)
class Scenarios:
    """Dimensions and rules of a run."""

    dims: dict[str, DataFrame]
    rules: DataFrame
    what_if_ids: tuple[str, ...]

    @classmethod
    def of(
        cls, dims: dict[str, DataFrame], rules: DataFrame, what_if_ids: Sequence[str]
    ) -> Scenarios:
        matched = {tbl.lower() for _, tbl, _, _ in FACTOR_KINDS.values()}
        used = {name: df for name, df in dims.items() if name in matched}
        ids = tuple(dict.fromkeys(str(i) for i in what_if_ids))
        if not ids:
            raise ValueError("no scenario ids given")
        wanted = rules.filter(F.col("what_if_id").cast("string").isin(*ids))
        return cls(used, wanted, ids)

    def factor_columns(self, kind: str) -> tuple[str, DataFrame]:
        """One row per entity with one factor column per scenario, NULL if none of its rules hits."""
        ref_tbl, tbl, id_col, match_cols = FACTOR_KINDS[kind]
        hits = _matches(
            self.dims[tbl.lower()], self.rules, id_col, match_cols, ref_tbl, tbl, self.what_if_ids
        )
        columns = []
        for n, wid in enumerate(self.what_if_ids):
            hit = F.collect_list(F.when(F.col("what_if_id") == wid, F.struct("factor", "times")))
            columns.append(F.when(F.size(hit) > 0, _product(hit)).alias(f"{kind}_{n}"))
        table = hits.groupBy(id_col).agg(*columns)
        return id_col, table

    def join_factors(self, fact: DataFrame, kind: str) -> DataFrame:
        """Left join of a fact with the factor columns of one kind.

        The factor table has one row per entity that a rule hits.  Those of a reference
        table are broadcast, since a fact shuffled by the few units or security types there
        are is a few tasks, whatever its size; unless the session forbids broadcasts.  Any
        other is broadcast by adaptive execution if its measured bytes allow; else that
        splits the fact's partitions that hold a hot entity and reads the entity's one row
        with each part, however alike the fact's rows are.
        """
        id_col, table = self.factor_columns(kind)
        allowed = not table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
        if allowed and FACTOR_KINDS[kind][1] in REFERENCE_TABLES:
            table = F.broadcast(table)
        return fact.join(table, id_col, "left")


def apply_factors(
    fact: DataFrame, amount_col: str, kinds: Sequence[str], scenarios: Scenarios
) -> DataFrame:
    """Restate ``amount_col`` once per scenario, rounded to cents, and add what_if_id.

    An entity that no rule hits has no factor and keeps its amounts.  The fact is joined once
    whatever the number of scenarios; its rows are multiplied only after the joins.
    """
    joined, columns = fact, fact.columns
    for kind in kinds:
        joined = scenarios.join_factors(joined, kind)

    def combined(n: int) -> Column:
        total, *others = (F.col(f"{kind}_{n}") for kind in kinds)
        for factor in others:
            product = fitted(total * factor, FACTOR, "factor")
            total = F.when(total.isNull(), factor).when(factor.isNull(), total).otherwise(product)
        return total

    per_scenario = F.array(*[F.struct(F.lit(wid).alias("what_if_id"), combined(n).alias("factor")) for n, wid in enumerate(scenarios.what_if_ids)])
    stressed = joined.select(*columns, F.inline(per_scenario).alias("what_if_id", "stress_factor"))
    stressed, amount = with_factor(stressed, amount_col, "stress_factor")
    return stressed.select("what_if_id", *[amount.alias(c) if c == amount_col else F.col(c) for c in columns])


def apply_scenario(
    facts: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    rules: DataFrame,
    what_if_ids: Sequence[str],
) -> dict[str, DataFrame]:
    """The given facts restated for each scenario; the inputs are left as they are."""
    scenarios = Scenarios.of(dims, rules, what_if_ids)
    return {
        name: apply_factors(fact, *STRESSED_FACTS[name], scenarios)
        for name, fact in facts.items()
    }
