"""The semantic model: tables, columns, keys, relationships and queries along them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.operators.history import change_analysis, trend


@dataclass(frozen=True)
class ModelTable:
    """A table's dimensions, time dimensions, facts and primary key."""

    name: str
    dimensions: tuple[str, ...]
    time_dimensions: tuple[str, ...] = ()
    facts: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()

    def columns(self) -> set[str]:
        return {*self.dimensions, *self.time_dimensions, *self.facts}


@dataclass(frozen=True)
class Relationship:
    """A many-to-one link between two tables over one column each."""

    name: str
    left: str
    right: str
    left_column: str
    right_column: str


# The ten tables and five relationships of the model.
MODEL: dict[str, ModelTable] = {
    t.name: t
    for t in (
        ModelTable(
            "asset_classifications",
            ("description", "hqla_level", "regulatory_basis", "security_type"),
            ("created_date",), ("haircut_percent",), ("security_type",),
        ),
        ModelTable(
            "business_unit_reference",
            ("business_unit_id", "business_unit_name", "business_unit_type", "is_active", "region"),
            ("created_date",), (), ("business_unit_id",),
        ),
        ModelTable(
            "cash_inflows",
            ("business_unit_id", "counterparty_id", "inflow_id", "inflow_type"),
            ("created_date", "maturity_date", "position_date"),
            ("inflow_amount_usd",), ("inflow_id",),
        ),
        ModelTable(
            "cash_outflows",
            ("business_unit_id", "counterparty_id", "outflow_id", "outflow_type"),
            ("created_date", "maturity_date", "position_date"),
            ("outflow_amount_usd",), ("outflow_id",),
        ),
        ModelTable(
            "counterparty_data",
            ("counterparty_id", "counterparty_name", "counterparty_type", "credit_rating",
             "is_active", "region"),
            ("created_date",), (), ("counterparty_id",),
        ),
        ModelTable("hqla_summary", ("day_number",), (), ("total_hqla_usd",)),
        ModelTable(
            "lcr", ("day_number",), ("created_timestamp",),
            ("hqla", "lcr", "total_net_cash_outflows"),
        ),
        ModelTable(
            "positions",
            ("business_unit_id", "position_id", "position_type", "security_id", "security_type"),
            ("created_date", "maturity_date", "position_date"),
            ("position_value_usd", "quantity"), ("position_id",),
        ),
        ModelTable(
            "what_if_definitions_lookup",
            ("col", "ref_tbl", "tbl", "val", "what_if_id", "what_if_name"),
            ("created_date",), ("factor",), ("what_if_id",),
        ),
        ModelTable(
            "what_if_lcr", ("day_number", "what_if_id"), ("created_timestamp",),
            ("hqla", "lcr", "total_net_cash_outflows"),
        ),
    )
}
RELATIONSHIPS: tuple[Relationship, ...] = (
    Relationship("inflow_counterparty", "cash_inflows", "counterparty_data",
                 "counterparty_id", "counterparty_id"),
    Relationship("outflow_business_unit", "cash_outflows", "business_unit_reference",
                 "business_unit_id", "business_unit_id"),
    Relationship("outflow_counterparty", "cash_outflows", "counterparty_data",
                 "counterparty_id", "counterparty_id"),
    Relationship("positions_to_asset_security_type", "positions", "asset_classifications",
                 "security_type", "security_type"),
    Relationship("position_business_unit", "positions", "business_unit_reference",
                 "business_unit_id", "business_unit_id"),
)

# Fixed values (titles): queries whose answer has been verified, over the newest baseline run.
VERIFIED_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "What is the liquidity coverage ratio trend over time?": trend,
    "What is contributing to the increase in LCR over the next 150 days?": change_analysis,
}

# How a fact is aggregated, and how its partial results are combined.
_AGGREGATES = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}


@dataclass(frozen=True)
class Name:
    """A resolved ``table.column`` of the model."""

    table: str
    column: str

    @property
    def alias(self) -> str:
        return f"{self.table}__{self.column}"


def resolve(name: str, role: str) -> Name:
    """Look up ``table.column``; ``role`` is dimension or fact.  Case does not matter."""
    table, _, column = name.lower().partition(".")
    if table not in MODEL:
        raise KeyError(f"unknown table {table!r}")
    entry = MODEL[table]
    known = entry.facts if role == "fact" else entry.dimensions + entry.time_dimensions
    if column not in known:
        raise KeyError(f"{table} has no {role} {column!r}")
    return Name(table, column)


def dimension(name: str) -> Name:
    return resolve(name, "dimension")


def fact(name: str) -> Name:
    return resolve(name, "fact")


def relationship(left: str, right: str) -> Relationship:
    """The link from ``left`` to ``right``."""
    for link in RELATIONSHIPS:
        if (link.left, link.right) == (left, right):
            return link
    raise KeyError(f"no relationship from {left} to {right}")


def semantic_query(
    tables: dict[str, DataFrame],
    facts: Sequence[str],
    dimensions: Sequence[str] = (),
    filters: Sequence[tuple[str, Callable[[Column], Column]]] = (),
    aggregate: str = "sum",
) -> DataFrame:
    """Facts of one table grouped by dimensions of it or of tables it relates to.

    Facts are aggregated by their own dimensions and link columns first and the related
    tables are joined to that result, so neither a hot link value nor a large related
    table moves more than one row per link value and task.  Columns of the result are
    named after the model columns; a dimension that two tables share is prefixed with
    its table.
    """
    measures = [fact(f) for f in facts]
    dims = [dimension(d) for d in dimensions]
    tests = [(dimension(name), test) for name, test in filters]
    home = measures[0].table
    if any(m.table != home for m in measures):
        raise ValueError("facts must come from one table; drill_across takes several")
    first, combine = _AGGREGATES[aggregate]

    foreign = list(dict.fromkeys(n.table for n in [*dims, *(n for n, _ in tests)] if n.table != home))
    links = [relationship(home, table) for table in foreign]
    rows = tables[home]
    for name, test in tests:
        if name.table == home:
            rows = rows.filter(test(F.col(name.column)))
    own = [d for d in dims if d.table == home]
    kept = {d.column: d.alias for d in own} | {
        link.left_column: f"{home}__{link.left_column}" for link in links
    }
    grouped = rows.groupBy(*[F.col(c).alias(a) for c, a in kept.items()]).agg(
        *[first(m.column).alias(m.alias) for m in measures]
    )
    for link in links:
        names = [n for n in [*dims, *(n for n, _ in tests)] if n.table == link.right]
        columns = {n.column: n.alias for n in names}
        right = tables[link.right].select(
            F.col(link.right_column).alias("linked"),
            *[F.col(c).alias(a) for c, a in columns.items()],
        )
        grouped = grouped.join(
            right, F.col(f"{home}__{link.left_column}") == F.col("linked"), "left"
        ).drop("linked")
    for name, test in tests:
        if name.table != home:
            grouped = grouped.filter(test(F.col(name.alias)))
    shared = [n.column for n in [*dims, *measures]]

    def label(n: Name) -> str:
        return n.column if shared.count(n.column) == 1 else f"{n.table}_{n.column}"

    return grouped.groupBy(*[F.col(d.alias).alias(label(d)) for d in dims]).agg(
        *[combine(m.alias).alias(label(m)) for m in measures]
    )


def _reached(home: str, names: Sequence[str]) -> str:
    """The first of the names that a fact table has itself or over one link."""
    tables = {home, *(link.right for link in RELATIONSHIPS if link.left == home)}
    for name in names:
        if dimension(name).table in tables:
            return name
    raise KeyError(f"none of {', '.join(names)} is a dimension of {home}")


def drill_across(
    tables: dict[str, DataFrame],
    facts: Sequence[str],
    dimensions: dict[str, Sequence[str]],
    aggregate: str = "sum",
) -> DataFrame:
    """Facts of several tables side by side, by dimensions that they share.

    ``dimensions`` maps a column of the result to the model columns that stand for it; a fact
    table is grouped by the first of them that it has itself or is linked to.  Each table is
    aggregated to the shared dimensions by itself before the results meet, so no row of one
    fact is repeated for rows of another.  A value that only one table has, NULL included,
    has NULL in the others' columns.
    """
    homes = dict.fromkeys(fact(f).table for f in facts)
    columns = [fact(f).column for f in facts]
    if len(set(columns)) < len(columns) or set(columns) & set(dimensions):
        raise ValueError("columns of the result must differ")
    sides = []
    for home in homes:
        own = [f for f in facts if fact(f).table == home]
        used = [_reached(home, names) for names in dimensions.values()]
        grouped = semantic_query(tables, own, used, (), aggregate)
        measures = grouped.columns[len(used) :]
        named = grouped.toDF(*dimensions, *measures)
        absent = [F.lit(None).alias(c) for c in columns if c not in measures]  # of no type, so the fact's stays
        sides.append(named.select(*dimensions, *measures, *absent))
    every = sides[0]
    for side in sides[1:]:
        every = every.unionByName(side)
    # One side has a value for a column and a group at most; grouping takes NULLs as equal.
    return every.groupBy(*dimensions).agg(*[F.max(c).alias(c) for c in columns])
