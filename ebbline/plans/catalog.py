"""Every operator as a query over the Parquet tables of one directory.

Money is computed in decimals and handed out as doubles, dates as text, so that any
client can compare the results.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.functions.money import TOTAL
from ebbline.operators import history as hist
from ebbline.operators import quality
from ebbline.operators.projection import (
    N_DAYS,
    cashflow_daily,
    cashflow_projection,
    hqla_detail,
    hqla_projection,
    wide_summary,
)
from ebbline.operators.scenario import FACTOR_KINDS, apply_scenario, factors_of_kind
from ebbline.operators.semantic import drill_across, semantic_query
from ebbline.plans import questions as ask
from ebbline.plans.jobs import Book, forecast_hqla, forecast_net, run_forecast, run_what_if
from ebbline.sources import runs
from ebbline.sources.tables import fetch, overwrite, read_snapshot, read_table, run_sql, snapshot, working_folder
from ebbline.sources.testdata import AS_OF, StarSchema

Query = Callable[[SparkSession, str], DataFrame]

MIDNIGHT = AS_OF.replace(hour=0)
EARLIER = AS_OF - dt.timedelta(days=7)
LATE = AS_OF.replace(month=11)
SCENARIOS = ("1", "2", "3")


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text."""

    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


# Runs of the stored histories: what is valued, when the run is made, and its id.
BASELINE_RUNS = ((EARLIER, EARLIER, "first"), (AS_OF, AS_OF, "second"))
EQUAL_STAMPS = ((AS_OF, AS_OF, "a"), (EARLIER, AS_OF, "b"))
SCENARIO_RUNS = ((EARLIER, ("1", "3"), "first"), (AS_OF, ("1", "2"), "second"))


def _target(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where a history of these tables lies for as long as the application runs."""
    tables = hashlib.sha256(sf_dir.encode()).hexdigest()[:16]
    return f"{working_folder(spark)}/ebbline-{spark.sparkContext.applicationId}/{tables}/{name}"


def stored_baseline(spark: SparkSession, sf_dir: str, wanted=BASELINE_RUNS, name: str = "lcr") -> str:
    """The stored baseline history; runs that it doesn't hold yet are made and appended."""
    target = _target(spark, sf_dir, name)
    for as_of, created, run_id in wanted:
        if not runs.is_stored(spark, target, run_id):
            runs.append_run(run_forecast(StarSchema(spark, sf_dir).facts(), as_of), target, created, "lcr", run_id)
    return target


def stored_scenarios(spark: SparkSession, sf_dir: str) -> str:
    """The stored scenario history: scenarios 1 and 3 a week ago, 1 and 2 now."""
    target = _target(spark, sf_dir, "what_if_lcr")
    for as_of, ids, run_id in SCENARIO_RUNS:
        if not runs.is_stored(spark, target, run_id, "what_if_lcr"):
            result = run_what_if(StarSchema(spark, sf_dir).book_with_rules(), ids, as_of)
            runs.append_run(result, target, as_of, "what_if_lcr", run_id)
    return target


def _appended_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs and a retry of the second appended to a new history, then all that it holds."""
    target = _target(spark, sf_dir, f"lcr-{uuid.uuid4().hex}")
    facts = StarSchema(spark, sf_dir).facts()
    for as_of, created, run_id in (*BASELINE_RUNS, BASELINE_RUNS[-1]):
        runs.append_run(run_forecast(facts, as_of), target, created, "lcr", run_id)
    held = runs.history(spark, target).groupBy("run_id").agg(F.count("*").alias("n_days"), F.min("lcr").alias("least_lcr"), F.max("lcr").alias("most_lcr"))
    return present(held.join(runs.runs(spark, target).select("run_id", "n_rows"), "run_id"))


def _facts(build: Callable[[Book], DataFrame]) -> Query:
    """Query over the facts without unit lookups."""
    return lambda spark, sf_dir: present(build(StarSchema(spark, sf_dir).facts()))


def _book(build: Callable[[Book], DataFrame], units: bool = True) -> Query:
    """Query over facts with their lookups, and dimensions."""
    return lambda spark, sf_dir: present(build(StarSchema(spark, sf_dir).book(units)))


def _scenario(build: Callable[[Book], DataFrame]) -> Query:
    """Query over all model tables, scenario rules included."""
    return lambda spark, sf_dir: present(build(StarSchema(spark, sf_dir).book_with_rules()))


def _rules(build: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = StarSchema(spark, sf_dir).what_if_definitions_lookup()
        df = present(build(rules))
        rounded = [F.round(c, 6).alias(c) if c == "factor" else F.col(c) for c in df.columns]
        return df.select(*rounded)

    return run


def _history(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Query over the newest run of the stored baseline history."""
    return lambda spark, sf_dir: present(build(runs.latest(spark, stored_baseline(spark, sf_dir))))


def _scenario_history(build: Callable[[DataFrame], DataFrame], what_if_id: str | None = None) -> Query:
    """Query over the newest run of every scenario, or of one, of the stored history."""
    return lambda spark, sf_dir: present(build(runs.latest(spark, stored_scenarios(spark, sf_dir), "what_if_lcr", what_if_id)))


def _detail(book: Book) -> DataFrame:
    return hqla_detail(book.positions, book.asset_classifications, AS_OF)


def _stressed(name: str) -> Query:
    def build(book: Book) -> DataFrame:
        tables = book.tables()
        return apply_scenario({name: tables[name]}, tables, book.what_if_definitions_lookup, SCENARIOS)[name]

    return _scenario(build)


def _factors(kind: str) -> Query:
    return _scenario(
        lambda b: factors_of_kind(kind, b.tables(), b.what_if_definitions_lookup, SCENARIOS)
    )


def _compare(days: Sequence[int] = ()) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = StarSchema(spark, sf_dir)
        baseline, scenarios = run_forecast(schema.facts(), AS_OF), run_what_if(schema.book_with_rules(), SCENARIOS, AS_OF)
        compared = hist.compare_runs(baseline, scenarios)
        return present(hist.on_days(compared, *days) if days else compared)

    return run


def _reconciliation(book: Book) -> DataFrame:
    hqla = "total_hqla_usd"
    parts = [
        quality.reconcile_days(
            wide_summary(hqla_projection(_detail(book), AS_OF, in_cents=True), hqla, hqla), forecast_hqla(book, AS_OF), hqla, "hqla"
        )
    ]
    for side, flows in (("inflow", book.cash_inflows), ("outflow", book.cash_outflows)):
        rows = wide_summary(cashflow_projection(flows, side, AS_OF, in_cents=True), f"{side}_stock", f"total_{side}")
        parts.append(quality.reconcile_days(rows, cashflow_daily(flows, side, AS_OF), f"total_{side}", side))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = StarSchema(spark, sf_dir).book_with_rules()
    baseline, scenarios = stored_baseline(spark, sf_dir), stored_scenarios(spark, sf_dir)
    tables = {
        **book.tables(),
        "hqla_summary": forecast_hqla(book, AS_OF),
        "lcr": runs.history(spark, baseline),
        "what_if_lcr": runs.history(spark, scenarios, "what_if_lcr"),
    }
    return quality.check_all(spark, tables, runs.latest(spark, baseline))


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inflows by type from a snapshot of a stored table that has grown since."""
    target = _target(spark, sf_dir, f"flows-{uuid.uuid4().hex}")
    flows = StarSchema(spark, sf_dir).cash_inflows(units=False)
    overwrite(flows, f"{target}/flows")
    snapshot(spark, f"{target}/flows", f"{target}/snapshot")
    flows.write.mode("append").parquet(f"{target}/flows")
    held = read_snapshot(spark, f"{target}/snapshot")
    return present(ask.flows_by(held, "inflow", "inflow_type", "flow_type"))


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outflows still due late in the year, from a table clustered by maturity."""
    target = _target(spark, sf_dir, f"clustered-{uuid.uuid4().hex}/outflows")
    overwrite(StarSchema(spark, sf_dir).cash_outflows(units=False, counterparties=False), target, cluster_by=("maturity_date",))
    return present(cashflow_daily(read_table(spark, target), "outflow", LATE))


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stressed outflows by scenario, from outflows bucketed by counterparty."""
    name = f"ebbline_outflows_{uuid.uuid4().hex}"
    book = StarSchema(spark, sf_dir).book_with_rules()
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    overwrite(book.cash_outflows, name, buckets=buckets, bucket_by=("counterparty_id",), location=_target(spark, sf_dir, name))
    stored = replace(book, cash_outflows=spark.table(name))
    flows = apply_scenario({"cash_outflows": stored.cash_outflows}, stored.tables(), stored.what_if_definitions_lookup, SCENARIOS)["cash_outflows"]
    return present(flows.groupBy("what_if_id").agg(F.count("*").alias("n_flows"), F.sum("outflow_amount_usd").cast(TOTAL).alias("outflow_usd")))


def _sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a table's path with bound parameters."""
    return present(
        run_sql(
            spark,
            f"SELECT o_orderpriority AS priority, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DECIMAL(38,2)) AS price_usd"
            f" FROM parquet.`{sf_dir}/orders.parquet` WHERE o_orderstatus = :status AND o_totalprice >= :least GROUP BY o_orderpriority",
            status="F",
            least=1000,
        )
    )


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report brought to the client and shown there."""
    rows = fetch(present(ask.flows_by_unit(StarSchema(spark, sf_dir).book())))
    return spark.createDataFrame(rows, "direction string, business_unit_id string, n_flows long, amount_usd double")


def _both_sides(book: Book) -> DataFrame:
    """Distinct units and counterparties that deal with each other, over both flows."""
    sides = [df.select("business_unit_id", "counterparty_id") for df in (book.cash_inflows, book.cash_outflows)]
    return sides[0].unionByName(sides[1]).distinct()


def _beside_their_day(book: Book) -> DataFrame:
    """Positions beside the total of their security on their position date."""
    totals = book.positions.groupBy("security_id", F.col("position_date").alias("market_date")).agg(F.sum("position_value_usd").cast(TOTAL).alias("day_usd"))
    on = (F.col("p.security_id") == F.col("t.security_id")) & (F.col("p.position_date") == F.col("t.market_date"))
    return book.positions.alias("p").join(totals.alias("t"), on).select("p.position_id", "p.position_date", "p.position_value_usd", "t.day_usd")


def _price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price for every security and each of the 30 days up to the valuation; no cross join."""
    parts = StarSchema(spark, sf_dir).raw("part").select("p_partkey", F.col("p_retailprice").cast("decimal(20,4)").alias("base"))
    laid_out = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("back"))
    return present(
        laid_out.select(
            F.concat(F.lit("SEC_"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("security_id"),
            F.date_sub(F.lit(AS_OF.date()), F.col("back")).alias("market_date"),
            (F.col("base") * (F.lit(1000) - F.col("back")) * F.lit(Decimal("0.001"))).cast("decimal(20,4)").alias("price_usd"),
        )
    )


def _notices(book: Book) -> DataFrame:
    """When dated inflows are to be announced: keys padded, 30 days before maturity."""
    return book.cash_inflows.where(F.col("maturity_date").isNotNull()).select(
        F.concat(F.lit("CP_"), F.lpad("counterparty_id", 6, "0")).alias("counterparty"),
        F.concat(F.lit("IN_"), F.lpad("inflow_id", 10, "0")).alias("inflow"),
        F.date_sub("maturity_date", 30).alias("notice_date"),
        F.date_add("maturity_date", 2).alias("settled_by"),
    )


def _changes(df: DataFrame) -> DataFrame:
    return df.withColumn("lcr_change", F.round("lcr_change", 8))


def catalog() -> dict[str, Query]:
    """All queries by name."""
    return {
        # Projection, netting, ratio
        "hqla_detail": _facts(_detail),
        "hqla_projection_wide": _facts(lambda b: hqla_projection(_detail(b), AS_OF)),
        "hqla_summary": _facts(lambda b: forecast_hqla(b, AS_OF)),
        "hqla_summary_from_wide": _facts(
            lambda b: wide_summary(
                hqla_projection(_detail(b), AS_OF), "total_hqla_usd", "total_hqla_usd"
            ),
        ),
        "hqla_summary_by_level": _facts(lambda b: forecast_hqla(b, AS_OF, by=("hqla_level",))),
        "cash_inflow_projection_wide": _book(
            lambda b: cashflow_projection(b.cash_inflows, "inflow", AS_OF)
        ),
        "cash_outflow_projection_wide": _book(
            lambda b: cashflow_projection(b.cash_outflows, "outflow", AS_OF, gathered=True)
        ),
        "cash_inflow_daily": _facts(lambda b: cashflow_daily(b.cash_inflows, "inflow", AS_OF)),
        "cash_outflow_daily": _facts(lambda b: cashflow_daily(b.cash_outflows, "OUTFLOW", AS_OF)),
        "cash_outflow_from_wide": _facts(
            lambda b: wide_summary(
                cashflow_projection(b.cash_outflows, "outflow", AS_OF),
                "outflow_stock",
                "total_outflow",
            ),
        ),
        "net_cashflow": _facts(lambda b: forecast_net(b, AS_OF)),
        "lcr_baseline": _facts(lambda b: run_forecast(b, AS_OF)),
        "lcr_baseline_midnight": _facts(lambda b: run_forecast(b, MIDNIGHT)),
        "lcr_baseline_with_units": _book(lambda b: run_forecast(b, AS_OF)),
        "cash_outflow_daily_by_counterparty": _book(
            lambda b: cashflow_daily(b.cash_outflows, "outflow", AS_OF, by=("counterparty_id",)), units=False
        ),
        # Tables, stored and read
        "sql_text": _sql_text,
        "fetched_report": _fetched,
        "flows_in_a_snapshot": _snapshot,
        "late_outflows_of_a_clustered_table": _clustered,
        "stressed_outflows_of_a_bucketed_table": _bucketed,
        "units_and_counterparties": _book(_both_sides),
        "positions_beside_their_day": _facts(_beside_their_day),
        "security_price_days": _price_days,
        "inflow_notices": _book(_notices, units=False),
        # Scenarios
        **{f"factors_{kind}": _factors(kind) for kind in FACTOR_KINDS},
        "stressed_inflows": _stressed("cash_inflows"),
        "stressed_outflows": _stressed("cash_outflows"),
        "stressed_positions": _stressed("positions"),
        "lcr_what_if": _scenario(lambda b: run_what_if(b, "1", AS_OF)),
        "lcr_what_if_all": _scenario(lambda b: run_what_if(b, SCENARIOS, AS_OF)),
        # History
        "appended_runs": _appended_runs,
        "latest_lcr": _history(hist.trend),
        "latest_what_if_lcr": _scenario_history(lambda run: hist.trend(run, "what_if_id"), "1"),
        "lcr_change_analysis": _history(lambda run: _changes(hist.change_analysis(run))),
        "what_if_change_analysis": _scenario_history(
            lambda run: _changes(hist.scenario_change_analysis(run))
        ),
        "latest_of_equal_stamps": lambda spark, sf_dir: present(
            _changes(hist.change_analysis(runs.latest(spark, stored_baseline(spark, sf_dir, EQUAL_STAMPS, "equal_stamps"))))
        ),
        "headline": _history(hist.headline),
        # Scenario definitions
        "scenario_definitions": _rules(ask.scenario_definitions),
        "scenario_listing": _rules(ask.scenario_listing),
        "scenario_ids": _rules(ask.scenario_ids),
        "scenario_rules": _rules(lambda r: ask.scenario_rules(r, "3")),
        # Business questions
        "lcr_trend_30_days": _history(lambda run: hist.within(hist.trend(run), 30)),
        "days_below_floor": _history(lambda run: hist.below_floor(hist.trend(run))),
        "lcr_next_90_days": _history(lambda run: hist.within(hist.trend(run), 90)),
        "lcr_at_7_and_30_days": _history(lambda run: hist.on_days(hist.trend(run), 7, 30)),
        "hqla_by_security_type": _facts(lambda b: ask.hqla_by(b, AS_OF, "security_type")),
        "hqla_by_level": _facts(lambda b: ask.hqla_by(b, AS_OF, "hqla_level")),
        "top_unit_by_hqla": _book(lambda b: ask.hqla_by_unit(b, AS_OF, k=1)),
        "largest_outflows_by_counterparty": _book(lambda b: ask.largest_outflows(b, 10), units=False),
        "inflow_versus_outflow": _facts(
            lambda b: forecast_net(b, AS_OF).select("day_number", "total_inflow", "total_outflow")
        ),
        "net_outflow_by_unit": _book(ask.net_outflow_by_unit),
        "baseline_versus_scenarios": _compare(),
        "scenario_impact_day_30": _compare((30,)),
        "positions_of_type": _facts(lambda b: ask.positions_like(b, "ECONOMY%")),
        "largest_positions": _facts(lambda b: ask.largest_positions(b, 10)),
        "exposure_by_security_type": _facts(ask.exposure_by_security_type),
        "lcr_drivers": _facts(
            lambda b: hist.lcr_drivers(forecast_hqla(b, AS_OF), forecast_net(b, AS_OF), 1, N_DAYS),
        ),
        "counterparties_by_type": _book(ask.counterparties_by_type, units=False),
        "hqla_first_30_days": _facts(lambda b: ask.hqla_over(forecast_hqla(b, AS_OF), 30)),
        "flows_by_unit": _book(ask.flows_by_unit),
        "flows_by_counterparty_type": _book(ask.flows_by_counterparty_type, units=False),
        "flows_by_type": _facts(ask.flows_by_type),
        "flows_by_maturity_bucket": _facts(lambda b: ask.flows_by_bucket(b, AS_OF)),
        # Semantic model and data quality
        "semantic_inflows_by_counterparty": _book(
            lambda b: semantic_query(
                b.tables(),
                ["cash_inflows.inflow_amount_usd"],
                ["counterparty_data.counterparty_type", "counterparty_data.region",
                 "cash_inflows.inflow_type"],
                [("counterparty_data.credit_rating", lambda c: c.isin("AAA", "AA"))],
            )
        ),
        "semantic_outflows_by_region": _book(
            lambda b: semantic_query(
                b.tables(),
                ["cash_outflows.outflow_amount_usd"],
                ["business_unit_reference.region", "counterparty_data.region"],
            )
        ),
        "semantic_positions_by_level": _book(
            lambda b: semantic_query(
                b.tables(),
                ["positions.position_value_usd", "positions.quantity"],
                ["asset_classifications.hqla_level", "positions.position_type"],
                [("positions.position_date", lambda c: c >= dt.date(1998, 1, 1))],
            )
        ),
        "relationship_orphans": _book(lambda b: quality.orphans(b.tables())),
        "unclassified_positions": _book(
            lambda b: quality.orphan_rows(b.tables(), "positions_to_asset_security_type").select(
                "position_id", "security_type", "position_value_usd"
            )
        ),
        "duplicate_keys": _scenario(lambda b: quality.duplicate_keys(b.tables())),
        "semantic_flows_and_positions_by_region": _book(
            lambda b: drill_across(
                b.tables(),
                ["cash_inflows.inflow_amount_usd", "cash_outflows.outflow_amount_usd", "positions.position_value_usd"],
                {"region": ("counterparty_data.region", "business_unit_reference.region")},
            )
        ),
        "missing_fields": _scenario(lambda b: quality.missing_fields(b.tables())),
        "reconciliation": _facts(_reconciliation),
        "quality_report": lambda spark, sf_dir: present(_report(spark, sf_dir)),
        "quality_summary": lambda spark, sf_dir: present(
            quality.summary(_report(spark, sf_dir))
        ),
    }
