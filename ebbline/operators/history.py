"""Run history: the latest run, its trend and headline, changes and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbline.functions.money import RATIO

# Fixed value: the regulatory floor of the ratio.
FLOOR = 1.0

SERIES = ("day_number", "total_net_cash_outflows", "hqla", "lcr")


def _stamp() -> Column:
    return F.struct("created_timestamp", "run_id")


def latest_run(history: DataFrame) -> DataFrame:
    """Rows of the newest run of a history; of runs made at one instant, that of the largest id.

    The newest stamp is a subquery, so rows are filtered and not joined.  Runs without id are
    one run per instant.  A stored history knows its newest run without being read:
    see ``ebbline.sources.runs.latest``.
    """
    return history.where(_stamp().eqNullSafe(history.agg(F.max(_stamp())).scalar()))


def latest_run_per_scenario(history: DataFrame) -> DataFrame:
    """Rows of the newest run of every scenario; the subquery has a stamp for each scenario."""
    newest = history.groupBy("what_if_id").agg(F.max(_stamp()).alias("newest"))
    stamps = newest.agg(F.collect_list(F.struct("what_if_id", "newest.created_timestamp", "newest.run_id")))
    return history.where(F.array_contains(stamps.scalar(), F.struct("what_if_id", "created_timestamp", "run_id")))


def trend(run: DataFrame, *keys: str) -> DataFrame:
    """The ratio of one run, by day."""
    return run.select(*keys, *SERIES).orderBy(*keys, F.asc_nulls_first("day_number"))


def latest_lcr(history: DataFrame) -> DataFrame:
    """Trend of the newest baseline run, by day."""
    return trend(latest_run(history))


def latest_what_if_lcr(history: DataFrame, what_if_id: str) -> DataFrame:
    """Trend of the newest run of one scenario, by day."""
    one = history.filter(F.col("what_if_id").cast("string") == str(what_if_id))
    return trend(latest_run(one), "what_if_id")


def within(series: DataFrame, horizon: int) -> DataFrame:
    """Forecast days up to ``horizon``."""
    return series.filter(F.col("day_number") <= horizon)


def on_days(series: DataFrame, *days: int) -> DataFrame:
    """The given forecast days."""
    return series.filter(F.col("day_number").isin(list(days)))


def below_floor(series: DataFrame, floor: float = FLOOR) -> DataFrame:
    """Forecast days whose ratio is below the floor."""
    return series.filter(F.col("lcr") < F.lit(floor).cast(RATIO)).orderBy("day_number")


def _status(floor: float) -> Column:
    enough = F.col("lcr") >= F.lit(floor).cast(RATIO)
    return F.when(enough, "Compliant").otherwise("Non-Compliant")


def headline(series: DataFrame, day: int = 1, floor: float = FLOOR) -> DataFrame:
    """One day's ratio, HQLA, outflows, status and headroom over the floor."""
    return on_days(series, day).select(
        "day_number",
        "lcr",
        "hqla",
        "total_net_cash_outflows",
        _status(floor).alias("status"),
        (F.col("lcr") - F.lit(floor).cast(RATIO)).alias("headroom"),
    )


def change_analysis(run: DataFrame, horizon: int = 150) -> DataFrame:
    """One run with day-over-day changes.

    The window has no partition key, yet holds one run: at most ``horizon`` rows.
    """
    return _changes(within(run, horizon), W.orderBy("day_number")).orderBy("day_number")


def scenario_change_analysis(run: DataFrame, horizon: int = 150) -> DataFrame:
    """As :func:`change_analysis` for one run of each scenario."""
    return _changes(within(run, horizon), W.partitionBy("what_if_id").orderBy("day_number"), "what_if_id")


def lcr_change_analysis(history: DataFrame, horizon: int = 150) -> DataFrame:
    """:func:`change_analysis` of the newest run."""
    return change_analysis(latest_run(history), horizon)


def what_if_change_analysis(history: DataFrame, horizon: int = 150) -> DataFrame:
    """:func:`scenario_change_analysis` of the newest run of every scenario."""
    return scenario_change_analysis(latest_run_per_scenario(history), horizon)


def _changes(run: DataFrame, window: W, *keys: str) -> DataFrame:
    def change(column: str) -> Column:
        return F.col(column) - F.lag(column).over(window)

    return run.select(
        *keys,
        "day_number",
        "hqla",
        "total_net_cash_outflows",
        "lcr",
        change("hqla").alias("hqla_change"),
        change("total_net_cash_outflows").alias("outflows_change"),
        change("lcr").alias("lcr_change"),
    )


def compare_runs(baseline: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Baseline and scenario ratios by scenario and day, with their difference."""
    base = baseline.select("day_number", F.col("lcr").alias("baseline_lcr"))
    return (
        scenarios.select("what_if_id", "day_number", F.col("lcr").alias("scenario_lcr"))
        .join(base, "day_number")
        .select(
            "what_if_id",
            "day_number",
            "baseline_lcr",
            "scenario_lcr",
            (F.col("scenario_lcr") - F.col("baseline_lcr")).alias("lcr_difference"),
        )
    )


def lcr_drivers(
    hqla: DataFrame, net: DataFrame, first_day: int = 1, last_day: int = 150, k: int = 3
) -> DataFrame:
    """The k largest causes of the ratio's move between two days.

    HQLA, inflow and outflow are replaced one after the other by their values on the
    last day, so the three effects add up to the whole move.
    """
    days = on_days(hqla.join(net, "day_number"), first_day, last_day)

    def on(day: int, column: str) -> Column:
        picked = F.when(F.col("day_number") == day, F.col(column).cast("double"))
        return F.max(picked)

    ends = days.agg(
        *[
            on(day, column).alias(f"{name}{n}")
            for n, day in enumerate((first_day, last_day))
            for name, column in (
                ("h", "total_hqla_usd"), ("i", "total_inflow"), ("o", "total_outflow")
            )
        ]
    )
    start = F.col("h0") / (F.col("i0") + F.col("o0"))
    new_hqla = F.col("h1") / (F.col("i0") + F.col("o0"))
    new_inflow = F.col("h1") / (F.col("i1") + F.col("o0"))
    new_outflow = F.col("h1") / (F.col("i1") + F.col("o1"))
    effects = F.array(
        F.struct(F.lit("hqla").alias("cause"), (new_hqla - start).alias("effect")),
        F.struct(F.lit("inflow").alias("cause"), (new_inflow - new_hqla).alias("effect")),
        F.struct(F.lit("outflow").alias("cause"), (new_outflow - new_inflow).alias("effect")),
    )
    return (
        ends.select(F.inline(effects))
        .select("cause", F.round("effect", 8).alias("effect"))
        .orderBy(F.abs("effect").desc(), "cause")
        .limit(k)
    )
