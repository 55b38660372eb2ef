"""The baseline forecast and the what-if run, each one lazy plan, and their jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession

from ebbline.operators.history import trend
from ebbline.operators.netting import lcr, net_cashflow
from ebbline.operators.projection import (
    BASELINE_DECAY,
    N_DAYS,
    SCENARIO_DECAY,
    cashflow_daily,
    hqla_daily,
    hqla_detail,
)
from ebbline.operators.scenario import STRESSED_FACTS, apply_scenario
from ebbline.sources.runs import append_run, latest
from ebbline.sources.tables import read_table


@dataclass(frozen=True)
class Book:
    """The input tables of a run; the last three are only needed for scenarios."""

    positions: DataFrame
    cash_inflows: DataFrame
    cash_outflows: DataFrame
    asset_classifications: DataFrame
    counterparty_data: DataFrame | None = None
    business_unit_reference: DataFrame | None = None
    what_if_definitions_lookup: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, sources: Mapping[str, str]) -> Book:
        """Book from table names or Parquet paths, one per table of the model."""
        return cls(**{name: read_table(spark, source, name) for name, source in sources.items()})

    def tables(self) -> dict[str, DataFrame]:
        """The tables present, by name."""
        named = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in named.items() if df is not None}


def forecast_hqla(
    book: Book,
    as_of: dt.datetime,
    n_days: int = N_DAYS,
    decay: float = BASELINE_DECAY,
    by: Sequence[str] = (),
) -> DataFrame:
    """Daily HQLA of a book, optionally per value of ``by``."""
    detail = hqla_detail(book.positions, book.asset_classifications, as_of, by)
    return hqla_daily(detail, as_of, n_days, decay, by)


def forecast_net(
    book: Book, as_of: dt.datetime, n_days: int = N_DAYS, by: Sequence[str] = ()
) -> DataFrame:
    """Daily inflow, outflow and net position of a book."""
    return net_cashflow(
        cashflow_daily(book.cash_inflows, "inflow", as_of, n_days, by),
        cashflow_daily(book.cash_outflows, "outflow", as_of, n_days, by),
        by,
    )


def run_forecast(
    book: Book,
    as_of: dt.datetime,
    n_days: int = N_DAYS,
    decay: float = BASELINE_DECAY,
    on_zero: str = "raise",
) -> DataFrame:
    """(day_number, total_net_cash_outflows, hqla, lcr) for each forecast day."""
    return lcr(
        forecast_net(book, as_of, n_days),
        forecast_hqla(book, as_of, n_days, decay),
        on_zero=on_zero,
    )


def stressed_book(book: Book, what_if_ids: Sequence[str]) -> Book:
    """The book with its three facts restated, each row carrying its what_if_id."""
    tables = book.tables()
    facts = apply_scenario(
        {name: tables[name] for name in STRESSED_FACTS},
        tables,
        book.what_if_definitions_lookup,
        what_if_ids,
    )
    return replace(book, **facts)


def run_what_if(
    book: Book,
    what_if_ids: Sequence[str] | str,
    as_of: dt.datetime,
    n_days: int = N_DAYS,
    decay: float = SCENARIO_DECAY,
    on_zero: str = "raise",
) -> DataFrame:
    """As :func:`run_forecast`, for one or more scenarios in one pass over the facts.

    The default decay differs from the baseline's, so two runs compare like with like
    only if they are given the same one.
    """
    ids = [what_if_ids] if isinstance(what_if_ids, str) else list(what_if_ids)
    stressed, by = stressed_book(book, ids), ("what_if_id",)
    return lcr(
        forecast_net(stressed, as_of, n_days, by),
        forecast_hqla(stressed, as_of, n_days, decay, by),
        by,
        on_zero,
    )


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _run_id(created: dt.datetime | None, as_of: dt.datetime, *terms: object) -> str:
    """A run is named by when it was made, or else by what it values, so that a retry has its id."""
    return created.isoformat() if created else "/".join(map(str, (as_of.isoformat(), *terms)))


def forecast_job(
    spark: SparkSession,
    sources: Mapping[str, str],
    target: str,
    as_of: dt.datetime,
    n_days: int = N_DAYS,
    decay: float = BASELINE_DECAY,
    run_id: str | None = None,
    created: dt.datetime | None = None,
) -> DataFrame:
    """Read the tables, append one baseline run to ``target``, return the latest trend.

    ``created`` is the instant of the run in UTC, now if not given.  A run replaces the one
    of its ``run_id``; without one, a run given ``created`` is named by it, and any other
    by ``as_of``, horizon and decay, so that a retried job leaves one run.
    """
    result = run_forecast(Book.read(spark, sources), as_of, n_days, decay)
    append_run(result, target, created or _now(), "lcr", run_id or _run_id(created, as_of, n_days, decay))
    return trend(latest(spark, target))


def what_if_job(
    spark: SparkSession,
    sources: Mapping[str, str],
    target: str,
    what_if_ids: Sequence[str] | str,
    as_of: dt.datetime,
    n_days: int = N_DAYS,
    decay: float = SCENARIO_DECAY,
    run_id: str | None = None,
    created: dt.datetime | None = None,
) -> DataFrame:
    """As :func:`forecast_job` for scenarios; returns the latest run of each."""
    result = run_what_if(Book.read(spark, sources), what_if_ids, as_of, n_days, decay)
    append_run(result, target, created or _now(), "what_if_lcr", run_id or _run_id(created, as_of, n_days, decay))
    return latest(spark, target, "what_if_lcr")
