from __future__ import annotations

import datetime as dt

import pytest

from ebbline import Book, forecast_job, run_forecast, run_what_if, what_if_job
from ebbline.sources.reference import reference_table
from ebbline.sources.sample import cash_flows, counterparties, market_data, positions
from ebbline.sources.tables import overwrite
from tests import fixtures as fx

LATER = fx.NOON + dt.timedelta(days=1)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("bank")
    prices = market_data(spark, fx.TODAY, n_securities=20, n_days=10)
    tables = {
        "positions": positions(spark, fx.TODAY, prices, n=200, n_cash=60, n_securities=20, n_days=10),
        "cash_inflows": cash_flows(spark, fx.TODAY, "inflow", n=120),
        "cash_outflows": cash_flows(spark, fx.TODAY, "outflow", seed=9, n=120),
        "counterparty_data": counterparties(spark, fx.TODAY, 50),
    }
    for name in ("asset_classifications", "business_unit_reference", "what_if_definitions_lookup"):
        tables[name] = reference_table(spark, name, fx.NOON)
    for name, df in tables.items():
        overwrite(df, str(base / name))
    return {name: str(base / name) for name in tables}


def values(df, *keys):
    return sorted((*(r[k] for k in keys), r.total_net_cash_outflows, r.hqla, r.lcr) for r in df.collect())


def test_forecast_job_appends_and_returns_the_latest(spark, sources, tmp_path):
    target = str(tmp_path / "lcr")
    forecast_job(spark, sources, target, fx.NOON, 5, created=fx.NOON)
    latest = forecast_job(spark, sources, target, LATER, 5, run_id="second", created=LATER)
    assert values(latest, "day_number") == values(
        run_forecast(Book.read(spark, sources), LATER, 5), "day_number"
    )
    assert spark.read.parquet(target).count() == 10


def test_what_if_job_keeps_scenarios_and_runs_apart(spark, sources, tmp_path):
    target = str(tmp_path / "what_if")
    what_if_job(spark, sources, target, ["1", "2"], fx.NOON, 4, created=fx.NOON)
    latest = what_if_job(spark, sources, target, "2", LATER, 4, created=LATER)
    book = Book.read(spark, sources)
    want = values(run_what_if(book, "1", fx.NOON, 4), "what_if_id", "day_number") + values(
        run_what_if(book, "2", LATER, 4), "what_if_id", "day_number"
    )
    assert values(latest, "what_if_id", "day_number") == want


def test_rerun_at_the_same_valuation_time_gives_one_run(spark, sources, tmp_path):
    target = str(tmp_path / "lcr")
    forecast_job(spark, sources, target, fx.NOON, 150, created=fx.NOON, run_id="a")
    latest = forecast_job(spark, sources, target, fx.NOON, 150, created=fx.NOON, run_id="b")
    assert sorted(r.day_number for r in latest.collect()) == list(range(1, 151))


def test_a_hot_counterparty_gives_the_same_totals(spark, sources):
    """One counterparty holds a third of the flows; per-row factors must still be exact."""
    book = Book.read(spark, sources)
    flows = [(f"I{i}", "US_TREASURY", "CP_000001" if i % 3 == 0 else f"CP_{i % 50:06d}", f"{i}.37", None) for i in range(300)]
    hot = Book(**{**book.tables(), "cash_inflows": fx.flows(spark, "inflow", flows)})
    rows = run_what_if(hot, "1", fx.NOON, 2).collect()
    factors = {}
    for r in book.counterparty_data.collect():
        factors[r.counterparty_id] = (90 if r.region == "Europe" else 100) * (85 if r.counterparty_type == "Institutional" else 100)
    unit = 98 * 90  # both unit rules of inflows hit a North American treasury
    cents = 0
    for _, _, cp, amount, _ in flows:
        exact = int(amount.replace(".", "")) * factors[cp] * unit
        cents += (2 * exact + 10**8) // (2 * 10**8)
    from ebbline.plans.jobs import forecast_net, stressed_book

    net = forecast_net(stressed_book(hot, ["1"]), fx.NOON, 2, ("what_if_id",)).filter("day_number = 1").first()
    assert int(net.total_inflow * 100) == cents
    assert len(rows) == 2
