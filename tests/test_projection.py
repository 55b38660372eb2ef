from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from ebbline.functions.money import after_haircut, coverage_ratio, decay_curve
from ebbline.operators.netting import lcr, net_cashflow
from ebbline.operators.projection import (
    cashflow_daily,
    cashflow_projection,
    hqla_daily,
    hqla_detail,
    hqla_projection,
    wide_summary,
)
from tests import fixtures as fx

INSTANTS = [fx.NOON, fx.MIDNIGHT, dt.datetime(2024, 3, 10, 23, 59, 59)]
EDGES = [None, fx.day(-1), fx.day(0), fx.day(1), fx.day(2), fx.day(9), fx.day(10), fx.day(400)]


def detail_frame(spark, rows):
    return spark.createDataFrame(
        [(m, v) for v, m in rows], "maturity_date date, total_hqla_usd decimal(20,6)"
    )


@pytest.mark.parametrize("as_of", INSTANTS)
def test_hqla_detail_and_daily_on_maturity_edges(spark, as_of):
    rows = [(f"P{i}", "U1", "BOND", "Long", "1000.05", m) for i, m in enumerate(EDGES)]
    rows += [("S", "U1", "BOND", "Short", "500.00", None), ("X", "U1", "GOLD", "Long", "1.00", None)]
    detail = hqla_detail(fx.positions(spark, rows), fx.classes(spark), as_of)
    want = [(Decimal("850.042500"), m) for m in EDGES if m is None or m >= fx.TODAY]
    have = [(r.total_hqla_usd, r.maturity_date) for r in detail.collect()]
    assert sorted(have, key=str) == sorted(want, key=str)
    daily = fx.by_day(hqla_daily(detail, as_of, 10, 0.9999), "total_hqla_usd")
    assert daily == fx.plain_hqla(want, as_of, 10, "0.9999")


@pytest.mark.parametrize("as_of", INSTANTS)
def test_cashflow_daily_on_maturity_edges(spark, as_of):
    rows = [(f"I{i}", "U1", "C1", f"{100 + i}.25", m) for i, m in enumerate(EDGES)]
    daily = cashflow_daily(fx.flows(spark, "inflow", rows), "inflow", as_of, 10)
    plain = fx.plain_flow([(Decimal(r[3]), r[4]) for r in rows], as_of, 10)
    assert fx.by_day(daily, "total_inflow") == plain


@pytest.mark.parametrize("as_of", INSTANTS)
def test_cashflow_daily_by_group_shuffles_lives_and_not_days(spark, as_of):
    rng = random.Random(5)
    groups = ["A", "B", "C", "D", None]
    rows = [(f"I{i}", "U1", groups[i % 4], f"{rng.randint(1, 10**9)}.{i % 90 + 10}", fx.day(rng.choice([-1, 0, 1, 2, 7, 39, 40, 41, 90]))) for i in range(60)]
    rows += [("I-", "U1", "D", "5.00", None), ("I--", "U1", None, "6.25", fx.day(3)), ("I---", "U1", "E", "1.00", fx.day(-2))]
    daily = cashflow_daily(fx.flows(spark, "inflow", rows), "inflow", as_of, 40, ("counterparty_id",))
    have = daily.collect()
    for group in (*groups, "E"):
        plain = fx.plain_flow([(Decimal(r[3]), r[4]) for r in rows if r[2] == group], as_of, 40)
        assert {r.day_number: r.total_inflow for r in have if r.counterparty_id == group} == plain
    assert len(have) == sum(40 for g in groups) and daily.schema["total_inflow"].dataType.simpleString() == "decimal(38,2)"
    text = daily._jdf.queryExecution().executedPlan().toString()
    assert text.index("Generate") < text.index("Exchange")  # days come last, after every shuffle


def test_flow_due_today_counts_only_at_midnight(spark):
    flow = fx.flows(spark, "outflow", [("O", "U1", "C1", "7.00", fx.TODAY)])
    assert cashflow_daily(flow, "outflow", fx.NOON, 3).count() == 0
    at_midnight = fx.by_day(cashflow_daily(flow, "outflow", fx.MIDNIGHT, 3), "total_outflow")
    assert at_midnight == {1: Decimal("7.00"), 2: Decimal("0.00"), 3: Decimal("0.00")}


def test_position_due_today_keeps_the_days_but_counts_nothing(spark):
    detail = detail_frame(spark, [(Decimal("5.000000"), fx.TODAY)])
    for as_of in INSTANTS:
        daily = fx.by_day(hqla_daily(detail, as_of, 4, 1.0), "total_hqla_usd")
        assert daily == {d: Decimal("0.00") for d in range(1, 5)}


def test_direction_is_case_insensitive(spark):
    flow = fx.flows(spark, "outflow", [("O", "U1", "C1", "7.00", None)])
    assert cashflow_daily(flow, "OUTFLOW", fx.NOON, 2).columns == ["day_number", "total_outflow"]


def test_empty_inputs_give_no_days(spark):
    assert hqla_daily(detail_frame(spark, []), fx.NOON, 5).count() == 0
    empty = fx.flows(spark, "inflow", [])
    assert cashflow_daily(empty, "inflow", fx.NOON, 5).count() == 0


@pytest.mark.parametrize("decay", [0.9999, 0.99, 1.0, 0.5])
def test_rounding_to_cents_is_exact_for_all_sizes_and_ties(spark, decay):
    rng = random.Random(7)
    values = [Decimal(rng.randrange(1, 10**k)).scaleb(-6) for k in range(2, 21) for _ in range(12)]
    values += [Decimal(f"{n}.{c}5") for n in (0, 1, 12345, 10**9, 10**12) for c in ("00", "01", "99")]
    values += [Decimal("9999999999.995"), Decimal("10000000000.005"), Decimal("99999999999999.999999")]
    values += [-v for v in values[::7]]
    rows = [(v, rng.choice([None, fx.day(3), fx.day(40)])) for v in values]
    daily = fx.by_day(hqla_daily(detail_frame(spark, rows), fx.NOON, 30, decay), "total_hqla_usd")
    assert daily == fx.plain_hqla(rows, fx.NOON, 30, str(decay))


def test_sums_beyond_a_long_stay_exact(spark):
    n, value = 3000, Decimal("99999999999999.990000")
    detail = spark.range(n).select(
        F.lit(None).cast("date").alias("maturity_date"),
        F.lit(value).cast("decimal(20,6)").alias("total_hqla_usd"),
    ).coalesce(1)
    daily = fx.by_day(hqla_daily(detail, fx.NOON, 2, 1.0), "total_hqla_usd")
    assert daily == {1: fx.cents(value * n), 2: fx.cents(value * n)}


def test_rows_are_laid_out_over_blocks_and_not_over_days(spark):
    """A row that lives for 150 days is looked up in the hash table 10 times and not 151."""
    n = 40
    detail = detail_frame(spark, [(Decimal(f"{i}.123456"), None) for i in range(n)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        daily = hqla_daily(detail, fx.NOON)
        assert len(daily.collect()) == 150
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    nodes, generated = [daily._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().length())]
        if node.nodeName() == "Generate" and "Exchange" not in str(node):
            generated.append(node.metrics().apply("numOutputRows").value())
    assert generated and max(generated) == 10 * n


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("value", ["999999998.999999", "999999999.995", "-999999999.994999", "1000000000.005", "123456789012345678.915"])
def test_many_rows_of_a_task_are_added_up_exactly(spark, value, ansi):
    """More rows than one double adds up, on both sides of the values that come by digits."""
    n, days = 70_000, [None, fx.day(7)]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        detail = spark.range(n).coalesce(1).select(
            F.when(F.col("id") % 2 == 0, F.lit(days[1])).cast("date").alias("maturity_date"),
            F.lit(Decimal(value)).cast("decimal(24,6)").alias("total_hqla_usd"),
        )
        daily = fx.by_day(hqla_daily(detail, fx.NOON, 20, 0.9999), "total_hqla_usd")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    one = [fx.plain_hqla([(Decimal(value), day)], fx.NOON, 20, "0.9999") for day in days]
    assert daily == {d: n // 2 * (one[0][d] + one[1][d]) for d in range(1, 21)}


def test_a_curve_that_grows(spark):
    rows = [(Decimal(v), m) for v in ("0.005", "12345.678901", "-7.125", "20000000000.5") for m in (None, fx.day(3))]
    daily = fx.by_day(hqla_daily(detail_frame(spark, rows), fx.NOON, 30, 1.01), "total_hqla_usd")
    assert daily == fx.plain_hqla(rows, fx.NOON, 30, "1.01")


def test_wide_and_daily_routes_agree(spark):
    rng = random.Random(3)
    rows = [
        (Decimal(rng.randrange(10**9)).scaleb(-6), rng.choice(EDGES + [fx.day(5)])) for _ in range(60)
    ]
    detail = detail_frame(spark, [r for r in rows if r[1] is None or r[1] >= fx.TODAY])
    wide = hqla_projection(detail, fx.NOON, 12, 0.99)
    assert wide.columns[2:] == [f"day_{d}_total_hqla_usd" for d in range(1, 13)]
    summed = fx.by_day(wide_summary(wide, "total_hqla_usd", "total_hqla_usd", 12), "total_hqla_usd")
    assert summed == fx.by_day(hqla_daily(detail, fx.NOON, 12, 0.99), "total_hqla_usd")

    flow = fx.flows(
        spark, "inflow", [(f"I{i}", "U", "C", f"{i}.10", m) for i, m in enumerate(EDGES)]
    )
    for as_of in INSTANTS:
        wide = cashflow_projection(flow, "inflow", as_of, 12)
        summed = fx.by_day(wide_summary(wide, "inflow_stock", "total_inflow", 12), "total_inflow")
        assert summed == fx.by_day(cashflow_daily(flow, "inflow", as_of, 12), "total_inflow")


def test_a_stored_wide_table_holds_an_amount_once_for_a_day(spark, tmp_path):
    """400 amounts, a fourth of the rows with one of them, nulls among them, in no order."""
    rng = random.Random(17)
    amounts = [None, *[f"{rng.randrange(10**4, 10**7)}.{rng.randrange(10, 100)}" for _ in range(399)]]
    picked = [amounts[7] if rng.random() < 0.25 else rng.choice(amounts) for _ in range(12_000)]
    rows = [(f"O{i}", "U1", f"C{rng.randrange(3000)}", a or "0", rng.choice([None, None, fx.day(rng.randrange(90))])) for i, a in enumerate(picked)]
    flow = fx.flows(spark, "outflow", rows).withColumn("outflow_amount_usd", F.expr("nullif(outflow_amount_usd, 0)")).repartition(8).localCheckpoint()
    sizes = {}
    for gathered in (False, True):
        wide = cashflow_projection(flow, "outflow", fx.NOON, 60, gathered=gathered)
        target = tmp_path / str(gathered)
        wide.selectExpr(*[f"CAST({c} AS DOUBLE)" if t.startswith("decimal") else c for c, t in wide.dtypes]).write.parquet(str(target))
        sizes[gathered] = sum(f.stat().st_size for f in target.glob("*.parquet"))
    assert sizes[True] < 0.5 * sizes[False]
    plain, together = (spark.read.parquet(str(tmp_path / str(g))) for g in (False, True))
    assert plain.schema == together.schema and plain.count() == together.count() > 0
    assert plain.exceptAll(together).isEmpty() and together.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_wide_table_in_cents_is_exact(spark, ansi):
    """Ties, signs, nulls and any stored money, cell by cell and in total, without decimals for usual rows."""
    rng = random.Random(11)
    values = ["0.005000", "-0.005000", "0.004999", "0", "9999999999.999999", "10000000000", "-10000000000.015000", "999999999999999999.99", "-123456789012345678.91"]
    values += [str(Decimal(rng.randrange(-(10**17), 10**17)).scaleb(-rng.choice([1, 4, 6]))) for _ in range(60)]
    rows = [(Decimal(v), EDGES[i % 6 + 2] if i % 8 < 6 else None) for i, v in enumerate(values)]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        typed = "maturity_date date, total_hqla_usd decimal(24,6)"
        detail = spark.createDataFrame([(m, v) for v, m in rows] + [(None, None)], typed)
        for as_of, decay in ((fx.NOON, 0.99), (fx.MIDNIGHT, 0.9999), (fx.NOON, 1.0)):
            wide = hqla_projection(detail, as_of, 11, decay, in_cents=True)
            want = fx.plain_hqla(rows, as_of, 11, str(decay))
            assert fx.by_day(wide_summary(wide, "total_hqla_usd", "t", 11), "t") == want
            cells = wide.table()
            assert [t for c, t in cells.dtypes if c.startswith("day_")] == ["bigint"] * 11
            whole = {}
            for r in cells.where("total_hqla_usd IS NOT NULL").collect():
                at = (r.maturity_date, r.total_hqla_usd)
                whole[at] = whole.get(at, 0) + r.unit * r.day_3_total_hqla_usd
            curve = decay_curve(decay, 11)
            with localcontext(prec=60):
                for value, maturity in rows:
                    alive = maturity is None or maturity >= as_of.date() + dt.timedelta(days=3)
                    assert whole[maturity, value] == (int((value * curve[2]).quantize(Decimal("0.01"), ROUND_HALF_UP).scaleb(2)) if alive else 0), (value, maturity)
        nothing = wide_summary(hqla_projection(detail.where("false"), fx.NOON, 11, 0.99, in_cents=True), "total_hqla_usd", "t", 11)
        assert nothing.collect() == []
        amounts = ["99999999999999999.99", "-10000000000.01", "9999999999.99", "0.07", "-0.01"]
        flow = fx.flows(spark, "outflow", [(f"O{i}", "U", "C", amounts[i % 5], m) for i, m in enumerate(EDGES * 2)])
        flow = flow.unionByName(flow.withColumn("outflow_amount_usd", F.lit(None).cast("decimal(20,2)")))
        for as_of in INSTANTS:
            wide = cashflow_projection(flow, "outflow", as_of, 12, in_cents=True)
            summed = fx.by_day(wide_summary(wide, "outflow_stock", "t", 12), "t")
            assert summed == fx.by_day(cashflow_daily(flow, "outflow", as_of, 12), "total_outflow")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    with pytest.raises(ValueError):
        hqla_projection(detail, fx.NOON, 11, 1.01, in_cents=True)


def test_wide_table_in_cents_is_added_up_in_two_passes(spark):
    detail = spark.createDataFrame([(None, Decimal("1.5"))], "maturity_date date, total_hqla_usd decimal(24,6)")
    summed = wide_summary(hqla_projection(detail, fx.NOON, in_cents=True), "total_hqla_usd", "t")
    text = summed._jdf.queryExecution().optimizedPlan().toString()
    assert sum("sum(CASE WHEN (live_days" in line for line in text.splitlines()) == 2
    assert summed.count() == 150


def test_groups_have_their_own_days(spark):
    rows = [("A", "U1", "CASH", "Long", "1.00", None), ("B", "U2", "CASH", "Long", "2.00", fx.day(1))]
    detail = hqla_detail(fx.positions(spark, rows), fx.classes(spark), fx.NOON, ("business_unit_id",))
    daily = hqla_daily(detail, fx.NOON, 2, 1.0, ("business_unit_id",))
    have = {(r.business_unit_id, r.day_number): r.total_hqla_usd for r in daily.collect()}
    assert have == {
        ("U1", 1): Decimal("1.00"), ("U1", 2): Decimal("1.00"),
        ("U2", 1): Decimal("2.00"), ("U2", 2): Decimal("0.00"),
    }


def test_stock_never_grows(spark):
    rng = random.Random(11)
    rows = [(Decimal(rng.randrange(10**8)).scaleb(-2), fx.day(rng.randrange(60))) for _ in range(200)]
    hqla = fx.by_day(hqla_daily(detail_frame(spark, rows), fx.NOON, 50), "total_hqla_usd")
    flow = fx.flows(spark, "inflow", [("I", "U", "C", str(v), m) for v, m in rows])
    cash = fx.by_day(cashflow_daily(flow, "inflow", fx.NOON, 50), "total_inflow")
    for series in (hqla, cash):
        assert all(series[d] >= series[d + 1] for d in range(1, 50))


def test_haircut_value_keeps_all_digits(spark):
    row = spark.range(1).select(
        after_haircut(F.lit(Decimal("0.03")), F.lit(Decimal("33.33"))).alias("v")
    ).first()
    assert row.v == Decimal("0.020001")
    assert decay_curve(0.99, 3) == [Decimal("1.0000000000000000"), Decimal("0.9900000000000000"), Decimal("0.9801000000000000")]


def totals(spark, name, rows):
    return spark.createDataFrame(
        [(d, Decimal(v)) for d, v in rows], f"day_number int, {name} decimal(38,2)"
    )


def test_netting_adds_and_fills_the_missing_side(spark):
    net = net_cashflow(
        totals(spark, "total_inflow", [(1, "10.00"), (2, "4.00")]),
        totals(spark, "total_outflow", [(1, "30.00"), (3, "5.00")]),
    )
    have = {r.day_number: (r.total_inflow, r.total_outflow, r.net_position, r.abs_net_position) for r in net.collect()}
    d = Decimal
    assert have == {
        1: (d("10.00"), d("30.00"), d("40.00"), d("40.00")),
        2: (d("4.00"), d("0.00"), d("4.00"), d("4.00")),
        3: (d("0.00"), d("5.00"), d("5.00"), d("5.00")),
    }


def test_ratio_and_zero_divisor(spark):
    hqla = totals(spark, "total_hqla_usd", [(1, "2.00"), (2, "1.00"), (9, "1.00")])
    net = net_cashflow(
        totals(spark, "total_inflow", [(1, "1.00")]), totals(spark, "total_outflow", [(1, "2.00"), (2, "0.00")])
    )
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        lcr(net, hqla).collect()
    rows = {r.day_number: r for r in lcr(net, hqla, on_zero="null").collect()}
    assert set(rows) == {1, 2}
    assert rows[1].lcr == Decimal("0.666666670000") and rows[2].lcr is None
    with pytest.raises(ValueError):
        lcr(net, hqla, on_zero="skip")


def test_session_time_zone_does_not_matter(spark):
    rows = [(Decimal("1.000000"), m) for m in EDGES if m is None or m >= fx.TODAY]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for as_of in INSTANTS:
            detail = detail_frame(spark, rows)
            wide = wide_summary(hqla_projection(detail, as_of, 11, 1.0), "total_hqla_usd", "t", 11)
            want = fx.plain_hqla(rows, as_of, 11, "1.0")
            assert fx.by_day(wide, "t") == want
            assert fx.by_day(hqla_daily(detail, as_of, 11, 1.0), "total_hqla_usd") == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_any_stored_money_is_exact(spark, ansi):
    """Positions up to the width of the stored type, in either ANSI mode."""
    values = ["100000000000000.07", "123456789012345678.91", "999999999999999999.99", "0.01"]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        held = fx.positions(spark, [(f"P{i}", "U1", "BOND", "Long", v, None) for i, v in enumerate(values)])
        detail = hqla_detail(held, fx.classes(spark), fx.NOON)
        haircuts = {r.security_type: r.haircut_percent for r in fx.classes(spark).collect()}
        kept = (100 - haircuts["BOND"]) / Decimal(100)
        with localcontext() as exact:
            exact.prec = 80
            for row in hqla_daily(detail, fx.NOON, 5).collect():
                decay = decay_curve(0.9999, 5)[row.day_number - 1]
                want = sum((Decimal(v) * kept * decay).quantize(Decimal("0.01"), ROUND_HALF_UP) for v in values)
                assert row.total_hqla_usd == want
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ratio_of_totals_too_large_for_decimals(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.sql("SELECT CAST('30000000000000000000000.00' AS DECIMAL(38,2)) AS h, CAST('20000000000000000000000.00' AS DECIMAL(38,2)) AS o")
        assert df.select(coverage_ratio(df.h, df.o).alias("r")).first().r == Decimal("1.5")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
