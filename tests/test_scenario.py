from __future__ import annotations

import random
import re
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from ebbline import Book, run_forecast, run_what_if
from ebbline.functions.money import with_factor
from ebbline.operators.scenario import Scenarios, apply_scenario, factors_of_kind, scenario_factors
from ebbline.plans.jobs import stressed_book
from tests import fixtures as fx

CP = ("COUNTERPARTY_DATA", "COUNTERPARTY_DATA")
IN_UNIT = ("CASH_INFLOWS", "BUSINESS_UNIT_REFERENCE")
POS_UNIT = ("POSITIONS", "BUSINESS_UNIT_REFERENCE")
POS_TYPE = ("POSITIONS", "ASSET_CLASSIFICATIONS")


def cp_factors(spark, rows, dim=None, ids=("1",)):
    dims = {"counterparty_data": dim if dim is not None else fx.counterparties(spark)}
    found = factors_of_kind("counterparty", dims, fx.rules(spark, rows), ids).collect()
    return {(r.what_if_id, r.counterparty_id): r.factor for r in found}


def book(spark, rule_rows):
    return Book(
        positions=fx.positions(
            spark,
            [
                ("P1", "U1", "CASH", "Long", "1000000.00", None),
                ("P2", "U2", "BOND", "Long", "333.33", fx.day(5)),
                ("P3", "U2", "BOND", "Long", "333.33", fx.day(5)),
            ],
        ),
        cash_inflows=fx.flows(
            spark, "inflow", [("I1", "U1", "C1", "1000000.00", None), ("I2", "U2", "C9", "10.01", fx.day(3))]
        ),
        cash_outflows=fx.flows(spark, "outflow", [("O1", "U2", "C2", "77.77", None)]),
        asset_classifications=fx.classes(spark),
        counterparty_data=fx.counterparties(spark),
        business_unit_reference=fx.units(spark),
        what_if_definitions_lookup=fx.rules(spark, rule_rows),
    )


def test_two_rules_multiply(spark):
    rows = [("1", *CP, "REGION", "Europe", -0.1), ("1", *CP, "COUNTERPARTY_TYPE", "Bank", -0.15)]
    assert cp_factors(spark, rows) == {("1", "C1"): Decimal("0.765000000000")}


def test_the_rules_column_name_plays_no_part(spark):
    rows = [("1", *CP, "REGION", "Bank", -0.1)]
    assert cp_factors(spark, rows) == {("1", "C1"): Decimal("0.900000000000")}


def test_a_value_found_in_two_columns_hits_once(spark):
    dim = spark.createDataFrame(
        [("C1", "Asia", "Asia"), ("C2", None, "Asia"), ("C3", None, None)],
        "counterparty_id string, region string, counterparty_type string",
    )
    rows = [("1", *CP, "REGION", "Asia", -0.5)]
    assert cp_factors(spark, rows, dim) == {("1", "C1"): Decimal("0.5"), ("1", "C2"): Decimal("0.5")}


def test_repeated_rules_and_repeated_entities_count_each_time(spark):
    rule = ("1", *CP, "REGION", "Asia", -0.1)
    assert cp_factors(spark, [rule, rule]) == {("1", "C2"): Decimal("0.81")}
    twice = fx.counterparties(spark).unionByName(fx.counterparties(spark))
    assert cp_factors(spark, [rule], twice) == {("1", "C2"): Decimal("0.81")}


@pytest.mark.parametrize("factor, times", [("4641.58", 3), ("-21.44", 8), ("0.97", 20), ("1.01", 13), ("99999999.99", 1), ("0.00", 2)])
def test_powers_of_equal_factors_are_decimal(spark, factor, times):
    """Up to 23 digits, where a double has 17; each step is rounded to 12 decimals."""
    step = Decimal(1).scaleb(-12)
    want = Decimal(1)
    with localcontext() as context:
        context.prec = 60
        for digit in f"{times:b}":
            want = (want * want).quantize(step, ROUND_HALF_UP)
            want = (want * Decimal(factor)).quantize(step, ROUND_HALF_UP) if digit == "1" else want
        exact = Decimal(factor) ** times
        assert abs(want - exact) <= (0 if 2 * times <= 12 else Decimal("1e-11") * max(1, abs(exact)))
    rule = ("1", *CP, "REGION", "Asia", float(Decimal(factor) - 1))
    assert cp_factors(spark, [rule] * times) == {("1", "C2"): want}


def test_rules_of_other_tables_and_scenarios_are_ignored(spark):
    rows = [
        ("1", *IN_UNIT, "REGION", "Asia", -0.1),
        ("2", *CP, "REGION", "Asia", -0.2),
        ("x-9", *CP, "REGION", "Asia", -0.3),
    ]
    assert cp_factors(spark, rows) == {}
    assert cp_factors(spark, rows, ids=("2", "x-9")) == {
        ("2", "C2"): Decimal("0.8"), ("x-9", "C2"): Decimal("0.7")
    }


def test_factors_finer_than_a_percent_are_rounded(spark):
    assert cp_factors(spark, [("1", *CP, "REGION", "Asia", -0.1234)]) == {("1", "C2"): Decimal("0.88")}


def test_factor_order_does_not_matter(spark):
    rows = [("1", *CP, "REGION", v, f) for v, f in (("Europe", -0.1), ("Bank", -0.33), ("Europe", 0.27))]
    assert cp_factors(spark, rows) == cp_factors(spark, rows[::-1])


def test_worked_case_and_unmatched_rows(spark):
    b = book(spark, [("1", *CP, "REGION", "Europe", -0.05), ("1", *IN_UNIT, "REGION", "Europe", -0.05)])
    inflows = {r.inflow_id: r.inflow_amount_usd for r in stressed_book(b, ["1"]).cash_inflows.collect()}
    assert inflows == {"I1": Decimal("902500.00"), "I2": Decimal("10.01")}


def test_duplicate_fact_ids_are_kept(spark):
    b = book(spark, [])
    doubled = b.positions.unionByName(b.positions)
    stressed = apply_scenario({"positions": doubled}, b.tables(), b.what_if_definitions_lookup, ["1"])
    assert stressed["positions"].count() == 6


def test_amounts_are_rounded_half_up_to_cents(spark):
    b = book(spark, [("1", *POS_TYPE, "SECURITY_TYPE", "BOND", -0.5)])
    values = {r.position_id: r.position_value_usd for r in stressed_book(b, ["1"]).positions.collect()}
    assert values == {"P1": Decimal("1000000.00"), "P2": Decimal("166.67"), "P3": Decimal("166.67")}


def test_stressed_amounts_are_exact_for_all_sizes_signs_and_ties(spark):
    """Longs for usual amounts and factors, decimals for others, on both sides of the limits."""
    rng = random.Random(13)
    amounts = ["0.01", "0.05", "-0.05", "9999999999.99", "10000000000.00", "-9999999999.99", "999999999999.99", "0.00"]
    factors = ["0.5", "0.999999999999", "1", "7.999999999999", "8", "-0.5", "0.1", "0.000000000001", "-7.999999999999", "1234.567890123456"]
    pairs = [(Decimal(a), Decimal(f)) for a in amounts for f in factors]
    pairs += [(Decimal(rng.randrange(-(10**13), 10**13)).scaleb(-2), Decimal(rng.randrange(-(10**13), 10**13)).scaleb(-12)) for _ in range(300)]
    pairs += [(Decimal("3.33"), None), (None, Decimal("0.5"))]
    df = spark.createDataFrame(pairs, "amount decimal(20,2), factor decimal(23,12)")
    for mode in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", mode)
        try:
            rows, amount = with_factor(df, "amount", "factor")
            have = rows.select("amount", "factor", amount.alias("stressed"), F.col("stress_upper").isNotNull().alias("as_longs")).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        assert len(have) == len(pairs)
        for r in have:
            if r.amount is None or r.factor is None:
                assert r.stressed == r.amount
                continue
            with localcontext(prec=60):
                assert r.stressed == (r.amount * r.factor).quantize(Decimal("0.01"), ROUND_HALF_UP), r
            assert r.as_longs == (abs(r.amount) < 10**10 and abs(r.factor) < 8)


def test_an_amount_that_no_rule_hits_takes_no_decimal_product(spark):
    b = book(spark, [("1", *CP, "REGION", "Europe", -0.1)])
    flows = stressed_book(b, ["1"]).cash_inflows
    text = flows._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN isnull(stress_factor" in text and "stress_upper" in text


def test_an_entity_has_no_factor_in_a_scenario_that_does_not_hit_it(spark):
    rows = [("1", *CP, "REGION", "Europe", -0.1), ("2", *CP, "REGION", "Asia", -0.2), ("2", *CP, "REGION", "Europe", 0.0)]
    scenarios = Scenarios.of({"counterparty_data": fx.counterparties(spark)}, fx.rules(spark, rows), ["1", "2", "3"])
    key, table = scenarios.factor_columns("counterparty")
    have = {r[key]: tuple(r[f"counterparty_{n}"] for n in range(3)) for r in table.collect()}
    assert have == {"C1": (Decimal("0.9"), Decimal(1), None), "C2": (None, Decimal("0.8"), None)}


def test_inputs_are_left_as_they_are(spark):
    b = book(spark, [("1", *POS_UNIT, "REGION", "Asia", -0.5)])
    before = b.positions.collect()
    stressed_book(b, ["1"]).positions.collect()
    assert b.positions.collect() == before


def test_no_rules_and_equal_decay_equal_the_baseline(spark):
    b = book(spark, [])
    base = {r.day_number: (r.hqla, r.lcr) for r in run_forecast(b, fx.NOON, 8).collect()}
    scenario = run_what_if(b, "1", fx.NOON, 8, decay=0.9999).collect()
    assert {r.day_number: (r.hqla, r.lcr) for r in scenario} == base
    assert {r.what_if_id for r in scenario} == {"1"}
    default = {r.day_number: r.hqla for r in run_what_if(b, "1", fx.NOON, 8).collect()}
    assert default[1] == base[1][0] and default[8] < base[8][0]


def test_scenarios_together_equal_scenarios_alone(spark):
    b = book(
        spark,
        [
            ("1", *CP, "REGION", "Europe", -0.1),
            ("2", *CP, "REGION", "Asia", -0.2),
            ("2", *POS_UNIT, "BUSINESS_UNIT_TYPE", "Trading", -0.3),
        ],
    )
    together = {tuple(r) for r in run_what_if(b, ["1", "2"], fx.NOON, 6).collect()}
    alone = {tuple(r) for i in ("1", "2") for r in run_what_if(b, i, fx.NOON, 6).collect()}
    assert together == alone and len(together) == 12


def test_repeated_ids_run_once_and_none_is_an_error(spark):
    b = book(spark, [("1", *CP, "REGION", "Europe", -0.1)])
    once = {tuple(r) for r in run_what_if(b, ["1"], fx.NOON, 3).collect()}
    assert {tuple(r) for r in run_what_if(b, ["1", "1"], fx.NOON, 3).collect()} == once
    with pytest.raises(ValueError, match="no scenario ids"):
        run_what_if(b, [], fx.NOON, 3)


@pytest.fixture()
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_join_without_broadcast_gives_the_same(spark, no_broadcast):
    b = book(spark, [("1", *CP, "REGION", "Europe", -0.1), ("1", *POS_UNIT, "REGION", "Asia", -0.2)])
    df = run_what_if(b, "1", fx.NOON, 5)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    want = {tuple(r) for r in df.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert {tuple(r) for r in run_what_if(b, "1", fx.NOON, 5).collect()} == want


def test_positions_are_not_shuffled_by_unit_or_security_type(spark):
    b = book(spark, [("1", *POS_UNIT, "REGION", "Asia", -0.2)])
    text = stressed_book(b, ["1"]).positions._jdf.queryExecution().executedPlan().toString()
    for key in ("business_unit_id", "security_type"):
        assert re.search(rf"BroadcastHashJoin \[{key}#\d+\], \[{key}#\d+\], LeftOuter, BuildRight", text)


def test_methods_of_a_what_if_run_are_short_enough_for_the_jit_compiler(spark, capsys):
    b = book(spark, [("1", *CP, "REGION", "Europe", -0.1), ("2", *POS_UNIT, "REGION", "Asia", -0.2)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        run_what_if(b, ["1", "2", "3"], fx.NOON).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 7000  # HotSpot compiles none of more than 8000


def test_equal_flows_of_a_hot_counterparty_are_split(spark, no_broadcast):
    """A third of the rows are one flow of one counterparty, again and again."""
    b = book(spark, [("1", *CP, "REGION", "Europe", -0.1)])
    n = 60_000
    hot = F.when(F.col("id") % 3 == 0, "C1").otherwise(F.concat(F.lit("X"), (F.col("id") % 997).cast("string")))
    flows = spark.range(n).repartition(16).select(
        F.col("id").cast("string").alias("inflow_id"), F.lit("U1").alias("business_unit_id"), hot.alias("counterparty_id"),
        F.lit("10.01").cast("decimal(20,2)").alias("inflow_amount_usd"), F.lit(None).cast("date").alias("maturity_date"),
    )
    stressed = apply_scenario({"cash_inflows": flows}, b.tables(), b.what_if_definitions_lookup, ["1"])["cash_inflows"]
    placed = stressed.select("counterparty_id", "inflow_amount_usd", F.spark_partition_id().alias("p"))
    rows = placed.where("counterparty_id = 'C1'").groupBy("p").agg(F.count("*").alias("n"), F.sum("inflow_amount_usd").alias("usd")).collect()
    assert sum(r.n for r in rows) == n // 3 and sum(r.usd for r in rows) == n // 3 * Decimal("9.01")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_factors_are_exact_and_overflow_fails(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        b = book(spark, [("1", *CP, "REGION", "Europe", 199_999.0)])
        inflows = {r.inflow_id: r.inflow_amount_usd for r in stressed_book(b, ["1"]).cash_inflows.collect()}
        assert inflows["I1"] == Decimal("200000000000.00") and inflows["I2"] == Decimal("10.01")
        again = [("1", *CP, "REGION", "Europe", 9e9), ("1", *CP, "COUNTERPARTY_TYPE", "Bank", 9e8)]
        with pytest.raises(Exception, match="fit|out of range|OUT_OF_RANGE|overflow"):
            stressed_book(book(spark, again), ["1"]).cash_inflows.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_or_join_written_out_gives_the_same_factors(spark):
    dim = fx.counterparties(spark).withColumn("region", F.lower("region"))
    rows = [("1", *CP, "REGION", v, f) for v, f in (("asia", -0.1), ("Bank", -0.2), ("Corporate", -0.3))]
    rules = fx.rules(spark, rows)
    joined = dim.join(
        rules, (dim.region == rules.val) | (dim.counterparty_type == rules.val)
    ).collect()
    want: dict[str, Decimal] = {}
    for r in joined:
        factor = Decimal(str(round(r.factor + 1, 2)))
        want[r.counterparty_id] = want.get(r.counterparty_id, Decimal(1)) * factor
    have = scenario_factors(
        dim, rules, "counterparty_id", ("region", "counterparty_type"), *CP, ["1"]
    ).collect()
    assert {r.counterparty_id: r.factor for r in have} == want


@pytest.mark.parametrize("n", [1, 3])
def test_fact_is_read_once_however_many_scenarios(spark, n):
    b = book(spark, [("1", *CP, "REGION", "Europe", -0.1)])
    ids = [str(i) for i in range(1, n + 1)]
    plan = stressed_book(b, ids).cash_inflows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("inflow_amount_usd#") and plan.count("LeftOuter") == 2
