from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ebbline.sources import sample
from ebbline.sources.inline import inline_table
from ebbline.sources.reference import reference_table
from ebbline.sources.schemas import SCHEMAS, conform
from ebbline.sources.runs import append_run
from ebbline.sources.tables import fetch, overwrite, read_snapshot, read_table, run_sql, snapshot

TODAY = dt.date(2024, 5, 1)
NOW = dt.datetime(2024, 5, 1, 8)


@pytest.mark.parametrize(
    "table, rows, key",
    [
        ("asset_classifications", 13, "security_type"),
        ("currency_reference", 10, "currency_code"),
        ("business_unit_reference", 9, "business_unit_id"),
        ("stress_scenarios", 3, "scenario_id"),
    ],
)
def test_reference_tables(spark, table, rows, key):
    df = reference_table(spark, table, NOW)
    assert df.schema.fieldNames() == SCHEMAS[table].fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in SCHEMAS[table]]
    assert df.count() == df.select(key).distinct().count() == rows


def test_reference_values(spark):
    haircuts = {
        r.security_type: r.haircut_percent for r in reference_table(spark, "asset_classifications", NOW).collect()
    }
    assert haircuts["CASH"] == 0 and haircuts["EQUITIES_OTHER"] == Decimal("50.00")
    rules = reference_table(spark, "what_if_definitions_lookup", NOW)
    assert {r.what_if_id: r["count"] for r in rules.groupBy("what_if_id").count().collect()} == {"1": 9, "2": 12}
    unit = reference_table(spark, "business_unit_reference", NOW).first()
    assert unit.is_active is True and unit.created_date == NOW


def test_inline_text_is_quoted(spark):
    odd = "it's a \\ \"test\""
    df = inline_table(spark, "stress_scenarios", ("scenario_id", "scenario_name"), [("A", odd)])
    assert df.first().scenario_name == odd


def test_conform_casts_fills_and_checks(spark):
    raw = spark.createDataFrame([("U1", "One")], "Business_Unit_ID string, business_unit_name string")
    row = conform(raw, "business_unit_reference", F.lit(NOW)).first()
    assert (row.business_unit_id, row.region, row.is_active, row.created_date) == ("U1", None, True, NOW)
    with pytest.raises(ValueError, match="business_unit_name"):
        conform(raw.drop("business_unit_name"), "business_unit_reference")
    broken = spark.createDataFrame([("U1", None)], "business_unit_id string, business_unit_name string")
    with pytest.raises(Exception, match="business_unit_name is NULL"):
        conform(broken, "business_unit_reference").collect()
    assert conform(broken, "business_unit_reference", enforce=False).count() == 1


def test_tables_by_path_and_by_name(spark, tmp_path):
    units = reference_table(spark, "business_unit_reference", NOW)
    path = str(tmp_path / "units")
    overwrite(units, path)
    overwrite(units.limit(4), path)
    assert read_table(spark, path, "business_unit_reference").count() == 4
    copy = snapshot(spark, path, str(tmp_path / "copy"))
    assert sorted(map(tuple, copy.collect())) == sorted(map(tuple, spark.read.parquet(path).collect()))
    units.createOrReplaceTempView("units_by_name")
    assert read_table(spark, "units_by_name", "business_unit_reference").count() == 9


def test_catalog_tables_are_replaced_and_appended_by_column_name(spark):
    run = spark.createDataFrame(
        [(Decimal(3), 1, Decimal(6), Decimal(2))],
        "total_net_cash_outflows decimal(38,2), day_number int, hqla decimal(38,10), lcr decimal(38,12)",
    )
    name = f"lcr_{uuid.uuid4().hex}"
    append_run(run, name, NOW)
    append_run(run, name, NOW + dt.timedelta(hours=1))
    stored = read_table(spark, name, "lcr")
    assert {(r.created_timestamp, r.day_number, r.lcr) for r in stored.collect()} == {
        (NOW, 1, Decimal(2)), (NOW + dt.timedelta(hours=1), 1, Decimal(2))
    }
    overwrite(run, name)
    assert read_table(spark, name).count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_sql_parameters_are_bound(spark):
    reference_table(spark, "what_if_definitions_lookup", NOW).createOrReplaceTempView("rules_sql")
    text = "SELECT count(*) AS n FROM rules_sql WHERE what_if_id = :id"
    assert run_sql(spark, text, id="2").first().n == 12
    assert run_sql(spark, text, id="2' OR '1'='1").first().n == 0
    assert run_sql(spark, "SELECT 1 AS one").first().one == 1


def test_sql_reuses_an_alias_and_groups_by_position(spark):
    reference_table(spark, "what_if_definitions_lookup", NOW).createOrReplaceTempView("rules_sql")
    text = "SELECT what_if_id, count(*) AS n, n * 2 AS twice FROM rules_sql GROUP BY 1 ORDER BY 1"
    assert [tuple(r) for r in run_sql(spark, text).collect()] == [("1", 9, 18), ("2", 12, 24)]


def test_fetch_is_bounded(spark):
    assert len(fetch(spark.range(150), 150)) == 150
    with pytest.raises(ValueError, match="more than 149"):
        fetch(spark.range(150), 149)


def test_sample_counterparties(spark):
    df = sample.counterparties(spark, TODAY)
    assert df.count() == 2000
    first = df.orderBy("counterparty_id").first()
    assert (first.counterparty_id, first.counterparty_name, first.counterparty_type, first.region) == (
        "CP_000000", "Counterparty 1", "Bank", "North America"
    )
    assert df.groupBy("counterparty_type").count().filter("count <> 500").count() == 0


def test_sample_market_data(spark):
    df = sample.market_data(spark, TODAY, n_securities=80, n_days=30)
    stats = df.agg(
        F.count("*").alias("n"), F.countDistinct("security_id").alias("securities"),
        F.min("price_usd").alias("low"), F.max("price_usd").alias("high"),
        F.min("market_date").alias("first"), F.max("market_date").alias("last"),
    ).first()
    assert (stats.n, stats.securities) == (2400, 80)
    assert (stats.first, stats["last"]) == (TODAY - dt.timedelta(days=29), TODAY)
    assert Decimal(98) <= stats.low <= stats.high <= Decimal("1019.9")
    spread = df.groupBy("security_id").agg((F.max("price_usd") / F.min("price_usd")).alias("r"))
    assert spread.filter("r > 1.041").count() == 0
    assert df.filter("security_type = 'GOVERNMENT_BOND'").count() == 900


def test_sample_positions(spark):
    prices = sample.market_data(spark, TODAY, n_securities=80, n_days=30)
    df = sample.positions(spark, TODAY, prices, n=900, n_cash=120, n_securities=80, n_days=30)
    assert df.count() == 1020
    cash = df.filter(F.col("security_type").isin("CASH", "CENTRAL_BANK_RESERVES"))
    assert cash.count() == 120
    assert cash.filter("position_type <> 'Long' OR maturity_date IS NOT NULL OR quantity <> 1").count() == 0
    assert cash.agg(F.min("position_id")).first()[0] == "POS_00000900"
    held = df.filter("security_id LIKE 'SEC%'")
    assert held.filter("maturity_date IS NULL").count() == 300
    assert held.filter("position_type = 'Long'").count() == 450
    assert df.select("position_id").distinct().count() == 1020
    quote = prices.select("security_id", F.col("market_date").alias("position_date"), "price_usd")
    off = held.join(quote, ["security_id", "position_date"]).filter(
        F.abs(F.col("position_value_usd") - F.col("quantity") * F.col("price_usd")) > 0.005
    )
    assert off.count() == 0


@pytest.mark.parametrize("direction", ["inflow", "OUTFLOW"])
def test_sample_flows(spark, direction):
    side = direction.lower()
    df = sample.cash_flows(spark, TODAY, direction, n=2000)
    days = F.datediff("maturity_date", F.lit(TODAY))
    buckets = df.agg(
        F.count_if(days.isNull()).alias("open"),
        F.count_if((days >= 0) & (days < 90)).alias("near"),
        F.count_if((days >= 90) & (days < 180)).alias("mid"),
        F.count_if((days >= 180) & (days < 365)).alias("far"),
        F.count_if(days >= 365).alias("beyond"),
        F.min(f"{side}_amount_usd").alias("low"),
        F.max(f"{side}_amount_usd").alias("high"),
    ).first()
    assert tuple(buckets)[:5] == (200, 600, 600, 400, 200)
    assert 1_000_000 / 1600 <= buckets.low <= buckets.high <= 991_000_000 / 1200
    assert df.filter(f"{side}_id LIKE '{side.upper()}\\\\_%'").count() == 2000
    assert df.select("counterparty_id").distinct().count() == 2000


def test_sample_is_repeatable(spark):
    one, two = (sample.cash_flows(spark, TODAY, "inflow", seed=5, n=50).collect() for _ in range(2))
    assert one == two
    other = sample.cash_flows(spark, TODAY, "inflow", seed=6, n=50).collect()
    assert one != other


def test_forecast_on_sample_data(spark):
    from ebbline import Book, run_forecast, run_what_if

    prices = sample.market_data(spark, TODAY, n_securities=80, n_days=30)
    book = Book(
        positions=sample.positions(spark, TODAY, prices, n=900, n_cash=120, n_securities=80, n_days=30),
        cash_inflows=sample.cash_flows(spark, TODAY, "inflow", n=500),
        cash_outflows=sample.cash_flows(spark, TODAY, "outflow", seed=3, n=500),
        asset_classifications=reference_table(spark, "asset_classifications", NOW),
        counterparty_data=sample.counterparties(spark, TODAY),
        business_unit_reference=reference_table(spark, "business_unit_reference", NOW),
        what_if_definitions_lookup=reference_table(spark, "what_if_definitions_lookup", NOW),
    )
    base = {r.day_number: r for r in run_forecast(book, NOW, 30).collect()}
    cash = book.positions.filter("security_id LIKE 'CASH%'").agg(F.sum("position_value_usd")).first()[0]
    # Only cash types are classified, so nothing else counts as liquid.
    assert base[1].hqla == cash and len(base) == 30
    stressed = {r.day_number: r for r in run_what_if(book, "1", NOW, 30).collect()}
    assert stressed[1].hqla < base[1].hqla
    assert stressed[1].total_net_cash_outflows < base[1].total_net_cash_outflows


def files_below(path) -> set:
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}


def test_a_snapshot_outlives_growth_and_copies_nothing(spark, tmp_path):
    path, target = tmp_path / "flows", tmp_path / "snapshot"
    rows = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("part"))
    overwrite(rows, str(path), partition_by=("part",))
    held = snapshot(spark, str(path), str(target))
    assert held.count() == 100 and dict(held.dtypes) == {"id": "bigint", "part": "int"}
    before = files_below(path)
    spark.range(100, 150).select("id", F.lit("7").alias("part")).write.mode("append").partitionBy("part").parquet(str(path))
    assert read_table(spark, str(path)).count() == 150 and before < files_below(path)
    again = read_snapshot(spark, str(target))
    assert sorted(map(tuple, again.collect())) == [(i, i % 3) for i in range(100)]
    assert len(files_below(target)) == 1 and sum(f.stat().st_size for f in target.rglob("*.parquet")) < 10_000
    rows.limit(5).write.mode("overwrite").partitionBy("part").parquet(str(path))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|changed"):
        read_snapshot(spark, str(target)).count()


def test_snapshots_of_catalog_and_empty_tables_and_of_views(spark, tmp_path):
    name = f"snap_{uuid.uuid4().hex}"
    overwrite(spark.range(10), name)
    held = snapshot(spark, name, str(tmp_path / "one"))
    spark.range(10, 20).write.insertInto(name)
    assert spark.table(name).count() == 20 and held.count() == 10 == read_snapshot(spark, str(tmp_path / "one")).count()
    empty = f"snap_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {empty} (id BIGINT) USING parquet")
    assert snapshot(spark, empty, str(tmp_path / "two")).schema.simpleString() == "struct<id:bigint>"
    spark.range(3).createOrReplaceTempView("no_files")
    with pytest.raises(ValueError, match="no files"):
        snapshot(spark, "no_files", str(tmp_path / "three"))


def test_bucketed_facts_are_joined_without_a_shuffle_of_theirs(spark, tmp_path):
    name = f"flows_{uuid.uuid4().hex}"
    flows = spark.range(3000).select(F.col("id").cast("string").alias("flow"), (F.col("id") % 40).cast("string").alias("counterparty_id"))
    overwrite(flows, name, buckets=6, bucket_by=("counterparty_id",), location=str(tmp_path / name))
    factors = spark.range(40).select(F.col("id").cast("string").alias("counterparty_id"), (F.col("id") * 2).alias("factor"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spark.table(name).join(factors, "counterparty_id", "left")
        lines = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
        fact_side = lines[:scan]
        assert sum("Exchange" in line for line in lines) == 1 and not any("Exchange" in line for line in fact_side)
        assert joined.where("factor = 2 * CAST(counterparty_id AS INT)").count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    with pytest.raises(ValueError, match="table name"):
        overwrite(flows, str(tmp_path / "x"), buckets=2, bucket_by=("flow",))


def test_a_late_forecast_skips_row_groups_of_a_clustered_table(spark, tmp_path):
    from ebbline.operators.projection import cashflow_daily

    start = dt.date(2024, 1, 1)
    flows = spark.range(40_000).select(
        F.when(F.col("id") % 50 != 0, F.date_add(F.lit(start), ((F.col("id") * 7919) % 700).cast("int"))).alias("maturity_date"),
        (F.col("id") % 1000).cast("decimal(20,2)").alias("outflow_amount_usd"),
    ).repartition(8)
    overwrite(flows, str(tmp_path / "plain"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as it is, it gets 8 files
    overwrite(flows, str(tmp_path / "clustered"), cluster_by=("maturity_date",))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    late = dt.datetime(2025, 9, 1, 12)
    found, read = {}, {}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("plain", "clustered"):
            daily = cashflow_daily(read_table(spark, str(tmp_path / name)), "outflow", late)
            found[name] = sorted(map(tuple, daily.collect()))
            leaf = daily._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
            read[name] = leaf.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert found["plain"] == found["clustered"] and read["plain"] == 40_000
    assert read["clustered"] <= 20_000
