"""Data checks over the model, reported as (check, object, status, metric, detail)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.operators.semantic import MODEL, RELATIONSHIPS, VERIFIED_QUERIES, Relationship
from ebbline.sources.schemas import missing_and_extra

REPORT = "check string, object string, status string, metric double, detail string"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _line(check: str, obj: str, status: Column | str, metric: Column, detail: Column | str) -> Column:
    """A report row as a struct."""
    status, detail = (F.lit(x) if isinstance(x, str) else x for x in (status, detail))
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(obj).alias("object"),
        status.alias("status"),
        metric.cast("double").alias("metric"),
        detail.cast("string").alias("detail"),
    )


def _links_of(name: str, tables: dict[str, DataFrame]) -> list[Relationship]:
    return [link for link in RELATIONSHIPS if link.left == name and link.right in tables]


def profile(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """One row on a table: row_count, and orphans_<relationship> for each link it has.

    The table is read once, for all its links: rows are counted by their link values before
    those are looked up, so a hot value is one row for each task.  A NULL link value is an
    orphan.
    """
    links = _links_of(name, tables)
    columns = list(dict.fromkeys(link.left_column for link in links))
    counted = tables[name].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    orphaned = []
    for link in links:
        found = f"found_{link.name}"
        partners = tables[link.right].select(F.col(link.right_column).alias(f"{found}_key"), F.lit(True).alias(found)).distinct()
        counted = counted.join(partners, F.col(link.left_column) == F.col(f"{found}_key"), "left")
        lost = F.sum(F.when(F.col(found).isNull(), F.col("n")))
        orphaned.append(F.coalesce(lost, F.lit(0)).alias(f"orphans_{link.name}"))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), *orphaned)


def check_contents(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Every table of the model is present and has rows, and every link finds its partner.

    One pass over each table.
    """
    parts = []
    for name in MODEL:
        if name not in tables:
            missing = _line("table", name, "FAIL", F.lit(-1), "table is missing")
            parts.append(spark.range(1).select(F.inline(F.array(missing))))
            continue
        n = F.col("row_count")
        some = F.when(n > 0, "PASS").otherwise("WARN"), n, F.when(n > 0, "has rows").otherwise("empty")
        lines = [_line("table", name, *some)]
        for link in _links_of(name, tables):
            lost = F.col(f"orphans_{link.name}")
            detail = F.concat(lost.cast("string"), F.lit(" of "), n.cast("string"), F.lit(" rows"))
            lines.append(_line("relationship", link.name, F.when(lost == 0, "PASS").otherwise("WARN"), lost, detail))
        parts.append(profile(name, tables).select(F.inline(F.array(*lines))))
    return _union(parts)


def check_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Every column of the model exists; columns the model does not know are listed.

    Reads schemas only, one row per table.
    """
    rows = []
    for name, df in tables.items():
        if name not in MODEL:
            continue
        missing, extra = missing_and_extra(df, MODEL[name].columns())
        detail = f"missing: {', '.join(sorted(missing))}; extra: {', '.join(sorted(extra))}"
        status = "FAIL" if missing else "PASS"
        rows.append(("column", name, status, float(len(missing)), detail))
    return spark.createDataFrame(rows, REPORT)


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each relationship's left table that find no partner, one pass over each table."""
    parts = []
    for name in dict.fromkeys(link.left for link in RELATIONSHIPS):
        links = _links_of(name, tables) if name in tables else []
        if links:
            lost = [F.struct(F.lit(link.name).alias("relationship"), F.col(f"orphans_{link.name}").alias("orphan_count")) for link in links]
            parts.append(profile(name, tables).select("row_count", F.inline(F.array(*lost))))
    percent = F.coalesce(F.try_divide(F.col("orphan_count") * F.lit(100.0), F.col("row_count")), F.lit(0.0))
    return _union(parts).select("relationship", "orphan_count", "row_count", F.round(percent, 4).alias("orphan_percent"))


def orphan_rows(tables: dict[str, DataFrame], relationship: str) -> DataFrame:
    """The orphans themselves."""
    link = next(r for r in RELATIONSHIPS if r.name == relationship)
    left, right = tables[link.left], tables[link.right].select(
        F.col(link.right_column).alias("partner")
    )
    return left.join(right, F.col(link.left_column) == F.col("partner"), "left_anti")


def check_verified_queries(run: DataFrame) -> DataFrame:
    """Every verified query returns rows for the newest run of the history."""
    parts = []
    for name, query in VERIFIED_QUERIES.items():
        n = F.col("n")
        some = query(run).limit(1).agg(F.count(F.lit(1)).alias("n"))
        status, detail = F.when(n > 0, "PASS").otherwise("WARN"), F.when(n > 0, "returns rows").otherwise("no rows")
        parts.append(some.select(F.inline(F.array(_line("verified query", name, status, n, detail)))))
    return _union(parts)


def check_all(spark: SparkSession, tables: dict[str, DataFrame], run: DataFrame) -> DataFrame:
    """All checks in one report; ``run`` is the newest run of the baseline history."""
    return _union([check_contents(spark, tables), check_columns(spark, tables), check_verified_queries(run)])


def duplicate_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """For each declared key: rows, distinct keys, rows beyond the first of their key, NULL keys.

    Keys are counted before they meet, so one that very many rows repeat is a row for each
    task.  A key with a NULL part is none, and isn't compared with others.
    """
    parts = []
    for name, table in MODEL.items():
        if name not in tables or not table.primary_key:
            continue
        whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in table.primary_key])
        counted = tables[name].groupBy(*table.primary_key).agg(F.count(F.lit(1)).alias("n")).withColumn("whole", whole)
        rows, keys = (F.coalesce(x, F.lit(0)) for x in (F.sum("n"), F.count_if("whole")))
        held = F.coalesce(F.sum(F.when(F.col("whole"), F.col("n"))), F.lit(0))
        parts.append(
            counted.agg(rows.alias("row_count"), keys.alias("distinct_keys"), held.alias("held")).select(
                F.lit(name).alias("table_name"),
                F.lit(", ".join(table.primary_key)).alias("key_columns"),
                "row_count",
                "distinct_keys",
                (F.col("held") - F.col("distinct_keys")).alias("duplicate_rows"),
                (F.col("row_count") - F.col("held")).alias("null_keys"),
                F.when(F.col("row_count") == F.col("distinct_keys"), "PASS").otherwise("FAIL").alias("status"),
            )
        )
    return _union(parts)


def summary(report: DataFrame) -> DataFrame:
    """Passed and total rows per check; a check passes if all its rows do."""
    passed = F.sum(F.when(F.col("status") == "PASS", 1).otherwise(0))
    return report.groupBy("check").agg(
        passed.alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.when(passed == F.count(F.lit(1)), "PASS").otherwise("FAIL").alias("result"),
    )


def missing_fields(tables: dict[str, DataFrame]) -> DataFrame:
    """NULL count of every column of every table, one pass per table."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
        )
        parts.append(
            counts.unpivot(["row_count"], df.columns, "column_name", "null_count").select(
                F.lit(name).alias("table_name"), "column_name", "row_count", "null_count"
            )
        )
    return _union(parts)


def reconcile_days(row_daily: DataFrame, daily: DataFrame, total: str, name: str) -> DataFrame:
    """Daily totals summed row by row against those of the daily route, day by day."""
    rows = row_daily.select("day_number", F.col(total).alias("row_total"))
    gap = F.col("row_total") - F.col("day_total")
    return rows.join(daily.select("day_number", F.col(total).alias("day_total")), "day_number", "full").select(
        F.lit(name).alias("object"),
        "day_number",
        "row_total",
        "day_total",
        gap.alias("difference"),
        F.when(gap == 0, "PASS").otherwise("FAIL").alias("status"),
    )
