"""Small literal tables as DataFrames with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ebbline.sources.schemas import conform


def _literal(value: str | float | bool) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def inline_table(
    spark: SparkSession,
    table: str,
    columns: Sequence[str],
    rows: Sequence[tuple],
    now: Column | None = None,
) -> DataFrame:
    """Rows of text, numbers and flags as a VALUES list, cast to the schema of ``table``.

    The planner sees the exact size of such a table and needs no Python data source.
    """
    values = ", ".join(f"({', '.join(_literal(v) for v in row)})" for row in rows)
    literal = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
    return conform(literal, table, now)
