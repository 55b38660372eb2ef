"""Run histories: a partition for each run, a manifest with a row for each run.

A run is written into a partition of its own and only then entered into the manifest, which
readers go by.  Both writes replace what the same run id wrote before, so a retry after
any failure leaves one run and a run that failed half-way isn't seen.  Two runs touch
different partitions and may be written at the same time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.calendar import instant
from ebbline.sources.schemas import RUN_KEYS, SCHEMAS
from ebbline.sources.tables import is_path, read_table

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def stamp_run(result: DataFrame, created: dt.datetime, table: str, run_id: str | None = None) -> DataFrame:
    """Run result with its creation time and id, in the declared column order of ``table``.

    Without ``run_id`` the creation time names the run, so that a retry has the id of what
    it retries.
    """
    if run_id == "":
        raise ValueError("a run id is not empty")
    stamped = result.withColumn("created_timestamp", instant(created)).withColumn("run_id", F.lit(run_id or created.isoformat()))
    absent = set(SCHEMAS[table].fieldNames()) - {c.lower() for c in stamped.columns}
    if absent:
        raise ValueError(f"{table}: result lacks {sorted(absent)}")
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields])


def _replace_partitions(rows: DataFrame, target: str, keys: tuple[str, ...]) -> None:
    """Write ``rows``, which take the place of the partitions they fall into and of no other."""
    spark = rows.sparkSession
    if is_path(target):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(target)
        return
    if not spark.catalog.tableExists(target):
        spark.createDataFrame([], rows.schema).write.mode("ignore").partitionBy(*keys).saveAsTable(target)
    before = spark.conf.get(_OVERWRITE_MODE)  # insertInto goes by the session and not by an option
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        rows.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def _manifest(target: str) -> str:
    return f"{target.rstrip('/')}_runs"


def append_run(result: DataFrame, target: str, created: dt.datetime, table: str = "lcr", run_id: str | None = None) -> None:
    """Append one run to its history, columns matched by name, or replace it if it is there.

    A run is a few hundred rows, so each partition of it is written as one file.
    """
    spark, keys = result.sparkSession, RUN_KEYS[table]
    _replace_partitions(stamp_run(result, created, table, run_id).coalesce(1), target, keys)
    written = read_table(spark, target, table).where((F.col("run_id") == (run_id or created.isoformat())) & (F.col("created_timestamp") == instant(created)))
    entry = written.groupBy(*keys, "created_timestamp").agg(F.count(F.lit(1)).alias("n_rows")).select(*SCHEMAS[f"{table}_runs"].fieldNames())
    _replace_partitions(entry.coalesce(1), _manifest(target), keys)


def runs(spark: SparkSession, target: str, table: str = "lcr") -> DataFrame:
    """The manifest of a history: key, creation time and row count of every run."""
    return read_table(spark, _manifest(target), f"{table}_runs")


def history(spark: SparkSession, target: str, table: str = "lcr") -> DataFrame:
    """Rows of every run in the manifest."""
    keys = RUN_KEYS[table]
    listed = runs(spark, target, table).select(*keys, "created_timestamp")
    return read_table(spark, target, table).join(listed, [*keys, "created_timestamp"], "left_semi")


def latest(spark: SparkSession, target: str, table: str = "lcr", what_if_id: str | None = None) -> DataFrame:
    """Rows of the newest run, of a scenario history the newest of each scenario or of one.

    Of runs made at one instant, the largest id is the newest.  The manifest is aggregated in
    a subquery whose value is compared with the partition columns, so that no other
    partition is read and nothing is joined.
    """
    rows, listed = read_table(spark, target, table), runs(spark, target, table)
    if what_if_id is not None:
        rows, listed = (df.where(F.col("what_if_id") == str(what_if_id)) for df in (rows, listed))
    newest = F.max(F.struct("created_timestamp", "run_id")).alias("newest")
    if table == "lcr":
        return rows.where(F.col("run_id") == listed.agg(newest).select("newest.run_id").scalar())
    # One pair for each scenario.
    pairs = listed.groupBy("what_if_id").agg(newest).agg(F.collect_list(F.struct("what_if_id", "newest.run_id")))
    return rows.where(F.array_contains(pairs.scalar(), F.struct("what_if_id", "run_id")))


def is_stored(spark: SparkSession, target: str, run_id: str, table: str = "lcr") -> bool:
    """Whether the manifest lists a run."""
    try:
        listed = runs(spark, target, table)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return False
        raise
    return not listed.where(F.col("run_id") == run_id).isEmpty()
