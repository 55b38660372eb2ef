"""Reading and writing tables by name or path."""

from __future__ import annotations


import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.sources.schemas import SCHEMAS, STORED_BY_RUN, conform


def is_path(target: str) -> bool:
    return "/" in target


def working_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: spark.checkpoint.dir, or else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/ebbline").rstrip("/")


def read_table(spark: SparkSession, source: str, table: str | None = None) -> DataFrame:
    """Catalog table ``source``, or Parquet if it is a path, conformed to ``table``."""
    # A run id such as 007 would be read as a number from a partition's name, so types are given.
    reader = spark.read.schema(SCHEMAS[table]) if table in STORED_BY_RUN else spark.read
    df = reader.parquet(source) if is_path(source) else spark.table(source)
    return conform(df, table, enforce=False) if table else df


def run_sql(spark: SparkSession, text: str, **parameters: object) -> DataFrame:
    """SQL text with named parameters, which are bound and never pasted in."""
    return spark.sql(text, args=parameters or None)


def overwrite(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    buckets: int = 0,
    bucket_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Replace a table or Parquet directory.

    ``cluster_by`` sorts rows over ranges, NULLs first, so that a filter on these columns skips
    the row groups outside it.  ``buckets`` and ``bucket_by`` need a table name: a join or
    aggregate on these columns then reads the table without a shuffle; ``location`` says
    where its files lie.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if is_path(target):
        if buckets:
            raise ValueError("buckets are kept by the catalog: give a table name")
        writer.parquet(target)
        return
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(target)


_MANIFEST = "schema string, base string, path string, length long, modified timestamp"


def snapshot(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Fix what a table holds now, without copying it: a manifest of its files at path ``target``.

    What is added to the table later isn't in the snapshot.  Scenario runs need none: they
    derive new frames.
    """
    df = read_table(spark, source)
    files = df.inputFiles()
    if is_path(source):
        base = source
    else:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {source}").where("col_name = 'Location'").first()
        if described is None:
            raise ValueError(f"{source} has no files to take a snapshot of")
        base = described["data_type"]
    row = F.lit(df.schema.json()).alias("schema"), F.lit(base).alias("base")
    listed = _listed(spark, files) if files else spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in (("path", "string"), ("length", "long"), ("modified", "timestamp"))])
    listed.select(*row, "path", "length", "modified").coalesce(1).write.mode("overwrite").parquet(target)
    return read_snapshot(spark, target)


def _listed(spark: SparkSession, files: list[str]) -> DataFrame:
    """Length and time of files, whose contents aren't read."""
    return spark.read.format("binaryFile").load(files).select("path", "length", F.col("modificationTime").alias("modified"))


def read_snapshot(spark: SparkSession, target: str) -> DataFrame:
    """The rows a table had when the snapshot was taken.  Fails if a file of it is gone or another."""
    manifest = spark.read.schema(_MANIFEST).parquet(target)
    rows = manifest.collect()
    schema = T.StructType.fromJson(json.loads(rows[0]["schema"]))
    files = [r["path"] for r in rows if r["path"] is not None]
    if not files:
        return spark.createDataFrame([], schema)
    changed = manifest.join(_listed(spark, files), ["path", "length", "modified"], "left_anti").count()
    if changed:
        raise ValueError(f"{changed} files of the snapshot {target} have changed")
    return spark.read.schema(schema).option("basePath", rows[0]["base"]).parquet(*files)


def fetch(df: DataFrame, max_rows: int = 1_000) -> pd.DataFrame:
    """Bring a report to the client; refuses anything longer than ``max_rows``."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate it first")
    return rows
