"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.sources.tables import working_folder

#: White space between words, as in the pattern ``[^\x20\x09-\x0D]+``.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or else the warehouse."""
    return working_folder(spark)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back, which cuts its lineage.

    A lost executor costs later stages nothing but a new read of these files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def smallest_hashes(rows: DataFrame, hashed: Column, wanted: int, count: int) -> DataFrame:
    """Those of `count` rows whose hash is below a threshold that leaves somewhat more than `wanted`.

    An order with a limit keeps `wanted` rows in every task; after this filter few do.
    """
    if count <= 2 * wanted:
        return rows
    most = min(1.0, (wanted + 6 * wanted**0.5 + 36) / count)
    return rows.where(hashed < F.lit(int(-(2**63) + most * 2**64)))


def words_of(text: Column) -> Column:
    """The words ``[^\x20\x09-\x0D]+`` of a text as an array; null counts as empty."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+", -1)
    )


def small_batches(spark: SparkSession, megabytes: int = 8) -> None:
    """Bound an Arrow batch by bytes, so that very long texts don't pile up in a worker.

    A larger bound is replaced, that of an operator earlier in the session included; a
    smaller one stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1)).rstrip("bB")) > megabytes << 20:
        spark.conf.set(key, str(megabytes << 20))
