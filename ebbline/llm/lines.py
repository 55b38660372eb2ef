"""Line dedup over overlapping windows of consecutive lines.

Each window of three lines is hashed to 128 bits; a window met at several places is kept
where it is met first, by (doc_id, position), and its later occurrences cover their lines.
Covered positions are merged and their lines removed.  Every removed line is still found
where its window is met first, so no line is lost everywhere.

Windows are counted by hash before they meet, and their occurrences join a table with one
row per repeated window, so a window that a third of all documents share is split.
A text of fewer than three lines, an empty or a null text stays as it is; windows of
blank lines only are left alone.  Rows with equal doc_id and text are one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, text: str = "text", lines: int = LINES) -> DataFrame:
    """(doc, mark, pos, h1, h2) of every window; mark tells texts of one doc_id apart."""
    split = docs.select(F.col("doc_id").alias("doc"), F.xxhash64(text).alias("mark"), _lines(F.col(text)).alias("lines"))

    def window(i: Column) -> Column:
        part = [F.col("lines")[i + k] for k in range(lines)]
        blank = F.btrim(F.concat(*part)) == ""
        return F.when(~blank, F.struct(i.alias("pos"), F.xxhash64(*part).alias("h1"), F.xxhash64(F.lit(7), *part).alias("h2")))

    found = F.transform(F.sequence(F.lit(0), F.size("lines") - lines), window)
    return (
        split.where(F.size("lines") >= lines)
        .select("doc", "mark", F.explode(found).alias("w"))
        .where("w IS NOT NULL")
        .select("doc", "mark", "w.pos", "w.h1", "w.h2")
    )


def dedup_lines(docs: DataFrame, text: str = "text", lines: int = LINES) -> DataFrame:
    """The documents with the later occurrences of repeated windows cut out of their text.

    All other columns are kept; ``removed_lines`` is added or replaced.
    """
    every = windows(docs, text, lines)
    place = F.struct("doc", "mark", "pos")
    repeated = every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = every.join(repeated, ["h1", "h2"]).where(place != F.col("first")).select("doc", "mark", "pos").distinct()
    in_doc = Window.partitionBy("doc", "mark").orderBy("pos")
    since = F.coalesce(F.lag("pos").over(in_doc) + lines, F.lit(0))
    gap = F.when(F.col("pos") > F.col("since"), F.struct("since", (F.col("pos") - F.col("since")).alias("n")))
    kept = (
        later.withColumn("since", since)
        .groupBy("doc", "mark")
        .agg(F.sort_array(F.collect_list(gap)).alias("pieces"), (F.max("pos") + lines).alias("tail"))
        .select(*[F.col(c).alias(f"__{c}") for c in ("doc", "mark", "pieces", "tail")])
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__mark"))
    joined = docs.join(kept, same, "left").withColumn("__lines", F.when(F.col("__tail").isNotNull(), _lines(F.col(text))))
    end = F.size("__lines") - F.col("__tail")
    rest = F.when(end > 0, F.array(F.struct(F.col("__tail").alias("since"), end.alias("n")))).otherwise(F.array().cast("array<struct<since:int,n:int>>"))
    pieces = joined.withColumn("__pieces", F.concat("__pieces", rest))
    cut = F.array_join(F.transform("__pieces", lambda p: F.array_join(F.slice("__lines", p["since"] + 1, p["n"]), "\n")), "\n")
    left = F.aggregate("__pieces", F.lit(0), lambda n, p: n + p["n"])
    touched = F.col("__tail").isNotNull()
    return pieces.select(
        *[(F.when(touched, cut).otherwise(F.col(c)).alias(c) if c == text else F.col(c)) for c in docs.columns if c != "removed_lines"],
        F.when(touched, F.size("__lines") - left).otherwise(0).cast("long").alias("removed_lines"),
    )
