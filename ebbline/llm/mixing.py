"""Mixing sources to target weights by Sainte-Lague apportionment.

Sizes are words.  Sources share the whole by weight, none above ``most`` times its size;
what is above is shared again among the others.  A target becomes equal blocks of
``block_words`` words, which go to the sources by the highest quotients target / (2 n + 1).
Inside a source its blocks go to its shards by the quotients of their sizes, and each shard
gives whole passes over its documents and then the first blocks of their seeded order.

Null texts have size 0; a null source is a source, ordered last.  An empty table gives an
empty table.  Documents that repeat an id are told apart by their texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import SPACES, keep, words_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 32
#: A shard has about so many words.
SHARD_WORDS = 1 << 18
SEED = 20240601


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``: white space runs of the trimmed text, and one."""
    return F.size(words_of(text)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds number, weight and target to (source, source_size): one row per source."""
    every = Window.orderBy(F.col("source").asc_nulls_last())
    cap = F.col("source_size") * F.lit(float(most))
    weighed = sources.withColumn("number", F.row_number().over(every) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    )
    # Sources in the order in which a rising level reaches their caps; those reached are a prefix.
    by_cap = Window.orderBy(cap / F.col("weight"), "number")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    level = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(after)
    capped = weighed.withColumn("total", total).withColumn("full", cap / F.col("weight") <= level)
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), cap)).over(whole), F.lit(0.0))
    free = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    return capped.withColumn("target", F.when(F.col("full"), cap).otherwise(rest / free * F.col("weight"))).drop("total", "full")


def apportion(sizes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients size / (2 n + 1), none above its cap; ties: first."""
    sizes, seats = sizes.astype(float), int(min(seats, caps.sum()))
    low, high = 0.0, max(sizes.max(initial=0.0) * 4 + 1, 1.0)
    got = np.zeros(len(sizes), dtype=np.int64)
    for _ in range(200):  # the largest divisor that gives at most the seats is `high` in the end
        middle = (low + high) / 2
        tried = np.minimum(np.floor(sizes / middle + 0.5), caps).astype(np.int64) if middle > 0 else caps
        if tried.sum() > seats:
            low = middle
        else:
            high, got = middle, tried
    while (left := seats - int(got.sum())) > 0:
        quotient = np.where(got < caps, sizes / (2 * got + 1), -1.0)
        best = np.argsort(-quotient, kind="stable")[:left]
        got[best[quotient[best] >= 0]] += 1
    return got


def _source_quotas(block: int, most: float):
    def quotas(sources: pd.DataFrame) -> pd.DataFrame:
        sources = sources.sort_values("number")
        wanted = sources["target"].to_numpy()
        caps = np.ceil(sources["source_size"].to_numpy() * most / block).astype(np.int64)
        return sources.assign(blocks=apportion(wanted, int(np.floor(wanted.sum() / block + 0.5)), caps))

    return quotas


def _quotas(block: int, most: float):
    def quotas(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard")
        sizes = shards["shard_size"].to_numpy()
        caps = np.ceil(sizes * most / block).astype(np.int64)
        blocks = apportion(sizes, int(shards["blocks"].iloc[0]), caps)
        return shards[["number", "shard", "shard_size"]].assign(words=blocks * block)

    return quotas


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    text: str = "text",
) -> DataFrame:
    """The documents with size, source_size, target and taken.

    All columns but these names are kept.  taken is how many words the mix takes, repeats
    counted: whole passes first, then the words of the document inside the chosen blocks,
    which are the first ones of the shard's seeded order.  Shard and order go by doc_id and
    text, so the order of the input plays no part even where ids repeat.
    """
    sized = docs.drop("size", "source_size", "target", "taken").withColumn("size", word_count(F.col(text)))
    mark = F.xxhash64(text)
    measured = keep(docs.select("doc_id", "source", mark.alias("mark"), word_count(F.col(text)).alias("size")), "mix-sizes")
    sources = targets(measured.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    # One row for each source, in the one task that weighs them against each other.
    dealt = sources.groupBy(F.lit("all")).applyInPandas(_source_quotas(block_words, most), f"{sources.schema.simpleString()[7:-1]}, blocks long")
    sources = keep(
        dealt.withColumn("shards", F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1))), "mix-sources"
    ).select(
        F.col("source").alias("__source"), "source_size", "target", F.col("number").alias("__number"), F.col("shards").alias("__shards"), F.col("blocks").alias("__blocks")
    )

    def placed(df: DataFrame, mark: Column) -> DataFrame:
        shard = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), mark), F.col("__shards"))
        return df.join(sources, F.col("source").eqNullSafe(F.col("__source"))).withColumn("__shard", shard)

    shards = (
        placed(measured, F.col("mark"))
        .groupBy(F.col("__number").alias("number"), F.col("__shard").alias("shard"), F.col("__blocks").alias("blocks"))
        .agg(F.sum("size").alias("shard_size"))
    )
    quotas = keep(
        shards.groupBy("number").applyInPandas(_quotas(block_words, most), "number int, shard long, shard_size long, words long"), "mix-quotas"
    ).select(*[F.col(c).alias(f"__q_{c}") for c in ("number", "shard", "shard_size", "words")])
    # Rows alike in all of these are alike in what is taken, whichever comes first.
    stream = Window.partitionBy("__number", "__shard").orderBy(F.xxhash64(F.lit(seed + 1), F.col("doc_id"), mark), "doc_id", mark, "size")
    before = F.coalesce(F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    passes = F.when(F.col("__q_shard_size") > 0, F.floor(F.col("__q_words") / F.col("__q_shard_size"))).otherwise(0)
    rest = F.col("__q_words") - F.col("__passes") * F.col("__q_shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__before")))
    taken = F.least(F.col("__passes") * F.col("size") + part, F.col("size") * F.lit(most)).cast("long")
    return (
        placed(sized, mark)
        .withColumn("__before", before)
        .join(quotas, (F.col("__number") == F.col("__q_number")) & (F.col("__shard") == F.col("__q_shard")))
        .withColumn("__passes", passes)
        .withColumn("taken", taken)
        .select(*sized.columns, "source_size", "target", "taken")
    )


def copies(mixed: DataFrame, text: str = "text") -> DataFrame:
    """A row for each copy that the mix takes of a document, and whole texts but for one.

    A copy of which only the first words are taken has these, one space apart.
    """
    size, taken = F.col("size"), F.col("taken")
    words = F.explode(F.concat(F.array_repeat(size, F.floor(taken / size).cast("int")), F.array(taken % size)))
    cut = F.array_join(F.slice(words_of(F.col(text)), 1, F.col("__words").cast("int")), " ")
    kept = mixed.where("taken > 0").withColumn("__words", words).where("__words > 0")
    return kept.withColumn(text, F.when(F.col("__words") < size, cut).otherwise(F.col(text))).drop("__words")
