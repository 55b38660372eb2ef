"""Document fingerprints by one-permutation MinHash with optimal densification.

A text's shingles are hashed once.  The high bits of a hash choose its bin and each bin
keeps its smallest hash.  An empty bin takes the value of the first bin that isn't empty
in an order of its own, which is the same for all texts.  ``BITS`` low-order bits of each
bin are stored; the likeness of two fingerprints is the share of equal bins, corrected
for those that agree by chance.

All expressions are built in: sorting the hashes puts every bin's smallest first in its
run, so a fingerprint needs neither a shuffle nor Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import keep, words_of

WORDS = 5
BINS = 256
BITS = 4
#: Bins that an empty one tries by arithmetic before it looks through all that are filled.
TRIES = 16
_PER_LONG = 64 // BITS
_CHANCE = 2.0**-BITS


def _bin(x: Column) -> Column:
    return F.shiftright(x, 56).cast("int") + 128


def _order(i: Column, t: int) -> Column:
    """The t-th bin that bin i tries: an odd multiple and an offset, modulo BINS."""
    return (i * (2 * t + 3) * 37 + (t * t * 91 + 53 * t + 17)).bitwiseAND(BINS - 1)


def with_fingerprint(df: DataFrame, text: Column, name: str, words: int = WORDS) -> DataFrame:
    """Adds a fingerprint (array of longs) of a text; empty and null texts have an empty one.

    A text of fewer words than a shingle is one shingle.  Equal texts have equal
    fingerprints, and so have texts that differ in white space only.
    """
    c = lambda suffix: f"__{name}_{suffix}"
    steps = df.withColumn(c("w"), F.transform(words_of(text), lambda w: F.xxhash64(w)))
    n, h = F.size(c("w")), F.col(c("w"))
    every = F.transform(F.sequence(F.lit(0), n - words), lambda i: F.xxhash64(*[h[i + k] for k in range(words)]))
    shingles = F.when(n >= words, every).when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    steps = steps.withColumn(c("s"), F.sort_array(shingles)).drop(c("w"))
    s = F.col(c("s"))
    first = F.filter(s, lambda x, i: (i == 0) | (_bin(s[F.greatest(i - 1, F.lit(0))]) != _bin(x)))
    steps = steps.withColumn(c("m"), first).drop(c("s"))
    m = F.col(c("m"))
    empty = F.lit(None).cast("bigint")
    prior = lambda j: F.when(j == 0, F.lit(-1)).otherwise(_bin(m[F.greatest(j - 1, F.lit(0))]))
    runs = F.flatten(F.transform(m, lambda x, j: F.concat(F.array_repeat(empty, _bin(x) - prior(j) - 1), F.array(x))))
    steps = steps.withColumn(c("d"), F.when(F.size(m) > 0, F.concat(runs, F.array_repeat(empty, BINS - 1 - _bin(F.element_at(m, -1))))))
    d = F.col(c("d"))
    last = lambda i: F.array_min(F.transform(m, lambda x: F.struct(F.hash(i, _bin(x)).alias("k"), x.alias("x"))))["x"]
    # A borrowed value is hashed with its bin, else few values would agree by chance in many bins.
    borrowed = lambda i: F.xxhash64(F.coalesce(*[d[_order(i, t)] for t in range(TRIES)], last(i)), i)
    dense = F.transform(d, lambda x, i: F.coalesce(x, borrowed(i)).bitwiseAND((1 << BITS) - 1))
    steps = steps.withColumn(c("b"), dense).drop(c("m"), c("d"))
    b = F.col(c("b"))
    packed = F.transform(
        F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)),
        lambda k: F.aggregate(F.slice(b, k * _PER_LONG + 1, _PER_LONG), F.lit(0).cast("bigint"), lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x)),
    )
    return steps.withColumn(name, F.when(b.isNotNull(), packed).otherwise(F.array().cast("array<bigint>"))).drop(c("b"))


def shown(fingerprint: Column) -> Column:
    """A fingerprint as lower-case hex."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity: equal bins less those equal by chance, 0 to 1.

    Two empty fingerprints are alike, an empty and another one are not.
    """
    lowest = F.lit(int("1" * (64 // BITS), 16)).cast("bigint")

    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        folded = z
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(z, k))
        return F.bit_count(folded.bitwiseAND(lowest))

    differ = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    share = (F.lit(1.0) - differ / F.lit(BINS) - _CHANCE) / (1 - _CHANCE)
    both = F.when(F.size(b) == 0, 1.0).otherwise(0.0)
    return F.when(F.size(a) == 0, both).when(F.size(b) == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def following(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id): the largest smaller id, and for the smallest the largest of all.

    Ids are dealt out by range and written with the number of their range, so that both
    readers see the same ranges, and only the ends of the ranges meet in one task.
    """
    some = ids.select("doc_id").where("doc_id IS NOT NULL").distinct()
    dealt = keep(some.repartitionByRange("doc_id").withColumn("p", F.spark_partition_id()), "dealt-ids")
    inside = F.lag("doc_id").over(Window.partitionBy("p").orderBy("doc_id"))
    ends = dealt.groupBy("p").agg(F.max("doc_id").alias("top"))
    below = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("p", F.max("top").over(below).alias("lower"), F.max("top").over(whole).alias("largest"))
    return dealt.withColumn("inside", inside).join(ends, "p").select("doc_id", F.coalesce("inside", "lower", "largest").alias("next_id"))


def edited(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of documents, of their edited texts and the likeness to the next one.

    The edited text has its second half (rounded down) replaced by as many first code
    points of the next document's text, or all it has.  Rows that share a doc_id are
    edited each; of next documents that share one, that of the smallest text is taken.  A
    row without doc_id has no next one, so its second half goes.
    """
    every = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("n_chars", F.length("t").cast("long"))
    base, nameless = every.where("doc_id IS NOT NULL"), every.where("doc_id IS NULL")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    order = following(docs).select(F.col("doc_id").alias("asker"), F.col("next_id").alias("asked"))
    longest = base.groupBy("doc_id").agg(F.max(half).alias("need")).select(F.col("doc_id").alias("asker"), "need")
    asks = order.join(longest, order["asker"] == longest["asker"]).select(order["asker"], "asked", "need")
    # One shuffle of the texts serves both as documents and as those that follow: its key is
    # never null, so no join adds a filter to one side, and both sides use all its columns.
    # Rows without doc_id, which may be many, don't take part in it.
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    printed = with_fingerprint(base, F.col("t"), "fp").select(key.alias("key"), "doc_id", "t", "n_chars", "fp").repartition("key")
    begun = (
        printed.join(asks, printed["key"] == asks["asked"])
        .select("asker", F.substring("t", F.lit(1), F.col("need")).alias("head"), F.col("fp").alias("next_fp"), "doc_id", "n_chars")
        .groupBy("asker")
        .agg(F.min(F.struct("head", "next_fp", "doc_id", "n_chars")).alias("after"))
    )
    texts = printed.join(begun, printed["key"] == begun["asker"], "left").select(
        "doc_id",
        "n_chars",
        "fp",
        F.concat(
            F.substring("t", F.lit(1), (F.col("n_chars") - half).cast("int")),
            F.substring(F.coalesce("after.head", F.lit("")), F.lit(1), half),
        ).alias("edited"),
        F.coalesce("after.next_fp", F.array().cast("array<bigint>")).alias("next_fp"),
    )
    alone = with_fingerprint(nameless, F.col("t"), "fp").select(
        "doc_id",
        "n_chars",
        "fp",
        F.substring("t", F.lit(1), (F.col("n_chars") - half).cast("int")).alias("edited"),
        F.array().cast("array<bigint>").alias("next_fp"),
    )
    return with_fingerprint(texts, F.col("edited"), "edited_fp").unionByName(with_fingerprint(alone, F.col("edited"), "edited_fp"))
