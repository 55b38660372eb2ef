"""Secret scans with multipart credential linking.

Base findings (assignments of secrets, access identifiers, long hex strings) are always
reported.  Weak candidates (labelled identifiers, bare 40-character keys, endpoints) are
reported only where complementary parts stand within a scope of each other: a weak
identifier near a secret, a bare key near an identifier, an endpoint near both.  The
interval join of parts inside a document is a sweep over their sorted positions: a part
needs only the nearest part before and after it, so no pairs are made.

Positions are code points, ends exclusive.  Null and empty texts have no spans.  Each row
is scanned by itself, so rows that repeat a doc_id give a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import keep

#: Most code points between complementary parts.
SCOPE = 300

# The base patterns.  A hit counts if group `part` has `least` characters.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Weak candidates.
IDENTIFIER = r"""(?i:access_?key_?id|client_?id|account_?id|user(?:_?name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}"""
KEY = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""(?i:https?|s3|jdbc:[a-z]+|redis|amqps?|mongodb|mysql|postgres(?:ql)?)://[^\s"'<>]{4,}"""

#: Kind, pattern, base or weak; in the order that breaks ties.
KINDS = (
    ("assign", ASSIGN, True),
    ("access", ACCESS, True),
    ("hex", HEX, True),
    ("identifier", IDENTIFIER, False),
    ("key", KEY, False),
    ("endpoint", ENDPOINT, False),
)


def _hits(docs: DataFrame, text: str) -> DataFrame:
    """A row for each hit (row, doc_id, kind, n, gap, hit), and one without for each text without.

    gap is what stands between a hit and the one before it, as split() leaves it.  The rows are
    numbered and written before any shuffle goes by their numbers: a task that is run again
    reads the numbers it read before.
    """
    base = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col(text), F.lit("")).alias("t"))
    found = base.select("*", *[F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias(k) for k, p, _ in KINDS])

    def listed(order: int, kind: str, pattern: str) -> Column:
        gaps = F.split("t", pattern, -1)
        rows = F.transform(
            F.arrays_zip(F.col(kind).alias("hit"), F.slice(F.transform(gaps, F.length), 1, F.size(kind)).alias("gap")),
            lambda x: F.struct(F.lit(order).alias("kind"), x["gap"].alias("gap"), x["hit"].alias("hit")),
        )
        nothing = F.array().cast("array<struct<kind:int,gap:int,hit:string>>")
        return F.when(F.size(kind) > 0, rows).otherwise(nothing)

    rows = F.concat(*[listed(i, k, p) for i, (k, p, _) in enumerate(KINDS)])
    hits = found.select("row", "doc_id", F.posexplode_outer(rows).alias("n", "h")).select("row", "doc_id", "n", "h.kind", "h.gap", "h.hit")
    return keep(hits, "secret-hits")


def spans(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """A row per span (row, doc_id, kind, start, end, base); start is null for texts without."""
    in_kind = Window.partitionBy("row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("hit")
    placed = _hits(docs, text).withColumn("end", F.sum(F.col("gap") + size).over(in_kind)).withColumn("start", F.col("end") - size)
    strong = F.col("kind") < sum(b for _, _, b in KINDS)
    enough = (F.col("kind") != 0) | (F.length(F.regexp_extract("hit", ASSIGN, 2)) >= 8)
    parts = placed.select("row", "doc_id", "kind", F.when(F.coalesce(enough, F.lit(True)), F.col("start")).alias("start"), "end", strong.alias("base"))
    order = Window.partitionBy("row").orderBy(F.col("start").asc_nulls_last(), "kind", "end")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)

    def gap_to(what: Column) -> tuple[Column, Column]:
        """Distance to the nearest part of a kind before and after; negative if they overlap."""
        return F.col("start") - F.max(F.when(what, F.col("end"))).over(before), F.min(F.when(what, F.col("start"))).over(after) - F.col("end")

    def within(name: str, most: int) -> Column:
        return F.coalesce(F.col(f"{name}_before") <= most, F.lit(False)) | F.coalesce(F.col(f"{name}_after") <= most, F.lit(False))

    def measured(df: DataFrame, **parts: Column) -> DataFrame:
        gaps = [(f"{name}_{side}", g) for name, what in parts.items() for side, g in zip(("before", "after"), gap_to(what), strict=True)]
        return df.select("*", *[g.alias(n) for n, g in gaps])

    real = F.col("start").isNotNull()
    apart = measured(parts, base=F.col("base") & real)
    candidates = apart.withColumn("start", F.when(F.col("base") | ~within("base", -1), F.col("start"))).drop("base_before", "base_after")
    kind = {k: i for i, (k, _, _) in enumerate(KINDS)}
    linked = measured(
        candidates,
        id=F.col("kind").isin(kind["access"], kind["identifier"]) & real,
        secret=F.col("kind").isin(kind["assign"], kind["hex"], kind["key"]) & real,
    )
    near_id, near_secret = within("id", scope), within("secret", scope)
    shown = (
        F.col("base")
        | ((F.col("kind") == kind["identifier"]) & near_secret)
        | ((F.col("kind") == kind["key"]) & near_id)
        | ((F.col("kind") == kind["endpoint"]) & near_id & near_secret)
    )
    return linked.select("row", "doc_id", "kind", F.when(shown, F.col("start")).alias("start"), "end", "base")


def scan(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per text: doc_id, n_<base kind>, base_spans and spans as ``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k, _, _ in KINDS])
    span = F.struct("start", "kind", "end")

    def joined(found: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(found), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")

    real = F.col("start").isNotNull()
    counts = [F.count(F.when(real & (F.col("kind") == i), 1)).alias(f"n_{k}") for i, (k, _, b) in enumerate(KINDS) if b]
    grouped = (
        spans(docs, text, scope)
        .groupBy("row", "doc_id")
        .agg(*counts, F.collect_list(F.when(real & F.col("base"), span)).alias("b"), F.collect_list(F.when(real, span)).alias("a"))
    )
    return grouped.select("doc_id", *[f"n_{k}" for k, _, b in KINDS if b], joined(F.col("b")).alias("base_spans"), joined(F.col("a")).alias("spans"))
