"""Embedding near-dedup with product quantisation.

An index fitted on a bounded sample has coarse lists and, for each subspace, codes of
the residuals.  Every vector is filed in its nearest list and looked for in its nearest
lists.  Inside a list, table lookups give the distance of each query to each coded
vector; no vector is missed there, since a code's distance differs from its vector's by
its own coding error at most, which is stored with it.  What is left is ranked by exact
cosines in double precision.

Equal vectors are one vector with a count.  Lists are cut into blocks of ``BLOCK``
vectors and queries, so none lands in one task, and a block gives counts and one link for
each connected vector, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import keep, small_batches, smallest_hashes
from ebbline.llm.components import components

THRESHOLD = 0.9
#: Vectors the index is fitted on at most.
SAMPLE = 20_000
#: Lists that a vector is looked for in, and sampled vectors that a list is fitted on at least.
PROBES = 16
PER_LIST = 4
SUBSPACES, CODES = 8, 256
BLOCK = 2048
_ROUNDS = 8


def usable(v: Column) -> Column:
    """Vectors without null or non-finite components whose length isn't zero."""
    double = v.cast("array<double>")
    bad = F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(double, lambda x: x != 0)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _nearest(x: np.ndarray, centres: np.ndarray, n: int = 1) -> np.ndarray:
    """The n nearest centres of each row, nearest first."""
    far = (centres**2).sum(axis=1) - 2 * x @ centres.T
    if n == 1:
        return far.argmin(axis=1)[:, None]
    some = np.argpartition(far, n - 1, axis=1)[:, :n] if n < far.shape[1] else np.tile(np.arange(far.shape[1]), (len(x), 1))
    return np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable"), 1)


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(_ROUNDS):
        own = np.concatenate([_nearest(x[i : i + 4096], centres)[:, 0] for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


class Index:
    """Coarse lists and residual codebooks for vectors of one dimension."""

    def __init__(self, sample: np.ndarray, lists: int, probes: int = PROBES, seed: int = 7):
        x = unit(sample)
        self.centres = _kmeans(x, min(lists, len(x)), seed)
        self.probes = min(probes, len(self.centres))
        self.cuts = np.array_split(np.arange(x.shape[1]), min(SUBSPACES, x.shape[1]))
        rest = x - self.centres[_nearest(x, self.centres)[:, 0]]
        self.books = [_kmeans(rest[:, c], min(CODES, len(x)), seed + 1 + i) for i, c in enumerate(self.cuts)]

    def file(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists to probe (its own first), codes and coding error of unit vectors."""
        probes = _nearest(x, self.centres, self.probes)
        rest = x - self.centres[probes[:, 0]]
        codes = np.stack([_nearest(rest[:, c], b)[:, 0] for c, b in zip(self.cuts, self.books, strict=True)], axis=1)
        coded = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return probes, codes.astype(np.uint8), np.linalg.norm(rest - coded, axis=1)

    def distances(self, queries: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to coded vectors of a list, from lookup tables."""
        rest = queries - self.centres[which]
        out = np.zeros((len(queries), len(codes)), dtype=np.float32)
        for i, (c, book) in enumerate(zip(self.cuts, self.books, strict=True)):
            part = rest[:, c]
            table = (part**2).sum(axis=1)[:, None] - 2 * part @ book.T + (book**2).sum(axis=1)
            out += np.maximum(table, 0).astype(np.float32)[:, codes[:, i]]
        return out


def _stars(n: int, a: np.ndarray, b: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between n nodes: each linked node and the node of least rank it's connected with."""
    order = np.argsort(rank, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    a, b, label = place[a], place[b], np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label != (up := label[label])).any():
            label = up
        on = label[a] != label[b]
        a, b = a[on], b[on]
    linked = np.flatnonzero(label != np.arange(n))
    return order[linked], order[label[linked]]


def _block(index: Index, threshold: float):
    reach = np.sqrt(2 - 2 * threshold)

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        coded, asked = rows[rows["coded"]], rows[~rows["coded"]]
        out = pd.DataFrame({"rep": [], "n": [], "to": []})
        if not len(coded) or not len(asked):
            return out.astype("int64")
        which = int(rows["list"].iloc[0])
        x, q = unit(np.stack(coded["v"].to_numpy())), unit(np.stack(asked["v"].to_numpy()))
        x_id, q_id = coded["rep"].to_numpy(), asked["rep"].to_numpy()
        x_n, q_n = coded["copies"].to_numpy(), asked["copies"].to_numpy()
        x_probes = np.stack(coded["probes"].to_numpy())
        home = np.array([p[0] for p in asked["probes"]])
        codes = np.frombuffer(b"".join(coded["codes"]), dtype=np.uint8).reshape(len(x), -1)
        error = coded["error"].to_numpy()
        at, to = [], []
        for s in range(0, len(q), 256):
            part = q[s : s + 256]
            i, j = np.nonzero(index.distances(part, which, codes) <= (reach + error + 1e-4) ** 2)
            for k in range(0, len(i), 1 << 16):
                a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                ok = (np.einsum("nd,nd->n", part[a], x[b]) >= threshold) & (q_id[s + a] != x_id[b])
                at.append(s + a[ok])
                to.append(b[ok])
        at, to = np.concatenate(at or [np.zeros(0, int)]), np.concatenate(to or [np.zeros(0, int)])
        # The other way round the pair is found too if the query's list is among the vector's.
        once = ~(x_probes[to] == home[at][:, None]).any(axis=1)
        ids = np.unique(np.concatenate([x_id, q_id]))
        counts = np.zeros(len(ids), dtype=np.int64)
        q_at, x_at = np.searchsorted(ids, q_id[at]), np.searchsorted(ids, x_id[to])
        np.add.at(counts, q_at, x_n[to])
        np.add.at(counts, x_at[once], q_n[at][once])
        node, root = _stars(len(ids), q_at, x_at, ids)
        some = np.flatnonzero(counts)
        return pd.concat(
            [
                pd.DataFrame({"rep": ids[some], "n": counts[some], "to": ids[some]}),
                pd.DataFrame({"rep": ids[node], "n": 0, "to": ids[root]}),
            ]
        ).astype("int64")

    return block


def _filing(index: Index):
    def filing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                probes, codes, error = index.file(unit(np.stack(batch["v"].to_numpy())))
                yield batch.assign(probes=list(probes.astype(np.int32)), codes=[c.tobytes() for c in codes], error=error)

    return filing


def _fit(reps: DataFrame, dimension: int, count: int, sample: int, probes: int, lists: int | None) -> Index:
    """Index fitted on the vectors of smallest hash, at most `sample` of them.

    There are lists by the root of the number of vectors, as far as the sample can fit them.
    """
    few = smallest_hashes(reps.where(F.size("v") == dimension), F.xxhash64("rep"), sample, count)
    some = few.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").toPandas()
    n = lists or int(min(max(1, np.sqrt(count)), max(1, len(some) / PER_LIST)))
    return Index(np.stack(some["v"].to_numpy()), n, probes)


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    probes: int = PROBES,
    lists: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of (vec_id, embedding).

    Null, zero and non-finite vectors and those without vec_id link with nothing.  Vectors
    of different dimension don't link.  Rows that repeat a vector are linked with each other.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    good = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    reps = keep(good.groupBy(F.col("embedding").alias("v")).agg(F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("copies")), "vectors")
    found = None
    # A table holds vectors of one dimension, or of a few; each has an index of its own.
    for dimension, count in [(r["d"], r["count"]) for r in reps.groupBy(F.size("v").alias("d")).count().collect()]:
        index = _fit(reps, dimension, count, sample, probes, lists)
        own = reps.where(F.size("v") == dimension)
        filed = keep(own.mapInPandas(_filing(index), own.schema.simpleString()[7:-1] + ",probes:array<int>,codes:binary,error:double"), "filed-vectors")
        sizes = filed.groupBy(F.col("probes")[0].alias("list")).count().collect()
        asking = filed.select(F.explode("probes").alias("list")).groupBy("list").count().collect()
        n = len(index.centres)
        blocks = np.ones((2, n), dtype=int)
        for k, counted in enumerate((sizes, asking)):
            for r in counted:
                blocks[k, r["list"]] = -(-r["count"] // block)
        parts = [F.array(*[F.lit(int(b)) for b in row]) for row in blocks]
        number = [F.pmod(F.xxhash64(F.lit(k), "rep"), p[F.col("list")]).cast("int") for k, p in enumerate(parts)]
        upto = [F.explode(F.sequence(F.lit(0), p[F.col("list")] - 1)) for p in parts]
        columns = ["list", "i", "j", "rep", "copies", "v", "probes", "codes", "error", "coded"]
        coded = filed.withColumn("list", F.col("probes")[0]).withColumn("i", number[0]).withColumn("j", upto[1]).withColumn("coded", F.lit(True))
        asked = filed.withColumn("list", F.explode("probes")).withColumn("j", number[1]).withColumn("i", upto[0]).withColumn("coded", F.lit(False))
        asked = asked.withColumn("codes", F.lit(None).cast("binary")).withColumn("error", F.lit(None).cast("double"))
        rows = coded.select(columns).unionByName(asked.select(columns))
        links = rows.groupBy("list", "i", "j").applyInPandas(_block(index, threshold), "rep long, n long, to long")
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = spark.createDataFrame([], "rep long, n long, to long")
    found = keep(found, "vector-links")
    counts = found.groupBy(F.col("rep").alias("c_rep")).agg(F.sum("n").alias("n"))
    labels = components(found.select("rep", "to"), "rep", "to")
    by_vector = (
        reps.join(counts, F.col("rep") == F.col("c_rep"), "left")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("root"))
    )
    real = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", F.when(real, F.col("embedding")).alias("e"))
    component = F.coalesce("root", F.col("vec_id").cast("long"))
    return rows.join(by_vector, F.col("e") == F.col("v"), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
