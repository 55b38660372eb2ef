"""SimHash near-dedup with a hierarchical index in Gray order.

Distinct fingerprints are filed under nodes, masked bit patterns that their members
share.  The bits are cut into one part more than may differ, so that two linked
fingerprints agree in a part and meet under its node.  A node of more than ``NODE``
members is cut in the same way by the bits it doesn't fix, again and again; a node of the
last level has so few free bits that its members are bounded.  No node is dropped.

Inside a node members stand in Gray order, in which neighbours differ least.  Groups of
them form upper nodes with the bits all members agree on; a pair of groups whose agreed
bits differ too often already is pruned whole.  What is left is compared.  A node gives
each of its members one link to the smallest it is connected with, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import keep, small_batches
from ebbline.llm.components import components

WORDS = 3
DISTANCE = 2
SEED = 42
NODE = 1024
#: Levels of nodes; with 2 differing bits the last has at most 13 free bits.
LEVELS = 4
#: Members of a group, and groups of an upper group.
FAN = 8
_CHUNK = 1 << 16


def simhash(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """Fingerprint of a text; bits set in over half of the shingles' hashes."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        part = [found[at + k : min(n, at + _CHUNK) + k] for k in range(words)] if len(found) >= words else [[w] for w in found]
        hashes = np.array([digest(b" ".join(s), seed) for s in zip(*part, strict=True)], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """Adds fp, the fingerprint as a signed 64-bit number."""

    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(t.as_py(), words, seed) for t in texts], type=pa.int64())

    small_batches(docs.sparkSession)
    return docs.withColumn("fp", fp(F.col(text)))


def parts(bits: list[int], n: int) -> list[list[int]]:
    return [x.tolist() for x in np.array_split(np.array(bits, dtype=int), n)]


def masks(fixed: int, distance: int) -> list[int]:
    """The masks of a node's children: its own bits and one part of the others each."""
    free = [b for b in range(64) if not fixed >> b & 1]
    return [fixed | sum(1 << b for b in part) for part in parts(free, distance + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit pattern in Gray order."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def _apart(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def close_pairs(codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs of distinct codes at most `distance` apart, by the Gray tree."""
    order = np.argsort(gray_rank(codes), kind="stable")
    ones, zeros = codes[order], ~codes[order]  # bits that all members of a group have, or lack
    levels = [(ones, zeros)]
    while len(ones) > 1:
        starts = np.arange(0, len(ones), FAN)
        ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
        levels.append((ones, zeros))
    a = b = np.zeros(1, dtype=np.int64)
    for ones, zeros in reversed(levels[:-1]):
        grown_a, grown_b = [], []
        for at in range(0, len(a), _CHUNK):
            kids = np.arange(FAN)
            x = (a[at : at + _CHUNK, None] * FAN + kids)[:, :, None] + 0 * kids
            y = (b[at : at + _CHUNK, None] * FAN + kids)[:, None, :] + 0 * kids[:, None]
            x, y = x.ravel(), y.ravel()
            ok = (x <= y) & (y < len(ones)) & (x < len(ones))
            x, y = x[ok], y[ok]
            ok = _apart((ones[x] & zeros[y]) | (zeros[x] & ones[y])) <= distance
            grown_a.append(x[ok])
            grown_b.append(y[ok])
        a, b = np.concatenate(grown_a), np.concatenate(grown_b)
    other = a != b
    return order[a[other]], order[b[other]]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of n is connected with."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != (up := new[new])).any():
            new = up
        label = new
        left = label[a] != label[b]
        a, b = a[left], b[left]
    return label


def _links(distance: int):
    def in_nodes(mask: np.ndarray, pattern: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        new = np.r_[True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(fp)])
        codes = fp.view(np.uint64)
        a, b = [], []
        # Nodes of one group have no upper nodes: all of them are compared at once.
        owner = np.cumsum(new) - 1
        small = sizes[owner] <= FAN
        for k in range(1, FAN):
            i = np.flatnonzero(small[: max(0, len(fp) - k)])
            i = i[owner[i] == owner[i + k]]
            i = i[_apart(codes[i] ^ codes[i + k]) <= distance]
            a.append(i)
            b.append(i + k)
        for s, n in zip(starts[sizes > FAN], sizes[sizes > FAN], strict=True):
            x, y = close_pairs(codes[s : s + n], distance)
            a.append(s + x)
            b.append(s + y)
        label = roots(len(fp), np.concatenate(a), np.concatenate(b))
        linked = np.flatnonzero(label != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[label[linked]], "b": fp[linked]})

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = (rows["mask"].to_numpy() == rows["mask"].iloc[-1]) & (rows["pattern"].to_numpy() == rows["pattern"].iloc[-1])
            cut = int(np.argmax(last))  # the last node may go on in the next batch
            if cut:
                yield in_nodes(*(rows[c].to_numpy()[:cut] for c in ("mask", "pattern", "fp")))
            rest = rows.iloc[cut:]
        if rest is not None and len(rest):
            yield in_nodes(*(rest[c].to_numpy() for c in ("mask", "pattern", "fp")))

    return links


def links(fps: DataFrame, distance: int = DISTANCE, node: int = NODE, levels: int = LEVELS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints fp exactly as all close pairs do."""

    def children(rows: DataFrame, kinds: list[tuple[int, int]]) -> DataFrame:
        """kinds: mask of the node and of a child; the node's mask is null for the root."""
        table = F.array(*[F.struct(F.lit(_signed(p)).alias("p"), F.lit(_signed(m)).alias("m")) for p, m in kinds])
        own = F.filter(table, lambda k: k["p"] == F.col("mask"))
        return rows.select("fp", F.explode(own).alias("k")).select("fp", F.col("k.m").alias("mask"), F.col("fp").bitwiseAND(F.col("k.m")).alias("pattern"))

    fixed, rows, leaves = [0], fps.select("fp", F.lit(0).cast("long").alias("mask")), None
    for level in range(levels):
        kinds = [(p, m) for p in fixed for m in masks(p, distance)]
        fixed = list(dict.fromkeys(m for _, m in kinds))
        rows = keep(children(rows, kinds), "simhash-nodes")
        if level == levels - 1:
            leaves = rows if leaves is None else leaves.unionByName(rows)
            break
        heavy = rows.groupBy("mask", "pattern").count().where(F.col("count") > node)
        heavy = keep(heavy.select(F.col("mask").alias("m"), F.col("pattern").alias("p")), "simhash-heavy")
        at = (F.col("mask") == F.col("m")) & (F.col("pattern") == F.col("p"))
        light = rows if heavy.isEmpty() else rows.join(heavy, at, "left_anti")
        leaves = light if leaves is None else leaves.unionByName(light)
        if light is rows:
            break
        rows = rows.join(heavy, at, "left_semi")
    by_node = leaves.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
    return by_node.mapInPandas(_links(distance), "a long, b long")


def _grouped(docs: DataFrame, text: str, words: int, distance: int, seed: int) -> DataFrame:
    """(doc_id, mark, fp, component_id); mark tells texts of one doc_id apart."""
    marked = docs.select("doc_id", F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    prints = keep(fingerprints(marked, "text", words, seed).select("doc_id", "mark", "fp"), "simhash-prints")
    distinct = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    labels = components(links(distinct.select("fp"), distance), "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = distinct.join(labels, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "mark", "fp", "component_id")


def groups(docs: DataFrame, text: str = "text", words: int = WORDS, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id that a document's links lead to.

    Texts without words, empty and null ones have fingerprint 0 and are linked like any
    other.  Documents with equal fingerprints are linked; only distinct fingerprints are
    searched, and a fingerprint of many documents is joined from its one row.  A row
    without doc_id takes part but is never the smallest; repeated rows give a row each.
    """
    return _grouped(docs, text, words, distance, seed).select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id, with all its columns.

    Rows without doc_id stay; rows that repeat the smallest doc_id of a group do, too.  Of
    rows that share a doc_id only those whose text is in a group of a smaller one go.
    """
    gone = _grouped(docs, text, words, distance, SEED).where(F.col("doc_id") != F.col("component_id"))
    gone = gone.select(F.col("doc_id").alias("__gone"), F.col("mark").alias("__mark")).distinct()
    return docs.join(gone, (F.col("doc_id") == F.col("__gone")) & (F.xxhash64(text) == F.col("__mark")), "left_anti")
