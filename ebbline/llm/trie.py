"""Prefix trie of conversations, rolled up by bands of depth.

A node is a sequence of turns that at least one conversation starts with.  Texts stay where
they are read: a turn is shuffled as 128 bits of hash and a count of words, and the hash of a
sequence is the exclusive or of its turns' hashes, each taken with its place.  So prefixes
of a long conversation are hashed block by block, the blocks block by block again, and no
task needs a conversation whole.

Bands are ``HEIGHT`` depths high.  A node explodes to its ancestors within its band only,
which gives every node the total of its subtree down to the band's end.  The roots of bands
form a trie of their own, ``HEIGHT`` times flatter, which is rolled up in the same way; then
each root's completed total goes to the nodes of the band above it that lead there.
A conversation of n turns takes log(n) to the base of ``HEIGHT`` rounds, and a node explodes
to at most ``HEIGHT`` rows for its own band and as many for the band above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import keep, words_of

HEIGHT = 16
#: Contract of the rebuilt conversations: those of one stride share up to KINDS - 1 turns.
STRIDE, KINDS = 20, 4
#: Ids of one piece of text that is hashed as part of a longer one.
_PIECE = 1 << 16


def _hashes(first: int, *of: Column) -> list[Column]:
    return [F.xxhash64(F.lit(first + i), *of) for i in range(2)]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds p, the partition, and r, a row's place among its conversation's there."""
    p, last, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column("conv").to_numpy()
        if not len(conv):
            continue
        new = np.r_[conv[0] != last, conv[1:] != conv[:-1]]
        starts = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -1))
        r = np.arange(len(conv)) - starts + 1
        r[starts < 0] = n + np.arange(1, int((starts < 0).sum()) + 1)
        last, n = conv[-1], int(r[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(conv), p, dtype=np.int32)), pa.array(r)], names=[*batch.schema.names, "p", "r"]
        )


def ranked(conversations: DataFrame) -> DataFrame:
    """(conv, rank, k1, k2, words, n): each turn's place from 1, its hash, the words of its
    text, and the turns of its conversation.

    Turns are sorted over ranges, so that a conversation of any length is dealt to many
    tasks; a place is that in its task plus the turns of the tasks before.  Turns of equal
    number stand in the order of their hashes.  A null number comes first, a null role or
    text is empty, and rows without conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    k1, k2 = _hashes(1, role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", k1.alias("k1"), k2.alias("k2"), F.size(words_of(text)).cast("long").alias("words")
    )
    turns = keep(turns, "trie-digests")  # cutting ranges reads its input twice, and texts are long
    order = ("conv", "turn", "k1", "k2")
    schema = f"conv long, turn {turns.schema['turn'].dataType.simpleString()}, k1 long, k2 long, words long, p int, r long"
    placed = keep(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_numbered, schema).drop("turn"), "trie-turns")
    pieces = placed.groupBy("conv", "p").agg(F.max("r").alias("held"))  # of a conversation, one for each task it is in
    of = Window.partitionBy("conv")
    before = F.coalesce(F.sum("held").over(of.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = pieces.select("conv", "p", before.alias("before"), F.sum("held").over(of).alias("n"))
    return placed.join(offsets, ["conv", "p"]).select("conv", (F.col("r") + F.col("before")).alias("rank"), "k1", "k2", "words", "n")


def rebuilt(turns: DataFrame, stride: int = STRIDE, kinds: int = KINDS) -> DataFrame:
    """Conversations (as of :func:`ranked`) whose first turns are those of another one.

    Of conversation c the first h = crc32(c) % kinds turns are replaced by as many first turns
    of conversation c - c % stride, as far as it has them.  Returns (conv, rank, k1, k2, words,
    n) with a row of rank 0 and no words for each conversation, those without turns included.
    """
    convs = keep(turns.groupBy("conv").agg(F.max("n").alias("n")), "trie-convs")
    base = F.col("conv") - F.col("conv") % stride
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % kinds
    heads = turns.where((F.col("rank") < kinds) & (F.col("conv") % stride == 0))
    by_base = convs.where(F.col("conv") % stride == 0).select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    given = F.least("h", F.coalesce("n_base", F.lit(0)))
    plan = convs.select("conv", "n", base.alias("base"), h.alias("h")).join(by_base, "base", "left")
    plan = keep(plan.select("conv", "base", "h", given.alias("given"), (given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-plan")
    # Few conversations have one base, so that the join on it is even.
    taken = plan.where("given > 0").join(heads.select(F.col("conv").alias("base"), "rank", "k1", "k2", "words"), "base").where("rank <= given")
    own = turns.where(F.col("rank") > h).drop("n").join(plan, "conv")
    columns = ["conv", "rank", "k1", "k2", "words", "length"]
    start = plan.select("conv", F.lit(0).cast("long").alias("rank"), *[F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "words")], "length")
    every = own.withColumn("rank", F.col("rank") - F.col("h") + F.col("given")).select(columns).unionByName(taken.select(columns))
    return every.unionByName(start).withColumnRenamed("length", "n")


def with_roots(turns: DataFrame) -> DataFrame:
    """Conversations as of :func:`ranked`, unchanged, with the row of rank 0 that the trie starts from."""
    start = turns.groupBy("conv").agg(F.max("n").alias("n"))
    return turns.unionByName(start.select("conv", *[F.lit(0).cast("long").alias(c) for c in ("rank", "k1", "k2", "words")], "n"))


def _prefixes(rows: DataFrame, top: int) -> DataFrame:
    """Adds a and b, for e1 and e2 the exclusive or over the rows of conv up to ``at``."""
    rows = rows.withColumn("block", F.floor(F.col("at") / HEIGHT))
    so_far = Window.partitionBy("conv", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("a", F.bit_xor("e1").over(so_far)).withColumn("b", F.bit_xor("e2").over(so_far))
    if top < HEIGHT:
        return inside
    blocks = keep(rows.groupBy("conv", F.col("block").alias("at")).agg(F.bit_xor("e1").alias("e1"), F.bit_xor("e2").alias("e2")), "trie-blocks")
    before = _prefixes(blocks, top // HEIGHT).select("conv", (F.col("at") + 1).alias("block"), F.col("a").alias("xa"), F.col("b").alias("xb"))
    joined = inside.join(before, ["conv", "block"], "left")
    return joined.withColumn("a", F.col("a").bitwiseXOR(F.coalesce("xa", F.lit(0)))).withColumn("b", F.col("b").bitwiseXOR(F.coalesce("xb", F.lit(0)))).drop("xa", "xb")


def _with_path(rows: DataFrame) -> DataFrame:
    """Adds path, the nodes from the band's first to the row's own."""
    upward = Window.partitionBy("conv", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("path", F.collect_list(F.struct("a", "b")).over(upward))


def _summed(rows: DataFrame, nodes: str) -> DataFrame:
    """Totals by node of rows (leaves, saved) exploded to the array ``nodes``."""
    spread = rows.select(F.explode(nodes).alias("to"), "leaves", "saved")
    return spread.groupBy("to.a", "to.b").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _rolled_up(valued: DataFrame, rows: DataFrame, top: int) -> DataFrame:
    """(a, b, leaves, saved) over whole subtrees.

    valued: (a, b, path, leaves, saved), a row for each node; rows: (conv, at, a, b), the
    nodes along each conversation, ``at`` counted from 0 to ``top`` in steps of this level.
    """
    inside = keep(_summed(valued, "path"), "trie-bands")
    if top < HEIGHT:
        return inside
    starts = keep(rows.where(F.col("at") % HEIGHT == 0).select("conv", (F.col("at") / HEIGHT).cast("long").alias("at"), "a", "b"), "trie-starts")
    paths = _with_path(starts.withColumn("block", F.floor(F.col("at") / HEIGHT))).groupBy("a", "b").agg(F.first("path").alias("path"))
    flatter = paths.join(inside, ["a", "b"])
    whole = _rolled_up(flatter, starts, top // HEIGHT)
    # The band above a band's root, along any conversation that leads there: all give the same nodes.
    band = rows.groupBy("conv", (F.floor(F.col("at") / HEIGHT) + 1).alias("at")).agg(F.collect_list(F.struct("a", "b")).alias("above"))
    above = starts.where("at > 0").join(band, ["conv", "at"]).groupBy("a", "b").agg(F.first("above").alias("above"))
    passed = _summed(above.join(whole, ["a", "b"]), "above")
    return keep(inside.unionByName(passed).groupBy("a", "b").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "trie-totals")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node as comma-joined text, with the first id of each."""
    for batch in batches:
        a, b, conv = (batch.column(c).to_numpy() for c in ("a", "b", "conv"))
        if not len(a):
            continue
        cuts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        cuts = np.unique(np.concatenate([np.arange(s, e, _PIECE) for s, e in zip(cuts, np.r_[cuts[1:], len(a)], strict=True)]))
        ends = np.r_[cuts[1:], len(a)]
        texts = [",".join(map(str, conv[s:e].tolist())) for s, e in zip(cuts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[cuts]), pa.array(b[cuts]), pa.array(conv[cuts]), pa.array(texts, type=pa.string())], names=["a", "b", "first", "ids"]
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each node's pieces, joined by commas; pieces of a node follow one another."""
    node, digest = None, None

    def done(found: list) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["a", "b", "ends_sha256"])

    for batch in batches:
        found = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
            if node == (a, b):
                digest.update(b"," + ids.encode())
                continue
            if node is not None:
                found.append((*node, digest.hexdigest()))
            node, digest = (a, b), hashlib.sha256(ids.encode())
        yield done(found)
    if node is not None:
        yield done([(*node, digest.hexdigest())])


def _ends(members: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the nodes where conversations (a, b, conv) end.

    Ids are sorted over ranges and joined to pieces there, so that what one task hashes for a
    node of many ends is a row for each 65,536 of them.
    """
    order = ("a", "b", "conv")
    pieces = members.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, "a long, b long, first long, ids string")
    return pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_digests, "a long, b long, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """A row for each node of the trie of conversations (conv, rank, k1, k2, words, n), rank 0 included.

    conv_id, the smallest of the n_convs conversations that start with the node's turns, with
    depth names a node; parent_conv_id names its parent (null for the root).  n_children are
    its child nodes, n_leaves the nodes without children in its subtree, itself included,
    and saved_tokens the words that storing each last turn once saves there, n_convs - 1
    times its words for each node.  ends_sha256 is the hash of the ids of conversations that
    end there, ascending and comma-joined.  No conversations give no row.
    """
    e1, e2 = _hashes(3, F.col("rank"), F.col("k1"), F.col("k2"))
    placed = turns.select(
        "conv",
        F.col("rank").alias("at"),
        "words",
        (F.col("rank") == F.col("n")).alias("last"),
        *[F.when(F.col("rank") > 0, e).otherwise(0).alias(c) for c, e in (("e1", e1), ("e2", e2))],
    )
    placed = keep(placed, "trie-placed")
    top = placed.agg(F.max("at")).first()[0] or 0
    rows = keep(_with_path(_prefixes(placed, top)).drop("block"), "trie-rows")
    above = [F.col(x).bitwiseXOR(F.col(e)) for x, e in (("a", "e1"), ("b", "e2"))]
    nodes = rows.groupBy("a", "b", F.col("at").alias("depth")).agg(
        F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("words").alias("words"),
        F.max(above[0]).alias("pa"),
        F.max(above[1]).alias("pb"),
        F.first("path").alias("path"),  # equal for all that start with these turns
    )
    nodes = keep(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    valued = keep(nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-valued")
    leaf, saved = (F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("words")
    totals = _rolled_up(valued.select("a", "b", "path", leaf.alias("leaves"), saved.alias("saved")), rows.select("conv", "at", "a", "b"), top)
    ends = _ends(rows.where("last").select("a", "b", "conv"))
    # One row for each parent: Spark splits the children of a node that has very many.
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent"))
    named = valued.drop("path").join(totals, ["a", "b"]).join(ends, ["a", "b"], "left").join(parents, ["pa", "pb"], "left")
    return named.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
