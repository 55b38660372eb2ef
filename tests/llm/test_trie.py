"""The trie against one built turn by turn in plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import trie
from ebbline.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def conversations(rows: list[tuple]) -> dict[int, list[tuple]]:
    """Turns in order; of equal numbers, rows aren't told apart by this version."""
    out: dict[int, list] = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            out.setdefault(conv, []).append((role or "", text or ""))
    return out


def rebuilt(by_conv: dict[int, list]) -> dict[int, list]:
    out = {}
    for c, own in by_conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = by_conv.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(by_conv: dict[int, list]) -> list[tuple]:
    members: dict[tuple, list] = {}
    for c, turns in by_conv.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        own = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = own + sum(saved[k] for k in below)
    out = []
    for node, of in members.items():
        ends = ",".join(map(str, sorted(c for c in of if len(by_conv[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(of), len(node), parent, len(of), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=lambda r: (r[1], r[0]))


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def made(seed: int, convs: int, longest: int) -> list[tuple]:
    """Conversations of few different turns, so that many share their start."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.permutation(convs * 3)[:convs]:
        for t in range(int(rng.integers(1, longest))):
            rows.append((int(c), t * 2 - 3, ["user", "assistant", None][t % 3], [None, "", "one two", "three"][int(rng.integers(4) ** 2 / 4)]))
    rng.shuffle(rows)
    return [(int(a), int(b), c, d) for a, b, c, d in rows]


@pytest.mark.parametrize("height, longest", [(2, 12), (3, 40), (16, 9), (16, 60)])
def test_trie_equals_brute_force(spark, monkeypatch, height, longest):
    monkeypatch.setattr(trie, "HEIGHT", height)
    rows = made(height * longest, 120, longest)
    rows += [(1001, t, "user", f"a deep one {t // 70}") for t in range(150)] + [(1002, t, "user", f"a deep one {t // 70}") for t in range(130)]
    turns = trie.ranked(spark.createDataFrame(rows, SCHEMA).repartition(5))
    plain = conversations(rows)
    assert rows_of(trie.trie(trie.with_roots(turns))) == brute(plain)
    assert rows_of(trie.trie(trie.rebuilt(turns))) == brute(rebuilt(plain))


def test_a_conversation_in_many_tasks_keeps_its_order(spark):
    rows = [(7, t, "user", str(t * 7919 % 1000)) for t in range(20_000)] + [(8, 1, "user", "x")]
    small = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the ranges of a small table become one task
    try:
        found = {(r.conv, r.rank): r for r in trie.ranked(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", small)
    want = spark.createDataFrame(rows, SCHEMA).select("conv_id", "turn", F.xxhash64(F.lit(1), "role", "text").alias("k1")).collect()
    assert len(found) == len(rows) and found[8, 1].n == 1
    assert all(found[r.conv_id, r.turn + 1].k1 == r.k1 and found[r.conv_id, r.turn + 1].n == 20_000 for r in want if r.conv_id == 7)


def test_odd_conversations(spark):
    long = "word " * 50_000
    rows = [
        (20, None, "user", "first by null"), (20, 0, None, None), (20, 5, "user", long), (20, 5, "user", long),
        (21, 1, "user", "x"), (22, 1, "", ""), (23, 0, "user", "y"), (23, 1, "user", "y"), (23, 2, "user", "y"),
        (None, 0, "user", "of no conversation"), (None, None, None, None), (41, 0, "a", "no base"), (0, 0, "user", "only"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for i, name in enumerate(("conv", "rank", "k1", "n", "a", "b", "path", "at", "words", "block", "depth")):
        df = df.withColumn(name, F.lit(i))
    found = trie.trie(trie.rebuilt(trie.ranked(df)))
    assert rows_of(found) == brute(rebuilt(conversations(rows)))
    assert {k: v for k, v in found.dtypes if v != "bigint"} == {"ends_sha256": "string"}
    turnless = trie.rebuilt(trie.ranked(spark.createDataFrame([(41, 0, "a", "b")], SCHEMA)))
    h = zlib.crc32(b"41") % 4
    assert rows_of(trie.trie(turnless)) == brute({41: [] if h else [("a", "b")]})
    nothing = trie.trie(trie.rebuilt(trie.ranked(df.limit(0))))
    assert nothing.count() == 0


def test_many_ends_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "_PIECE", 7)
    rows = [(c, 0, "user", "hello there") for c in range(300)]
    turns = trie.ranked(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert rows_of(trie.trie(trie.with_roots(turns))) == brute(conversations(rows))


def test_query_over_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op12_conversation_trie"](spark, sf)) == brute(rebuilt(conversations(rows)))
