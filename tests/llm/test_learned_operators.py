from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ebbline.llm import embeddings, quality, toxicity
from ebbline.llm.queries import QUERIES
from ebbline.llm.simhash import roots
from tests.llm.conftest import SF

LARGE = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    ("name", "label", "most", "rest", "accuracy"), [("op5_quality", "quality", 4, 2, 0.95), ("op7_toxicity", "toxic", 5, 0, 0.93)]
)
def test_held_out_accuracy(spark, name, label, most, rest, accuracy):
    rows = QUERIES[name](spark, LARGE).join(spark.read.parquet(f"{LARGE}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % most == rest) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r[label] for r in held]) >= accuracy


def test_held_out_labels_are_not_learnt_from(spark, docs, labels):
    held = ~quality.training_rows(F.col("doc_id"))
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in quality.classify(docs, other).collect()}


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_odd_rows_and_missing_labels(spark, odd, nothing, labels, operator):
    rows = operator.classify(odd, labels.withColumn("score", F.lit(1))).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert operator.classify(nothing, labels).count() == 0
    none = operator.classify(odd, labels.limit(0)).collect()
    assert len(none) == odd.count()
    bad = labels.withColumn("quality", F.lit(None).cast("int")).withColumn("toxic", F.lit(7))
    assert operator.classify(odd, bad).count() == odd.count()


def test_the_lexicon_alone_votes_without_labels(spark, labels):
    df = spark.createDataFrame([(1, "you stupid idiot"), (2, "a kind text"), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r.predicted for r in toxicity.classify(df, labels.limit(0)).collect()}
    assert rows == {1: 1, 2: 0, 3: 0}
    assert [r.doc_id for r in toxicity.reject_toxic(df, labels.limit(0)).orderBy("doc_id").collect()] == [2, 3]


def test_held_out_toxic_rows_are_found_and_clean_ones_left(spark):
    """Recall and precision; some labels of these tables are wrong, which bounds both."""
    sf = "/root/testdata/sf0.1"
    marked = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    found = QUERIES["op7_toxicity"](spark, sf).where("held_out").join(marked, "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] >= 0.92 * (counts[1, 1] + counts[1, 0]) and counts[1, 1] >= 0.9 * (counts[1, 1] + counts[0, 1])


def test_label_model_finds_the_rates_behind_made_votes(spark):
    """From few labels and many documents; two voters that say the same thing share a weight."""
    rng = np.random.default_rng(17)
    n, hit, false = 12_000, np.array([0.5, 0.4, 0.3, 0.3, 0.2]), np.array([2e-6, 1e-5, 1e-6, 5e-6, 1e-6])
    y, words = rng.random(n) < 0.15, rng.integers(50, 400, n)
    fired = rng.random((n, 5)) < np.where(y[:, None], hit, 1 - np.exp(-false * words[:, None]))
    fired = np.c_[fired, fired[:, 0]]  # the last one follows the first
    votes = [([{"voter": int(v), "times": 1} for v in np.flatnonzero(f)] or [{"voter": 6, "times": 1}]) for f in fired]
    labels = [int(y[i]) if i < 400 else None for i in range(n)]
    table = spark.createDataFrame(list(zip(votes, words.tolist(), labels, strict=True)), "votes array<struct<voter:int,times:int>>, words int, y int")
    some = np.c_[fired, ~fired.any(axis=1)][:400]
    known = y[:400]
    model = toxicity.LabelModel(some[known].sum(axis=0) * 1.0, some[~known].sum(axis=0) * 1.0, int(known.sum()), int((~known).sum()), float(words[:400][~known].sum()))
    first = model.hit.copy()
    model = toxicity.estimate(table, model)
    truth = fired[y].mean(axis=0)
    assert np.abs(model.hit[:6] - truth).max() < 0.06 and np.abs(model.hit[:6] - truth).mean() < np.abs(first[:6] - truth).mean()
    assert model.weight[0] == model.weight[5] < 0.7 and model.weight[1:5].min() > 0.9
    row, voter, _ = toxicity._sparse(votes)
    sure = model.posterior(row, voter, words.astype(float)) >= 0.5
    assert (sure & y).sum() >= 0.97 * (y & fired.any(axis=1)).sum() and (sure & ~y).sum() <= 0.05 * sure.sum()


def test_mining_takes_one_stem_and_no_word_of_a_copied_text(spark):
    rng = np.random.default_rng(23)
    word = lambda: f"{''.join(rng.choice(list('abcdefghij'), 6))}"
    plain = lambda n: [word() for _ in range(n)]
    rows = [(0, " ".join(plain(40))) for _ in range(600)]
    for i in range(60):
        text = plain(40)
        text[int(rng.integers(40))] = f"zorkl{'abcd'[i % 4]}"
        rows.append((1, " ".join(text)))
    copied = " ".join(plain(40))
    rows += [(1, f"{copied} {word()}") for _ in range(40)]
    terms = toxicity.mine(spark.createDataFrame(rows, "y int, text string"))
    assert len([t for t in terms if t.startswith("zork")]) == 1 and not any(w.startswith(t.rstrip("*")) for t in terms for w in copied.split())
    assert toxicity.mine(spark.createDataFrame(rows[:5], "y int, text string")) == []


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)  # no feature tells alone
    model = quality.Model(x[:3000], y[:3000])
    assert (1, 0) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


# Embeddings


def brute(vectors: list[np.ndarray], threshold: float = 0.9):
    x = np.stack(vectors).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    a, b = np.nonzero(near)
    return near.sum(axis=1) - 1, roots(len(x), a, b)


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 24))
    near = base[rng.integers(0, 40, 500)] + rng.normal(scale=0.12, size=(500, 24))
    vectors = list(np.concatenate([base, near, base[:60], base[:5] * 3, np.repeat(base[:1], 80, axis=0)]).astype(np.float32))
    df = spark.createDataFrame([(i + 10, [float(c) for c in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    n, root = brute(vectors)
    for block in (2048, 50):
        rows = {r.vec_id: r for r in embeddings.near_duplicates(df, lists=12, probes=12, block=block).collect()}
        assert [rows[i + 10].n_links for i in range(len(vectors))] == n.tolist()
        assert [rows[i + 10].component_id for i in range(len(vectors))] == (root + 10).tolist()
        assert all(r.kept == (r.vec_id == r.component_id) for r in rows.values())


def test_embedding_recall_with_few_probes(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(1500, 32))
    vectors = list(np.concatenate([base, base[:800] + rng.normal(scale=0.3, size=(800, 32))]).astype(np.float32))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    n, _ = brute(vectors)
    found = embeddings.near_duplicates(df).agg(F.sum("n_links")).first()[0]
    assert n.sum() > 500 and found >= 0.9 * n.sum()


def test_embedding_recall_with_many_lists(spark):
    """1,100 lists; every list has fewer vectors than a query of 16 lists reaches."""
    rng = np.random.default_rng(13)
    base = rng.normal(size=(3000, 24))
    near = base[:1500] + rng.normal(size=(1500, 24)) * 0.12 * rng.random((1500, 1)) * 3
    x = np.concatenate([base, near]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, lists=1100, sample=4500).collect()}
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    links = (y @ y.T >= 0.9).sum(axis=1) - 1
    assert all(found[i] <= links[i] for i in range(len(x)))
    assert links.sum() > 1000 and sum(found.values()) >= 0.9 * links.sum()


def test_smallest_hashes_bound_what_tasks_hand_on(spark):
    from ebbline.llm.common import smallest_hashes

    rows = spark.range(100_000)
    few = smallest_hashes(rows, F.xxhash64("id"), 2000, 100_000)
    assert 2000 <= few.count() <= 2700
    first = rows.orderBy(F.xxhash64("id")).limit(2000)
    assert first.join(few, "id", "left_anti").isEmpty()
    assert smallest_hashes(rows, F.xxhash64("id"), 60_000, 100_000) is rows


def test_embedding_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, []),
            (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit(1)).withColumn("list", F.lit(2))
    found = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()), key=str)
    want = [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)], (0, 0, None, True)]
    assert found == sorted(want, key=str)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


# Pipeline


def test_pipeline_stages_keep_columns_and_take_effect(spark, docs):
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns and after.schema == docs.schema, name
        before = corpus_pipeline.keep(after, "stage-test")
        assert before.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert last.count() == before.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).drop("ids").collect())) == sorted(map(tuple, last.drop("ids").collect()))


def test_pipeline_stages_take_odd_rows(spark, odd, nothing):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() > 0, name
        assert stage(spark, nothing, SF).count() == 0, name
