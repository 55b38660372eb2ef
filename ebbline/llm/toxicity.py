"""Toxicity by weak supervision.

Voters are a lexicon and stems (words, and beginnings of words) mined from labelled training
rows: every term that tells toxic rows from clean ones more surely than chance would among
as many terms, one voter for terms that begin alike.  A voter votes toxic or abstains.

The generative label model starts from the voters' records on the labelled rows and then
estimates by expectation and maximisation over all documents how often each voter fires on
toxic and on clean ones, so from how voters agree.  Voters that fire together more often
than toxicity explains share a weight.  Its posteriors, not the labels, train the linear
classifier that scores documents.

Mining and starting values use at most ``SAMPLE`` labelled rows and the classifier as many
documents more, those of smallest hash; votes and their statistics cover all documents.
Documents are read once for their votes, which are kept as a small table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.llm.common import keep, small_batches, smallest_hashes

#: Words of open insult that vote whatever the labels say.
LEXICON = ("idiot", "moron", "stupid", "loser", "trash", "scum", "pathetic", "worthless", "disgusting", "clown", "dumbass", "retard")
SAMPLE = 20_000
#: Toxic rows that a term must stand in.
SUPPORT = 3
#: Toxic rows that a term stands in for each clean one, at least.
PURITY = 8
#: Passes in which the label model estimates its rates.
PASSES = 6
#: Lengths of the beginnings that are patterns.
PREFIXES = range(4, 9)
_WORD = re.compile(r"[^\W\d_]+")


def found_words(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


class Voters:
    """Terms by number; a term that ends with * is a beginning of words."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.words = {t: i for i, t in enumerate(terms) if not t.endswith("*")}
        self.starts = {t[:-1]: i for i, t in enumerate(terms) if t.endswith("*")}
        self.lengths = sorted({len(t) for t in self.starts})

    def votes(self, text: str | None) -> tuple[dict[int, int], int]:
        """How often each voter's term is met, and how many different words there are."""
        out: dict[int, int] = {}
        found = found_words(text)
        for word, n in found.items():
            for i in self.of(word):
                out[i] = out.get(i, 0) + n
        return out, len(found)

    def of(self, word: str) -> list[int]:
        """The voters whose term a word is."""
        out = [i] if (i := self.words.get(word)) is not None else []
        for k in self.lengths:
            if len(word) >= k and (i := self.starts.get(word[:k])) is not None:
                out.append(i)
        return out


def voting(terms: list[str]):
    """A column function from text to its votes [(voter, times)] and different words.

    A text without a vote has that of silence, which comes after all terms.
    """

    @F.arrow_udf("struct<votes:array<struct<voter:int,times:int>>,words:int>")
    def vote(texts: pa.Array) -> pa.Array:
        voters, votes, words = Voters(terms), [], []
        for t in texts:
            met, n = voters.votes(t.as_py())
            votes.append([{"voter": i, "times": k} for i, k in sorted((met or {len(terms): 1}).items())])
            words.append(n)
        kind = pa.list_(pa.struct([("voter", pa.int32()), ("times", pa.int32())]))
        return pa.StructArray.from_arrays([pa.array(votes, type=kind), pa.array(words, type=pa.int32())], names=["votes", "words"])

    return vote


@F.arrow_udf(T.ArrayType(T.StringType()))
def _terms(texts: pa.Array) -> pa.Array:
    """Words and beginnings of words of each text."""
    out = []
    for text in texts:
        words = set(_WORD.findall((text.as_py() or "").lower()))
        out.append(sorted({*words, *(w[:k] + "*" for w in words for k in PREFIXES if len(w) > k)}))
    return pa.array(out, type=pa.list_(pa.string()))


def _counting(terms: list[str]):
    """Counts, in a task, the rows (y, text) of each label that terms stand in."""

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, held = Voters(terms), np.zeros((2, len(terms)), dtype=np.int64)
        for batch in batches:
            for y, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                met, _ = voters.votes(text)
                held[y, list(met)] += 1
        some = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[1, some]), pa.array(held[0, some])], names=["i", "toxic", "clean"])

    return counting


def _beside(terms: list[str]):
    """A column function from text to [(term, side, neighbour)]: hashes of the words next to where a term is met first."""

    @F.arrow_udf("array<struct<i:int,side:int,beside:bigint>>")
    def beside(texts: pa.Array) -> pa.Array:
        voters, out = Voters(terms), []
        for text in texts:
            words = ["", *_WORD.findall((text.as_py() or "").lower()), ""]
            first: dict[int, int] = {}
            for at, word in enumerate(words[1:-1], 1):
                for i in voters.of(word):
                    first.setdefault(i, at)
            out.append([{"i": i, "side": s, "beside": xxhash.xxh64_intdigest(words[at + 2 * s - 1]) - 2**63} for i, at in first.items() for s in (0, 1)])
        return pa.array(out, type=pa.list_(pa.struct([("i", pa.int32()), ("side", pa.int32()), ("beside", pa.int64())])))

    return beside


def labelled(docs: DataFrame, labels: DataFrame, label: str, training: Column, sample: int) -> DataFrame:
    """(doc_id, text, y) of the training rows among the `sample` rows of smallest hash.

    Of rows of ``labels`` that share a doc_id one counts, of the smallest label, and of
    documents that share one that of the smallest text, so that `sample` bounds the rows.
    """
    rows = labels.where(F.col(label).isin(0, 1) & training).groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y"))
    hashed = F.xxhash64(F.lit(5), F.col("doc_id"))
    few = smallest_hashes(rows, hashed, sample, rows.count())
    some = few.orderBy(hashed, "doc_id").limit(sample)
    met = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # at most `sample` rows
    return met.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("y").alias("y"))


def mine(rows: DataFrame) -> list[str]:
    """Terms that tell the toxic rows (y, text) from the others, of those that begin alike the surest.

    Tested is every term that stands in SUPPORT or more toxic rows, of which the bounded sample
    has so many.  A term's evidence is the likelihood of its toxic and clean rows under its
    own share over that under the share of all rows.  Among n terms chance gives some one
    log(n) of it, so that much and 1 more is asked for.  It must hold of rows, and again if
    rows where the term stands after the same word count once, and if those where it stands
    before the same one do: every word of a text that is copied often would tell otherwise.
    """
    by_label = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(by_label) < 2:
        return []
    share = by_label[1] / (by_label[0] + by_label[1])
    often = rows.where("y = 1").select(F.explode(_terms("text")).alias("term")).groupBy("term").count().where(F.col("count") >= SUPPORT)
    tested = sorted(r["term"] for r in often.collect())
    least = math.log(max(1, len(tested))) + 1

    def evidence(toxic: int, clean: int) -> float:
        n = toxic + clean
        if toxic < SUPPORT or toxic < PURITY * clean:
            return 0.0
        return toxic * math.log(toxic / n / share) + (clean * math.log(clean / n / (1 - share)) if clean else 0.0)

    counted = rows.select("y", "text").mapInArrow(_counting(tested), "i int, toxic long, clean long").groupBy("i").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sure = sorted(tested[r["i"]] for r in counted.collect() if evidence(r["toxic"], r["clean"]) >= least)
    met = rows.select("y", F.explode(_beside(sure)("text")).alias("b")).select("y", "b.*").distinct()
    fewest = lambda y: F.least(*[F.count_if((F.col("y") == y) & (F.col("side") == k)) for k in (0, 1)])
    again = met.groupBy("i").agg(fewest(1).alias("toxic"), fewest(0).alias("clean")).collect()
    surest = [(sure[r["i"]], e) for r in again if (e := evidence(r["toxic"], r["clean"])) >= least]
    chosen, begun = [], set()
    for term, _ in sorted(surest, key=lambda t: (-t[1], len(t[0]), t[0])):
        stem = term.removesuffix("*")
        if stem in begun or any(stem[:k] + "*" in begun for k in range(1, len(stem) + 1)):
            continue  # a beginning or a continuation of a surer one
        chosen.append(term)
        begun.update(stem[:k] for k in range(1, len(stem) + 1))
        begun.add(stem + "*")
    return chosen


class LabelModel:
    """How often voters fire on toxic documents, and on a word of clean ones, and what votes weigh.

    A toxic document means its votes, however long it is; a clean one meets a term by
    chance, so the more often the more words it has.  Silence, the last voter, fires where
    no other does and speaks for clean.
    """

    def __init__(self, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, words: float):
        """toxic, clean: votes of each voter on labelled rows; words: different words of the clean rows, summed up."""
        self.prior = float(np.clip((n_toxic + 1) / (n_toxic + n_clean + 10), 0.005, 0.5))
        self.weight = np.ones(len(toxic))
        if n_toxic + n_clean:
            self.update(toxic + clean, toxic, n_toxic + n_clean, n_toxic, words)
        else:  # without labels voters are trusted
            self.hit, self.false = np.full(len(toxic), 0.1), np.full(len(toxic), 1e-5)
            self.false[-1] = 0.9

    def update(self, fired: np.ndarray, weighed: np.ndarray, documents: float, toxic: float, words: float) -> None:
        """New rates from votes, and votes weighed by posteriors, over documents of which `toxic` are expected."""
        spared, clean = np.maximum(fired - weighed, 0), max(documents - toxic, 0)
        self.hit = np.clip((weighed + 0.5) / (toxic + 1), 1e-6, 0.95)
        self.false = np.clip((spared + 0.1) / (words + 10_000), 1e-12, 0.9)
        self.false[-1] = (spared[-1] + 0.5) / (clean + 1)

    def odds(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Log odds of any document; what each vote adds, and takes for each unit of the logarithm of words."""
        per_word = self.weight.copy()
        per_word[-1] = 0
        return math.log(self.prior / (1 - self.prior)), self.weight * np.log(self.hit / self.false), per_word

    def posterior(self, row: np.ndarray, voter: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Of rows given by their votes (row, voter) and words."""
        start, odds, per_word = self.odds()
        z = start + np.bincount(row, weights=odds[voter] - per_word[voter] * np.log(np.maximum(words, 1))[row], minlength=len(words))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _doubles(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def estimate(votes: DataFrame, model: LabelModel, passes: int = PASSES) -> LabelModel:
    """The model with rates and weights estimated on all documents (votes: [(voter, times)], words, y).

    A document has its label if y isn't null, and else its posterior; the prior stays that of
    the labelled rows.  Each pass is one aggregate over the votes; what is collected is a row
    for each voter.
    """
    m, voters = len(model.hit), F.col("votes.voter")
    for _ in range(passes):
        start, odds, per_word = model.odds()
        each, taken, length = _doubles(odds), _doubles(per_word), F.log(F.greatest(F.col("words"), F.lit(1)))
        z = F.aggregate(F.transform(voters, lambda v: each[v] - taken[v] * length), F.lit(start), lambda s, x: s + x)  # noqa: B023
        told = votes.select(F.coalesce(F.col("y").cast("double"), 1 / (1 + F.exp(-z))).alias("p"), "words", F.explode(F.array_append(voters, F.lit(m))).alias("voter"))
        summed = told.groupBy("voter").agg(F.count("*").alias("n"), F.sum("p").alias("p"), F.sum((1 - F.col("p")) * F.col("words")).alias("words"))
        sums = {r["voter"]: (r["n"], r["p"], r["words"]) for r in summed.collect()}
        fired, weighed = (np.array([sums.get(v, (0, 0.0))[k] for v in range(m)], dtype=float) for k in (0, 1))
        documents, toxic, words = sums.get(m, (0, 0.0, 0.0))
        model.update(fired, weighed, documents, toxic, words)
    terms = F.filter(voters, lambda v: v < m - 1)
    met = votes.select(F.explode(terms).alias("i"), terms.alias("all")).select("i", F.explode("all").alias("j")).where("i != j")
    together = met.groupBy("i", "j").count().collect()  # pairs of voters, whatever the number of documents
    i, j, n = (np.array([r[k] for r in together], dtype=int) for k in ("i", "j", "count"))
    # Toxicity alone would bring two voters together so often; what is beyond ties them.
    alone = weighed[i] * weighed[j] / max(toxic, 1)
    excess = (n - alone) / np.sqrt(np.maximum(fired[i] * fired[j], 1))
    tied = np.bincount(i, weights=np.clip(excess, 0, 1), minlength=m) if len(i) else np.zeros(m)
    model.weight = np.maximum(1 / (1 + tied), 0.5)
    return model


def fit_linear(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, width: int, rounds: int = 40, penalty: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft labels, of sparse rows; the last weight is the intercept.

    Newton steps, each solved by conjugate gradients.
    """
    n = len(y)
    row, column, value = np.r_[row, np.arange(n)], np.r_[column, np.full(n, width)], np.r_[value, np.ones(n)]
    times = lambda w: np.bincount(row, weights=value * w[column], minlength=n)
    back = lambda r: np.bincount(column, weights=value * r[row], minlength=width + 1)
    w, ridge = np.zeros(width + 1), penalty * n + 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        gradient, curve = back(p - y) + ridge * w, p * (1 - p)
        step, rest = np.zeros(width + 1), gradient.copy()
        ahead, size = rest.copy(), rest @ rest
        for _ in range(2 * (width + 1)):
            if size < 1e-16 * max(1.0, gradient @ gradient):
                break
            bent = back(curve * times(ahead)) + ridge * ahead
            far = size / (ahead @ bent)
            step, rest = step + far * ahead, rest - far * bent
            size, last = rest @ rest, size
            ahead = rest + size / last * ahead
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sparse(votes: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, voter and times (logarithm) of every vote."""
    row = np.repeat(np.arange(len(votes)), [len(v) for v in votes])
    flat = [x for v in votes for x in v]
    return row, np.array([x["voter"] for x in flat], dtype=int), np.log1p(np.array([x["times"] for x in flat], dtype=float))


def score(docs: DataFrame, labels: DataFrame, training: Column, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score) of every row of documents (doc_id, text).

    `training` says of a labels row, by its doc_id, whether it may be learnt from.  Null
    and empty texts have no votes and get the score of such texts; without labels the
    lexicon alone votes, and labels other than 0 and 1 are none.  Rows that repeat a doc_id
    are scored each.
    """
    small_batches(docs.sparkSession)
    rows = keep(labelled(docs, labels, label, training, sample), "toxic-sample")
    terms = list(dict.fromkeys([*LEXICON, *mine(rows)]))
    m, vote = len(terms) + 1, voting(terms)
    told = F.broadcast(rows.select(F.col("doc_id").alias("told"), "y"))  # at most `sample` rows
    votes = docs.select("doc_id", vote("text").alias("v")).join(told, F.col("doc_id") == F.col("told"), "left")
    votes = keep(votes.select("doc_id", "v.votes", "v.words", "y"), "toxic-votes")
    known = rows.select("y", vote("text").alias("v")).select("y", "v.votes", "v.words").collect()
    y = np.array([r["y"] for r in known], dtype=int)
    row, voter, _ = _sparse([r["votes"] for r in known])
    toxic, clean = (np.bincount(voter[y[row] == k], minlength=m).astype(float) for k in (1, 0))
    model = LabelModel(toxic, clean, int((y == 1).sum()), int((y == 0).sum()), float(sum(r["words"] for r in known if r["y"] == 0)))
    model = estimate(votes, model)
    hashed = F.xxhash64(F.lit(7), F.col("doc_id"))
    few = smallest_hashes(votes, hashed, sample, votes.count())
    more = few.orderBy(hashed, "words", F.col("votes").cast("string")).limit(sample).select("votes", "words").collect()
    # Single votes in short texts, and none, are trained on even where no row is there to vote on.
    made = [([{"voter": v, "times": 1}], n) for v in range(m - 1) for n in (20, 100)] + [([{"voter": m - 1, "times": 1}], 100)] * m
    trained = [(r["votes"], r["words"]) for r in [*known, *more]] + made
    row, voter, times = _sparse([t[0] for t in trained])
    words = np.array([t[1] for t in trained], dtype=float)
    soft = model.posterior(row, voter, words)
    # Inputs: which voters fired, how often, and the length of the text once for each vote.
    some = voter < m - 1
    length = np.log(np.maximum(words, 1))[row]
    inputs = np.r_[row, row, row[some]], np.r_[voter, voter + m, np.full(some.sum(), 2 * m)], np.r_[np.ones(len(row)), times, length[some]]
    weights = fit_linear(*inputs, soft, 2 * m + 1)
    first, again, per_word = _doubles(weights[:m]), _doubles(weights[m : 2 * m]), _doubles(np.r_[np.full(m - 1, weights[2 * m]), 0.0])
    size = F.log(F.greatest(F.col("words"), F.lit(1)))
    told = F.transform("votes", lambda v: first[v["voter"]] + again[v["voter"]] * F.log1p(v["times"].cast("double")) + per_word[v["voter"]] * size)
    z = F.aggregate(told, F.lit(float(weights[-1])), lambda s, x: s + x)
    return votes.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def training_rows(doc_id: Column) -> Column:
    """Rows that may be learnt from: crc32 of the doc_id's text modulo 5 isn't 0."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted."""
    scored = score(docs, labels, training_rows(F.col("doc_id")))
    held = F.coalesce(~training_rows(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that aren't predicted toxic, with all their columns.

    Rows that share a doc_id go if one of them is toxic; rows without doc_id stay.
    """
    toxic = classify(docs, labels, threshold).where("predicted = 1").select(F.col("doc_id").alias("__toxic")).distinct()
    return docs.join(toxic, F.col("doc_id") == F.col("__toxic"), "left_anti")
