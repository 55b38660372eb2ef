"""The corpus pipeline: from raw documents to token ids, in stages of one operator each.

A stage takes (spark, docs, sf_dir) with the columns of documents and returns a DataFrame,
which is written and read again as the next stage's docs.  All stages but the last return
the columns of documents; where a text changes, n_chars follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import bpe, lines, mixing, simhash, toxicity
from ebbline.llm.common import documents, keep
from ebbline.llm.queries import bpe_digests, word_vocabulary


def _as_before(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, with n_chars of the new text if there is such a column."""
    return changed.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects as toxic go."""
    return toxicity.reject_toxic(docs, documents(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go from the texts."""
    return _as_before(lines.dedup_lines(docs), docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; three-word shingles, at most 2 differing bits, as `op4`."""
    return simhash.near_dedup(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy the mix takes; where it takes a part, the first words of the text."""
    return _as_before(mixing.copies(mixing.mix(docs)), docs)


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of them and of the decoded text."""
    vocabulary = word_vocabulary()
    encoded = bpe.decode(bpe.encode(docs.select("doc_id", "source", "text"), vocabulary), vocabulary)
    return bpe_digests(encoded, "source", "ids")


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("bpe", bpe_round_trip),
]

#: SQL can express neither the classifier nor merging; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE = {"pipeline": run}
