"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import bpe, embeddings, licenses, lines, minhash, mixing, quality, secrets, simhash, toxicity, trie, warc, whitening
from ebbline.llm.common import documents, shared_folder


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to seekable bundles and read back from them."""
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(documents(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).drop("url", "payload")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, decoded again."""
    vocabulary = word_vocabulary()
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe_digests(bpe.decode(bpe.encode(docs, vocabulary), vocabulary))


def bpe_digests(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.joined(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets and linked weak candidates of every text."""
    return secrets.scan(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later occurrences of repeated three-line windows."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "removed_lines", "text")


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash.groups(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.classify(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op8_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return minhash.edited(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        minhash.shown(F.col("fp")).alias("fingerprint"),
        minhash.shown(F.col("edited_fp")).alias("edited_fingerprint"),
        minhash.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        minhash.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return embeddings.near_duplicates(documents(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector on the leading components."""
    vectors = documents(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors).withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return trie.trie(trie.rebuilt(trie.ranked(documents(spark, sf_dir, "conversations"))))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every text."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = licenses.scan(docs).select("doc_id", "licenses.n_words", "licenses.places")
    base = F.filter("places", lambda p: p["exact"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["first_word"]).alias("first_word"),
        F.array_max(base["first_word"]).alias("last_word"),
        licenses.labels_of(base).alias("base_labels"),
        licenses.labels_of(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.col("places.share")), F.lit(0.0)).alias("score"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_bundles,
        op2_bpe_round_trip,
        op3_secret_scan,
        op4_simhash_groups,
        op5_quality,
        op6_source_mix,
        op7_toxicity,
        op8_minhash_fingerprints,
        op9_line_dedup,
        op10_embedding_dedup,
        op11_whitening,
        op12_conversation_trie,
        op13_license_scan,
    )
}

#: SQL of the queries that SQL can express.
ORACLE = {
    "op1_warc_bundles": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM q""",
    "op9_line_dedup": """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (
  SELECT doc_id, i, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS k
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d)
  WHERE trim(l[i] || l[i + 1] || l[i + 2]) <> ''),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM w) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM later),
kept AS (
  SELECT d.doc_id, count(*) FILTER (g.i IS NOT NULL) AS removed_lines,
         coalesce(string_agg(d.line, chr(10) ORDER BY d.i) FILTER (g.i IS NULL), '') AS text
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM d) d
  LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.i = d.i GROUP BY d.doc_id)
SELECT d.doc_id, CAST(coalesce(k.removed_lines, 0) AS BIGINT) AS removed_lines,
       CASE WHEN k.removed_lines > 0 THEN k.text ELSE d.text END AS text
FROM d LEFT JOIN kept k USING (doc_id)""",
    "op12_conversation_trie": r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, max(r) AS n FROM t GROUP BY c),
crc AS (
  SELECT c, n, c - c % 20 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                             lambda e, z: xor(e >> 1, 3988292384 * (e & 1)))), 4294967295) % 4 AS h
  FROM n),
g AS (SELECT q.c, q.base, q.h, least(q.h, coalesce(b.n, 0)) AS given FROM crc q LEFT JOIN n b ON b.c = q.base),
m AS (
  SELECT g.c, t.r AS d, t.role, t.text FROM g JOIN t ON t.c = g.base WHERE t.r <= g.given
  UNION ALL SELECT g.c, t.r - g.h + g.given, t.role, t.text FROM g JOIN t ON t.c = g.c WHERE t.r > g.h
  UNION ALL SELECT c, 0, '', '' FROM g),
p AS (
  SELECT c, d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, max(d) OVER (PARTITION BY c) AS last,
         string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d) AS k
  FROM m),
q AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS pk FROM p),
v AS (
  SELECT d, k, min(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = last), '')) AS ends_sha256
  FROM q GROUP BY d, k),
kids AS (SELECT pk, count(*) AS n FROM v GROUP BY pk),
w AS (SELECT v.*, coalesce(kids.n, 0) AS n_children FROM v LEFT JOIN kids ON kids.pk = v.k),
sums AS (
  SELECT p.k, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(w.saved) AS saved_tokens
  FROM w JOIN p ON p.c = w.conv_id AND p.d <= w.d GROUP BY p.k)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, w.n_convs, CAST(w.n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN sums USING (k) LEFT JOIN v up ON up.k = w.pk""",
}
