"""Registered queries of this package: one per operator, over its whole table."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from periodbook.llm import bpe, decontaminate, filter_audit, graph_search, licences, near_dedup, page_text, pivot_simhash, quality, ring_sharding
from periodbook.llm import segment_negatives, substring_dedup, toxicity
from periodbook.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that Python workers can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "periodbook.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder in (PACKAGE, os.path.join(PACKAGE, "llm")):
            for name in os.listdir(folder):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def register(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@register
def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


@register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@register
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = bpe.vocabulary_text()
    return bpe.digests(table(spark, sf_dir, "documents"), spec)


@register
def op6_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_sharding.ring_shards(table(spark, sf_dir, "documents"))


@register
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels"))).select("doc_id", F.round("score", 6).alias("score"), "kept")


@register
def op4_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"))


@register
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))


@register
def op7_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


@register
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


@register
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op12_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_simhash.classes(table(spark, sf_dir, "documents"))


@register
def op13_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_negatives.mine(table(spark, sf_dir, "embeddings"))


@register
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


# shares of an item's distinct runs of five words (all its words, if fewer) that a document has
ORACLE["op7_containment"] = """
WITH item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), item_shingles AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: list_slice(w, i, i + least(len(w), 5) - 1))) AS s
  FROM item_words WHERE len(w) > 0
), doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL
), doc_shingles AS (
  SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: list_slice(w, i, i + n - 1))) AS s
  FROM doc_words, (SELECT DISTINCT n FROM item_shingles) k WHERE len(w) >= n
)
SELECT d.doc_id, i.item_id, count(*)::DOUBLE / t.total AS containment
FROM item_shingles i JOIN doc_shingles d ON d.n = i.n AND d.s = i.s
JOIN (SELECT item_id, count(*) AS total FROM item_shingles GROUP BY item_id) t ON t.item_id = i.item_id
GROUP BY d.doc_id, i.item_id, t.total HAVING count(*)::DOUBLE / t.total >= 0.8
"""

# every start of a window of 20 words against the earliest start of its words
ORACLE["op10_substring_dedup"] = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)
), firsts AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS nth FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM firsts WHERE nth > 1
), placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words
), kept AS (
  SELECT placed.doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY placed.doc_id
)
SELECT words.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept ON kept.doc_id = words.doc_id
"""

# every document's failures as bits; each order's steps by the filters before them
ORACLE["op11_filter_audit"] = """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS first FROM texts GROUP BY t
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), bits AS (
  SELECT x.part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * (length(x.t) - length(regexp_replace(x.t, '[A-Z]', '', 'g'))) > 10 * length(x.t))::INT
    + 8 * regexp_matches(x.t, '[#$%&*|]')::INT + 16 * coalesce(x.doc_id > f.first, false)::INT AS fails,
    coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic
  FROM texts x JOIN firsts f ON f.t = x.t LEFT JOIN known k ON k.doc_id = x.doc_id
), counts AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM bits GROUP BY ALL
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(c, bit)
), orders AS (
  SELECT a.c || b.c || d.c || e.c || f.c AS filter_order FROM letters a, letters b, letters d, letters e, letters f
  WHERE a.bit + b.bit + d.bit + e.bit + f.bit = 31 AND a.bit | b.bit | d.bit | e.bit | f.bit = 31
), steps AS (
  SELECT o.filter_order, s.step, l.bit AS own,
    (SELECT coalesce(sum(p.bit), 0) FROM letters p WHERE position(p.c IN o.filter_order) < s.step)::INT AS before
  FROM orders o, (SELECT unnest(range(1, 6)) AS step) s JOIN letters l ON l.c = substr(o.filter_order, s.step, 1)
), result AS (
  SELECT c.part, s.filter_order, s.step, s.own,
    sum(CASE WHEN fails & (before | own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails & before = 0 AND fails & own > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails & before > 0 AND fails & own > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails & before = 0 AND fails & own > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails & before = 0 AND fails & own > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts c, steps s GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM result
"""

# integer vectors, all products of anchors with their own and with other labels
ORACLE["op13_segment_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON len(a.v) = len(c.v) AND a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
