"""Catalogue: embedding queue, outcomes, vector store, re-embedding."""

import hashlib
import sys
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import functions as F

from feedlake.functions import text
from feedlake.functions.text import BLANKS
from feedlake.operators import embedding as ops
from feedlake.operators.embedding import ServiceRefused
from feedlake.plans import tables as t
from feedlake.plans.catalogue import query
from feedlake.plans.tables import STORED_SQL, VEC_SQL, load
from feedlake.session import Scratch

# The stand-in embedder below travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIM = 8


def _waiting(spark, sf_dir):
    """Stored documents; stories wait for their vector."""
    stored = t.stored_docs(spark, sf_dir, "body")
    return stored.withColumn("embed_pending", F.when(F.col("kind") == "story", F.lit(True)))


_WAITING_SQL = f"""{STORED_SQL}, waiting AS (
  SELECT *, trim(title || ' ' || substr(body, 1, 500), '{BLANKS}') AS input
  FROM stored WHERE kind = 'story')"""


class HashEmbedder:
    """Stands in for the embedding service: a vector from the text's digest.

    Like the service it refuses some inputs for good and is out of reach for others, here
    by the first hex digit of the digest.
    """

    def __call__(self, item_text: str) -> list[float]:
        digest = hashlib.sha1(item_text.encode("utf-8")).hexdigest()
        if digest[0] == "0":
            raise ServiceRefused(f"bad input key={digest[:6]}", code=400)
        if digest[0] == "1":
            raise TimeoutError(f"no answer for {digest[:6]}")
        return [int(digest[2 * i:2 * i + 2], 16) / 256.0 for i in range(DIM)]


def _outcomes(spark, sf_dir, cap=None):
    queue = ops.pending_queue(_waiting(spark, sf_dir), cap=cap)
    return queue, ops.embed_outcomes(queue, ops.one_by_one(HashEmbedder), dim=DIM)


OUTCOME_SQL = f"""{_WAITING_SQL}, outcomes AS (
  SELECT item_id, expire_at, sha1(input) AS digest,
         CASE WHEN input = '' OR sha1(input)[1] = '0' THEN 'permanent'
              WHEN sha1(input)[1] = '1' THEN 'retryable' ELSE 'ok' END AS outcome,
         CASE WHEN input = '' THEN 'nothing to embed'
              WHEN sha1(input)[1] = '0' THEN 'bad input key=[redacted]'
              WHEN sha1(input)[1] = '1' THEN 'no answer for ' || substr(sha1(input), 1, 6)
              ELSE '' END AS reason FROM waiting)"""


@query("embed_queue", f"""
WITH {_WAITING_SQL}
SELECT item_id, title, body, expire_at FROM waiting""")
def embed_queue(spark, sf_dir):
    """The whole queue."""
    return ops.pending_queue(_waiting(spark, sf_dir))


@query("embed_queue_capped", f"""
WITH {_WAITING_SQL}
SELECT item_id, title, body, expire_at FROM waiting ORDER BY fetched_at, item_id LIMIT 100""")
def embed_queue_capped(spark, sf_dir):
    """The oldest hundred, for a service that allows no more calls per pass."""
    return ops.pending_queue(_waiting(spark, sf_dir), cap=100)


@query("embed_input", f"""
SELECT doc_id, trim(trim(split_part(text, chr(10), 1), '{BLANKS}') || ' ' || substr(text, 1, 500),
       '{BLANKS}') AS input FROM documents""")
def embed_input(spark, sf_dir):
    """Embedding input of every document: title and the contract's share of the body."""
    return t.doc_items(spark, sf_dir).select(
        "doc_id", text.embed_text("title", "body").alias("input"))


@query("embed_outcomes", f"WITH {OUTCOME_SQL} SELECT item_id, outcome, reason FROM outcomes")
def embed_outcomes(spark, sf_dir):
    """Outcome and reason of a call per waiting story."""
    return _outcomes(spark, sf_dir)[1].select("item_id", "outcome", "reason")


@query("embed_vectors", f"""
WITH {OUTCOME_SQL}
SELECT item_id, 8 AS dim, expire_at,
       CAST(CAST('0x' || substr(digest, 1, 2) AS INTEGER) / 256.0 AS DOUBLE) AS first_value,
       CAST(CAST('0x' || substr(digest, 15, 2) AS INTEGER) / 256.0 AS DOUBLE) AS last_value
FROM outcomes WHERE outcome = 'ok'""")
def embed_vectors(spark, sf_dir):
    """Vectors of the successful calls with the mirrored expiry."""
    queue, outcomes = _outcomes(spark, sf_dir)
    return ops.vector_entries(outcomes, queue).select(
        "item_id", F.size("vector").alias("dim"), "expire_at",
        F.element_at("vector", 1).alias("first_value"),
        F.element_at("vector", -1).alias("last_value"))


@query("embed_pass_stats", f"""
WITH {OUTCOME_SQL}
SELECT count(*) AS pending, count(*) FILTER (WHERE outcome = 'ok') AS embedded,
       count(*) FILTER (WHERE outcome = 'permanent') AS permanent,
       count(*) FILTER (WHERE outcome = 'retryable') AS retryable FROM outcomes""")
def embed_pass_stats(spark, sf_dir):
    """Counts of a pass over the whole queue, each text sent once: outcomes are stored first."""
    queue, outcomes = _outcomes(spark, sf_dir)
    with Scratch(spark, "pass-stats") as stage:
        outcomes = stage(outcomes, "outcomes")
        saved = ops.vectors_to_save(
            ops.vector_entries(outcomes, queue), _waiting(spark, sf_dir), t.now())
        stats = ops.pass_stats(outcomes, saved)
        return spark.createDataFrame(stats.collect(), stats.schema)


_NOW = f"TIMESTAMP '{t.NOW}'"


@query("mark_pending", f"""
WITH {STORED_SQL}, {VEC_SQL}
SELECT item_id FROM stored s WHERE kind = 'story' AND expire_at - {_NOW} >= INTERVAL 30 DAY
  AND NOT EXISTS (SELECT 1 FROM vec v WHERE v.item_id = s.item_id
                  AND embed_model = 'gemini-embedding-001'
                  AND embed_task_type = 'RETRIEVAL_DOCUMENT')""")
def mark_pending(spark, sf_dir):
    """Stories to embed again: no vector of the current contract, long enough to live."""
    items = t.stored_docs(spark, sf_dir).withColumn("embed_pending", F.lit(None).cast("boolean"))
    vectors = t.one_vector_per_item(t.doc_vectors(spark, sf_dir), "embed_model", "embed_task_type")
    return ops.unembedded(items, vectors, t.now(), min_life=timedelta(days=30))


@query("current_contract", f"""
WITH {STORED_SQL}, {VEC_SQL}
SELECT item_id, coalesce(embed_model = 'gemini-embedding-001', false)
   AND coalesce(embed_task_type = 'RETRIEVAL_DOCUMENT', false) AS is_current FROM vec""")
def current_contract(spark, sf_dir):
    """Which vectors belong to the current model and task type."""
    vectors = t.one_vector_per_item(t.doc_vectors(spark, sf_dir), "embed_model", "embed_task_type")
    return vectors.select("item_id", ops.is_current_contract().alias("is_current"))


def _saved(spark, sf_dir):
    """Vectors of all documents offered to a store that holds the labelled ones."""
    labels = load(spark, sf_dir, "labels").select("doc_id")
    held = t.stored_docs(spark, sf_dir).join(labels, "doc_id", "left_semi")
    entries = t.one_vector_per_item(t.doc_vectors(spark, sf_dir)).select(
        "item_id", "vector", "expire_at")
    return ops.vectors_to_save(entries, held, t.now())


_SAVED_SQL = f"""{STORED_SQL}, {VEC_SQL}, saved AS (
  SELECT item_id, vector, 'gemini-embedding-001' AS embed_model,
         'RETRIEVAL_DOCUMENT' AS embed_task_type, {_NOW} AS embedded_at, expire_at
  FROM vec WHERE item_id IN (SELECT item_id FROM stored JOIN labels USING (doc_id)))"""


@query("save_vectors", f"""
WITH {_SAVED_SQL}
SELECT item_id, embed_model, embed_task_type, embedded_at, expire_at,
       CAST(len(vector) AS INTEGER) AS dim FROM saved""")
def save_vectors(spark, sf_dir):
    """Vectors written: stamped with the contract, none for an article that is gone."""
    return _saved(spark, sf_dir).select(
        "item_id", "embed_model", "embed_task_type", "embedded_at", "expire_at",
        F.size("vector").alias("dim"))


@query("upsert_vectors", f"""
WITH {_SAVED_SQL}
SELECT item_id, embed_model, embed_task_type, embedded_at FROM saved
UNION ALL
SELECT item_id, embed_model, embed_task_type, embedded_at FROM vec
WHERE item_id NOT IN (SELECT item_id FROM saved)""")
def upsert_vectors(spark, sf_dir):
    """The vector table after that save."""
    vectors = t.one_vector_per_item(t.doc_vectors(spark, sf_dir))
    return ops.upsert_vectors(vectors, _saved(spark, sf_dir)).select(
        "item_id", "embed_model", "embed_task_type", "embedded_at")


@query("clear_pending", f"""
WITH {OUTCOME_SQL}
SELECT s.item_id, CASE WHEN s.kind = 'story' AND o.outcome <> 'permanent' THEN true END
  AS embed_pending FROM stored s LEFT JOIN outcomes o USING (item_id)""")
def clear_pending(spark, sf_dir):
    """Flags after the permanent failures left the queue without a vector."""
    permanent = _outcomes(spark, sf_dir)[1].filter(F.col("outcome") == "permanent")
    return ops.set_pending(_waiting(spark, sf_dir), permanent, False).select(
        "item_id", "embed_pending")


@query("vector_audit", """
WITH n AS (SELECT *, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)
             * CAST(x AS DOUBLE)))) AS norm FROM embeddings)
SELECT label, count(*) AS vectors, count(*) FILTER (WHERE len(embedding) <> 64) AS wrong_dim,
       round(min(norm), 6) AS min_norm, round(max(norm), 6) AS max_norm FROM n GROUP BY label""")
def vector_audit(spark, sf_dir):
    """Dimension and norm of the given vectors, per label."""
    norm = ops.vector_norm("embedding")
    return load(spark, sf_dir, "embeddings").groupBy("label").agg(
        F.count("*").alias("vectors"),
        F.count_if(F.size("embedding") != 64).alias("wrong_dim"),
        F.round(F.min(norm), 6).alias("min_norm"), F.round(F.max(norm), 6).alias("max_norm"))


@query("vector_contract_audit", f"""
WITH {STORED_SQL}, {VEC_SQL}
SELECT count(*) AS vectors, count(*) FILTER (WHERE len(vector) <> 768) AS wrong_dim,
       count(*) FILTER (WHERE NOT (coalesce(embed_model = 'gemini-embedding-001', false)
         AND coalesce(embed_task_type = 'RETRIEVAL_DOCUMENT', false))) AS stale FROM vec""")
def vector_contract_audit(spark, sf_dir):
    """How many stored vectors break the contract of dimension, model and task type."""
    vectors = t.one_vector_per_item(t.doc_vectors(spark, sf_dir))
    return ops.vector_audit(vectors).select("vectors", "wrong_dim", "stale")


@query("reembed_complete", f"""
WITH {STORED_SQL}, {VEC_SQL}
SELECT min(embedded_at) AS oldest, min(embedded_at) >= TIMESTAMP '2024-01-01 00:30:00'
  AS complete FROM vec""")
def reembed_complete(spark, sf_dir):
    """Whether every vector is younger than the start of a job."""
    vectors = t.one_vector_per_item(t.doc_vectors(spark, sf_dir), "embedded_at")
    return ops.reembedding_complete(vectors, F.lit("2024-01-01 00:30:00").cast("timestamp"))
