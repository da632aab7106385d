"""Embedding passes, re-embedding, retention recompute and purge over stored tables."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.operators import embedding as emb
from feedlake.operators import items as ops
from feedlake.session import Scratch
from feedlake.sources import store


def waiting(spark: SparkSession, root: str, now: datetime, *,
            min_life: timedelta = C.MIN_LIFE) -> DataFrame:
    """Ids that still want a vector, derived from the tables: no article row carries a state.

    Stories that live on, without a vector of the current contract and without a refusal of
    it. So a change of the contract queues everything again by itself.
    """
    items, vectors, failures = (
        store.read(spark, root, name) for name in ("items", "item_vectors", "embed_failures"))
    unset = items.withColumn("embed_pending", F.lit(None).cast("boolean"))
    ids = emb.unembedded(unset, vectors, now, min_life=min_life)
    refused = failures.filter(emb.is_current_contract()).select("item_id")
    return ids.join(refused, "item_id", "left_anti")


def embed_pass(
    spark: SparkSession, root: str, make_embedder, now: datetime, *, cap: int | None = None,
    min_life: timedelta = C.MIN_LIFE, **calls,
) -> dict:
    """One pass over all that waits: pending, embedded, permanent and retryable counts.

    Outcomes are stored before anything else: the calls are not repeated, and a set-up
    fault in one task stops the calls of all, with no table changed. A pass appends vectors and refusals and
    writes no article. ``cap`` limits a pass to the oldest so many.
    """
    items = store.read(spark, root, "items")
    with Scratch(spark, "embed") as stage:
        ids = waiting(spark, root, now, min_life=min_life)
        asked = items.join(ids, "item_id", "left_semi").withColumn("embed_pending", F.lit(True))
        queue = stage(emb.pending_queue(asked, cap=cap), "queue")
        outcomes = emb.stored_outcomes(queue, make_embedder, lambda df: stage(df, "outcomes"), **calls)
        saved = stage(
            emb.vectors_to_save(emb.vector_entries(outcomes, queue), items, now), "vectors")
        refused = outcomes.filter(F.col("outcome") == "permanent").select(
            "item_id", F.lit(C.EMBED_MODEL).alias("embed_model"),
            F.lit(C.EMBED_TASK_TYPE).alias("embed_task_type"), "reason",
            F.lit(now).cast("timestamp").alias("failed_at"))
        store.append(root, "item_vectors", saved)
        store.append(root, "embed_failures", refused)
        return emb.pass_stats(outcomes, saved).head().asDict()


def drain(
    spark: SparkSession, root: str, make_embedder, now: datetime, *, cap: int | None = None,
    patience: int = C.STALL_ROUNDS, **calls,
) -> dict:
    """Passes until nothing waits; stalled if the last ``patience`` passes settled nothing.

    Without a cap the first pass takes everything, and later ones only what may be retried.
    """
    settled: list[dict] = []
    stalled = False
    while not stalled:
        result = embed_pass(spark, root, make_embedder, now, cap=cap, **calls)
        if not result["pending"]:
            break
        settled.append({name: result[name] for name in ("embedded", "permanent")})
        recent = settled[-patience:]
        stalled = len(recent) == patience and not any(sum(s.values()) for s in recent)
    sums = {name: sum(s[name] for s in settled) for name in ("embedded", "permanent")}
    return {**sums, "stalled": stalled}


def _days_of(rows: DataFrame, ids: DataFrame) -> list:
    """Days that hold any of the ids: as many as the retention has at most."""
    hit = rows.select("item_id", store.DAY).join(ids.select("item_id"), "item_id", "left_semi")
    return [r[0] for r in hit.select(store.DAY).distinct().collect()]


def drop_stale_vectors(spark: SparkSession, root: str) -> None:
    """After a re-embedding, remove the vectors of other contracts."""
    vectors = store.read(spark, root, "item_vectors")
    _keep(spark, root, "item_vectors", vectors, emb.is_current_contract())


def _keep(spark: SparkSession, root: str, table: str, rows: DataFrame, kept) -> None:
    """Leave only the rows that satisfy ``kept``: days without one go, mixed days are rewritten."""
    by_day = rows.groupBy(store.DAY).agg(
        F.count("*").alias("n"), F.count_if(kept).alias("kept")).filter("kept < n").collect()
    mixed = [r[store.DAY] for r in by_day if r["kept"]]
    if mixed:
        store.overwrite_days(root, table, store.on_days(rows, mixed).filter(kept))
    store.drop_days(spark, root, table, [r[store.DAY] for r in by_day if not r["kept"]])


def recompute_retention(
    spark: SparkSession, root: str, *, ttl: timedelta = C.TTL, dry_run: bool = False
) -> dict:
    """Bring expire_at of articles and their vectors in line with ``ttl``; returns counts.

    Recomputed from fetched_at and not added to, so a second run changes nothing, and a run
    that died between the tables is finished by the next. Only days with a wrong row are
    rewritten, vectors first: an article is wrong until its own day is done.
    """
    items, vectors = store.read(spark, root, "items"), store.read(spark, root, "item_vectors")
    stats = ops.retention_stats(items, vectors, ttl=ttl).head().asDict()
    if dry_run or not stats["items_updated"]:
        return stats
    with Scratch(spark, "retention") as stage:
        targets = stage(ops.retention_targets(items, ttl=ttl), "targets")
        for table, rows in (("item_vectors", vectors), ("items", items)):
            days = _days_of(rows, targets)
            if days:
                store.overwrite_days(root, table, store.on_days(rows, days).join(
                    targets, "item_id", "left").withColumn(
                        "expire_at", F.coalesce("new_expire", "expire_at")))
    return stats


def purge(spark: SparkSession, root: str, now: datetime) -> None:
    """Remove expired articles and vectors with their files."""
    for table in ("items", "item_vectors"):
        alive = F.col("expire_at").isNull() | (F.col("expire_at") > F.lit(now))
        _keep(spark, root, table, store.read(spark, root, table), alive)
