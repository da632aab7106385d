"""The article table: stamps, first-wins de-duplication, insert, purge, retention."""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake import schemas
from feedlake.functions import classify

ITEM_COLUMNS = [f.name for f in schemas.ITEM]


def _days(ttl: timedelta) -> Column:
    return F.lit(ttl)


def family_rank(family="family", families=C.FAMILIES) -> Column:
    return F.array_position(F.array(*[F.lit(f) for f in families]), F.col(family))


def arrival_columns(items: DataFrame) -> list[str]:
    """What "first" means besides the family: fetch time, feed, response and row position."""
    return [c for c in ("fetched_at", "feed_pos", "seq", "row_pos") if c in items.columns]


def arrival_order(items: DataFrame) -> list[Column]:
    """Fetch time, family, feed position, response, row position: a total order."""
    first, *rest = arrival_columns(items)
    return [F.col(first), family_rank(), *map(F.col, rest)]


def stamp(items: DataFrame, *, ttl: timedelta = C.TTL) -> DataFrame:
    """Add kind, expire_at and, for stories only, the waiting-for-embedding flag."""
    return (
        items.withColumn("kind", classify.kind("title"))
        .withColumn("expire_at", F.col("fetched_at") + _days(ttl))
        .withColumn("embed_pending", F.when(F.col("kind") == C.STORY, F.lit(True)))
    )


def first_wins(
    items: DataFrame, *, key: str = "item_id", order=None, fields: list[str] | None = None
) -> DataFrame:
    """One row per key: the first in arrival order, with ``fields`` or all columns.

    An aggregate and not a row_number() window: every task keeps one row per key before
    the shuffle, so a url that fills a third of the batch reaches its reducer as one row
    per task. ``order`` must be a total order. Name the ``fields`` that are needed: Spark
    does not prune columns inside the aggregated row.
    """
    order = order if order is not None else arrival_order(items)
    rest = fields or [c for c in items.columns if c != key]
    winner = F.min_by(F.struct(*rest), F.struct(*order))
    return items.groupBy(key).agg(winner.alias("_first")).select(key, "_first.*")


def known_ids(ids: DataFrame, stored: DataFrame, *, key: str = "item_id") -> DataFrame:
    """Those of ``ids`` that the store holds.

    The store is the left side of a semi join: a small batch is broadcast against the
    stored keys at run time and the table is never shuffled; only its key column is read.
    """
    return stored.select(key).join(ids.select(key).distinct(), key, "left_semi")


def new_rows(batch: DataFrame, stored: DataFrame, *, key: str = "item_id") -> DataFrame:
    """Rows of the batch whose key the store does not hold, copies within the batch kept.

    The known keys are one row each and the batch is the left side, so adaptive execution
    broadcasts them or splits a hot key of the batch, however large it is.
    """
    return batch.join(known_ids(batch, stored, key=key), key, "left_anti")


def insert_if_absent(
    batch: DataFrame, stored: DataFrame, *, ttl: timedelta = C.TTL, order=None
) -> DataFrame:
    """The rows to append: first of each key, not stored yet, stamped.

    Nothing stored is ever overwritten. Running it again on the grown table gives none.
    """
    fresh = first_wins(batch, order=order).join(
        known_ids(batch, stored), "item_id", "left_anti"
    )
    return stamp(fresh, ttl=ttl)


def insert_rescanned(
    batch: DataFrame, stored: DataFrame, *, ttl: timedelta = C.TTL, key: str = "item_id"
) -> DataFrame:
    """insert_if_absent for a stored batch that is mostly known already, as every rescan is.

    The choice is made on the key and the arrival columns alone. Wide rows are only read
    for the few that win, mostly against a broadcast of those, and a wide shuffle never
    sees a known article. For a first load, where most rows are new, ``insert_if_absent``
    moves the rows once and is the better one.
    """
    ranked = batch.withColumn("_rank", family_rank())
    order = ["fetched_at", "_rank", *arrival_columns(batch)[1:]]
    winners = ranked.groupBy(key).agg(F.min(F.struct(*order)).alias("_at"))
    new = winners.join(known_ids(batch, stored, key=key), key, "left_anti").select(
        F.col(key).alias("_key"), *[F.col(f"_at.{c}").alias(f"_new_{c}") for c in order])
    same = F.col(key) == F.col("_key")
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    chosen = ranked.join(new, same, "left_semi").drop("_rank")
    return stamp(first_wins(chosen, key=key), ttl=ttl)


def as_item(df: DataFrame) -> DataFrame:
    """Only the stored columns, in contract order."""
    return df.select(*ITEM_COLUMNS)


def new_counts(fresh: DataFrame) -> DataFrame:
    """New rows per feed of an insert."""
    return fresh.groupBy("family", "feed_id").agg(F.count("*").alias("new_count"))


def purge_expired(df: DataFrame, now: datetime | Column) -> DataFrame:
    """Drop rows past their expire_at; rows without one stay. Never for state tables."""
    return df.filter(F.col("expire_at").isNull() | (F.col("expire_at") > F.lit(now)))


# --- retention recompute ---------------------------------------------------

def retention_targets(items: DataFrame, *, ttl: timedelta = C.TTL) -> DataFrame:
    """Ids whose expire_at differs from fetched_at + ttl, with the right value."""
    target = F.col("fetched_at") + _days(ttl)
    return items.filter(
        F.col("fetched_at").isNotNull() & ~F.col("expire_at").eqNullSafe(target)
    ).select("item_id", target.alias("new_expire"))


def recompute_item_expiry(items: DataFrame, *, ttl: timedelta = C.TTL) -> DataFrame:
    """expire_at from fetched_at; map-only. Rows without fetched_at stay untouched."""
    return items.withColumn(
        "expire_at",
        F.when(F.col("fetched_at").isNull(), F.col("expire_at"))
        .otherwise(F.col("fetched_at") + _days(ttl)),
    )


def recompute_vector_expiry(
    vectors: DataFrame, items: DataFrame, *, ttl: timedelta = C.TTL
) -> DataFrame:
    """Vectors take the new expire_at of an item that needs one; all others stay."""
    targets = retention_targets(items, ttl=ttl)
    return (
        vectors.join(targets, "item_id", "left")
        .withColumn("expire_at", F.coalesce("new_expire", "expire_at"))
        .drop("new_expire")
    )


def retention_stats(items: DataFrame, vectors: DataFrame, *, ttl: timedelta = C.TTL) -> DataFrame:
    """scanned, items_updated, vectors_updated, already_ok, no_fetched_at, oldest_fetched_at.

    Both counts come from one union of narrow rows and one aggregate.
    """
    target = F.col("fetched_at") + _days(ttl)
    ok = F.col("expire_at").eqNullSafe(target)
    known = F.col("fetched_at").isNotNull()
    marked = items.select(
        F.lit(1).alias("scanned"),
        (known & ~ok).cast("int").alias("items_updated"),
        F.lit(0).alias("vectors_updated"),
        (known & ok).cast("int").alias("already_ok"),
        (~known).cast("int").alias("no_fetched_at"),
        "fetched_at",
    )
    touched = vectors.select("item_id").join(
        retention_targets(items, ttl=ttl), "item_id", "left_semi"
    ).select(
        F.lit(0).alias("scanned"), F.lit(0).alias("items_updated"),
        F.lit(1).alias("vectors_updated"), F.lit(0).alias("already_ok"),
        F.lit(0).alias("no_fetched_at"), F.lit(None).cast("timestamp").alias("fetched_at"),
    )
    sums = ["scanned", "items_updated", "vectors_updated", "already_ok", "no_fetched_at"]
    return marked.unionByName(touched).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        F.min("fetched_at").alias("oldest_fetched_at"),
    )
