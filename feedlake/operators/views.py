"""Reader views, reports and the status board."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions import clock, text
from feedlake.functions.classify import keep_in_feed
from feedlake.operators.health import is_ok


def _now(now: datetime | Column) -> Column:
    return F.lit(now).cast("timestamp")


# --- reader ----------------------------------------------------------------

def newest_order() -> list[Column]:
    return [F.coalesce("published_at", "fetched_at"), F.col("fetched_at"), F.col("item_id")]


def reader_view(items: DataFrame, *, fields: list[str] | None = None) -> DataFrame:
    """Visible kinds, one row per normalised title: the newest, stored rows untouched.

    ``fields`` are the columns a reader is shown (all by default); ``copies`` counts the
    articles behind the row. A title without letters or digits stands for itself. The aggregate keeps one row per
    title and task before the shuffle.
    """
    visible = items.filter(keep_in_feed())
    group = F.coalesce(text.nonempty(text.norm_title("title")), F.col("item_id"))
    keep = fields or visible.columns
    return (
        visible.groupBy(group.alias("_title"))
        .agg(F.max_by(F.struct(*keep), F.struct(*newest_order())).alias("_new"),
             F.count("*").alias("copies"))
        .select("_new.*", "copies")
    )


def latest_per_source(items: DataFrame, *, fields=("item_id", "title", "fetched_at")) -> DataFrame:
    """The last fetched article of every source."""
    rest = [F.col(f) for f in fields]
    return items.groupBy("source").agg(
        F.max_by(F.struct(*rest), F.struct("fetched_at", "item_id")).alias("_last")
    ).select("source", "_last.*")


def list_source(items: DataFrame, source: str, *, limit: int, by: str = "published_at") -> DataFrame:
    """The newest articles of one source; sort and limit run as per-task top-k lists."""
    return (
        items.filter(F.col("source") == source)
        .orderBy(F.col(by).desc_nulls_last(), "item_id").limit(limit)
    )


def latest_item(items: DataFrame) -> DataFrame:
    """The last fetched article."""
    return items.orderBy(F.col("fetched_at").desc_nulls_last(), F.col("item_id").desc()).limit(1)


# --- reports ---------------------------------------------------------------

def source_volume(items: DataFrame) -> DataFrame:
    """Articles per source."""
    return items.groupBy("source").agg(F.count("*").alias("n"))


def url_overlap(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """How many urls of a batch the store has already, and the share in percent."""
    urls = batch.filter(text.nonempty("url").isNotNull()).groupBy("url").agg(
        F.count("*").alias("n")
    )
    held = stored.select("url").join(urls.select("url"), "url", "left_semi").distinct()
    return urls.join(held.withColumn("_hit", F.lit(True)), "url", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("n"))), F.lit(0)).alias("known"),
    ).withColumn("percent", F.round(F.try_divide(F.col("known") * 100, F.col("rows")), 2))


def probe_report(registry: DataFrame, items: DataFrame, polls: DataFrame | None = None) -> DataFrame:
    """Per registered feed: entries, whether any has a body, whether it needs attention."""
    found = items.groupBy("feed_id").agg(
        F.count("*").alias("entries"),
        F.max(text.strip("body") != "").alias("has_body"),
    )
    report = registry.select("feed_id").join(found, "feed_id", "left").select(
        "feed_id",
        F.coalesce("entries", F.lit(0)).alias("entries"),
        F.coalesce("has_body", F.lit(False)).alias("has_body"),
    )
    if polls is None:
        return report.withColumn("attention", F.col("entries") == 0)
    failed = polls.groupBy("feed_id").agg(F.max(~is_ok()).alias("failed"))
    return report.join(failed, "feed_id", "left").withColumn(
        "attention", (F.col("entries") == 0) | F.coalesce("failed", F.lit(True))
    ).drop("failed")


# --- status board ----------------------------------------------------------

def job_verdict(status, fetched_at, now, *, period_seconds: int | Column = C.PERIOD_SECONDS,
                factor: float = C.OVERDUE_FACTOR) -> Column:
    """struct(level, text): failed, stuck, running, late, fine or never run."""
    stale = F.coalesce(
        clock.age_seconds(fetched_at, _now(now)) > period_seconds * factor, F.lit(True)
    )
    status = F.col(status) if isinstance(status, str) else status

    def verdict(level, name):
        return F.struct(F.lit(level).alias("level"), F.lit(C.JOB_TEXT[name]).alias("text"))

    return (
        F.when(status.isNull(), verdict("bad", "none"))
        .when(status == "fail", verdict("bad", "fail"))
        .when((status == "running") & stale, verdict("bad", "stuck"))
        .when(status == "running", verdict("warn", "running"))
        .when(stale, verdict("bad", "late"))
        .otherwise(verdict("ok", "ok"))
    )


def overdue(last, now, *, period_seconds: int = C.PERIOD_SECONDS, market_data: bool = False,
            backfill_impossible: bool = False, factor: float = C.OVERDUE_FACTOR,
            ttl_days: float = C.TTL.days, lead_fraction: float = C.LEAD_FRACTION) -> Column:
    """struct(overdue, reason): empty, weekend-relaxed, stale or ok."""
    last = F.col(last) if isinstance(last, str) else last
    limit = ttl_days * 86400 * lead_fraction if backfill_impossible else period_seconds * factor
    late = clock.age_seconds(last, _now(now)) > limit

    def verdict(flag, reason):
        return F.struct(F.lit(flag).alias("overdue"), F.lit(reason).alias("reason"))

    relaxed = F.lit(market_data) & clock.is_weekend(_now(now))
    return (
        F.when(last.isNull(), verdict(True, "empty"))
        .when(relaxed, verdict(False, "weekend-relaxed"))
        .when(late, verdict(True, "stale"))
        .otherwise(verdict(False, "ok"))
    )


def card_freshness(
    latest: DataFrame, cards: DataFrame | None = None, *, card: str = "card", last: str = "last_fetched",
) -> DataFrame:
    """Per card the oldest of its collections' latest times; one empty one empties the card.

    ``cards`` lists the cards there are; one without a collection is empty too.
    """
    if cards is not None:
        latest = cards.select(card).distinct().join(latest, card, "left")
    empty = F.max(F.col(last).isNull())
    return latest.groupBy(card).agg(
        F.when(~empty, F.min(last)).alias("last_fetched"), empty.alias("any_empty")
    )


def job_rows(jobs: DataFrame, health: DataFrame, now: datetime | Column) -> DataFrame:
    """Board rows of jobs: ``jobs`` lists job, label and period_seconds (configuration)."""
    joined = jobs.join(health, "job", "left")
    verdict = job_verdict(
        "last_status", "fetched_at", now, period_seconds=F.col("period_seconds")
    )
    return joined.withColumn("_v", verdict).select(
        F.lit("job").alias("section"),
        F.col("label").alias("name"),
        F.col("_v.level").alias("level"),
        F.coalesce(text.nonempty("detail"), F.col("_v.text")).alias("detail"),
        F.when(F.col("fetched_at").isNull(), C.NO_RECORD)
        .otherwise(clock.relative_time("fetched_at", _now(now))).alias("when"),
    )


def card_row(items: DataFrame, now: datetime | Column, *, label: str, **rules) -> DataFrame:
    """Board row of one card over one collection, with its latest headline."""
    latest = items.agg(
        F.max_by(F.struct("source", "title"), F.struct("fetched_at", "item_id")).alias("last"),
        F.max("fetched_at").alias("at"),
    )
    verdict = overdue("at", now, **rules)
    return latest.withColumn("_v", verdict).select(
        F.lit("card").alias("section"),
        F.lit(label).alias("name"),
        F.when(F.col("_v.overdue"), "bad").otherwise("ok").alias("level"),
        F.when(F.col("at").isNull(), C.NO_ITEMS)
        .otherwise(text.headline("last.source", "last.title")).alias("detail"),
        F.when(F.col("at").isNull(), C.NO_DATA)
        .otherwise(clock.relative_time("at", _now(now))).alias("when"),
    )


def worst_level(board: DataFrame, *, levels=C.LEVELS) -> DataFrame:
    """The worst level on the board and its title."""
    rank = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col("level"))
    worst = board.agg(F.coalesce(F.max_by("level", rank), F.lit(levels[0])).alias("level"))
    return worst.withColumn("title", F.try_element_at(text.literal_map(C.LEVEL_TITLES), F.col("level")))
