"""Body text for headline-only sources, taken from landed article pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedlake import constants as C
from feedlake.functions.selector import page_text
from feedlake.operators.items import known_ids

#: Columns that tell the rows of a batch apart.
KEYS = ["item_id", "feed_id", "fetched_at", "feed_pos", "row_pos"]


def body_targets(
    items: DataFrame, stored: DataFrame, selectors: DataFrame, *, per_feed: int | None = None,
) -> DataFrame:
    """Listed source, empty body, not stored; with ``per_feed``, the first so many of each feed.

    Without a limit there is no window. With one, Spark turns row_number() <= k into top-k
    lists per task before the shuffle, so a hot feed sends k rows per task.
    """
    candidates = items.filter(F.coalesce("body", F.lit("")) == "").join(selectors, "source")
    new = candidates.join(known_ids(candidates, stored), "item_id", "left_anti")
    if per_feed is None:
        return new
    w = Window.partitionBy("feed_id").orderBy("fetched_at", "feed_pos", "row_pos", "item_id")
    return new.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_feed).drop("_n")


def page_texts(wanted: DataFrame, pages: DataFrame, *, min_chars: int) -> DataFrame:
    """Text of the newest good page per (url, selector) in ``wanted``; blank urls have no page.

    The newest page is chosen by its time alone; only chosen pages are read whole.
    """
    asked = wanted.select("url", "selector").filter(F.col("url") != "").distinct()
    good = pages.filter((F.col("status") == 200) & (F.col("url") != ""))
    newest = good.groupBy("url").agg(F.max("fetched_at").alias("fetched_at"))
    newest = newest.join(asked.select("url").distinct(), "url", "left_semi")
    html = good.join(newest, ["url", "fetched_at"], "left_semi").groupBy("url").agg(
        F.max("html").alias("html"))
    return asked.join(html, "url").select("url", "selector", page_text(
        F.col("html"), F.col("selector"), min_chars=min_chars).alias("_text"))


def fetch_bodies(
    targets: DataFrame, pages: DataFrame, *, min_chars: int = C.MIN_BODY_CHARS
) -> DataFrame:
    """Page text per target by the selector of its source.

    No page, a status other than 200, no match or too little text give ''. Each page is
    parsed once per selector, however many targets ask for it.
    """
    texts = page_texts(targets, pages, min_chars=min_chars)
    return targets.join(texts, ["url", "selector"], "left").withColumn(
        "body", F.coalesce("_text", F.lit(""))).drop("_text", "selector")


def enrich_bodies(
    items: DataFrame, stored: DataFrame, selectors: DataFrame, pages: DataFrame, *,
    per_feed: int | None = None, min_chars: int = C.MIN_BODY_CHARS,
) -> DataFrame:
    """The batch with bodies filled in where a target's page had text.

    Targets are chosen and joined on their keys alone; the batch meets only the bodies
    that were found.
    """
    narrow = items.select(*KEYS, "source", "url", "body")
    found = fetch_bodies(
        body_targets(narrow, stored, selectors, per_feed=per_feed), pages, min_chars=min_chars)
    found = found.filter(F.col("body") != "").select(*KEYS, F.col("body").alias("_found"))
    return items.join(found, KEYS, "left").withColumn(
        "body", F.coalesce("_found", "body")).select(*items.columns)


def empty_body_rate(fetched: DataFrame, *, alert: float = C.EMPTY_RATE_ALERT) -> DataFrame:
    """Per feed: targets, empty ones, their share, and whether the selector may have drifted."""
    return fetched.groupBy("feed_id").agg(
        F.count("*").alias("targets"),
        F.count_if(F.coalesce("body", F.lit("")) == "").alias("empty"),
    ).withColumn("rate", F.col("empty") / F.col("targets")).withColumn(
        "alert", F.col("rate") >= alert
    )
