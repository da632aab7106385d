"""Source rows to the one article shape. Pure projections; no shuffle.

The registry side of each join is a hand-written configuration of a few hundred rows;
it is broadcast once its size is checked.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions import clock, text
from feedlake.functions.publisher import publisher

COLUMNS = [
    "item_id", "feed_id", "source", "asset_hint", "language", "url", "title", "body", "symbol",
    "published_at", "fetched_at", "family", "feed_pos", "row_pos",
]


def body_for_mode(body_mode, summary, content):
    """headline: nothing; full: the content when there is any; else the summary."""
    mode = F.col(body_mode)
    return (
        F.when(mode == "headline", F.lit(""))
        .when(mode == "full", F.coalesce(text.nonempty(content), text.or_empty(summary)))
        .otherwise(text.or_empty(summary))
    )


def _seq(rows: DataFrame):
    """Number of the response an entry came with; 0 for rows that are not from responses."""
    return F.col("seq") if "seq" in rows.columns else F.lit(0).cast("long").alias("seq")


def map_feed_rows(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """RSS entries to articles.

    Key basis is link, else guid, else title; the url stays empty without a link. A row
    with no basis is dropped (``feed_rows_without_basis`` counts them).
    """
    joined = rows.join(registry.drop("url"), "feed_id")
    return (
        joined.withColumn("_basis", text.key_basis("link", "guid", "title"))
        .filter(F.col("_basis").isNotNull())
        .select(
            F.sha1(F.col("_basis").cast("binary")).alias("item_id"),
            "feed_id", "source", "asset_hint", "language",
            text.strip("link").alias("url"),
            text.strip("title").alias("title"),
            text.clean_spaced(body_for_mode("body_mode", "summary", "content")).alias("body"),
            F.lit("").alias("symbol"),
            clock.feed_time("published", "updated", "tz_offset").alias("published_at"),
            "fetched_at",
            F.lit(C.RSS).alias("family"),
            "feed_pos", _seq(rows), "row_pos",
        )
    )


def feed_rows_without_basis(rows: DataFrame) -> DataFrame:
    """Entries per feed that carry no link, guid or title and are therefore dropped."""
    return (
        rows.filter(text.key_basis("link", "guid", "title").isNull())
        .groupBy("feed_id").agg(F.count("*").alias("dropped"))
    )


def map_search_rows(rows: DataFrame, searches: DataFrame | None = None) -> DataFrame:
    """Search results to articles; titles and bodies are cleaned tightly.

    ``searches`` adds asset_hint and feed_pos per query; rows that carry the two columns
    already need no registry.
    """
    if searches is not None:
        rows = rows.join(searches, "q")
    url = F.coalesce(text.nonempty("originallink"), F.col("link"))
    return (
        rows.withColumn("url", text.strip(url))
        .withColumn("title", text.clean_tight("title"))
        .filter((F.col("url") != "") | (F.col("title") != ""))
        .select(
            text.content_key(F.coalesce(text.nonempty("url"), F.col("title"))).alias("item_id"),
            F.concat(F.lit(C.SEARCH_PREFIX), "q").alias("feed_id"),
            publisher(F.col("url")).alias("source"),
            "asset_hint",
            F.lit("ko").alias("language"),
            "url", "title",
            text.clean_tight("description").alias("body"),
            F.lit("").alias("symbol"),
            clock.rfc822_to_utc("pubDate").alias("published_at"),
            "fetched_at",
            F.lit(C.SEARCH).alias("family"),
            "feed_pos", _seq(rows), "row_pos",
        )
    )


def map_firehose_rows(
    rows: DataFrame, endpoints: DataFrame | None = None, *,
    article_endpoint: str = C.ARTICLE_ENDPOINT, page_size: int = C.PAGE_SIZE,
) -> DataFrame:
    """Firehose rows to articles; the article endpoint names its fields differently."""
    if endpoints is not None:
        rows = rows.join(endpoints, "endpoint")
    article = F.col("endpoint") == article_endpoint

    def pick(of_article: str, of_rest: str):
        return F.when(article, F.col(of_article)).otherwise(F.col(of_rest))

    source = F.when(
        article, F.coalesce(text.nonempty("site"), F.lit(C.ARTICLE_DEFAULT_SOURCE))
    ).otherwise(
        F.coalesce(
            text.nonempty("publisher"), text.nonempty("site"), F.lit(C.FIREHOSE_DEFAULT_SOURCE)
        )
    )
    return (
        rows.withColumn("_url", text.strip(pick("link", "url")))
        .withColumn("title", text.strip("title"))
        .filter((F.col("_url") != "") | (F.col("title") != ""))
        .select(
            text.content_key(F.coalesce(text.nonempty("_url"), F.col("title"))).alias("item_id"),
            F.concat(F.lit(C.FIREHOSE_PREFIX), "endpoint").alias("feed_id"),
            source.alias("source"),
            F.lit("").alias("asset_hint"),
            F.lit("en").alias("language"),
            F.col("_url").alias("url"),
            "title",
            text.clean_spaced(pick("content", "text")).alias("body"),
            F.when(article, text.first_ticker("tickers"))
            .otherwise(text.strip("symbol")).alias("symbol"),
            clock.zone_to_utc(pick("date", "publishedDate")).alias("published_at"),
            "fetched_at",
            F.lit(C.FIREHOSE).alias("family"),
            "feed_pos", _seq(rows),
            (F.col("page").cast("long") * page_size + F.col("row_pos")).alias("row_pos"),
        )
    )


def union_families(*families: DataFrame) -> DataFrame:
    """All source families as one frame of articles."""
    result = families[0].select(*COLUMNS, _seq(families[0]))
    for df in families[1:]:
        result = result.unionByName(df.select(*COLUMNS, _seq(df)))
    return result
