"""Catalogue: whole jobs over stored tables in the shared folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.text import BLANKS
from feedlake.operators import embedding as emb
from feedlake.operators import items as ops
from feedlake.plans import collect, upkeep
from feedlake.plans import tables as t
from feedlake.plans.catalogue import query
from feedlake.plans.embedding_queries import DIM, HashEmbedder, OUTCOME_SQL
from feedlake.plans.source_queries import (
    FIREHOSE_SQL, feed_payloads, feed_registry, firehose_payloads,
)
from feedlake.plans.tables import load
from feedlake.schemas import FEED_REGISTRY, FIREHOSE_REGISTRY, SEARCH_REGISTRY
from feedlake.session import Scratch
from feedlake.sources import registry, store


@query("usable_searches", f"""
SELECT trim(CASE WHEN p_size < 10 THEN ' ' ELSE p_name END, '{BLANKS}') AS q, p_partkey
FROM part WHERE p_size >= 10""")
def usable_searches(spark, sf_dir):
    """Search queries that are not blank, stripped."""
    rows = load(spark, sf_dir, "part").select(
        F.when(F.col("p_size") < 10, " \t").otherwise(F.concat(F.lit(" "), "p_name")).alias("q"),
        "p_partkey")
    return registry.usable_searches(rows)


def landed_responses(spark, sf_dir) -> collect.Landed:
    """All three families: two feed responses share a time, a firehose page may be bad or land twice."""
    feeds = feed_payloads(spark, sf_dir).withColumn(
        "fetched_at", F.lit(t.DAY0).cast("timestamp") + F.make_dt_interval(mins=F.floor(F.col("seq") / 2).cast("int")))
    found = t.page_search_rows(spark, sf_dir)
    entry = F.struct("title", "originallink", "link", "description", "pubDate")
    searches = found.select(
        "q", "fetched_at", F.col("row_pos").alias("seq"), F.lit(200).alias("status"),
        F.to_json(F.struct(F.array(entry).alias("items"))).alias("payload"))
    pages = firehose_payloads(spark, sf_dir).withColumn("fetched_at", t.now() + F.make_dt_interval(
        mins=F.col("request").cast("int")))
    bad = (F.col("request") % 5 == 0) & (F.col("page") == 1)
    pages = pages.withColumns({"status": F.when(bad, 500).otherwise(200),
                               "payload": F.when(~bad, F.col("payload")), "seq": F.col("seq") * 2 + 1})
    # an earlier try at the same page that failed
    tries = pages.filter(F.col("request") % 3 == 1).withColumns({
        "status": F.lit(503), "payload": F.lit(None).cast("string"), "seq": F.col("seq") - 1})
    return collect.Landed(feeds=feeds, searches=searches,
                          firehose=pages.unionByName(tries).drop("request"))


def job_registries(spark) -> collect.Registries:
    """Registries of what ``landed_responses`` has."""
    german = spark.createDataFrame([("feed-de", "", "German", "", "de", "full", None, "wire", 3)], FEED_REGISTRY)
    languages = [(f"lang-{lang}", "", i) for i, lang in enumerate(("en", "de", "fr", "es"))]
    return collect.Registries(
        feeds=feed_registry(spark).union(german), searches=spark.createDataFrame(languages, SEARCH_REGISTRY),
        endpoints=spark.createDataFrame([("stock-latest", 0), ("fmp-articles", 1)], FIREHOSE_REGISTRY),
        settings={"page_size": 3})


def feed_totals(spark, root: str) -> DataFrame:
    """Polls, stored articles and failures of each feed of a store, kept when the store is gone."""
    totals = store.read(spark, root, "poll_log").groupBy("family", "feed_id").agg(
        F.count("*").alias("polls"), F.sum("new_count").alias("new_articles"))
    state = store.read(spark, root, "feed_state").select(
        "feed_id", F.col("consecutive_failures").alias("failures"))
    return _small(spark, totals.join(state, "feed_id"))


def _small(spark, df: DataFrame) -> DataFrame:
    """A result of few rows, kept when the tables that it comes from are gone."""
    return spark.createDataFrame(df.collect(), df.schema)


@query("collect_ingest", f"""
WITH {FIREHOSE_SQL.format(rows="CASE WHEN request % 5 = 0 AND page = 1 THEN 3 ELSE count(*) END")},
requests AS (
  SELECT endpoint, request, coalesce(bool_or(accepted AND request % 5 = 0 AND page = 1), false) AS failed
  FROM read GROUP BY ALL
), candidate AS (
  SELECT 0 AS rank, 'feed-' || lang AS feed_id, TIMESTAMP '{t.DAY0}' + to_minutes(doc_id // 2) AS seen,
    CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END AS pos, doc_id AS seq,
    CASE lang WHEN 'en' THEN 'https://e/' || doc_id WHEN 'fr' THEN 'tag:' || doc_id
      ELSE trim(split_part(text, chr(10), 1), '{BLANKS}') END AS basis
  FROM documents WHERE lang IN ('en', 'fr', 'es')
  UNION ALL
  SELECT 1, 'naver:lang-' || regexp_extract(html, '<html lang="(\\w+)"', 1),
    TIMESTAMP '{t.DAY0}' + to_minutes(page_id), 0, page_id, url FROM pages
  UNION ALL
  SELECT 2, 'fmp:' || p.endpoint, TIMESTAMP '{t.NOW}' + to_minutes(p.request),
    CASE p.endpoint WHEN 'stock-latest' THEN 0 ELSE 1 END, 0,
    CASE WHEN p_size > 10 THEN 'https://e/' || p_partkey ELSE p_name || ' ' || p_partkey END
  FROM p JOIN read r ON p.endpoint = r.endpoint AND p.request = r.request AND p.page = r.page
  JOIN requests q ON p.endpoint = q.endpoint AND p.request = q.request
  WHERE accepted AND NOT failed
), fresh AS (
  SELECT feed_id, count(*) AS n FROM (
    SELECT feed_id FROM candidate
    QUALIFY row_number() OVER (PARTITION BY basis ORDER BY seen, rank, pos, seq) = 1) GROUP BY feed_id
), polled AS (
  SELECT 'rss' AS family, 'feed-' || lang AS feed_id, count(*) AS polls, lang <> 'de' AS ok,
    CASE lang WHEN 'de' THEN count(*) ELSE 0 END AS failures FROM documents GROUP BY lang
  UNION ALL
  SELECT 'naver', 'naver:lang-' || regexp_extract(html, '<html lang="(\\w+)"', 1), count(*), true, 0
  FROM pages GROUP BY ALL
  UNION ALL
  SELECT 'fmp', 'fmp:' || endpoint, count(*), bool_or(NOT failed),
    CASE WHEN bool_or(NOT failed) THEN count(*) FILTER (WHERE failed AND request > last_ok)
      ELSE count(*) END
  FROM (SELECT *, max(request) FILTER (WHERE NOT failed) OVER (PARTITION BY endpoint) AS last_ok FROM requests)
  GROUP BY endpoint)
SELECT family, feed_id, polls, CASE WHEN ok THEN coalesce(n, 0) END AS new_articles,
       CAST(failures AS BIGINT) AS failures
FROM polled LEFT JOIN fresh USING (feed_id)""")
def collect_ingest(spark, sf_dir):
    """Documents, pages and parts landed as responses of the three families, collected twice.

    The second run sees the same responses, as one does that is run again; it changes nothing.
    German documents land as pages that are no feed.
    """
    registries = job_registries(spark)
    with Scratch(spark, "collect") as job:
        root = f"{job.path}/tables"
        for _ in range(2):
            with Scratch(spark, "collect-run") as stage:
                collect.ingest(spark, root, landed_responses(spark, sf_dir), registries, stage)
        return feed_totals(spark, root)


@query("drain_totals", f"""
WITH {OUTCOME_SQL}
SELECT count(*) FILTER (WHERE outcome = 'ok') AS embedded,
       count(*) FILTER (WHERE outcome = 'permanent') AS permanent,
       bool_or(outcome = 'retryable') AS stalled,
       count(*) FILTER (WHERE outcome = 'retryable') AS still_waiting FROM outcomes""")
def drain_totals(spark, sf_dir):
    """Stored documents embedded until only those are left that may be retried."""
    stories = t.stored_docs(spark, sf_dir, "body", "feed_id", "language", "url", "symbol").select(
        "*", F.lit("").alias("asset_hint"), F.lit(None).cast("timestamp").alias("published_at"),
        F.when(F.col("kind") == "story", F.lit(True)).alias("embed_pending"))
    now = spark.sql(f"SELECT timestamp'{t.DAY0}'").head()[0]
    with Scratch(spark, "drain") as job:
        root = f"{job.path}/tables"
        store.append(root, "items", ops.as_item(stories))
        totals = upkeep.drain(spark, root, emb.one_by_one(HashEmbedder), now, dim=DIM)
        left = upkeep.waiting(spark, root, now).agg(F.count("*").alias("still_waiting"))
        return _small(spark, left.select(
            *[F.lit(v).cast("boolean" if k == "stalled" else "long").alias(k)
              for k, v in totals.items()], "still_waiting"))
