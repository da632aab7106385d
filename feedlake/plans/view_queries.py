"""Catalogue: reader views, reports, status board."""

from pyspark.sql import functions as F

from feedlake.functions import classify, clock, text
from feedlake.functions.publisher import publisher
from feedlake.operators import health, views
from feedlake.plans import tables as t
from feedlake.plans.catalogue import query
from feedlake.plans.tables import (
    CORPUS_SIGNALS, DOC_SQL, ORDER_POLL_SQL, RUN_SQL, STORED_SQL, load, sql_kind, sql_publisher,
)

_AT = f"TIMESTAMP '{t.NOW}'"
_NORM = r"trim(regexp_replace(lower(title), '[^\p{L}\p{N}]+', ' ', 'g'))"


def _doc_with_kind(spark, sf_dir):
    """All documents with a corpus kind; one source has no kind yet, one an unknown kind."""
    kind = F.when(F.col("source") == "src1", None).when(
        F.col("source") == "src2", "weird").otherwise(t.corpus_kind("title"))
    return t.doc_items(spark, sf_dir).withColumn("kind", kind)


_KINDS_SQL = f"""{DOC_SQL}, kinds AS (
  SELECT *, CASE source WHEN 'src1' THEN NULL WHEN 'src2' THEN 'weird'
            ELSE {sql_kind("title", **CORPUS_SIGNALS)} END AS kind FROM doc)"""


@query("keep_in_feed", f"""
WITH {_KINDS_SQL} SELECT doc_id, kind FROM kinds WHERE kind IS NULL OR kind = 'story'""")
def keep_in_feed(spark, sf_dir):
    """Documents a reader sees."""
    return _doc_with_kind(spark, sf_dir).filter(classify.keep_in_feed()).select("doc_id", "kind")


@query("reader_view", f"""
WITH {_KINDS_SQL}, visible AS (
  SELECT *, coalesce(nullif({_NORM}, ''), item_id) AS norm FROM kinds
  WHERE kind IS NULL OR kind = 'story')
SELECT doc_id, title, count(*) OVER (PARTITION BY norm) AS copies FROM visible
QUALIFY row_number() OVER (PARTITION BY norm ORDER BY fetched_at DESC, item_id DESC) = 1""")
def reader_view(spark, sf_dir):
    """The newest visible document of every normalised title."""
    return views.reader_view(_doc_with_kind(spark, sf_dir), fields=["doc_id", "title"])


@query("latest_per_source", f"""
WITH {DOC_SQL}
SELECT source, item_id, title, fetched_at FROM doc
QUALIFY row_number() OVER (PARTITION BY source ORDER BY fetched_at DESC, item_id DESC) = 1""")
def latest_per_source(spark, sf_dir):
    """The last fetched document of every source."""
    return views.latest_per_source(t.doc_items(spark, sf_dir))


@query("source_filter_list", f"""
WITH {DOC_SQL}
SELECT item_id, title, fetched_at FROM doc WHERE source = 'src3'
ORDER BY fetched_at DESC, item_id LIMIT 20""")
def source_filter_list(spark, sf_dir):
    """The reader's list: the twenty newest of one source."""
    return views.list_source(
        t.doc_items(spark, sf_dir), "src3", limit=20, by="fetched_at"
    ).select("item_id", "title", "fetched_at")


@query("latest_item", f"""
WITH {DOC_SQL}
SELECT item_id, source, title, fetched_at FROM doc
ORDER BY fetched_at DESC, item_id DESC LIMIT 1""")
def latest_item(spark, sf_dir):
    """The last fetched document."""
    return views.latest_item(t.doc_items(spark, sf_dir)).select(
        "item_id", "source", "title", "fetched_at")


@query("source_volume", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def source_volume(spark, sf_dir):
    """Documents per source."""
    return views.source_volume(t.doc_items(spark, sf_dir))


@query("publisher_volume",
       f"SELECT {sql_publisher('url')} AS source, count(*) AS n FROM pages GROUP BY 1")
def publisher_volume(spark, sf_dir):
    """Pages per publisher."""
    pages = load(spark, sf_dir, "pages").select(publisher(F.col("url")).alias("source"))
    return views.source_volume(pages)


_PLAIN = r"regexp_replace(url, '[?#].*$', '')"


@query("url_overlap", rf"""
WITH batch AS (SELECT {_PLAIN} AS url FROM pages),
held AS (SELECT url FROM pages WHERE NOT contains(url, '?'))
SELECT count(*) AS rows, count(*) FILTER (WHERE url IN (SELECT url FROM held)) AS known,
       round(count(*) FILTER (WHERE url IN (SELECT url FROM held)) * 100 / count(*), 2) AS percent
FROM batch""")
def url_overlap(spark, sf_dir):
    """Page urls without query and fragment, against the stored urls without a query."""
    pages = load(spark, sf_dir, "pages")
    batch = pages.select(F.regexp_replace("url", r"[?#].*$", "").alias("url"))
    return views.url_overlap(batch, pages.filter(~F.col("url").contains("?")))


@query("probe_report", f"""
WITH {ORDER_POLL_SQL}, found AS (
  SELECT 'cust-' || o_custkey AS feed_id, count(*) AS entries,
         bool_or(o_orderstatus <> 'F') AS has_body, bool_or(o_orderstatus = 'F') AS failed
  FROM orders GROUP BY o_custkey)
SELECT 'cust-' || c_custkey AS feed_id, coalesce(entries, 0) AS entries,
       coalesce(has_body, false) AS has_body,
       coalesce(entries, 0) = 0 OR coalesce(failed, true) AS attention
FROM customer LEFT JOIN found ON feed_id = 'cust-' || c_custkey""")
def probe_report(spark, sf_dir):
    """Per registered feed (customer): entries (orders), any body, needs attention."""
    registry = load(spark, sf_dir, "customer").select(
        F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("feed_id"))
    items = load(spark, sf_dir, "orders").select(
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("feed_id"),
        F.when(F.col("o_orderstatus") == "F", " \n").otherwise(F.col("o_orderpriority"))
        .alias("body"))
    return views.probe_report(registry, items, t.order_polls(spark, sf_dir))


# --- status board ----------------------------------------------------------

def _sql_ago(ts: str) -> str:
    s = f"greatest(0, CAST(floor(epoch({_AT} - {ts})) AS BIGINT))"
    return (
        f"CASE WHEN {s} < 60 THEN '방금' WHEN {s} < 3600 THEN ({s} // 60) || '분 전' "
        f"WHEN {s} < 86400 THEN ({s} // 3600) || '시간 전' ELSE ({s} // 86400) || '일 전' END"
    )


@query("relative_time", f"SELECT event_id, {_sql_ago('ts')} AS ago FROM events")
def relative_time(spark, sf_dir):
    """How long ago every event was, at a fixed moment within their range."""
    return load(spark, sf_dir, "events").select(
        "event_id", clock.relative_time("ts", t.now()).alias("ago"))


@query("weekend_events", """
SELECT event_id, dayofweek(ts) IN (0, 6) AS weekend FROM events""")
def weekend_events(spark, sf_dir):
    """Which events fall on a weekend."""
    return load(spark, sf_dir, "events").select(
        "event_id", clock.is_weekend("ts").alias("weekend"))


_LEVEL_SQL = f"""CASE WHEN last_status = 'fail' THEN 'bad'
  WHEN last_status = 'running' AND {_AT} - fetched_at > INTERVAL 24 HOUR THEN 'bad'
  WHEN last_status = 'running' THEN 'warn'
  WHEN {_AT} - fetched_at > INTERVAL 24 HOUR THEN 'bad' ELSE 'ok' END"""
_TEXT_SQL = f"""CASE WHEN last_status = 'fail' THEN '실패'
  WHEN last_status = 'running' AND {_AT} - fetched_at > INTERVAL 24 HOUR THEN '멈춤(정지)'
  WHEN last_status = 'running' THEN '실행 중'
  WHEN {_AT} - fetched_at > INTERVAL 24 HOUR THEN '지연(안 돎)' ELSE '정상' END"""


@query("job_verdict", f"""
WITH {RUN_SQL} SELECT job, {_LEVEL_SQL} AS level, {_TEXT_SQL} AS verdict FROM health""")
def job_verdict(spark, sf_dir):
    """Verdict on every job with a period of eight hours."""
    jobs = health.fold_job_health(t.event_runs(spark, sf_dir))
    verdict = views.job_verdict("last_status", "fetched_at", t.now(), period_seconds=8 * 3600)
    return jobs.withColumn("_v", verdict).select(
        "job", F.col("_v.level").alias("level"), F.col("_v.text").alias("verdict"))


@query("overdue", f"""
WITH last AS (
  SELECT c_custkey AS feed, max(ts) AS last_at FROM customer LEFT JOIN events ON user_id = c_custkey
  GROUP BY c_custkey)
SELECT feed, last_at IS NULL OR {_AT} - last_at > INTERVAL 24 HOUR AS overdue,
  CASE WHEN last_at IS NULL THEN 'empty' WHEN {_AT} - last_at > INTERVAL 24 HOUR THEN 'stale' ELSE 'ok' END
    AS reason,
  CASE WHEN last_at IS NULL THEN 'empty' WHEN {_AT} - last_at > INTERVAL 1 DAY * 0.4 * 2 THEN 'stale'
       ELSE 'ok' END AS deadline_reason,
  CASE WHEN last_at IS NULL THEN 'empty' ELSE 'weekend-relaxed' END AS weekend_reason FROM last""")
def overdue(spark, sf_dir):
    """Customers' last events against a period, a retention deadline and a weekend."""
    last = load(spark, sf_dir, "customer").join(
        load(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey"))
        .agg(F.max("ts").alias("at")), "c_custkey", "left")
    saturday = F.lit("2024-02-03 00:00:00").cast("timestamp")
    plain = views.overdue("at", t.now(), period_seconds=8 * 3600)
    deadline = views.overdue("at", t.now(), backfill_impossible=True, ttl_days=2)
    market = views.overdue("at", saturday, market_data=True)
    return last.select(
        F.col("c_custkey").alias("feed"),
        plain["overdue"].alias("overdue"), plain["reason"].alias("reason"),
        deadline["reason"].alias("deadline_reason"), market["reason"].alias("weekend_reason"))


@query("card_freshness", """
WITH last AS (
  SELECT c_mktsegment AS card, c_nationkey, max(ts) AS last_at
  FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY ALL)
SELECT card, CASE WHEN NOT bool_or(last_at IS NULL) THEN min(last_at) END AS last_fetched,
       bool_or(last_at IS NULL) AS any_empty FROM last GROUP BY card
UNION ALL
SELECT event_type, min(last_at), false FROM (
  SELECT event_type, user_id % 10, max(ts) AS last_at FROM events GROUP BY ALL) GROUP BY event_type
UNION ALL SELECT DISTINCT 'priority ' || o_orderpriority, NULL, true FROM orders""")
def card_freshness(spark, sf_dir):
    """Cards over customer segments, some without events, over event types, and without any collection."""
    events = load(spark, sf_dir, "events")
    per_user = events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max("ts").alias("ts"))
    segments = load(spark, sf_dir, "customer").join(per_user, "c_custkey", "left").groupBy(
        F.col("c_mktsegment").alias("card"), "c_nationkey").agg(F.max("ts").alias("last_fetched"))
    types = events.groupBy(
        F.col("event_type").alias("card"), (F.col("user_id") % 10).alias("part")
    ).agg(F.max("ts").alias("last_fetched"))
    latest = segments.select("card", "last_fetched").unionByName(types.select("card", "last_fetched"))
    bare = load(spark, sf_dir, "orders").select(
        F.concat(F.lit("priority "), "o_orderpriority").alias("card"))
    return views.card_freshness(latest, latest.select("card").unionByName(bare))


_BOARD_SQL = f"""{RUN_SQL}, {STORED_SQL}, jobs AS (
  SELECT 'job-' || c_custkey AS job, c_name AS label FROM customer
), newest AS (
  SELECT source, title, fetched_at AS last_at FROM stored ORDER BY fetched_at DESC, item_id DESC LIMIT 1
), board AS (
  SELECT 'job' AS section, label AS name,
         CASE WHEN last_status IS NULL THEN 'bad' ELSE {_LEVEL_SQL} END AS level,
         coalesce(nullif(detail, ''), CASE WHEN last_status IS NULL THEN '미실행'
           ELSE {_TEXT_SQL} END) AS detail,
         CASE WHEN fetched_at IS NULL THEN '기록 없음' ELSE {_sql_ago("fetched_at")} END AS "when"
  FROM jobs LEFT JOIN health USING (job)
  UNION ALL
  SELECT 'card', '뉴스', CASE WHEN {_AT} - last_at > INTERVAL 45 MINUTE THEN 'bad' ELSE 'ok' END,
         '최근: ' || source || CASE WHEN title <> '' THEN ' · ' || substr(title, 1, 44) ELSE '' END,
         {_sql_ago("last_at")} FROM newest)"""


def _board(spark, sf_dir):
    jobs = load(spark, sf_dir, "customer").select(
        F.concat(F.lit("job-"), F.col("c_custkey").cast("string")).alias("job"),
        F.col("c_name").alias("label"), F.lit(8 * 3600).alias("period_seconds"))
    rows = views.job_rows(jobs, health.fold_job_health(t.event_runs(spark, sf_dir)), t.now())
    return rows.unionByName(
        views.card_row(t.stored_docs(spark, sf_dir), t.now(), label="뉴스"))


@query("status_board", f"WITH {_BOARD_SQL} SELECT * FROM board")
def status_board(spark, sf_dir):
    """Jobs (one per customer, some never run) and the news card."""
    return _board(spark, sf_dir)


@query("worst_level", f"""
WITH {_BOARD_SQL}
SELECT CASE WHEN bool_or(level = 'bad') THEN 'bad' WHEN bool_or(level = 'warn') THEN 'warn'
            ELSE 'ok' END AS level,
       CASE WHEN bool_or(level = 'bad') THEN '점검이 필요합니다'
            WHEN bool_or(level = 'warn') THEN '주의가 필요합니다' ELSE '모두 정상' END AS title
FROM board""")
def worst_level(spark, sf_dir):
    """The worst level on that board."""
    return views.worst_level(_board(spark, sf_dir))


@query("headline_preview", f"""
WITH {DOC_SQL}
SELECT doc_id, '최근: ' || source || CASE WHEN title <> '' THEN ' · ' || substr(title, 1, 44)
  ELSE '' END AS headline FROM doc""")
def headline_preview(spark, sf_dir):
    """Preview line of every document."""
    return t.doc_items(spark, sf_dir).select(
        "doc_id", text.headline("source", "title").alias("headline"))
