"""Catalogue: keys, mappings, cleaning, classification, insert, retention."""

from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions import classify, clock, text
from feedlake.functions.publisher import host_of, publisher
from feedlake.functions.text import BLANKS
from feedlake.operators import items as ops
from feedlake.operators import mapping
from feedlake.plans import tables as t
from feedlake.plans.catalogue import query
from feedlake.plans.tables import (
    CORPUS_SIGNALS, DOC_SQL, SEARCH_SQL, STORED_SQL, VEC_SQL, load, sql_clean, sql_host,
    sql_kind, sql_publisher,
)
from feedlake.session import Scratch
from feedlake.sources import store


@query("item_id", f"""
SELECT 'page' AS origin, page_id AS id, sha1(url) AS item_id FROM pages
UNION ALL
SELECT 'doc', doc_id, sha1(trim(text, '{BLANKS}')) FROM documents""")
def item_id(spark, sf_dir):
    """Key of pages by url and of documents, which have none, by their text."""
    pages = load(spark, sf_dir, "pages").select(
        F.lit("page").alias("origin"), F.col("page_id").alias("id"),
        F.col("url").alias("link"), F.lit("").alias("guid"))
    docs = load(spark, sf_dir, "documents").select(
        F.lit("doc").alias("origin"), F.col("doc_id").alias("id"),
        F.lit(" ").alias("link"), F.col("text").alias("guid"))
    return pages.unionByName(docs).select(
        "origin", "id", text.content_key(text.key_basis("link", "guid")).alias("item_id"))


@query("dedup_first_wins", f"""
WITH {DOC_SQL}
SELECT item_id, doc_id, source, language, fetched_at FROM doc
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY fetched_at, doc_id) = 1""")
def dedup_first_wins(spark, sf_dir):
    """One row per key, the first in arrival order."""
    return ops.first_wins(
        t.doc_items(spark, sf_dir), fields=["doc_id", "source", "language", "fetched_at"])


_LABELLED_SQL = f"""{DOC_SQL}, held AS (
  SELECT DISTINCT item_id FROM doc JOIN labels USING (doc_id))"""


def _labelled(spark, sf_dir):
    """Stored articles: those documents that were labelled."""
    labels = load(spark, sf_dir, "labels").select("doc_id")
    held = t.doc_items(spark, sf_dir).join(labels, "doc_id", "left_semi")
    return ops.first_wins(held, fields=["doc_id"])


@query("insert_if_absent", f"""
WITH {_LABELLED_SQL}
SELECT item_id, feed_id, source, title, body, language, fetched_at,
       {sql_kind("title")} AS kind, fetched_at + INTERVAL 365 DAY AS expire_at,
       CASE WHEN {sql_kind("title")} = 'story' THEN true END AS embed_pending
FROM doc WHERE item_id NOT IN (SELECT item_id FROM held)
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY doc_id) = 1""")
def insert_if_absent(spark, sf_dir):
    """All documents against a store of the labelled ones: the rows to append."""
    fresh = ops.insert_if_absent(t.doc_items(spark, sf_dir), _labelled(spark, sf_dir))
    return fresh.select("item_id", "feed_id", "source", "title", "body", "language",
                        "fetched_at", "kind", "expire_at", "embed_pending")


@query("insert_rescanned", f"""
WITH {_LABELLED_SQL}
SELECT item_id, doc_id, source, title, body, {sql_kind("title")} AS kind
FROM doc WHERE item_id NOT IN (SELECT item_id FROM held)
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY doc_id) = 1""")
def insert_rescanned(spark, sf_dir):
    """The same insert in the form for batches that are mostly known."""
    fresh = ops.insert_rescanned(t.doc_items(spark, sf_dir), _labelled(spark, sf_dir))
    return fresh.select("item_id", "doc_id", "source", "title", "body", "kind")


@query("insert_counts", f"""
WITH {_LABELLED_SQL}, fresh AS (
  SELECT * FROM doc WHERE item_id NOT IN (SELECT item_id FROM held)
  QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY doc_id) = 1)
SELECT family, feed_id, count(*) AS new_count FROM fresh GROUP BY family, feed_id""")
def insert_counts(spark, sf_dir):
    """New articles per feed of that insert."""
    fresh = ops.insert_if_absent(t.doc_items(spark, sf_dir), _labelled(spark, sf_dir))
    return ops.new_counts(fresh)


@query("filter_new_ids", f"""
WITH {_LABELLED_SQL}
SELECT item_id, doc_id FROM doc WHERE item_id NOT IN (SELECT item_id FROM held)""")
def filter_new_ids(spark, sf_dir):
    """Rows with unknown keys, copies kept; doc_id is their input position."""
    return ops.new_rows(t.doc_items(spark, sf_dir), _labelled(spark, sf_dir)).select(
        "item_id", "doc_id")


@query("item_count", f"WITH {DOC_SQL} SELECT count(DISTINCT item_id) AS n FROM doc")
def item_count(spark, sf_dir):
    """Number of stored articles."""
    return ops.first_wins(t.doc_items(spark, sf_dir), fields=["doc_id"]).agg(
        F.count("*").alias("n"))


@query("stored_counts", f"""
WITH {DOC_SQL}, first AS (SELECT min(fetched_at) AS fetched_at FROM doc GROUP BY item_id)
SELECT CAST(fetched_at AS DATE) AS day, count(*) AS n FROM first GROUP BY ALL""")
def stored_counts(spark, sf_dir):
    """Stored articles by day, counted by the footers of their files."""
    with Scratch(spark, "stored-counts") as job:
        store.append(job.path, "items", ops.as_item(ops.stamp(ops.first_wins(t.doc_items(spark, sf_dir)))))
        return store.counts(spark, job.path, "items")


@query("kind_triage", f"""
WITH {DOC_SQL}
SELECT doc_id, {sql_kind("title")} AS kind,
       {sql_kind("title", **CORPUS_SIGNALS)} AS corpus_kind FROM doc""")
def kind_triage(spark, sf_dir):
    """Kind of every document title by the default and by the corpus vocabulary."""
    return t.doc_items(spark, sf_dir).select(
        "doc_id", classify.kind("title").alias("kind"),
        t.corpus_kind("title").alias("corpus_kind"))


@query("kind_by_label", f"""
WITH {DOC_SQL}
SELECT {sql_kind("title", **CORPUS_SIGNALS)} AS kind, quality, toxic, count(*) AS n
FROM doc JOIN labels USING (doc_id) GROUP BY ALL""")
def kind_by_label(spark, sf_dir):
    """How kinds fall on the quality and toxicity labels."""
    labels = load(spark, sf_dir, "labels")
    return t.doc_items(spark, sf_dir).select("doc_id", t.corpus_kind("title").alias("kind")).join(
        labels, "doc_id").groupBy("kind", "quality", "toxic").agg(F.count("*").alias("n"))


@query("publisher", f"""
SELECT page_id, {sql_host("url")} AS host, {sql_publisher("url")} AS publisher FROM pages""")
def publisher_of_pages(spark, sf_dir):
    """Host and publisher label of every page."""
    return load(spark, sf_dir, "pages").select(
        "page_id", host_of("url").alias("host"), publisher(F.col("url")).alias("publisher"))


@query("publisher_mapped", rf"""
SELECT page_id, coalesce(
  MAP {{'blog.tionsh.example.com': 'Tionsh', 'tionsh.example.com': 'not this one',
        'ththth.example.net': 'Ththth'}}[{sql_host("url")}],
  MAP {{'blog.tionsh.example.com': 'Tionsh', 'tionsh.example.com': 'not this one',
        'ththth.example.net': 'Ththth'}}[regexp_replace({sql_host("url")}, '^(www|m)\.', '')],
  regexp_replace({sql_host("url")}, '^(www|m)\.', '')) AS publisher FROM pages""")
def publisher_mapped(spark, sf_dir):
    """The same with a table of hosts that occur: exact host first, then without prefix."""
    table = {"blog.tionsh.example.com": "Tionsh", "tionsh.example.com": "not this one",
             "ththth.example.net": "Ththth"}
    return load(spark, sf_dir, "pages").select(
        "page_id", publisher(F.col("url"), table=table, prefixes=("www", "m")).alias("publisher"))


@query("clean_spaced", f"SELECT page_id, {sql_clean('html', ' ')} AS body FROM pages")
def clean_spaced(spark, sf_dir):
    """Page text, tags replaced by spaces."""
    return load(spark, sf_dir, "pages").select("page_id", text.clean_spaced("html").alias("body"))


@query("clean_tight", f"SELECT page_id, {sql_clean('html', '')} AS body FROM pages")
def clean_tight(spark, sf_dir):
    """Page text, tags removed without a space."""
    return load(spark, sf_dir, "pages").select("page_id", text.clean_tight("html").alias("body"))


@query("stamp_items", f"""
WITH {DOC_SQL}
SELECT doc_id, {sql_kind("title")} AS kind, fetched_at + INTERVAL 365 DAY AS expire_at,
       CASE WHEN {sql_kind("title")} = 'story' THEN true END AS embed_pending FROM doc""")
def stamp_items(spark, sf_dir):
    """Kind, expiry and waiting flag of every document."""
    return ops.stamp(t.doc_items(spark, sf_dir)).select(
        "doc_id", "kind", "expire_at", "embed_pending")


def _sql_eastern(clock_sql: str) -> str:
    """US Eastern clock to UTC; a clock that occurs twice means its first occurrence."""
    at = f"timezone('UTC', timezone('America/New_York', {clock_sql}))"
    earlier = f"({at} - INTERVAL 1 HOUR)"
    return (
        f"CASE WHEN timezone('America/New_York', timezone('UTC', {earlier})) = {clock_sql} "
        f"THEN {earlier} ELSE {at} END"
    )


@query("us_eastern_to_utc", f"""
SELECT event_id, {_sql_eastern("date_trunc('second', ts)")} AS with_seconds,
  {_sql_eastern("date_trunc('minute', ts + to_days(CAST(event_id % 366 AS INTEGER)))")}
    AS minutes_only,
  CAST(NULL AS TIMESTAMP) AS unreadable FROM events""")
def us_eastern_to_utc(spark, sf_dir):
    """Event clocks printed as US Eastern text and read back, over a whole year of days."""
    e = load(spark, sf_dir, "events")
    moved = F.timestamp_seconds(
        F.unix_timestamp("ts") + (F.col("event_id") % 366) * 86400)
    return e.select(
        "event_id",
        clock.zone_to_utc(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("with_seconds"),
        clock.zone_to_utc(F.date_format(moved, "yyyy-M-d H:mm")).alias("minutes_only"),
        clock.zone_to_utc(F.date_format("ts", "yyyy/MM/dd HH:mm")).alias("unreadable"))


@query("rfc822_to_utc", """
SELECT event_id, date_trunc('second', ts) - INTERVAL 9 HOUR AS seoul,
       date_trunc('second', ts) + INTERVAL 5 HOUR AS eastern,
       CAST(NULL AS TIMESTAMP) AS zoneless FROM events""")
def rfc822_to_utc(spark, sf_dir):
    """Event clocks printed as RFC 822 text with an offset, a zone name and neither."""
    e = load(spark, sf_dir, "events")
    day = F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss")
    return e.select(
        "event_id",
        clock.rfc822_to_utc(F.concat(day, F.lit(" +0900"))).alias("seoul"),
        clock.rfc822_to_utc(F.concat(day, F.lit(" EST"))).alias("eastern"),
        clock.rfc822_to_utc(day).alias("zoneless"))


@query("offset_reinterpret", """
SELECT event_id, date_trunc('second', ts) - INTERVAL 570 MINUTE AS local_clock,
       date_trunc('second', ts) - INTERVAL 9 HOUR AS iso,
       date_trunc('second', ts) AS naive FROM events""")
def offset_reinterpret(spark, sf_dir):
    """Feed times: a local clock moved by 9.5 hours, ISO with offset, no zone at all."""
    e = load(spark, sf_dir, "events")
    naive = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))
    none = F.lit(None).cast("double")
    return e.select(
        "event_id",
        clock.feed_time(naive, F.lit(""), F.lit(9.5)).alias("local_clock"),
        clock.feed_time(F.lit("no date"), iso, none).alias("iso"),
        clock.feed_time(naive, iso, none).alias("naive"))


@query("blackout_filter", """
SELECT event_id, ts FROM events WHERE NOT (hour(ts + INTERVAL 9 HOUR) >= 7
  AND hour(ts + INTERVAL 9 HOUR) < 9)""")
def blackout_filter(spark, sf_dir):
    """Polls outside the blackout hours in Seoul."""
    return load(spark, sf_dir, "events").filter(~clock.in_blackout("ts", 7, 9)).select(
        "event_id", "ts")


@query("lookback_window", """
SELECT event_id, ts FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-20'""")
def lookback_window(spark, sf_dir):
    """Events of the three days before a moment and of its day."""
    at = F.lit("2024-01-20 13:30:00").cast("timestamp")
    return load(spark, sf_dir, "events").filter(clock.in_lookback("ts", at)).select(
        "event_id", "ts")


@query("first_ticker", """
SELECT p_partkey, split_part(p_brand, '#', 1) AS plain, p_brand AS prefixed FROM part""")
def first_ticker(spark, sf_dir):
    """First ticker of a list, with and without exchange prefix."""
    p = load(spark, sf_dir, "part")
    plain = F.concat(F.lit(" "), F.substring_index("p_brand", "#", 1), F.lit(" ,X:Y"))
    prefixed = F.concat("p_type", F.lit(": "), "p_brand", F.lit(",NYSE:GS"))
    return p.select("p_partkey", text.first_ticker(plain).alias("plain"),
                    text.first_ticker(prefixed).alias("prefixed"))


@query("firehose_mapping", f"""
WITH r AS (
  SELECT *, p_type IN ('ECONOMY', 'PROMO') AS art,
         CASE WHEN p_size > 10 THEN 'https://e/' || p_partkey ELSE '' END AS url,
         p_name || ' ' || p_partkey AS title,
         {_sql_eastern("TIMESTAMP '2024-01-01' + to_seconds(p_partkey * 40000)")} AS at_s,
         {_sql_eastern("date_trunc('minute', TIMESTAMP '2024-01-01' "
                       "+ to_seconds(p_partkey * 40000))")} AS at_m FROM part)
SELECT sha1(CASE WHEN url <> '' THEN url ELSE title END) AS item_id,
  CASE WHEN art THEN 'fmp:fmp-articles' ELSE 'fmp:stock-latest' END AS feed_id,
  CASE WHEN art THEN CASE WHEN p_size % 3 = 0 THEN p_type ELSE 'Financial Modeling Prep' END
       WHEN p_size % 2 = 0 THEN p_brand WHEN p_size % 3 = 0 THEN p_type ELSE 'FMP' END AS source,
  url, title,
  CASE WHEN art THEN p_name || ' cut' ELSE p_name || ' is "new"' END AS body,
  CASE WHEN art THEN p_brand WHEN p_size > 25 THEN p_brand ELSE '' END AS symbol,
  CASE WHEN art THEN at_m ELSE at_s END AS published_at FROM r""")
def firehose_mapping(spark, sf_dir):
    """Firehose rows of both shapes as articles."""
    return mapping.map_firehose_rows(t.firehose_parts(spark, sf_dir)).select(
        "item_id", "feed_id", "source", "url", "title", "body", "symbol", "published_at")


@query("search_mapping", f"""
WITH {SEARCH_SQL}
SELECT sha1(url) AS item_id, feed_id, {sql_publisher("url")} AS source, 'ko' AS language, url,
       {sql_clean("raw || '.'", "")} AS title, {sql_clean("html", "")} AS body,
       fetched_at - INTERVAL 9 HOUR AS published_at FROM search""")
def search_mapping(spark, sf_dir):
    """Pages as search results mapped to articles; some have only the second link."""
    return mapping.map_search_rows(t.page_search_rows(spark, sf_dir)).select(
        "item_id", "feed_id", "source", "language", "url", "title", "body", "published_at")


@query("new_articles_by_source", f"""
WITH {SEARCH_SQL}, a AS (
  SELECT {sql_publisher("url")} AS source, {sql_kind(sql_clean("raw || '.'", ""))} AS kind,
         feed_id, url, fetched_at FROM search
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1)
SELECT source, kind, feed_id, count(*) AS n, min(fetched_at) AS first_at,
       max(fetched_at) + INTERVAL 365 DAY AS kept_until FROM a GROUP BY source, kind, feed_id""")
def new_articles_by_source(spark, sf_dir):
    """Search results from landing to store: mapped, first of each key, stamped, counted."""
    found = mapping.map_search_rows(t.page_search_rows(spark, sf_dir))
    empty_store = found.limit(0)
    return ops.insert_if_absent(found, empty_store).groupBy("source", "kind", "feed_id").agg(
        F.count("*").alias("n"), F.min("fetched_at").alias("first_at"),
        F.max("expire_at").alias("kept_until"))


@query("union_families", f"""
WITH {DOC_SQL}, {SEARCH_SQL}, talk AS (
  SELECT sha1(trim(text, '{BLANKS}')) AS item_id, 'talk-' || role AS feed_id,
         TIMESTAMP '2024-01-01' + to_minutes(conv_id) AS fetched_at
  FROM conversations WHERE trim(text, '{BLANKS}') <> '')
SELECT family, feed_id, count(*) AS n, count(DISTINCT item_id) AS keys,
       min(fetched_at) AS first_at, max(fetched_at) AS last_at
FROM (SELECT 'rss' AS family, feed_id, item_id, fetched_at FROM doc
      UNION ALL SELECT 'naver', feed_id, sha1(url), fetched_at FROM search
      UNION ALL SELECT 'fmp', feed_id, item_id, fetched_at FROM talk)
GROUP BY family, feed_id""")
def union_families(spark, sf_dir):
    """Documents, pages and conversations as one frame of articles, counted by feed."""
    docs = t.doc_items(spark, sf_dir).withColumn("family", F.lit(C.RSS))
    found = mapping.map_search_rows(t.page_search_rows(spark, sf_dir))
    talk = load(spark, sf_dir, "conversations").select(
        text.content_key("text").alias("item_id"),
        F.concat(F.lit("talk-"), "role").alias("feed_id"),
        F.col("role").alias("source"),
        *[F.lit("").alias(c) for c in ("asset_hint", "language", "url", "title")],
        F.col("text").alias("body"),
        F.lit("").alias("symbol"),
        F.lit(None).cast("timestamp").alias("published_at"),
        t.minutes_after_day0("conv_id").alias("fetched_at"),
        F.lit(C.FIREHOSE).alias("family"),
        F.col("conv_id").alias("feed_pos"),
        F.col("turn").alias("row_pos"),
    ).filter(text.strip("body") != "")
    return mapping.union_families(docs, found, talk).groupBy("family", "feed_id").agg(
        F.count("*").alias("n"), F.count_distinct("item_id").alias("keys"),
        F.min("fetched_at").alias("first_at"), F.max("fetched_at").alias("last_at"))


@query("purge_expired", f"""
WITH {STORED_SQL}
SELECT item_id, kind, expire_at FROM stored WHERE expire_at > TIMESTAMP '2024-03-02 06:00:00'""")
def purge_expired(spark, sf_dir):
    """Stored articles that are still kept at a moment."""
    at = F.lit("2024-03-02 06:00:00").cast("timestamp")
    return ops.purge_expired(t.stored_docs(spark, sf_dir), at).select(
        "item_id", "kind", "expire_at")


def _vectors(spark, sf_dir):
    return t.one_vector_per_item(t.doc_vectors(spark, sf_dir), "expire_at")


@query("ttl_recompute_items", f"""
WITH {STORED_SQL}
SELECT item_id, fetched_at + INTERVAL 365 DAY AS expire_at FROM stored""")
def ttl_recompute_items(spark, sf_dir):
    """Retention of every stored article recomputed from its fetch time."""
    return ops.recompute_item_expiry(t.stored_docs(spark, sf_dir)).select("item_id", "expire_at")


@query("ttl_recompute_vectors", f"""
WITH {STORED_SQL}, {VEC_SQL}
SELECT item_id, CASE WHEN s.expire_at <> s.fetched_at + INTERVAL 365 DAY
       THEN s.fetched_at + INTERVAL 365 DAY ELSE v.expire_at END AS expire_at
FROM vec v JOIN stored s USING (item_id)""")
def ttl_recompute_vectors(spark, sf_dir):
    """Vectors follow the articles whose retention changes; the others stay."""
    return ops.recompute_vector_expiry(
        _vectors(spark, sf_dir), t.stored_docs(spark, sf_dir)).select("item_id", "expire_at")


@query("ttl_stats", f"""
WITH {STORED_SQL}, {VEC_SQL}, m AS (
  SELECT *, expire_at <> fetched_at + INTERVAL 365 DAY AS off FROM stored)
SELECT count(*) AS scanned, count(*) FILTER (WHERE off) AS items_updated,
       (SELECT count(*) FROM vec JOIN m USING (item_id) WHERE off) AS vectors_updated,
       count(*) FILTER (WHERE NOT off) AS already_ok, CAST(0 AS BIGINT) AS no_fetched_at,
       min(fetched_at) AS oldest_fetched_at FROM m""")
def ttl_stats(spark, sf_dir):
    """What a retention recompute would change."""
    return ops.retention_stats(t.stored_docs(spark, sf_dir), _vectors(spark, sf_dir))
