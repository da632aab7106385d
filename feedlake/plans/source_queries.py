"""Catalogue: payload scans, registries, page bodies."""

from datetime import datetime

from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions import text
from feedlake.operators import bodies, mapping, paging
from feedlake.plans import tables as t
from feedlake.plans.catalogue import query
from feedlake.plans.tables import REG_SQL, SEARCH_SQL, load, sql_clean, sql_publisher
from feedlake.schemas import FEED_REGISTRY
from feedlake.session import scratch_path
from feedlake.sources import landing, payloads, registry


# --- feed payloads ---------------------------------------------------------

def _xml(c):
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def feed_payloads(spark, sf_dir):
    """Every document as one landed response: RSS, Atom, RDF or a block page, by language."""
    doc = load(spark, sf_dir, "documents")
    ident = F.col("doc_id").cast("string")
    body = _xml(F.col("text"))
    title = _xml(F.substring_index("text", "\n", 1))
    stamp = F.date_format(t.minutes_after_day0("doc_id"), "EEE, dd MMM yyyy HH:mm:ss")
    iso = F.date_format(t.minutes_after_day0("doc_id"), "yyyy-MM-dd'T'HH:mm:ss")

    def s(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    rss = s('<?xml version="1.0"?><rss version="2.0"><channel><title>R</title><item><title> ',
            title, "</title><link> https://e/", ident, "\n</link><description>", body,
            "</description><content:encoded>", body, "</content:encoded><pubDate>", stamp,
            " GMT</pubDate></item><item><description>no identity</description></item>"
            "</channel></rss>")
    atom = s('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>', title,
             '</title><link rel="self" href="https://no/"/><id>tag:', ident, "</id><summary>",
             body, "</summary><updated>", iso, "+09:00</updated></entry></feed>")
    rdf = s("<rdf:RDF><channel><title>c</title></channel><item><title>", title,
            "</title><description>", body, "&nbsp;</description><dc:date>", iso,
            "Z</dc:date></item></rdf:RDF>")
    page = s("<!DOCTYPE html><html><head><title>", title, "</title></head><body>blocked</body>",
             "</html>")
    lang = F.col("lang")
    return doc.select(
        F.concat(F.lit("feed-"), "lang").alias("feed_id"),
        t.minutes_after_day0("doc_id").alias("fetched_at"),
        F.col("doc_id").alias("seq"),
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        F.when(lang == "en", rss).when(lang == "fr", atom).when(lang == "es", rdf)
        .otherwise(page).alias("payload"),
    )


def feed_registry(spark):
    """Configuration: three feeds with different body modes and clocks."""
    rows = [("feed-en", "", "English", "us", "en", "full", None, "wire", 0),
            ("feed-fr", "", "French", "", "fr", "headline", None, "primary", 1),
            ("feed-es", "", "Spanish", "", "es", "summary", 2.0, "wire", 2)]
    return spark.createDataFrame(rows, FEED_REGISTRY)


_PLAIN = rf"trim(split_part(text, chr(10), 1), '{text.BLANKS}')"
_AT = "TIMESTAMP '2024-01-01' + to_minutes(doc_id)"


def _scan_sql(more=""):
    """The articles of all documents that land as feeds."""
    return f"""
SELECT feed_id, url, title, body, source, asset_hint, published_at, {more}
       sha1(basis) AS item_id
FROM (SELECT 'feed-' || lang AS feed_id, CASE lang WHEN 'en' THEN 'https://e/' || doc_id
               ELSE '' END AS url, {_PLAIN} AS title,
             CASE lang WHEN 'fr' THEN '' ELSE {sql_clean("text", " ")} END AS body,
             CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE 'Spanish' END
               AS source, CASE lang WHEN 'en' THEN 'us' ELSE '' END AS asset_hint,
             CASE lang WHEN 'en' THEN {_AT} WHEN 'fr' THEN {_AT} - INTERVAL 9 HOUR
               ELSE {_AT} - INTERVAL 2 HOUR END AS published_at, {_AT} AS fetched_at,
             CASE lang WHEN 'en' THEN 'https://e/' || doc_id WHEN 'fr' THEN 'tag:' || doc_id
               ELSE {_PLAIN} END AS basis
      FROM documents WHERE lang IN ('en', 'fr', 'es'))"""


@query("rss_scan", _scan_sql("fetched_at,"))
def rss_scan(spark, sf_dir):
    """RSS, Atom and RDF payloads parsed and mapped; the identity-less entry is dropped."""
    scanned = payloads.scan_feeds(feed_payloads(spark, sf_dir))
    items = mapping.map_feed_rows(payloads.feed_rows(scanned), feed_registry(spark))
    return items.select("feed_id", "url", "title", "body", "source", "asset_hint",
                        "published_at", "fetched_at", "item_id")


@query("feed_files_scan", _scan_sql())
def feed_files_scan(spark, sf_dir):
    """The same documents landed as a few large files per feed, each file read by many tasks."""
    folder = scratch_path(spark, "feed-files")
    feed_payloads(spark, sf_dir).select("feed_id", F.col("payload").alias("value")).hint(
        "rebalance", "feed_id").write.partitionBy("feed_id").text(folder)
    rows = payloads.scan_feed_files(spark, folder).unionByName(
        payloads.scan_feed_files(spark, folder, tag="entry"))
    rows = rows.withColumns({"fetched_at": t.now(), "seq": F.lit(0).cast("long")})
    return mapping.map_feed_rows(rows, feed_registry(spark)).select(
        "feed_id", "url", "title", "body", "source", "asset_hint", "published_at", "item_id")


@query("notafeed_guard", """
SELECT doc_id AS seq, lang <> 'de' AS is_feed, CASE lang WHEN 'en' THEN 2 WHEN 'de' THEN 0
  ELSE 1 END AS entries FROM documents""")
def notafeed_guard(spark, sf_dir):
    """Which responses were feeds, and how many entries they had."""
    return payloads.scan_feeds(feed_payloads(spark, sf_dir)).select(
        "seq", "is_feed", F.size("entries").alias("entries"))


@query("broken_feeds", """
SELECT doc_id AS seq, doc_id % 3 <> 2 AS is_feed, CASE doc_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 0 END AS entries,
       CASE doc_id % 3 WHEN 0 THEN 'https://e/' || doc_id || '/2' WHEN 1 THEN 'https://e/' || doc_id || '/3' END
         AS last_link FROM documents""")
def broken_feeds(spark, sf_dir):
    """Documents as feeds cut in their third item, left unclosed, or block pages with items."""
    doc = load(spark, sf_dir, "documents")
    ident = F.col("doc_id").cast("string")
    item = lambda n: F.concat(
        F.lit("<item><title>a &nbsp; b</title><link>https://e/"), ident, F.lit(f"/{n}</link></item>"))
    two = F.concat(item(1), item(2))
    head = F.lit('<rss version="2.0"><channel><title>c</title>')
    payload = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(head, two, F.lit("<item><title>lost</title><li")))
        .when(F.col("doc_id") % 3 == 1, F.concat(head, two, item(3), F.lit("</channel>")))
        .otherwise(F.concat(F.lit("<!DOCTYPE html><html><body>blocked"), two, F.lit("<p></body>"))))
    landed = doc.select(
        F.col("doc_id").alias("seq"), F.lit("f").alias("feed_id"), t.now().alias("fetched_at"),
        F.lit(200).alias("status"), payload.alias("payload"))
    return payloads.scan_feeds(landed).select(
        "seq", "is_feed", F.size("entries").alias("entries"),
        F.try_element_at("entries", F.lit(-1))["link"].alias("last_link"))


@query("dropped_entries", """
SELECT 'feed-en' AS feed_id, count(*) AS dropped FROM documents WHERE lang = 'en'
HAVING count(*) > 0""")
def dropped_entries(spark, sf_dir):
    """Entries without link, guid and title, per feed."""
    scanned = payloads.scan_feeds(feed_payloads(spark, sf_dir))
    return mapping.feed_rows_without_basis(payloads.feed_rows(scanned))


# --- JSON payloads ---------------------------------------------------------

@query("search_scan", f"""
WITH {SEARCH_SQL}
SELECT sha1(url) AS item_id, feed_id, {sql_publisher("url")} AS source, url,
       {sql_clean("raw || '.'", "")} AS title, fetched_at - INTERVAL 9 HOUR AS published_at
FROM search""")
def search_scan(spark, sf_dir):
    """Search responses as JSON text, parsed and mapped."""
    rows = t.page_search_rows(spark, sf_dir)
    entry = F.struct("title", "originallink", "link", "description", "pubDate")
    landed = rows.select(
        "q", "fetched_at", F.col("row_pos").alias("seq"), F.lit(200).alias("status"),
        F.to_json(F.struct(F.array(entry).alias("items"))).alias("payload"),
        "asset_hint", "feed_pos")
    scanned = payloads.scan_search(landed)
    hints = F.lit("").alias("asset_hint"), F.lit(0).cast("long").alias("feed_pos")
    found = payloads.search_rows(scanned).select("*", *hints)
    return mapping.map_search_rows(found).select(
        "item_id", "feed_id", "source", "url", "title", "published_at")


def firehose_payloads(spark, sf_dir):
    """part as landed firehose pages: ten part keys to a page, four pages to a request."""
    parts = t.firehose_parts(spark, sf_dir)
    key = F.col("row_pos")
    parts = parts.withColumn("request", F.floor(key / 40)).withColumn(
        "page", F.floor(key % 40 / 10).cast("int"))
    entry = F.struct("symbol", "publishedDate", "publisher", "site", "title", "text", "url",
                     "link", "content", "date", "tickers")
    # ten part keys share a page, so each list below has at most ten entries
    return parts.groupBy("endpoint", "request", "page").agg(
        F.to_json(F.sort_array(F.collect_list(entry))).alias("payload")
    ).withColumns({"status": F.lit(200), "seq": (F.col("request") * 4 + F.col("page")).cast("long")})


FIREHOSE_SQL = """p AS (
  SELECT *, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'fmp-articles' ELSE 'stock-latest' END
    AS endpoint, p_partkey // 40 AS request, p_partkey % 40 // 10 AS page FROM part
), counted AS (
  SELECT endpoint, request, page, {rows} AS n FROM p GROUP BY endpoint, request, page
), flagged AS (
  SELECT *, page = row_number() OVER w - 1 AS in_row,
         page = row_number() OVER w - 1 AND n >= 3 AS is_full
  FROM counted WINDOW w AS (PARTITION BY endpoint, request ORDER BY page)
), read AS (
  SELECT *, in_row AND coalesce(bool_and(is_full) OVER (PARTITION BY endpoint, request
           ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS accepted
  FROM flagged)"""


@query("firehose_scan", f"""
WITH {FIREHOSE_SQL.format(rows="count(*)")}
SELECT p.endpoint, p.request, p.page, count(*) AS articles,
       CAST(sum(p_partkey) AS BIGINT) AS key_sum
FROM p JOIN read r ON p.endpoint = r.endpoint AND p.request = r.request AND p.page = r.page
WHERE accepted GROUP BY ALL""")
def firehose_scan(spark, sf_dir):
    """Firehose pages as JSON text: parsed, cut after the first short page, counted."""
    scanned = payloads.scan_firehose(
        firehose_payloads(spark, sf_dir).withColumn("fetched_at", t.now()))
    return _page_sums(scanned, ["endpoint", "request"])


def _page_sums(scanned, request):
    """Articles of the pages that count, and the sum of their numbers."""
    read = paging.accepted_pages(
        scanned.select(*request, "page", "n_rows"), request, page_size=3)
    rows = scanned.join(
        read.filter("accepted").select(*request, "page"), [*request, "page"], "left_semi"
    ).select(*request, "page", F.explode("entries").alias("entry"))
    number = F.substring_index(text.strip(F.col("entry.title")), " ", -1).cast("long")
    return rows.groupBy(*request, "page").agg(
        F.count("*").alias("articles"), F.sum(number).alias("key_sum"))


@query("firehose_window", f"""
WITH {FIREHOSE_SQL.format(rows="count(*)")}, fetched AS (
  SELECT p.endpoint, TIMESTAMP '{t.DAY0}' + to_days(p.request % 30) + to_seconds(p.request) AS fetched_at,
         p.page, p_partkey
  FROM p JOIN read r ON p.endpoint = r.endpoint AND p.request = r.request AND p.page = r.page WHERE accepted)
SELECT endpoint, fetched_at, page, count(*) AS articles, CAST(sum(p_partkey) AS BIGINT) AS key_sum
FROM fetched WHERE CAST(fetched_at AS DATE) BETWEEN CAST(TIMESTAMP '{t.NOW}' AS DATE) - 3 AND TIMESTAMP '{t.NOW}'
GROUP BY ALL""")
def firehose_window(spark, sf_dir):
    """Firehose pages of a month landed by endpoint and date; the lookback window of its last day, scanned."""
    folder = scratch_path(spark, "firehose-window")
    seconds = F.col("request") % 30 * 86400 + F.col("request")
    pages = firehose_payloads(spark, sf_dir).withColumn(
        "fetched_at", F.timestamp_seconds(F.unix_timestamp(F.lit(t.DAY0).cast("timestamp")) + seconds))
    landing.land(folder, firehose=pages)
    recent = landing.window(landing.read(spark, folder), datetime.fromisoformat(t.NOW))
    scanned = payloads.scan_firehose(landing.split(recent)["firehose"])
    return _page_sums(scanned, ["endpoint", "fetched_at"])


# --- registries ------------------------------------------------------------

@query("registry_dups", """
SELECT c_mktsegment || '-' || c_nationkey AS feed_id, count(*) AS n FROM customer
GROUP BY 1 HAVING count(*) > 1""")
def registry_dups(spark, sf_dir):
    """Duplicate ids of a registry kept in a table."""
    ids = load(spark, sf_dir, "customer").select(
        F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string"))
        .alias("feed_id"))
    return registry.duplicate_feeds(ids)


@query("registry_invalid", f"""
WITH {REG_SQL}
SELECT feed_id, body_mode, tier FROM reg
WHERE body_mode NOT IN ('full', 'summary', 'headline')
   OR tier NOT IN ('primary', 'analysis', 'wire')""")
def registry_invalid(spark, sf_dir):
    """Registry rows outside their domains."""
    return registry.invalid_feeds(t.supplier_registry(spark, sf_dir)).select(
        "feed_id", "body_mode", "tier")


@query("distinct_sources", f"""
WITH {REG_SQL} SELECT source, min(feed_pos) AS first_pos FROM reg GROUP BY source""")
def distinct_sources(spark, sf_dir):
    """Sources with the position of their first feed."""
    return registry.distinct_sources(t.supplier_registry(spark, sf_dir))


@query("source_tiers", f"""
WITH {REG_SQL} SELECT source, arg_min(tier, feed_pos) AS tier FROM reg GROUP BY source""")
def source_tiers(spark, sf_dir):
    """Tier of every source, from its first feed."""
    return registry.source_tiers(t.supplier_registry(spark, sf_dir))


@query("sources_meta", f"""
WITH {REG_SQL}, s AS (
  SELECT source, min(feed_pos) AS pos, arg_min(tier, feed_pos) AS tier FROM reg GROUP BY source)
SELECT 'sources' AS key, string_agg(source, ',' ORDER BY pos) AS sources,
       string_agg(source || '=' || tier, ',' ORDER BY pos) AS tiers FROM s""")
def sources_meta(spark, sf_dir):
    """The published document of ordered sources and tiers, printed as text."""
    meta = registry.sources_meta(t.supplier_registry(spark, sf_dir))
    pairs = F.transform(
        "sources", lambda s: F.concat(s, F.lit("="), F.try_element_at(F.col("tiers"), s)))
    return meta.select("key", F.array_join("sources", ",").alias("sources"),
                       F.array_join(pairs, ",").alias("tiers"))


@query("registry_drift", f"""
WITH {REG_SQL}, pub AS (
  SELECT 'NATION_' || p_size AS source FROM part)
SELECT DISTINCT source, 'published only' AS side FROM pub
WHERE source NOT IN (SELECT source FROM reg)
UNION ALL
SELECT DISTINCT source, 'registry only' FROM reg WHERE source NOT IN (SELECT source FROM pub)""")
def registry_drift(spark, sf_dir):
    """Sources that only one of two lists has."""
    published = load(spark, sf_dir, "part").select(
        F.concat(F.lit("NATION_"), F.col("p_size").cast("string")).alias("source"))
    return registry.source_drift(published, t.supplier_registry(spark, sf_dir))


@query("selector_drift", f"""
WITH {REG_SQL}
SELECT DISTINCT 'NATION_' || p_size AS source FROM part
WHERE 'NATION_' || p_size NOT IN (SELECT source FROM reg)""")
def selector_drift(spark, sf_dir):
    """Selector sources without a registry row."""
    selectors = load(spark, sf_dir, "part").select(
        F.concat(F.lit("NATION_"), F.col("p_size").cast("string")).alias("source"))
    return registry.selector_drift(selectors, t.supplier_registry(spark, sf_dir))


# --- page bodies -----------------------------------------------------------

# Configuration of this catalogue: publishers whose pages are read, and where.
_SELECTORS = [("blog.tionsh.example.com", "article"), ("tionble.example.org", "article"),
              ("tiontion.example.net", "div.ad"), ("ththth.example.net", "article"),
              ("ththon.example.org", ".missing")]


def _headlines(spark, sf_dir):
    """Pages as headline-only articles, a feed per language."""
    rows = t.page_search_rows(spark, sf_dir).withColumn("description", F.lit(""))
    return mapping.map_search_rows(rows)


def _page_payloads(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    return pages.select(
        "url", F.lit(t.NOW).cast("timestamp").alias("fetched_at"),
        F.when(F.col("url").contains("page=2"), 404).otherwise(200).alias("status"), "html")


def _store_of_pages(spark, sf_dir):
    """Stored already: the pages whose number a label has."""
    labels = load(spark, sf_dir, "labels").filter("toxic = 1").select(
        F.col("doc_id").alias("row_pos"))
    return _headlines(spark, sf_dir).join(labels, "row_pos", "left_semi")


def _fetched(spark, sf_dir, per_feed=None):
    selectors = spark.createDataFrame(_SELECTORS, "source string, selector string")
    targets = bodies.body_targets(
        _headlines(spark, sf_dir), _store_of_pages(spark, sf_dir), selectors, per_feed=per_feed)
    return bodies.fetch_bodies(targets, _page_payloads(spark, sf_dir))


def _fetched_sql(per_feed: int | None = None) -> str:
    limit = "" if per_feed is None else (
        f"QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY page_id) <= {per_feed}")
    article = sql_clean(r"regexp_extract(html, '(?s)<article>(.*?)(</article>|\z)', 1)", " ")
    ad = sql_clean(r'''regexp_extract(html, '(?s)<div class="ad">(.*?)(</div>|\z)', 1)''', " ")
    table = ", ".join(f"('{a}', '{b}')" for a, b in _SELECTORS)
    return rf"""{SEARCH_SQL}, art AS (
  SELECT *, {sql_publisher("url")} AS source FROM search
), targets AS (
  SELECT a.*, selector FROM art a JOIN (VALUES {table}) v(source, selector) USING (source)
  WHERE page_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
  {limit}
), fetched AS (
  SELECT page_id, feed_id, sha1(url) AS item_id, CASE WHEN contains(url, 'page=2') THEN ''
    WHEN length(b) >= 80 THEN b ELSE '' END AS body
  FROM (SELECT *, CASE selector WHEN 'article' THEN {article} WHEN 'div.ad' THEN {ad}
               ELSE '' END AS b FROM targets))"""


@query("body_targets", f"WITH {_fetched_sql()} SELECT item_id, feed_id FROM fetched")
def body_targets(spark, sf_dir):
    """Articles whose page is asked for: all new ones of listed sources."""
    return _fetched(spark, sf_dir).select("item_id", "feed_id")


@query("body_targets_capped", f"WITH {_fetched_sql(2)} SELECT item_id, feed_id FROM fetched")
def body_targets_capped(spark, sf_dir):
    """The first two per feed, for sites that ration calls."""
    return _fetched(spark, sf_dir, 2).select("item_id", "feed_id")


@query("body_enrich", f"""
WITH {_fetched_sql()}
SELECT sha1(s.url) AS item_id, coalesce(f.body, '') AS body
FROM search s LEFT JOIN fetched f USING (page_id)""")
def body_enrich(spark, sf_dir):
    """All headline articles, with the bodies that were found."""
    selectors = spark.createDataFrame(_SELECTORS, "source string, selector string")
    return bodies.enrich_bodies(
        _headlines(spark, sf_dir), _store_of_pages(spark, sf_dir), selectors,
        _page_payloads(spark, sf_dir)).select("item_id", "body")


@query("empty_body_rate", f"""
WITH {_fetched_sql()}
SELECT feed_id, count(*) AS targets, count(*) FILTER (WHERE body = '') AS empty,
       round(count(*) FILTER (WHERE body = '') / count(*), 6) AS rate,
       count(*) FILTER (WHERE body = '') / count(*) >= 0.5 AS alert
FROM fetched GROUP BY feed_id""")
def empty_body_rate(spark, sf_dir):
    """Share of fetched pages per feed that gave no body."""
    rates = bodies.empty_body_rate(_fetched(spark, sf_dir))
    return rates.withColumn("rate", F.round("rate", 6))
