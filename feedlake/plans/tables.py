"""The given tables seen as news-feed tables. Pure projections over whole tables.

Each adapter has its SQL twin: a CTE that the oracle queries start from.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions import classify, text
from feedlake.functions.text import BLANKS
from feedlake.operators.items import first_wins

DAY0 = "2024-01-01 00:00:00"
NOW = "2024-01-31 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; ``session.configure`` makes its clock columns instants."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def minutes_after_day0(column: str):
    return F.timestamp_seconds(F.unix_timestamp(F.lit(DAY0).cast("timestamp")) + F.col(column) * 60)


# --- documents as mapped articles ------------------------------------------

def doc_items(spark, sf_dir) -> DataFrame:
    """documents: keyed by their text, the first line as title, no url."""
    return doc_items_of(load(spark, sf_dir, "documents"))


def doc_items_of(doc: DataFrame) -> DataFrame:
    family = F.when(F.col("lang") == "en", C.RSS).when(
        F.col("lang") == "fr", C.SEARCH).otherwise(C.FIREHOSE)
    return doc.select(
        text.content_key("text").alias("item_id"),
        F.concat(F.lit("feed-"), "lang").alias("feed_id"),
        "source",
        F.lit("").alias("asset_hint"),
        F.col("lang").alias("language"),
        F.lit("").alias("url"),
        text.strip(F.substring_index("text", "\n", 1)).alias("title"),
        F.col("text").alias("body"),
        F.lit("").alias("symbol"),
        F.lit(None).cast("timestamp").alias("published_at"),
        minutes_after_day0("doc_id").alias("fetched_at"),
        family.alias("family"),
        F.lit(0).cast("long").alias("feed_pos"),
        F.col("doc_id").alias("row_pos"),
        "doc_id",
    )


# Corpus vocabulary, so that every kind occurs in the given documents.
CORPUS_SIGNALS = {
    "digest_signals": ("einzte", "résumé", "theren the"),
    "spam_signals": ("casino", "pills", "thand", "lecióna"),
    "sports_signals": (" er ", "êeux", " dien"),
}


def corpus_kind(title):
    return classify.kind(title, **CORPUS_SIGNALS)


def stored_docs(spark, sf_dir, *more: str) -> DataFrame:
    """documents as stored articles, one per text; kinds by the corpus vocabulary.

    Bodies are left out unless asked for as one of the ``more`` columns.

    ``expire_at`` follows the old 60-day period for sources with an odd number of letters
    in their name, as a store half-way through a retention change would have it.
    """
    fields = ["doc_id", "source", "title", "fetched_at", *more]
    first = first_wins(doc_items(spark, sf_dir), fields=fields)
    old = F.length("source") % 2 == 1
    days = F.when(old, 60).otherwise(365)
    return first.withColumn("kind", corpus_kind(F.col("title"))).withColumn(
        "expire_at", F.timestamp_seconds(F.unix_timestamp("fetched_at") + days * 86400)
    )


def _sql_any(hay: str, signals) -> str:
    quoted = (s.replace("'", "''") for s in signals)
    return "(" + " OR ".join(f"contains({hay}, '{s}')" for s in quoted) + ")"


def sql_kind(title: str, *, digest_signals=C.DIGEST_SIGNALS, spam_signals=C.SPAM_SIGNALS,
             sports_signals=C.SPORTS_SIGNALS) -> str:
    low = f"lower(trim(coalesce({title}, ''), '{BLANKS}'))"
    hay = f"(' ' || {low} || ' ')"
    return (
        f"CASE WHEN ends_with({low}, '{C.DIGEST_SUFFIX}') OR {_sql_any(hay, digest_signals)} "
        f"THEN 'digest' WHEN {_sql_any(hay, spam_signals)} THEN 'spam' "
        f"WHEN {_sql_any(hay, sports_signals)} THEN 'sports' ELSE 'story' END"
    )


DOC_SQL = f"""doc AS (
  SELECT sha1(trim(text, '{BLANKS}')) AS item_id, 'feed-' || lang AS feed_id, source,
         lang AS language, trim(split_part(text, chr(10), 1), '{BLANKS}') AS title,
         text AS body, TIMESTAMP '{DAY0}' + to_minutes(doc_id) AS fetched_at,
         CASE lang WHEN 'en' THEN 'rss' WHEN 'fr' THEN 'naver' ELSE 'fmp' END AS family, doc_id
  FROM documents)"""
STORED_SQL = f"""{DOC_SQL}, stored AS (
  SELECT *, {sql_kind("title", **CORPUS_SIGNALS)} AS kind,
         fetched_at + CASE WHEN length(source) % 2 = 1 THEN INTERVAL 60 DAY
                           ELSE INTERVAL 365 DAY END AS expire_at
  FROM doc QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY doc_id) = 1)"""


# --- pages as search results -----------------------------------------------

def page_search_rows(spark, sf_dir) -> DataFrame:
    """pages as search results: the page title marked up, the page as description."""
    pages = load(spark, sf_dir, "pages")
    at = minutes_after_day0("page_id")
    return pages.select(
        F.concat(F.lit("lang-"), F.regexp_extract("html", r'<html lang="(\w+)"', 1)).alias("q"),
        F.lit("").alias("asset_hint"),
        F.lit(0).cast("long").alias("feed_pos"),
        F.col("page_id").alias("row_pos"),
        at.alias("fetched_at"),
        F.concat(F.lit("<b>"), F.regexp_extract("html", r"<title>([^<]*)</title>", 1),
                 F.lit("</b>.")).alias("title"),
        F.when(F.col("url").contains("casino"), "").otherwise(F.col("url")).alias("originallink"),
        F.concat(F.lit(" "), F.col("url"), F.lit("\n")).alias("link"),
        F.col("html").alias("description"),
        F.concat(F.date_format(at, "EEE"), F.lit(", "), F.date_format(at, "d MMM yyyy HH:mm:ss"),
                 F.lit(" +0900")).alias("pubDate"),
    )


def sql_clean(html: str, joint: str) -> str:
    """The page cleaner for the markup and entities that the given pages have."""
    r = html
    for pattern in (r"(?s)<!--.*?(-->|\z)", r"(?is)<script.*?(</script>|\z)",
                    r"(?is)<style.*?(</style>|\z)", r"<[a-zA-Z/!?][^>]*(>|\z)"):
        r = f"regexp_replace({r}, '{pattern}', '{joint}', 'g')"
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"),
                       ("gt", ">"), ("nbsp", "\xa0"), ("amp", "&")):
        r = f"replace({r}, '&{name};', '{char}')"
    return rf"trim(regexp_replace({r}, '[\s\x{{a0}}]+', ' ', 'g'))"


def sql_host(url: str) -> str:
    host = rf"regexp_extract({url}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)"
    return f"split_part(lower({host}), ':', 1)"


def _sql_map(key: str) -> str:
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in C.PUBLISHERS.items())
    return f"MAP {{{pairs}}}[{key}]"


def sql_publisher(url: str) -> str:
    host = sql_host(url)
    short = f"regexp_replace({host}, '^({'|'.join(C.HOST_PREFIXES)})\\.', '')"
    return (
        f"CASE WHEN {host} = '' OR contains({host}, '{C.PORTAL_HOST_MARK}') "
        f"THEN '{C.PORTAL_LABEL}' ELSE coalesce({_sql_map(host)}, {_sql_map(short)}, "
        f"nullif({short}, ''), '{C.PORTAL_LABEL}') END"
    )


SEARCH_SQL = rf"""search AS (
  SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS raw,
         'naver:lang-' || regexp_extract(html, '<html lang="(\w+)"', 1) AS feed_id,
         html, TIMESTAMP '2024-01-01' + to_minutes(page_id) AS fetched_at FROM pages)"""


# --- events and orders as poll logs, events as run log ---------------------

def event_polls(spark, sf_dir) -> DataFrame:
    """events as a poll log: a feed per user, in three families."""
    return event_polls_of(load(spark, sf_dir, "events"))


def event_polls_of(e: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    family = F.element_at(
        F.array(*[F.lit(f) for f in C.FAMILIES]), (F.col("user_id") % 3 + 1).cast("int"))
    return e.select(
        family.alias("family"),
        F.concat(F.lit("feed-"), F.col("user_id").cast("string")).alias("feed_id"),
        "ts",
        F.col("event_id").alias("seq"),
        F.when(kind == "error", 500).when(kind == "view", 304).otherwise(200).alias("status"),
        (~((kind == "signup") & (F.col("value") < 5))).alias("is_feed"),
        F.when(kind == "click", F.regexp_extract("props", r'"k": (\d+)', 1)).alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        F.floor("value").cast("long").alias("new_count"),
        F.lit(None).cast("string").alias("error"),
    )


POLL_SQL = r"""poll AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'rss' WHEN 1 THEN 'naver' ELSE 'fmp' END AS family,
         'feed-' || user_id AS feed_id, ts, event_id AS seq,
         CASE event_type WHEN 'error' THEN 500 WHEN 'view' THEN 304 ELSE 200 END AS status,
         NOT (event_type = 'signup' AND value < 5) AS is_feed,
         CASE WHEN event_type = 'click' THEN regexp_extract(props, '"k": (\d+)', 1) END AS etag,
         CAST(NULL AS VARCHAR) AS last_modified, CAST(floor(value) AS BIGINT) AS new_count
  FROM events), poll_ok AS (
  SELECT *, (status = 304 OR (status = 200 AND is_feed)) AS ok FROM poll)"""


def order_polls(spark, sf_dir) -> DataFrame:
    """orders as a large poll log: a feed per customer."""
    o = load(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    family = F.element_at(
        F.array(*[F.lit(f) for f in C.FAMILIES]), (F.col("o_custkey") % 3 + 1).cast("int"))
    return o.select(
        family.alias("family"),
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("feed_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("seq"),
        F.when(status == "F", 503).when(status == "P", 304).otherwise(200).alias("status"),
        F.lit(True).alias("is_feed"),
        F.col("o_orderpriority").alias("etag"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_modified"),
        F.lit(1).cast("long").alias("new_count"),
        F.lit(None).cast("string").alias("error"),
    )


ORDER_POLL_SQL = """poll_ok AS (
  SELECT CASE o_custkey % 3 WHEN 0 THEN 'rss' WHEN 1 THEN 'naver' ELSE 'fmp' END AS family,
         'cust-' || o_custkey AS feed_id, o_orderdate AS ts, o_orderkey AS seq,
         CASE o_orderstatus WHEN 'F' THEN 503 WHEN 'P' THEN 304 ELSE 200 END AS status,
         true AS is_feed, o_orderpriority AS etag,
         strftime(o_orderdate, '%Y-%m-%d') AS last_modified, 1 AS new_count,
         o_orderstatus <> 'F' AS ok
  FROM orders)"""

# feed state by windows and ordered aggregates, from poll_ok
STATE_SQL = """last_ok AS (
  SELECT feed_id, max(row(ts, seq)) FILTER (WHERE ok) AS ok_at FROM poll_ok GROUP BY feed_id
), state AS (
  SELECT p.feed_id,
         arg_max(row(etag, last_modified), row(ts, seq)) FILTER (WHERE ok AND status = 200) AS cur,
         max(ts) FILTER (WHERE ok) AS last_success,
         count(*) FILTER (WHERE NOT ok AND (ok_at IS NULL OR row(ts, seq) > ok_at)) AS streak,
         arg_max(CASE WHEN ok THEN '' WHEN status = 200 THEN 'not a parseable feed'
                      ELSE 'HTTP ' || status END, row(ts, seq)) AS err,
         arg_max(ts, row(ts, seq)) AS last_ts
  FROM poll_ok p JOIN last_ok USING (feed_id) GROUP BY p.feed_id
), feed_state AS (
  SELECT feed_id, cur[1] AS etag, cur[2] AS last_modified, last_success AS last_fetched,
         last_success, CAST(streak AS BIGINT) AS consecutive_failures,
         nullif(err, '') AS last_error,
         CASE WHEN err <> '' THEN last_ts END AS last_error_at
  FROM state)"""


def event_runs(spark, sf_dir) -> DataFrame:
    """events as a run log: a job per user."""
    e = load(spark, sf_dir, "events")
    kind = F.col("event_type")
    return e.select(
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job"),
        "ts",
        F.col("event_id").alias("seq"),
        F.when(kind == "error", "fail").when(kind == "purchase", "ok").otherwise("start")
        .alias("event"),
        F.when(kind == "error", "").otherwise(F.concat(F.lit(" run "), "props")).alias("detail"),
        F.concat(F.lit("code "), F.col("value").cast("int").cast("string")).alias("error"),
    )


RUN_SQL = """health AS (
  SELECT 'job-' || user_id AS job,
         arg_max(CASE event_type WHEN 'error' THEN 'fail' WHEN 'purchase' THEN 'ok'
                 ELSE 'running' END, event_id) AS last_status,
         max(ts) AS fetched_at,
         max(ts) FILTER (WHERE event_type NOT IN ('error', 'purchase')) AS last_run_at,
         max(ts) FILTER (WHERE event_type IN ('error', 'purchase')) AS last_finished_at,
         max(ts) FILTER (WHERE event_type = 'purchase') AS last_success_at,
         arg_max(CASE event_type WHEN 'error' THEN 'ERROR: code ' || CAST(trunc(value) AS INT)
                 ELSE 'run ' || props END, event_id)
           FILTER (WHERE event_type IN ('error', 'purchase')) AS detail
  FROM events GROUP BY user_id)"""


# --- other roles -----------------------------------------------------------

def supplier_registry(spark, sf_dir) -> DataFrame:
    """supplier and nation as a feed registry."""
    s, n = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "nation")
    tier = F.when(F.col("s_acctbal") < 2500, "primary").when(
        F.col("s_acctbal") < 5000, "analysis").otherwise("wire")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_name").alias("feed_id"),
        F.lit("").alias("url"),
        F.col("n_name").alias("source"),
        F.lit("").alias("asset_hint"),
        F.lit("en").alias("language"),
        F.when(F.col("s_acctbal") < 0, "calendar").otherwise("summary").alias("body_mode"),
        F.lit(None).cast("double").alias("tz_offset"),
        tier.alias("tier"),
        F.col("s_suppkey").alias("feed_pos"),
    )


REG_SQL = """reg AS (
  SELECT s_name AS feed_id, n_name AS source, s_suppkey AS feed_pos,
         CASE WHEN s_acctbal < 0 THEN 'calendar' ELSE 'summary' END AS body_mode,
         CASE WHEN s_acctbal < 2500 THEN 'primary' WHEN s_acctbal < 5000 THEN 'analysis'
              ELSE 'wire' END AS tier
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def doc_vectors(spark, sf_dir) -> DataFrame:
    """embeddings as stored vectors of the documents with the same number."""
    v = load(spark, sf_dir, "embeddings")
    ids = doc_items(spark, sf_dir).select("item_id", F.col("doc_id").alias("vec_id"))
    label = F.col("label")
    return v.join(ids, "vec_id").select(
        "item_id", "vec_id",
        F.col("embedding").cast("array<double>").alias("vector"),
        F.when(label < 7, C.EMBED_MODEL).when(label == 7, "older-model").alias("embed_model"),
        F.when(label < 6, C.EMBED_TASK_TYPE).when(label == 6, "CLUSTERING")
        .alias("embed_task_type"),
        minutes_after_day0("vec_id").alias("embedded_at"),
        F.timestamp_seconds(F.unix_timestamp(minutes_after_day0("vec_id")) + 60 * 86400)
        .alias("expire_at"),
    )


def one_vector_per_item(vectors: DataFrame, *fields: str) -> DataFrame:
    """The vector table has one row per article: the one of the lowest number."""
    rest = fields or [c for c in vectors.columns if c not in ("item_id", "vec_id")]
    return vectors.groupBy("item_id").agg(
        F.min_by(F.struct(*rest), "vec_id").alias("_v")).select("item_id", "_v.*")


VEC_SQL = f"""vec AS (
  SELECT item_id, vec_id, embedding AS vector,
         CASE WHEN label < 7 THEN '{C.EMBED_MODEL}' WHEN label = 7 THEN 'older-model' END
           AS embed_model,
         CASE WHEN label < 6 THEN '{C.EMBED_TASK_TYPE}' WHEN label = 6 THEN 'CLUSTERING' END
           AS embed_task_type,
         TIMESTAMP '{DAY0}' + to_minutes(vec_id) AS embedded_at,
         TIMESTAMP '{DAY0}' + to_minutes(vec_id) + INTERVAL 60 DAY AS expire_at
  FROM embeddings JOIN doc ON vec_id = doc_id
  QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY vec_id) = 1)"""


def order_pages(spark, sf_dir) -> DataFrame:
    """lineitem as landed pages: a request per order, a page per line number."""
    return (
        load(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("request"),
                 (F.col("l_linenumber") - 1).alias("page"))
        .agg(F.count("*").alias("n_rows"))
    )


def firehose_parts(spark, sf_dir) -> DataFrame:
    """part as firehose rows of two endpoints, with exchange-prefixed tickers."""
    p = load(spark, sf_dir, "part")
    article = F.col("p_type").isin("ECONOMY", "PROMO")
    name = F.concat(F.lit(" "), "p_name", F.lit(" "), F.col("p_partkey").cast("string"))
    day = F.date_format(
        F.timestamp_seconds(F.unix_timestamp(F.lit(DAY0).cast("timestamp"))
                            + F.col("p_partkey") * 40000), "yyyy-MM-dd HH:mm:ss")
    url = F.when(F.col("p_size") > 10, F.concat(F.lit("https://e/"), F.col("p_partkey")
                                                .cast("string"))).otherwise("")
    return p.select(
        F.when(article, C.ARTICLE_ENDPOINT).otherwise("stock-latest").alias("endpoint"),
        F.lit(0).alias("page"),
        F.lit(DAY0).cast("timestamp").alias("fetched_at"),
        F.lit(0).cast("long").alias("feed_pos"),
        F.col("p_partkey").alias("row_pos"),
        F.when(F.col("p_size") > 25, F.concat(F.col("p_brand"), F.lit(" "))).alias("symbol"),
        day.alias("publishedDate"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("").alias("publisher"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_type")).alias("site"),
        name.alias("title"),
        F.concat(F.lit("<p>"), "p_name", F.lit("<b>is</b> &quot;new&quot;</p>")).alias("text"),
        url.alias("url"),
        url.alias("link"),
        F.concat(F.lit("<i>"), "p_name", F.lit("</i>cut")).alias("content"),
        F.substring(day, 1, 16).alias("date"),
        F.concat(F.col("p_type"), F.lit(": "), F.col("p_brand"), F.lit(",NYSE:GS"))
        .alias("tickers"),
    )
