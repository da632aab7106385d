"""Catalogue: feed state, page truncation, verdicts, job health."""

from pyspark.sql import functions as F

from feedlake.functions import text
from feedlake.operators import health, paging
from feedlake.plans import tables as t
from feedlake.plans.catalogue import query
from feedlake.plans.tables import ORDER_POLL_SQL, POLL_SQL, RUN_SQL, STATE_SQL, load


@query("feed_state_fold", f"WITH {POLL_SQL}, {STATE_SQL} SELECT * FROM feed_state")
def feed_state_fold(spark, sf_dir):
    """State of every feed after all polls of the event log."""
    return health.fold_feed_state(t.event_polls(spark, sf_dir))


@query("feed_state_fold_large", f"WITH {ORDER_POLL_SQL}, {STATE_SQL} SELECT * FROM feed_state")
def feed_state_fold_large(spark, sf_dir):
    """The same over the order log: many feeds, long streaks."""
    return health.fold_feed_state(t.order_polls(spark, sf_dir))


_MID = "2024-01-15 00:00:00"


@query("feed_state_continued", f"WITH {POLL_SQL}, {STATE_SQL} SELECT * FROM feed_state")
def feed_state_continued(spark, sf_dir):
    """Fold of the first half, continued with the second: the same state as in one go."""
    polls = t.event_polls(spark, sf_dir)
    middle = F.lit(_MID).cast("timestamp")
    prior = health.fold_feed_state(polls.filter(F.col("ts") < middle))
    return health.fold_feed_state(polls.filter(F.col("ts") >= middle), prior)


@query("state_update", """
WITH cur AS (
  SELECT c_custkey AS feed_id, c_mktsegment AS etag, c_name AS last_modified FROM customer
), chg AS (
  SELECT o_custkey AS feed_id, arg_max(o_orderpriority, o_orderkey) AS etag,
         max(o_orderkey) % 2 = 0 AS etag_given, max(o_orderkey) % 3 = 0 AS clear_modified
  FROM orders GROUP BY o_custkey)
SELECT coalesce(chg.feed_id, cur.feed_id) AS feed_id,
       CASE WHEN coalesce(etag_given, false) THEN chg.etag ELSE cur.etag END AS etag,
       CASE WHEN coalesce(clear_modified, false) THEN NULL ELSE cur.last_modified END
         AS last_modified
FROM cur FULL JOIN chg ON cur.feed_id = chg.feed_id""")
def state_update(spark, sf_dir):
    """Partial updates merged over rows; a given NULL overwrites, a missing field does not."""
    current = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("feed_id"), F.col("c_mktsegment").alias("etag"),
        F.col("c_name").alias("last_modified"))
    changes = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("feed_id")).agg(
        F.max_by("o_orderpriority", "o_orderkey").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        (F.max("o_orderkey") % 2 == 0).alias("etag_given"),
        (F.max("o_orderkey") % 3 == 0).alias("modified_given"))
    return health.update_state(
        current, changes, {"etag": "etag_given", "last_modified": "modified_given"},
        key="feed_id", fields=["etag", "last_modified"])


@query("state_lookup", f"""
WITH {ORDER_POLL_SQL}, {STATE_SQL}
SELECT 'cust-' || c_custkey AS feed_id, etag, consecutive_failures
FROM customer LEFT JOIN feed_state ON feed_id = 'cust-' || c_custkey""")
def state_lookup(spark, sf_dir):
    """State of every customer's feed; customers without orders have none."""
    keys = load(spark, sf_dir, "customer").select(
        F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("feed_id"))
    state = health.fold_feed_state(t.order_polls(spark, sf_dir))
    return health.lookup_state(keys, state).select("feed_id", "etag", "consecutive_failures")


# full = pages 0..p without a gap, each with at least page_size rows
_PAGES_SQL = """counted AS (
  SELECT l_orderkey AS request, l_linenumber - 1 AS page, count(*) AS n_rows
  FROM lineitem GROUP BY 1, 2
), flagged AS (
  SELECT *, page = row_number() OVER w - 1 AS in_row,
         page = row_number() OVER w - 1 AND n_rows >= {size} AS is_full
  FROM counted WINDOW w AS (PARTITION BY request ORDER BY page)
), read AS (
  SELECT *, in_row AND coalesce(bool_and(is_full) OVER (PARTITION BY request ORDER BY page
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS accepted FROM flagged)"""


@query("page_truncation", f"""
WITH {_PAGES_SQL.format(size=1)}
SELECT request, count(*) FILTER (WHERE accepted) AS pages_read,
       CAST(coalesce(sum(n_rows) FILTER (WHERE accepted), 0) AS BIGINT) AS rows_read,
       count(*) FILTER (WHERE accepted AND is_full) >= 3 AS truncated
FROM read GROUP BY request""")
def page_truncation(spark, sf_dir):
    """Every request, read to the end or to a gap; cut off if the fetcher stopped at three pages."""
    read = paging.accepted_pages(t.order_pages(spark, sf_dir), ["request"], page_size=1)
    return paging.page_totals(read, ["request"], cap=3)


@query("page_concat", f"""
WITH {_PAGES_SQL.format(size=2)}
SELECT request, page, n_rows FROM read WHERE accepted""")
def page_concat(spark, sf_dir):
    """Pages that count: up to and with the first one of fewer than two rows."""
    read = paging.accepted_pages(t.order_pages(spark, sf_dir), ["request"], page_size=2)
    return read.filter("accepted").select("request", "page", "n_rows")


@query("page_concat_capped", f"""
WITH {_PAGES_SQL.format(size=1)}
SELECT request, page, n_rows FROM read WHERE accepted AND page < 2""")
def page_concat_capped(spark, sf_dir):
    """The first two pages at most, on request."""
    read = paging.accepted_pages(t.order_pages(spark, sf_dir), ["request"], cap=2, page_size=1)
    return read.filter("accepted").select("request", "page", "n_rows")


def _runs(spark, sf_dir):
    """Every day of the log as a run: summaries, and the streaks as of each."""
    polls = t.event_polls(spark, sf_dir).withColumn("run", F.to_date("ts"))
    return health.pass_summary(polls, run="run"), health.streaks_by_run(polls, "run")


_SUMMARY_SQL = f"""{POLL_SQL}, numbered AS (
  SELECT *, CAST(ts AS DATE) AS run, row_number() OVER (PARTITION BY feed_id ORDER BY ts, seq) AS n
  FROM poll_ok
), streaks AS (
  SELECT run, feed_id, n - coalesce(max(CASE WHEN ok THEN n END) OVER (
    PARTITION BY feed_id ORDER BY n), 0) AS streak FROM numbered
  QUALIFY row_number() OVER (PARTITION BY feed_id, run ORDER BY n DESC) = 1
), summary AS (
  SELECT run, family, feed_id, CASE WHEN bool_or(NOT ok) THEN -1
         ELSE CAST(coalesce(sum(new_count), 0) AS BIGINT) END AS outcome
  FROM numbered GROUP BY run, family, feed_id
), failures AS (
  SELECT run, family, feed_id, CASE WHEN coalesce(streak, 0) >= 2 THEN 'chronic' ELSE 'new' END AS failure
  FROM summary LEFT JOIN streaks USING (run, feed_id) WHERE outcome = -1)"""


@query("pass_summary", f"WITH {_SUMMARY_SQL} SELECT run, family, feed_id, outcome FROM summary")
def pass_summary(spark, sf_dir):
    """New articles per run and feed, 0 when unchanged, -1 when failed."""
    return _runs(spark, sf_dir)[0]


@query("streaks_by_run", f"WITH {_SUMMARY_SQL} "
                         "SELECT run, feed_id, CAST(streak AS BIGINT) AS consecutive_failures FROM streaks")
def streaks_by_run(spark, sf_dir):
    """Failures in a row at the end of each run."""
    return _runs(spark, sf_dir)[1]


@query("chronic_split", f"WITH {_SUMMARY_SQL} SELECT * FROM failures")
def chronic_split(spark, sf_dir):
    """Failed feeds of each run, split by their streak."""
    summary, state = _runs(spark, sf_dir)
    return health.classify_failures(summary, state, chronic_streak=2, run="run")


def _verdict_sql(rate: float) -> str:
    return f"""{_SUMMARY_SQL}, counted AS (
  SELECT r.run, rank, n.family, count(s.feed_id) AS attempted,
         count(*) FILTER (WHERE failure = 'chronic') AS chronic,
         count(*) FILTER (WHERE failure = 'new') AS new_failed
  FROM (SELECT DISTINCT run FROM summary) r
  CROSS JOIN (VALUES (0, 'rss'), (1, 'naver'), (2, 'fmp'), (3, 'quiet')) n(rank, family)
  LEFT JOIN summary s ON s.family = n.family AND s.run = r.run
  LEFT JOIN failures f ON f.family = s.family AND f.feed_id = s.feed_id AND f.run = s.run
  GROUP BY r.run, rank, n.family
), judged AS (
  SELECT *, attempted - chronic AS healthy,
         attempted > chronic AND (new_failed = attempted - chronic OR
           (attempted - chronic >= 10 AND new_failed >= (attempted - chronic) * {rate}))
           AS degraded
  FROM counted), verdicts AS (
  SELECT *, CASE WHEN degraded THEN family || '=fail(' || new_failed || '/' || healthy || ')'
            ELSE family || '=ok' END AS piece FROM judged)"""


_FAMILIES = ("rss", "naver", "fmp", "quiet")


@query("systemic_verdict",
       f"WITH {_verdict_sql(0.5)} SELECT * FROM verdicts")
def systemic_verdict(spark, sf_dir):
    """Verdict per run and source family with the default fail rate."""
    return health.family_verdicts(
        spark, *_runs(spark, sf_dir), families=_FAMILIES, chronic_streak=2, run="run")


@query("systemic_verdict_strict",
       f"WITH {_verdict_sql(0.2)} SELECT * FROM verdicts")
def systemic_verdict_strict(spark, sf_dir):
    """The same with a low fail rate, so that families fail."""
    return health.family_verdicts(
        spark, *_runs(spark, sf_dir), families=_FAMILIES, chronic_streak=2, fail_rate=0.2, run="run")


@query("run_verdict", f"""
WITH {_verdict_sql(0.5)}, pieces AS (
  SELECT run, rank, CASE WHEN family = 'naver' THEN 'naver=timeout' ELSE piece END AS piece,
         degraded OR family = 'naver' AS degraded FROM verdicts
  UNION ALL SELECT DISTINCT run, 99, 'embed=fail(no_key)', true FROM verdicts)
SELECT run, string_agg(piece, ' ' ORDER BY rank) AS detail, bool_or(degraded) AS failed
FROM pieces GROUP BY run""")
def run_verdict(spark, sf_dir):
    """Each run's line: one family timed out, and embedding has work but no key."""
    verdicts = health.family_verdicts(
        spark, *_runs(spark, sf_dir), families=_FAMILIES, chronic_streak=2, run="run")
    waiting = t.stored_docs(spark, sf_dir).withColumn("embed_pending", F.col("kind") == "story")
    return health.run_verdict(
        health.mark_errors(verdicts, {"naver": "timeout"}),
        health.embed_verdict(waiting, has_key=False), run="run")


@query("job_health_fold", f"WITH {RUN_SQL} SELECT * FROM health")
def job_health_fold(spark, sf_dir):
    """Health of every job after all its run events."""
    return health.fold_job_health(t.event_runs(spark, sf_dir))


@query("redact_reasons", r"""
SELECT event_id, 'GET https://e/?key=[redacted]&user=' || user_id || ' failed' AS reason,
       substr('code ' || props || ' ' || event_type, 1, 12) AS short,
       CASE WHEN event_type = 'view' THEN 'ERROR: ' || event_type
            ELSE 'run ' || user_id || ' | ERROR: ' || event_type END AS detail FROM events""")
def redact_reasons(spark, sf_dir):
    """Error texts: keys hidden, cut, and joined to a job's detail."""
    e = load(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    call = F.concat(F.lit("GET https://e/?key=S-"), "event_type", F.lit("&user="), user,
                    F.lit(" failed"))
    job = F.when(F.col("event_type") == "view", "").otherwise(F.concat(F.lit("run "), user))
    return e.select(
        "event_id", text.redact(call).alias("reason"),
        text.truncate(F.concat(F.lit("code "), "props", F.lit(" "), "event_type"), 12)
        .alias("short"),
        text.job_detail(job, F.col("event_type")).alias("detail"))
