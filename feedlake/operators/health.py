"""Feed state, job health and run verdicts, folded from append-only logs.

No fold sorts or lists a feed's rows: states are maxima with partial aggregation, and failure
streaks are counts, with partial counts per task, of the failures after the last success.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions import text


def is_ok(status="status", is_feed="is_feed") -> Column:
    """200 with a readable body, or 304."""
    readable = F.coalesce(F.col(is_feed), F.lit(True))
    return F.coalesce(
        ((F.col(status) == 200) & readable) | (F.col(status) == 304), F.lit(False)
    )


def poll_error(*, error_chars: int = C.FEED_ERROR_CHARS) -> Column:
    """Error text of a poll row; an ok row only has one when it carries a note."""
    fallback = F.when(F.col("status") == 200, F.lit("not a parseable feed")).otherwise(
        F.concat(F.lit("HTTP "), F.col("status").cast("string"))
    )
    message = F.coalesce(F.col("error"), F.when(~is_ok(), fallback))
    return text.truncate(message, error_chars)


def _failures_since(polls: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
    """keys, failures after ``ok_at`` of ``heads`` (null: all of them).

    A count with partial sums over narrow rows. ``heads`` has a row per key, so adaptive execution sends
    it to the polls or splits the polls of a hot key, also if all are of one hour.
    """
    failed = polls.filter(~is_ok()).select(*keys, F.struct("ts", "seq").alias("at"))
    after = F.col("ok_at").isNull() | (F.col("at") > F.col("ok_at"))
    return failed.join(heads.select(*keys, "ok_at"), keys).filter(after).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("failures"))


def fold_feed_state(poll: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Poll log to feed state, one row per feed.

    200 sets the cursor to what the response had, even nothing; 304 keeps it; a failure
    touches neither cursor nor last_fetched, adds to the streak and records its error.
    ``prior`` continues an earlier state with later polls.

    The streak is the number of failures after the last success. Last success, cursor and
    poll are maxima, of which each task sends one row per feed; the failures after the success
    are then counted. So no task holds a feed's polls, however many there are in whatever time.
    """
    ok = is_ok()
    rows = poll.select(
        "feed_id", F.struct("ts", "seq").alias("at"), ok.alias("ok"),
        (ok & (F.col("status") == 200)).alias("has_cursor"),
        F.struct("etag", "last_modified").alias("cursor"), poll_error().alias("message"),
    )
    heads = rows.groupBy("feed_id").agg(
        F.max(F.when(F.col("ok"), F.col("at"))).alias("ok_at"),
        F.max(F.when(F.col("has_cursor"), F.struct("at", "cursor"))).alias("cur"),
        F.max(F.struct("at", "message")).alias("last"),
    )
    state = heads.join(_failures_since(poll, heads, ["feed_id"]), "feed_id", "left").select(
        "feed_id",
        F.col("cur.cursor.etag").alias("etag"),
        F.col("cur.cursor.last_modified").alias("last_modified"),
        F.col("ok_at.ts").alias("last_fetched"),
        F.col("ok_at.ts").alias("last_success"),
        F.coalesce("failures", F.lit(0).cast("long")).alias("consecutive_failures"),
        F.col("last.message").alias("last_error"),
        F.when(F.col("last.message").isNotNull(), F.col("last.at.ts")).alias("last_error_at"),
        F.col("cur").isNotNull().alias("_cursor_set"),
    )
    if prior is None:
        return state.drop("_cursor_set")
    return _continue_state(prior, state)


def later_polls(poll: DataFrame, prior: DataFrame) -> DataFrame:
    """Polls later than what a feed's state already holds: a success or an error leaves its time there."""
    held = prior.select("feed_id", F.greatest("last_success", "last_error_at").alias("_held"))
    later = F.col("_held").isNull() | (F.col("ts") > F.col("_held"))
    return poll.join(held, "feed_id", "left").filter(later).drop("_held")


def fold_with_late_polls(
    poll: DataFrame, prior: DataFrame, log: DataFrame, keep: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """``prior`` with the polls of a run, which may come late; ``log`` has all polls, these too.

    Feeds whose polls are all later than their state go on from it. A feed with a poll that is not, be it late
    or seen before, is folded anew from the log, which is read for such feeds only. ``keep`` stores a result.
    """
    held = prior.select("feed_id", F.greatest("last_success", "last_error_at").alias("_held"))
    behind = keep(poll.groupBy("feed_id").agg(F.min("ts").alias("first")).join(held, "feed_id").filter(
        F.col("_held").isNotNull() & (F.col("first").isNull() | (F.col("first") <= F.col("_held")))).select("feed_id"),
        "behind")
    if behind.isEmpty():
        return fold_feed_state(poll, prior)
    ahead = fold_feed_state(poll.join(behind, "feed_id", "left_anti"), prior.join(behind, "feed_id", "left_anti"))
    return ahead.unionByName(fold_feed_state(log.join(behind, "feed_id", "left_semi")))


def _continue_state(prior: DataFrame, state: DataFrame) -> DataFrame:
    """Earlier state and the fold of later polls, one row per feed on both sides."""
    p, s = prior.alias("p"), state.alias("s")
    polled = F.col("s.feed_id").isNotNull()
    ok = F.col("s.last_success").isNotNull()

    def choose(use_new: Column, field: str) -> Column:
        return F.when(use_new, F.col(f"s.{field}")).otherwise(F.col(f"p.{field}")).alias(field)

    cursor_set = F.coalesce(F.col("s._cursor_set"), F.lit(False))
    carried = F.coalesce(F.col("p.consecutive_failures"), F.lit(0))
    return p.join(s, F.col("p.feed_id") == F.col("s.feed_id"), "full_outer").select(
        F.coalesce("s.feed_id", "p.feed_id").alias("feed_id"),
        choose(cursor_set, "etag"),
        choose(cursor_set, "last_modified"),
        choose(ok, "last_fetched"),
        choose(ok, "last_success"),
        F.when(~polled, carried)
        .when(ok, F.col("s.consecutive_failures"))
        .otherwise(carried + F.col("s.consecutive_failures"))
        .alias("consecutive_failures"),
        choose(polled, "last_error"),
        choose(polled, "last_error_at"),
    )


def update_state(current: DataFrame, changes: DataFrame, given: dict[str, str], *, key: str,
                 fields: list[str]) -> DataFrame:
    """Merge partial updates over current rows, one row per key on both sides.

    ``given`` names for each updatable field the boolean column of ``changes`` that says
    whether a value was given; a given NULL overwrites. Fields outside ``fields`` vanish.
    """
    c, u = current.alias("c"), changes.alias("u")
    out = [F.coalesce(f"u.{key}", f"c.{key}").alias(key)]
    for field in fields:
        old = F.col(f"c.{field}")
        if field in given:
            use = F.coalesce(F.col(f"u.{given[field]}"), F.lit(False))
            old = F.when(use, F.col(f"u.{field}")).otherwise(old)
        out.append(old.alias(field))
    return c.join(u, F.col(f"c.{key}") == F.col(f"u.{key}"), "full_outer").select(*out)


def lookup_state(keys: DataFrame, state: DataFrame, *, key: str = "feed_id") -> DataFrame:
    """State of each asked key; an unknown key gives a row of NULLs."""
    return keys.select(key).distinct().join(state, key, "left")


def fold_job_health(runs: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Run log (start, ok, fail) to one health row per job.

    A killed run leaves no closing event, so its job stays 'running' and keeps the detail
    of the run before. ``prior`` continues an earlier health table with later events.
    """
    at = F.struct("ts", "seq")
    start, closed, ok = (
        F.col("event") == "start", F.col("event") != "start", F.col("event") == "ok",
    )
    detail = F.when(F.col("event") == "fail", text.job_detail("detail", "error")).otherwise(
        text.strip("detail")
    )
    status = F.when(start, "running").otherwise(F.col("event"))
    folded = runs.groupBy("job").agg(
        F.max(F.struct(at.alias("at"), status.alias("status"))).alias("last"),
        F.max(F.when(start, F.col("ts"))).alias("last_run_at"),
        F.max(F.when(closed, F.col("ts"))).alias("last_finished_at"),
        F.max(F.when(ok, F.col("ts"))).alias("last_success_at"),
        F.max(F.when(closed, F.struct(at.alias("at"), detail.alias("text")))).alias("detail"),
    ).select(
        "job",
        F.col("last.status").alias("last_status"),
        F.col("last.at.ts").alias("fetched_at"),
        "last_run_at", "last_finished_at", "last_success_at",
        F.col("detail.text").alias("detail"),
    )
    if prior is None:
        return folded
    fields = [c for c in folded.columns if c != "job"]
    p, f = prior.alias("p"), folded.alias("f")
    return p.join(f, F.col("p.job") == F.col("f.job"), "full_outer").select(
        F.coalesce("f.job", "p.job").alias("job"),
        *[F.coalesce(f"f.{c}", f"p.{c}").alias(c) for c in fields],
    )


# --- summary and verdicts, of one run or of every run in a log --------------
#
# With ``run``, the name of a column that tells runs apart, each function works run by run and
# keeps that column.

def _keys(run: str | None) -> list[str]:
    return [] if run is None else [run]


def pass_summary(poll: DataFrame, *, run: str | None = None) -> DataFrame:
    """Per feed of a run: new articles, 0 when unchanged, -1 when failed."""
    failed = F.max((~is_ok()).cast("int"))
    return poll.groupBy(*_keys(run), "family", "feed_id").agg(
        F.when(failed == 1, F.lit(-1))
        .otherwise(F.coalesce(F.sum("new_count"), F.lit(0)))
        .cast("long").alias("outcome")
    )


def streaks_by_run(poll: DataFrame, run: str) -> DataFrame:
    """run, feed_id, consecutive_failures at the end of each run that polled the feed.

    ``run`` must ascend with time. A feed's polls of a run are counted first; the window then
    sees a row per run.
    """
    keys = [run, "feed_id"]
    heads = poll.groupBy(*keys).agg(F.max(F.when(is_ok(), F.struct("ts", "seq"))).alias("ok_at"))
    ends = heads.join(_failures_since(poll, heads, keys), keys, "left").select(
        *keys, F.coalesce("failures", F.lit(0).cast("long")).alias("failures"), F.col("ok_at").isNotNull().alias("ok"))
    so_far = Window.partitionBy("feed_id").orderBy(run)
    since = ends.withColumn("_since", F.count_if("ok").over(so_far))
    streak = F.sum("failures").over(Window.partitionBy("feed_id", "_since").orderBy(run))
    return since.select(run, "feed_id", streak.alias("consecutive_failures"))


def classify_failures(
    summary: DataFrame, state: DataFrame, *, chronic_streak: int = C.CHRONIC_STREAK,
    run: str | None = None,
) -> DataFrame:
    """Failed feeds as 'new' or 'chronic' by the streak that includes this run."""
    streak = F.coalesce("consecutive_failures", F.lit(0))
    keys = [*_keys(run), "feed_id"]
    return (
        summary.filter(F.col("outcome") == -1)
        .join(state.select(*keys, "consecutive_failures"), keys, "left")
        .select(
            *_keys(run), "family", "feed_id",
            F.when(streak >= chronic_streak, "chronic").otherwise("new").alias("failure"),
        )
    )


def family_verdicts(
    spark, summary: DataFrame, state: DataFrame, *,
    families=C.FAMILIES, chronic_streak: int = C.CHRONIC_STREAK,
    fail_rate: float = C.FAIL_RATE, min_attempted: int = C.MIN_ATTEMPTED, run: str | None = None,
) -> DataFrame:
    """Per source family: attempted, chronic, new_failed, piece of the verdict, degraded.

    Chronic failures are known and leave the base. The rest is a breakdown when all of it
    failed, or at least ``fail_rate`` of at least ``min_attempted``.
    """
    failures = classify_failures(summary, state, chronic_streak=chronic_streak, run=run)
    feed, family = [*_keys(run), "family", "feed_id"], [*_keys(run), "family"]
    counted = summary.select(*feed).join(failures.select(*feed, "failure"), feed, "left").groupBy(
        *family).agg(
        F.count("*").alias("attempted"),
        F.count_if(F.col("failure") == "chronic").alias("chronic"),
        F.count_if(F.col("failure") == "new").alias("new_failed"),
    )
    runs = spark.range(0, 1, 1, 1).drop("id") if run is None else summary.select(run).distinct()
    names = runs.select(*_keys(run), F.posexplode(F.lit(list(families))).alias("rank", "family"))
    zero = F.lit(0).cast("long")
    joined = names.join(counted, family, "left").select(
        *_keys(run), "rank", "family",
        *[F.coalesce(c, zero).alias(c) for c in ("attempted", "chronic", "new_failed")],
    ).withColumn("healthy", F.col("attempted") - F.col("chronic"))
    rate_hit = (F.col("healthy") >= min_attempted) & (
        F.col("new_failed") >= F.col("healthy") * fail_rate
    )
    broken = (F.col("healthy") > 0) & ((F.col("new_failed") == F.col("healthy")) | rate_hit)
    piece = F.when(
        broken,
        F.concat("family", F.lit("=fail("), F.col("new_failed").cast("string"), F.lit("/"),
                 F.col("healthy").cast("string"), F.lit(")")),
    ).otherwise(F.concat("family", F.lit("=ok")))
    return joined.withColumn("piece", piece).withColumn("degraded", broken)


def mark_errors(verdicts: DataFrame, markers: dict[str, str]) -> DataFrame:
    """Replace the piece of families whose whole pass ended in error, timeout or deadline."""
    piece, degraded = F.col("piece"), F.col("degraded")
    for family, marker in markers.items():
        hit = F.col("family") == family
        piece = F.when(hit, F.lit(f"{family}={marker}")).otherwise(piece)
        degraded = degraded | hit
    return verdicts.withColumn("piece", piece).withColumn("degraded", degraded)


def embed_verdict(items: DataFrame, *, has_key: bool, failed: bool = False) -> DataFrame:
    """The embedding piece of the verdict.

    With a key: ok, or fail when the pass failed. Without: fail while anything waits.
    """
    waiting = items.filter(F.col("embed_pending")).select(F.lit(1).alias("one")).limit(1)
    any_waiting = waiting.agg((F.count("*") > 0).alias("waiting"))
    if failed:
        piece = F.lit("embed=fail")
    elif has_key:
        piece = F.lit("embed=ok")
    else:
        piece = F.when(F.col("waiting"), "embed=fail(no_key)").otherwise(
            "embed=skip(no_key_no_pending)"
        )
    return any_waiting.select(piece.alias("piece")).withColumn(
        "degraded", F.col("piece").startswith("embed=fail")
    )


def run_verdict(verdicts: DataFrame, embed: DataFrame, *, run: str | None = None) -> DataFrame:
    """One line per run: family pieces in order, then embedding; failed if any is.

    ``embed`` has one piece, for every run. The list collected here has one entry per source
    family plus one.
    """
    last = embed.select(F.lit(len(C.FAMILIES) + 1000).alias("rank"), "piece", "degraded")
    if run is not None:
        only = last.head()
        last = verdicts.select(run).distinct().select(
            run, *[F.lit(only[name]).alias(name) for name in ("rank", "piece", "degraded")])
    columns = [*_keys(run), "rank", "piece", "degraded"]
    pieces = verdicts.select(*columns).unionByName(last.select(*columns))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "piece")))
    return pieces.groupBy(*_keys(run)).agg(
        F.array_join(F.transform(ordered, lambda p: p["piece"]), " ").alias("detail"),
        F.max("degraded").alias("failed"),
    )
