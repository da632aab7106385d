"""The collect run: landed responses to stored articles, health and verdict."""

import functools
import logging
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions import clock
from feedlake.operators import bodies, health, items as ops, mapping, paging
from feedlake.plans import upkeep
from feedlake.session import Scratch
from feedlake.sources import keys, landing, payloads, store
from feedlake.sources.registry import sources_meta, usable_searches
from feedlake.watch import Marker, Watched, side_by_side

log = logging.getLogger("feedlake.collect")

_POLL_COLUMNS = ["family", "feed_id", "ts", "seq", "status", "is_feed", "etag",
                 "last_modified", "error"]


@dataclass
class Landed:
    """Responses of one run; a family that did not run is None."""

    feeds: DataFrame | None = None
    searches: DataFrame | None = None
    firehose: DataFrame | None = None
    pages: DataFrame | None = None


@dataclass
class Registries:
    """Registries as loaded from their files."""

    feeds: DataFrame | None = None
    searches: DataFrame | None = None
    endpoints: DataFrame | None = None
    selectors: DataFrame | None = None
    settings: dict = field(default_factory=dict)


def feed_pass(scanned: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles and poll rows of scanned feed responses."""
    known = scanned.join(registry.select("feed_id"), "feed_id", "left_semi")
    polls = known.select(
        F.lit(C.RSS).alias("family"), "feed_id", F.col("fetched_at").alias("ts"), "seq",
        "status", "is_feed", "etag", "last_modified", F.lit(None).cast("string").alias("error"),
    )
    return mapping.map_feed_rows(payloads.feed_rows(known), registry), polls


def search_pass(scanned: DataFrame, searches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles and poll rows of scanned search responses; blank queries do not count."""
    usable = usable_searches(searches)
    known = scanned.join(usable.select("q"), "q", "left_semi")
    none = F.lit(None).cast("string")
    polls = known.select(
        F.lit(C.SEARCH).alias("family"), F.concat(F.lit(C.SEARCH_PREFIX), "q").alias("feed_id"),
        F.col("fetched_at").alias("ts"), "seq", "status", "is_feed",
        none.alias("etag"), none.alias("last_modified"), none.alias("error"),
    )
    return mapping.map_search_rows(payloads.search_rows(known), usable), polls


def firehose_pass(
    scanned: DataFrame, endpoints: DataFrame, *, page_size: int = C.PAGE_SIZE, caps=None,
    default_cap: int = C.PAGE_CAP, blackout_start_hour: int | None = None,
    blackout_end_hour: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Articles and poll rows of scanned firehose pages.

    All landed pages count up to the first short one; a page that landed twice is its last
    good response. A bad page in that range fails the whole request and none of its rows are
    used. ``caps`` say where the fetcher stopped asking, which makes a request cut off.
    Requests in the blackout never happened.
    """
    known = scanned.join(endpoints.select("endpoint"), "endpoint", "left_semi")
    known = known.filter(~clock.in_blackout("fetched_at", blackout_start_hour, blackout_end_hour))
    request = ["endpoint", "fetched_at"]
    good = (F.col("status") == 200) & F.col("is_feed")
    response = F.max(F.struct(good.alias("good"), "seq", "status", "n_rows"))
    pages = known.groupBy(*request, "page").agg(response.alias("r")).select(*request, "page", "r.*")
    # a bad page is read like a full one: what it would have held is not known
    pages = pages.withColumn("n_rows", F.when(F.col("good"), F.col("n_rows")).otherwise(page_size))
    read = paging.accepted_pages(pages, request, page_size=page_size)
    cap = paging.page_cap(caps=caps, default=default_cap)
    bad = F.col("accepted") & ~F.col("good")
    requests = paging.page_totals(read, request, cap=cap).join(
        read.groupBy(*request).agg(
            F.min("seq").alias("seq"), F.coalesce(F.max(bad), F.lit(False)).alias("failed"),
            F.max(F.when(bad, F.col("status"))).alias("bad_status")), request)
    none = F.lit(None).cast("string")
    polls = requests.select(
        F.lit(C.FIREHOSE).alias("family"),
        F.concat(F.lit(C.FIREHOSE_PREFIX), "endpoint").alias("feed_id"),
        F.col("fetched_at").alias("ts"), "seq",
        F.when(F.col("failed"), F.coalesce("bad_status", F.lit(200))).otherwise(200).alias("status"),
        (~F.col("failed")).alias("is_feed"), none.alias("etag"), none.alias("last_modified"),
        F.when(~F.col("failed"), paging.truncation_note("truncated", "endpoint")).alias("error"),
    )
    used = read.filter("accepted").select(*request, "page", "seq").join(
        requests.filter(~F.col("failed")).select(*request, F.col("seq").alias("_first")), request)
    # joined on the page as well, so that the pages of a busy endpoint spread out; the rows
    # of all pages carry the request's number, as its poll does
    rows = payloads.firehose_rows(known.join(used, [*request, "page", "seq"])
                                  .withColumn("seq", F.col("_first")))
    return mapping.map_firehose_rows(rows, endpoints, page_size=page_size), polls


def _families(landed: Landed, registries: Registries):
    """Name, and a function from a staging function to (articles, polls), of each family that ran."""
    if landed.feeds is not None:
        yield C.RSS, lambda stage: feed_pass(
            stage(payloads.scan_feeds(landed.feeds), "feeds"), registries.feeds)
    if landed.searches is not None:
        yield C.SEARCH, lambda stage: search_pass(
            stage(payloads.scan_search(landed.searches), "searches"), registries.searches)
    if landed.firehose is not None:
        # how far to look back has been settled by what was read
        settings = {k: v for k, v in registries.settings.items() if k != "lookback_days"}
        yield C.FIREHOSE, lambda stage: firehose_pass(
            stage(payloads.scan_firehose(landed.firehose), "firehose"), registries.endpoints, **settings)


def landed_window(spark: SparkSession, folder: str, now: datetime, registries: Registries) -> Landed:
    """Responses landed in the folders of the lookback window, which every run scans again."""
    days = registries.settings.get("lookback_days", C.LOOKBACK_DAYS)
    return Landed(**landing.split(landing.window(landing.read(spark, folder), now, days=days)))


def run_passes(
    spark: SparkSession, landed: Landed, registries: Registries, stage: Scratch, *,
    timeout: float | None = None, deadlines: dict[str, float] | None = None,
) -> tuple[DataFrame | None, DataFrame | None, dict[str, Marker]]:
    """Articles and poll rows of all families that worked, and a marker for each that did not.

    The families run side by side, each staged by jobs of its own, so that a small one fills the
    executors that the tail of a large one leaves idle, and a fault or a hang in one leaves the
    others as they are. They share ``timeout`` seconds; ``deadlines`` gives single families less.
    Nothing of a family that ended late is stored: its responses stay landed for the next run.
    """
    def work(name, make):
        def run(watched: Watched):
            def kept(df, label):
                watched.check()
                return stage(df, label)
            found, polled = make(kept)
            return kept(found, f"{name}-articles"), kept(polled.select(*_POLL_COLUMNS), f"{name}-polls")
        return run

    parts = {name: work(name, make) for name, make in _families(landed, registries)}
    done, broken = side_by_side(spark, parts, timeout=timeout, deadlines=deadlines)
    if not done:
        return None, None, broken
    articles, polls = zip(*done.values())
    return mapping.union_families(*articles), functools.reduce(DataFrame.unionByName, polls), broken


def ingest(
    spark: SparkSession, root: str, landed: Landed, registries: Registries, stage: Scratch, *,
    timeout: float | None = None, deadlines: dict[str, float] | None = None, marked: bool = False,
) -> tuple[DataFrame | None, dict[str, Marker]]:
    """Store what is new and log every poll; returns poll rows with counts, and families that failed.

    A family that failed raises RunFailed when the others are stored. With ``marked`` it does not: the caller
    judges the second value.

    Articles come first, then polls, then the state that follows from them. Each step leaves
    out what is there already and reads its result from the tables, so a run that died anywhere
    and is run again ends as one that did not die, and a second run over the same responses
    changes nothing.
    """
    articles, polls, broken = run_passes(
        spark, landed, registries, stage, timeout=timeout, deadlines=deadlines)
    if polls is None:
        if not marked:
            require_all(broken)
        return None, broken
    stored = keys.days_that_may_hold(spark, root, articles)
    if landed.pages is not None and registries.selectors is not None:
        articles = stage(bodies.enrich_bodies(
            articles, stored, registries.selectors, landed.pages), "enriched")
    keys.append_items(spark, root, stage(ops.as_item(ops.insert_rescanned(articles, stored)), "fresh"))
    counted = stage(_counted(spark, root, articles, polls), "polls")
    log = store.on_days(store.read(spark, root, "poll_log"), _days(counted, "ts"))
    response = ["family", "feed_id", "ts", "seq"]
    logged = log.join(counted.select(*response), response, "left_semi").select(*response)
    new_polls = stage(counted.join(logged, response, "left_anti"), "new-polls")
    prior = store.read(spark, root, "feed_state")
    everything = store.read(spark, root, "poll_log").select(*new_polls.columns).unionByName(new_polls)
    if prior.isEmpty():  # lost or never written: the log has it all
        state = health.fold_feed_state(everything)
    else:
        state = health.fold_with_late_polls(counted, prior, everything, stage)
    state = stage(state, "state")
    store.append(root, "poll_log", new_polls)
    store.replace(spark, root, "feed_state", state)
    if not marked:
        require_all(broken)
    return counted, broken


def require_all(broken: dict[str, Marker], label: str = "") -> None:
    """Raise RunFailed, caused by the first fault, if a family has no result."""
    if broken:
        raise RunFailed(label + " ".join(f"{family}={marker}" for family, marker in broken.items())) from _fault(broken)


def _fault(broken: dict[str, Marker]) -> BaseException | None:
    return next((marker.fault for marker in broken.values() if marker.fault is not None), None)


def _days(rows: DataFrame, clock_column: str) -> list:
    """Days that rows of a run fall on."""
    return [r[0] for r in rows.select(F.to_date(clock_column)).distinct().collect()]


def _counted(spark: SparkSession, root: str, articles: DataFrame, polls: DataFrame) -> DataFrame:
    """Poll rows with the number of stored articles that came with each response.

    An article belongs to the response that is its first in the batch, if the stored row is of that
    feed and time. So the count is the same whether this run or an earlier try has stored it.
    """
    response = ["family", "feed_id", "ts", "seq"]
    first = ops.first_wins(articles, fields=["family", "feed_id", "fetched_at", "seq"])
    items = store.on_days(store.read(spark, root, "items"), _days(polls, "ts"))
    here = items.select("item_id", F.col("feed_id").alias("_feed"), F.col("fetched_at").alias("_at"))
    counts = first.join(here, "item_id").filter(
        F.col("feed_id").eqNullSafe(F.col("_feed")) & F.col("fetched_at").eqNullSafe(F.col("_at"))
    ).withColumnRenamed("fetched_at", "ts").groupBy(*response).agg(F.count("*").alias("n"))
    return polls.join(counts, response, "left").withColumn(
        "new_count", F.when(health.is_ok(), F.coalesce("n", F.lit(0).cast("long")))).drop("n")


def log_run(spark: SparkSession, root: str, job: str, at: datetime, event: str, *,
            detail: str | None = None, error: str | None = None) -> None:
    """Append a run event and bring the job's health row up to date."""
    seq = int(at.timestamp() * 1_000_000)
    event_row = spark.createDataFrame(
        [(job, at, seq, event, detail, error)], store.TABLES["run_log"])
    now = health.fold_job_health(event_row, store.read(spark, root, "job_health"))
    store.append(root, "run_log", event_row)
    store.replace(spark, root, "job_health", now)


class RunFailed(RuntimeError):
    """A source family broke down or embedding failed; the health row says the same."""


def collect_run(
    spark: SparkSession, root: str, landed: Landed, registries: Registries, *,
    clock_now, embed=None, job: str = "collect_all", timeout: float | None = None,
    deadlines: dict[str, float] | None = None, **rules,
) -> str:
    """One scheduled run; returns its verdict line or raises RunFailed with it.

    ``clock_now`` gives the present time; ``embed`` is a function without arguments that
    makes one embedding pass, or None when there is no key. The start is logged first, so
    a run that is killed stays visible as 'running'. ``timeout`` and ``deadlines``: see ``run_passes``;
    a family that ran out of time is ``timeout`` or ``deadline`` in the line, and fails the run.
    """
    log_run(spark, root, job, clock_now(), "start")
    detail = ""
    try:
        if registries.feeds is not None:
            store.replace(spark, root, "meta", sources_meta(registries.feeds))
        with Scratch(spark, "collect") as stage:
            polls, broken = ingest(spark, root, landed, registries, stage,
                                   timeout=timeout, deadlines=deadlines, marked=True)
            if polls is None:
                polls = spark.createDataFrame([], store.TABLES["poll_log"])
            state = store.read(spark, root, "feed_state")
            verdicts = stage(health.mark_errors(health.family_verdicts(
                spark, health.pass_summary(polls), state, **rules), broken), "verdicts")
            embed_failed = False
            if embed is not None:
                try:
                    embed()
                except Exception:
                    log.exception("embedding pass failed")
                    embed_failed = True
            waiting = upkeep.waiting(spark, root, clock_now()).withColumn("embed_pending", F.lit(True))
            piece = health.embed_verdict(waiting, has_key=embed is not None, failed=embed_failed)
            line = health.run_verdict(verdicts, piece).head()
        detail = line["detail"]
        if line["failed"]:
            raise RunFailed(detail) from _fault(broken)
    except BaseException as e:
        log_run(spark, root, job, clock_now(), "fail", detail=detail, error=str(e))
        raise
    log_run(spark, root, job, clock_now(), "ok", detail=detail)
    return detail
