"""Catalogue: the streaming forms, run over the given tables until all is read.

The input lands in several parts, each of which becomes a micro-batch. Input and checkpoint go
away when the stream has ended; the tables that it wrote are the result and stay.
"""

from pyspark.sql import functions as F

from feedlake.plans import health_queries, job_queries  # noqa: F401  (their SQL is reused)
from feedlake.plans import tables as t
from feedlake.plans.catalogue import ORACLE_SQL, query
from feedlake.plans.tables import DOC_SQL, sql_kind
from feedlake.session import Scratch, scratch_path
from feedlake.sources import landing, store
from feedlake.streaming import collect, ingest

BATCHES = 3


def _cuts(places):
    """Values of the column ``place`` that part the rows into BATCHES."""
    return places.approxQuantile("place", [k / BATCHES for k in range(1, BATCHES)], 0.01)


def _part(place, cuts):
    return sum((F.when(place > cut, 1).otherwise(0) for cut in cuts), F.lit(0))


def _run(spark, sf_dir, name, order, shape, start, shuffled=False):
    """The table ``name`` landed in BATCHES parts by ``order``, or by its hash, each streamed before the next lands."""
    target = scratch_path(spark, f"stream-{name}")
    rows = t.load(spark, sf_dir, name)
    place = (F.xxhash64(order) if shuffled else F.col(order)).cast("double")
    part = _part(place, _cuts(rows.select(place.alias("place"))))
    with Scratch(spark, "stream-input") as job:
        for k in range(BATCHES):
            rows.filter(part == k).write.mode("append").parquet(f"{job.path}/in")
            source = ingest.stream_files(spark, f"{job.path}/in", rows.schema)
            start(shape(source), target, f"{job.path}/checkpoint").awaitTermination()
    return target


@query("stream_insert", f"""
WITH {DOC_SQL}
SELECT item_id, feed_id, fetched_at, {sql_kind("title")} AS kind FROM doc
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY doc_id) = 1""")
def stream_insert(spark, sf_dir):
    """Documents streamed into an empty store, batch by batch."""
    root = _run(spark, sf_dir, "documents", "doc_id", t.doc_items_of, ingest.stream_insert)
    return store.read(spark, root, "items").select("item_id", "feed_id", "fetched_at", "kind")


@query("stream_feed_state", ORACLE_SQL["feed_state_fold"])
def stream_feed_state(spark, sf_dir):
    """Feed state after the event log streamed through, in order of time."""
    target = _run(spark, sf_dir, "events", "ts", t.event_polls_of, ingest.stream_feed_state)
    return ingest.read_state(spark, target)


@query("stream_late_polls", ORACLE_SQL["feed_state_fold"])
def stream_late_polls(spark, sf_dir):
    """The same with the log landed out of order, a third of each time's polls in each part."""
    target = _run(spark, sf_dir, "events", "event_id", t.event_polls_of, ingest.stream_feed_state, shuffled=True)
    return ingest.read_state(spark, target)


@query("stream_collect", ORACLE_SQL["collect_ingest"])
def stream_collect(spark, sf_dir):
    """The responses of ``collect_ingest`` landed in parts by time and streamed from the folder as they land."""
    registries = job_queries.job_registries(spark)
    with Scratch(spark, "stream-input") as job:
        everything = f"{job.path}/all"
        landing.land(everything, **vars(job_queries.landed_responses(spark, sf_dir)))
        responses = landing.read(spark, everything)
        at = F.unix_timestamp("fetched_at").cast("double")
        part = _part(at, _cuts(responses.select(at.alias("place"))))
        root = f"{job.path}/tables"
        for k in range(BATCHES):
            landing.land(f"{job.path}/in", **landing.split(responses.filter(part == k)))
            collect.stream_collect(landing.stream(spark, f"{job.path}/in"), root, f"{job.path}/checkpoint",
                                   registries).awaitTermination()
        return job_queries.feed_totals(spark, root)
