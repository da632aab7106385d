"""Micro-batch forms. Both give after the last batch what the batch operators give at once.

Late and repeated articles need no watermark: every batch is compared with the stored days that
may hold its keys, so the horizon of de-duplication is the retention period, and rows of the batch job
count as stored too. Feed state is what each batch adds to it; a batch that is run again replaces what
it has stored. A poll must reach the stream once, as the poll log has it.
"""

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.operators import health, items as ops
from feedlake.session import Scratch
from feedlake.sources import keys, store


def stream_files(spark: SparkSession, path: str, schema: T.StructType, *,
                 files_per_batch: int | None = None) -> DataFrame:
    """Stream over a folder of landed parquet files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_insert(articles: DataFrame, root: str, checkpoint: str, *, trigger=None):
    """Insert-if-absent of streamed articles into the stored ``items`` below ``root``.

    The batch is stored once and read from there. A batch that is run again finds its own
    rows stored, so every article is stored exactly once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with Scratch(spark, "stream-batch") as stage:
            rows = stage(batch, "batch")
            fresh = ops.insert_rescanned(rows, keys.days_that_may_hold(spark, root, rows))
            keys.append_items(spark, root, stage(ops.as_item(fresh), "fresh"))

    return (
        articles.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


#: What a batch keeps of a feed: one row with its last success, cursor and poll, and a row per failure since.
PART = (
    "feed_id string, ok struct<ts: long, seq: long>, "
    "cursor struct<ts: long, seq: long, etag: string, last_modified: string>, "
    "last struct<ts: long, seq: long, message: string>, failed struct<ts: long, seq: long>")
#: Batches whose updates are joined into one folder.
COMPACT_EVERY = 20


def _fold_slot(old: tuple, polls: pd.DataFrame) -> tuple:
    """The state of a feed with some polls more, in any order of time, row by row: what tests hold the stream to."""
    ok, cursor, last = (old[0], old[1]), old[2:6], old[6:9]
    at = list(zip(polls["ts"], polls["seq"]))
    for place, is_ok, has_cursor, etag, modified, message in zip(
            at, polls["ok"], polls["has_cursor"], polls["etag"], polls["last_modified"], polls["message"]):
        if is_ok and (ok[0] is None or place > ok):
            ok = place
        if has_cursor and (cursor[0] is None or place > cursor[:2]):
            cursor = (*place, etag, modified)
        if last[0] is None or place > last[:2]:
            last = (*place, message)
    failed = [*zip(old[9], old[10]), *(p for p, is_ok in zip(at, polls["ok"]) if not is_ok)]
    if ok[0] is not None:
        failed = [p for p in failed if p > ok]
    return (*ok, *cursor, *last, [t for t, _ in failed], [n for _, n in failed])


def _heads(rows: DataFrame) -> DataFrame:
    """feed_id, ok, cursor, last: the latest of each, with partial sums in the tasks."""
    return rows.groupBy("feed_id").agg(*[F.max(c).alias(c) for c in ("ok", "cursor", "last")])


def _open_failures(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """feed_id, failed: the failures after the feed's last success.

    ``heads`` has a row per feed, so adaptive execution sends it to the failures or splits those of a hot feed.
    """
    failed = rows.filter("failed IS NOT NULL").select("feed_id", "failed")
    after = F.col("ok").isNull() | (F.col("failed") > F.col("ok"))
    same = F.col("f.feed_id").eqNullSafe(F.col("h.feed_id"))
    return failed.alias("f").join(heads.select("feed_id", "ok").alias("h"), same).filter(after).select(
        "f.feed_id", "failed")


def _write_parts(rows: DataFrame, path: str, label: str) -> None:
    """The heads and open failures of ``rows``, which are read twice, as one folder."""
    with Scratch(rows.sparkSession, label) as stage:
        heads = stage(_heads(rows), "heads")
        heads.unionByName(_open_failures(rows, heads), allowMissingColumns=True).write.mode(
            "overwrite").parquet(path)


def stream_feed_state(polls: DataFrame, target: str, checkpoint: str, *, trigger=None):
    """Feed state kept by a stream; polls may come late, in any order across batches.

    A batch stores the times of the last success, cursor and poll of the feeds that it has polls of, and the
    failures since, and no state of other feeds. Latest is latest whichever batch has it, so ``read_state`` takes the
    latest of all batches: a late success takes back only the failures before it, and a late failure counts if
    it is after the last success. Nothing is kept in the memory of the stream, and no task lists the polls of a feed.
    """
    at = F.struct(F.unix_micros("ts").alias("ts"), "seq")
    ok = health.is_ok()
    rows = polls.select(
        "feed_id", F.when(ok, at).alias("ok"),
        F.when(ok & (F.col("status") == 200), F.struct(at["ts"].alias("ts"), "seq", "etag", "last_modified")).alias("cursor"),
        F.struct(at["ts"].alias("ts"), "seq", health.poll_error().alias("message")).alias("last"),
        F.when(~ok, at).alias("failed"))

    def write(batch: DataFrame, batch_id: int) -> None:
        with Scratch(batch.sparkSession, "stream-polls") as stage:
            _write_parts(stage(batch, "polls"), f"{target}/updates/batch={batch_id}", "stream-state")
        if batch_id and batch_id % COMPACT_EVERY == 0:
            _compact(batch.sparkSession, target, batch_id)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _batches(spark: SparkSession, target: str, folder: str) -> dict[int, str]:
    """Whole batches of a folder, by number."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    if files.exists(path(f"{target}/{folder}")):
        for status in files.listStatus(path(f"{target}/{folder}")):
            number = status.getPath().getName().partition("batch=")[2]
            if number.isdigit() and files.exists(path(status.getPath(), "_SUCCESS")):
                found[int(number)] = status.getPath().toString()
    return found


def _parts(spark: SparkSession, target: str, before: float = float("inf")) -> DataFrame:
    """What the batches have stored, each once: the newest base and the batches after it."""
    bases = {k: p for k, p in _batches(spark, target, "base").items() if k < before}
    newest = max(bases, default=-1)
    changed = [p for k, p in _batches(spark, target, "updates").items() if newest < k < before]
    paths = [*([bases[newest]] if bases else []), *changed]
    return spark.read.schema(PART).parquet(*paths) if paths else spark.createDataFrame([], PART)


def _compact(spark: SparkSession, target: str, batch_id: int) -> None:
    """Join the updates of older batches into the base; a batch that is run again finds its own done."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if batch_id - 1 not in _batches(spark, target, "base"):
        _write_parts(_parts(spark, target, batch_id), f"{target}/base/batch={batch_id - 1}", "stream-base")
    for folder in ("base", "updates"):
        for number, found in _batches(spark, target, folder).items():
            if number < (batch_id - 1 if folder == "base" else batch_id):
                files.delete(path(found), True)


def read_state(spark: SparkSession, target: str) -> DataFrame:
    """Feed state as the stream has it, one row per feed; polls without a feed are in none."""
    rows = _parts(spark, target).filter("feed_id IS NOT NULL")
    heads = _heads(rows)
    failures = _open_failures(rows, heads).groupBy("feed_id").agg(F.count(F.lit(1)).alias("failures"))
    time = lambda c: F.timestamp_micros(c)
    return heads.join(failures, "feed_id", "left").select(
        "feed_id", F.col("cursor.etag").alias("etag"), F.col("cursor.last_modified").alias("last_modified"),
        time("ok.ts").alias("last_fetched"), time("ok.ts").alias("last_success"),
        F.coalesce("failures", F.lit(0).cast("long")).alias("consecutive_failures"),
        F.col("last.message").alias("last_error"),
        F.when(F.col("last.message").isNotNull(), time("last.ts")).alias("last_error_at"))
