"""Stored tables: plain parquet folders, written and read by Spark alone.

Articles, vectors and logs are appended, in one folder per day; changing rows overwrites the days
that hold them, and expired days are removed. States are small snapshots that are overwritten; they
follow from the logs, so a run that dies while writing one is mended by the next. There is one
writer at a time, as there is one scheduled run.
"""

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake import schemas
from feedlake.session import Scratch

TABLES = {
    "items": schemas.ITEM, "item_vectors": schemas.VECTOR, "embed_failures": schemas.EMBED_FAILURE,
    "feed_state": schemas.FEED_STATE, "job_health": schemas.JOB_HEALTH, "meta": schemas.META,
    "poll_log": schemas.POLL_LOG, "run_log": schemas.RUN_LOG,
}
#: The clock that puts a row of an appended table into its day's folder.
CLOCKS = {"items": "fetched_at", "item_vectors": "embedded_at", "embed_failures": "failed_at",
          "poll_log": "ts", "run_log": "ts"}
DAY = "day"
#: What lets a count be answered by the parquet files' footers.
COUNT_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table; an appended one with its ``day``, on which filters skip folders."""
    schema = TABLES[table]
    if table in CLOCKS:
        schema = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    return read_folder(spark, f"{root}/{table}", schema)


def read_folder(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A parquet folder; one that is not there has no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def counts(spark: SparkSession, root: str, table: str) -> DataFrame:
    """day, n: rows of an appended table by day, from the files' footers alone.

    The count is pushed into the parquet scan, which reads no column. Only the second generation of
    Spark's parquet source can do that, so the plan belongs to a session of its own that has it switched on; a
    day's count is one row, so the result comes back as rows of a table as long as the retention.
    """
    aside = spark.newSession()
    for key, value in COUNT_SETTINGS.items():
        aside.conf.set(key, value)
    aside.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    by_day = read(aside, root, table).groupBy(DAY).agg(F.count("*").alias("n"))
    return spark.createDataFrame(by_day.collect(), f"{DAY} date, n long")


def _writer(rows: DataFrame, table: str):
    """Rows dealt by day, busy days to several tasks; articles by source and time in a file."""
    rows = rows.select(*TABLES[table].names, F.to_date(CLOCKS[table]).alias(DAY)).hint("rebalance", DAY)
    order = [DAY, "source", "fetched_at"] if table == "items" else [DAY]
    return rows.sortWithinPartitions(*order).write.partitionBy(DAY)


def append(root: str, table: str, rows: DataFrame) -> None:
    _writer(rows, table).mode("append").parquet(f"{root}/{table}")


def overwrite_days(root: str, table: str, rows: DataFrame) -> None:
    """Put ``rows`` in place of all rows of the days that they have; other days stay."""
    _writer(rows, table).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(
        f"{root}/{table}")


def drop_days(spark: SparkSession, root: str, table: str, days: Iterable[date | None]) -> None:
    """Remove whole days with their files."""
    for day in days:
        name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/{DAY}={name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace(spark: SparkSession, root: str, table: str, rows: DataFrame) -> None:
    """Overwrite a snapshot. ``rows`` may come from the snapshot itself."""
    with Scratch(spark, "snapshot") as stage:
        stage(rows.select(*TABLES[table].names), table).write.mode("overwrite").parquet(f"{root}/{table}")


def on_days(rows: DataFrame, days: Iterable[date | None]) -> DataFrame:
    """Rows of some days; the list is as long as the retention at most."""
    days = list(days)
    known = F.col(DAY).isin([d for d in days if d is not None])
    return rows.filter(F.coalesce(known, F.lit(False)) | (F.col(DAY).isNull() & F.lit(None in days)))


def compact(spark: SparkSession, root: str, table: str, days: Iterable[date | None]) -> None:
    """Join the small files of some days; rows stay the same."""
    overwrite_days(root, table, on_days(read(spark, root, table), days))
