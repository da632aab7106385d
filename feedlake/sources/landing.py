"""Landed responses of all families in one folder, by family, endpoint and date.

A fetcher lands its responses as they come; a run reads the dates it looks back on, and a stream what is
new. The date is that of the fetch on the UTC clock. Only the firehose has endpoints, as its requests ask
for one each; feeds and searches are too many for folders of their own.

Nulls: a response without a fetch time lands under no date, is in no window, and a read of all has it. An
empty folder, or none, has no responses. Extra columns are not landed.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake import schemas
from feedlake.sources.store import read_folder

#: Argument of ``land``, family, and the column that names the source of a response.
_SHAPES = {
    "feeds": (C.RSS, "feed_id", schemas.FEED_PAYLOAD),
    "searches": (C.SEARCH, "q", schemas.SEARCH_PAYLOAD),
    "firehose": (C.FIREHOSE, "endpoint", schemas.FIREHOSE_PAYLOAD),
}
_FOLDERS = ["family", "endpoint", "date"]


def _landed_rows(kind: str, responses: DataFrame) -> DataFrame:
    family, name, schema = _SHAPES[kind]
    have = set(schema.names)
    columns = [
        (F.col(name) if f.name == "name" else F.col(f.name) if f.name in have else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in schemas.LANDED if f.name not in _FOLDERS]
    endpoint = F.col(name) if kind == "firehose" else F.lit(None).cast("string")
    return responses.select(*columns, F.lit(family).alias("family"), endpoint.alias("endpoint"),
                            F.to_date("fetched_at").alias("date"))


def land(folder: str, **responses: DataFrame | None) -> None:
    """Append ``feeds``, ``searches``, ``firehose`` responses; busy folders are written by several tasks.

    All pages of a firehose request belong into one call, so that a stream sees them together.
    """
    parts = [_landed_rows(kind, rows) for kind, rows in responses.items() if rows is not None]
    if not parts:
        return
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows.hint("rebalance", *_FOLDERS).write.mode("append").partitionBy(*_FOLDERS).parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All landed responses; filters on family, endpoint and date skip folders."""
    return read_folder(spark, folder, schemas.LANDED)


def window(responses: DataFrame, now, *, days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """Responses of the dates from ``now`` minus ``days`` to today, both included: whole folders.

    ``now`` is a datetime on the UTC clock, so that the bounds are constants.
    """
    today = F.lit(now.date())
    return responses.filter(F.col("date").between(F.date_sub(today, days), today))


def stream(spark: SparkSession, folder: str, *, files_per_batch: int | None = None) -> DataFrame:
    """Stream over what lands. ``files_per_batch`` can part the pages of a firehose request."""
    reader = spark.readStream.schema(schemas.LANDED).option("basePath", folder)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def split(responses: DataFrame, families=C.FAMILIES) -> dict[str, DataFrame]:
    """Responses by kind, in the columns of the scans; only kinds of ``families``."""
    found = {}
    for kind, (family, name, schema) in _SHAPES.items():
        if family in families:
            rows = responses.filter(F.col("family") == family)
            found[kind] = rows.select(*[
                F.col("name").alias(name) if f == name else F.col(f) for f in schema.names])
    return found
