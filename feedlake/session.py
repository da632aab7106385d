"""Session settings and the shared scratch folder."""

import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("feedlake.session")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Zone-less parquet clocks are instants on the UTC clock; without a cast in between,
    # time filters reach the scan.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A registry of a few sources leaves most partitions empty, which by default keeps it from being sent: the
    # responses of a busy source would all meet it in one task. Bytes decide, not partitions.
    "spark.sql.adaptive.nonEmptyPartitionRatioForBroadcastJoin": "0",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results depend on (the UTC clock) or plans want."""
    for key, value in SETTINGS.items():
        try:
            spark.conf.set(key, value)
        except AnalysisException as e:  # one that this Spark fixes at its start
            if key == "spark.sql.session.timeZone":
                raise
            log.warning("%s stays as it is: %s", key, e)
    return spark


def shared_dir(spark: SparkSession, default: str | None = None) -> str:
    """The folder all executors reach, as the cluster names it in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or default
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str, default: str | None = None) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark, default)}/feedlake-{label}-{uuid.uuid4().hex}"


class Scratch:
    """Intermediate results of one job, as parquet in the shared folder.

    What is used twice is computed once, and a lost executor costs one stage and not the
    whole lineage. Parquet rather than checkpoint(), as it keeps column pruning. The
    job's own folder goes away when the job is over.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = scratch_path(spark, label)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        """Write a result and read it back."""
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
