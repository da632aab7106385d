"""Helpers shared by the operators: stored intermediate results and Arrow batch sizes."""

import ctypes
import gc
import uuid
from collections import defaultdict
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes that one Arrow batch holds at most, so that a worker's memory follows the
#: longest text and not the row count.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20

#: Whether the shuffle files of a query go when it has ended, and not when the driver next collects garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: What clears the memory of earlier tasks, by module. Spark keeps a worker for later stages.
CACHES: dict[str, list[Callable[[], None]]] = defaultdict(list)


def forget(module: str) -> None:
    """In a task: let go of what other modules' tasks remember in this worker."""
    for name, clear in CACHES.items():
        if name != module:
            for one in clear:
                one()
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: it gives memory back when it likes
        pass


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor reaches, as the cluster names it in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    It is computed once however often it is read, survives lost executors, and its size
    is known to the planner. All results of an application are below one folder.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-llm/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")  # of this write: what was shuffled for it is not read again
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def release(*results: DataFrame) -> None:
    """Delete staged results that nothing reads any more."""
    for df in results:
        hadoop, spark = df.sparkSession._jvm.org.apache.hadoop.fs, df.sparkSession
        for file in df.inputFiles()[:1]:
            path = hadoop.Path(spark._jvm.java.net.URI(file)).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete all that this application has staged; results that read it must be stored by then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-llm")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def strings(values) -> pd.Series:
    """Strings as Python objects, which Arrow takes as one array, also if there are none."""
    return pd.Series(list(values), dtype=object)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def surrogate_key(spark: SparkSession) -> str:
    """The key of surrogates, from spark.feedlake.surrogateKey; invented tables go without a secret one."""
    return spark.conf.get("spark.feedlake.surrogateKey", "key for invented data")
