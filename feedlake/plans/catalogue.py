"""The registry of queries: a name, a Spark query and, where SQL can say it, its SQL."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.session import configure

QUERIES = {}
ORACLE_SQL = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; instants leave as clock values without a zone."""

    def register(fn):
        def run(spark, sf_dir) -> DataFrame:
            df = fn(configure(spark), sf_dir)
            return df.select(*[
                F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                if f.dataType.typeName() == "timestamp" else F.col(f"`{f.name}`")
                for f in df.schema
            ])

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run

    return register
