"""Which landed pages of a paginated request count, and whether it was cut off."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedlake import constants as C


def page_cap(endpoint: str = "endpoint", *, caps=None, default: int = C.PAGE_CAP) -> Column:
    """Pages after which the fetcher of an endpoint stops asking."""
    caps = C.PAGE_CAPS if caps is None else caps
    result = F.lit(default)
    for name, cap in caps.items():
        result = F.when(F.col(endpoint) == name, F.lit(cap)).otherwise(result)
    return result


def accepted_pages(
    pages: DataFrame, request: list[str], *, cap: Column | int | None = None,
    page_size: int = C.PAGE_SIZE,
) -> DataFrame:
    """Pages in reading order, accepted up to the first short one or a gap.

    ``pages`` has one row per request and page with ``n_rows``; pages count from 0. All
    landed pages take part unless a ``cap`` is given. The first page that is not a full
    one in its row comes from two aggregates, not from a window over a request's pages.
    """
    if cap is not None:
        pages = pages.filter(F.col("page") < (F.lit(cap) if isinstance(cap, int) else cap))
    full = F.col("n_rows") >= page_size
    # after full pages 0, 1, ..., k - 1 comes page k, whatever it holds
    some = pages.filter((F.col("n_rows") > 0) & (F.col("page") >= 0))
    stops = some.filter(full).groupBy(*request).agg(
        F.array_sort(F.collect_set("page")).alias("_full"))
    run = F.aggregate("_full", F.lit(0), lambda n, p: F.when(p == n, n + 1).otherwise(n))
    stops = stops.select(*request, run.alias("_stop"))
    marked = pages.join(stops, request, "left").withColumn("_stop", F.coalesce("_stop", F.lit(0)))
    return marked.withColumn("full", full & (F.col("page") < F.col("_stop"))).withColumn(
        "accepted", (F.col("n_rows") > 0) & F.col("page").between(0, F.col("_stop"))).drop("_stop")


def page_totals(
    accepted: DataFrame, request: list[str], *, cap: Column | int = C.PAGE_CAP
) -> DataFrame:
    """Per request: pages and rows read, and whether full pages reach the fetcher's ``cap``.

    A request without a page that counts read nothing and is there too. ``cap`` is a
    number or depends on the request columns.
    """
    cap = F.lit(cap) if isinstance(cap, int) else cap
    taken = F.when(F.col("accepted"), 1).otherwise(0)
    full = F.when(F.col("accepted") & F.col("full"), 1).otherwise(0)
    return accepted.groupBy(*request).agg(
        F.sum(taken).alias("pages_read"),
        F.coalesce(F.sum(F.when(F.col("accepted"), F.col("n_rows"))), F.lit(0)).alias("rows_read"),
        F.sum(full).alias("_full"),
    ).withColumn("truncated", F.col("_full") >= cap).drop("_full")


def truncation_note(truncated, endpoint, *, unbounded=C.UNBOUNDED_ENDPOINTS) -> Column:
    """Health note of a cut-off request; endpoints without a date window get none."""
    return F.when(F.col(truncated) & ~F.col(endpoint).isin(*unbounded), C.TRUNCATED_NOTE)
