"""Connected components by contraction: point to the smallest neighbour, jump, merge, repeat."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import staged


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _roots(links: DataFrame) -> DataFrame:
    """node, root: each node points to its smallest neighbour or itself; roots end the chains."""
    up = staged(_both_ways(links).groupBy(F.col("a").alias("node"))
                .agg(F.least(F.col("a"), F.min("b")).alias("root")), "up")
    while True:
        above = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = staged(up.join(above, "root").select(
            "node", F.col("next").alias("root"), (F.col("next") < F.col("root")).alias("moved")), "up")
        up = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return up


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node in ``links`` (a, b: long).

    Each round at least merges every node that has a smaller neighbour, so few rounds are
    needed; links that end up within one root disappear. All joins read stored tables, whose
    hot keys adaptive execution splits. An empty table gives no rows; repeated links and links
    to oneself change nothing; links with a null end are left out.
    """
    links = staged(links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b").distinct(), "links")
    labels = None
    while labels is None or not links.isEmpty():
        roots = _roots(links)
        if labels is None:
            labels = roots
        else:
            after = roots.select(F.col("node").alias("root"), F.col("root").alias("later"))
            labels = staged(labels.join(after, "root", "left").select(
                "node", F.coalesce("later", "root").alias("root")), "labels")
        of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        links = staged(
            links.join(of_a, "a").join(of_b, "b").where("root_a <> root_b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
            .distinct(), "links")
    return labels
