"""Registries: hand-written YAML files, and the same checks for registries kept in tables.

A file becomes a table as it is, with every field as text; the checks are DataFrame operations, whose
findings are put together before anything is refused.
"""

from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake import schemas
from feedlake.functions.text import strip

#: Value of a field that a feed leaves out; fields that are not here must be given.
FEED_DEFAULTS = {"asset_hint": "", "language": "en", "body_mode": "summary", "tz_offset": None, "tier": "wire"}


class RegistryError(ValueError):
    """The registry breaks its contract; the message lists all faults."""


def _entries(path, name: str) -> tuple[list, dict]:
    """The list of that name in a file, and what else stands there."""
    whole = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    rest = {key: value for key, value in whole.items() if key != name}
    return whole.get(name) or [], rest


def _refuse(faults: list[str]) -> None:
    if faults:
        raise RegistryError("; ".join(faults))


def _feed_faults(entries: list[dict]) -> list[str]:
    """Fields that a feed has too many or too few."""
    fields = {f.name for f in schemas.FEED_REGISTRY} - {"feed_pos"}
    needed = fields - FEED_DEFAULTS.keys()
    faults = []
    for at, entry in enumerate(entries):
        given = {key for key, value in entry.items() if value is not None}
        for what, names in (("does not know", entry.keys() - fields), ("lacks", needed - given)):
            if names:
                faults.append(f"feed {at} {what} {', '.join(sorted(names))}")
    return faults


def load_feeds(spark: SparkSession, path) -> DataFrame:
    """RSS registry; unknown or missing fields, values out of bounds and repeated ids are refused."""
    entries, _ = _entries(path, "feeds")
    _refuse(_feed_faults(entries))
    table = spark.createDataFrame(
        [({**FEED_DEFAULTS, **{k: None if v is None else str(v) for k, v in e.items()}}, at)
         for at, e in enumerate(entries)], "entry map<string,string>, feed_pos long")
    feeds = table.select(*[
        F.col("feed_pos") if f.name == "feed_pos" else F.col("entry")[f.name].cast(f.dataType).alias(f.name)
        for f in schemas.FEED_REGISTRY])
    repeated = sorted(r["feed_id"] for r in duplicate_feeds(feeds).collect())
    odd = invalid_feeds(feeds).select("feed_id", "body_mode", "tier").collect()
    _refuse(([f"repeated: {repeated}"] if repeated else [])
            + [f"{r['feed_id']} has body_mode {r['body_mode']} and tier {r['tier']}" for r in odd])
    return feeds


def _load(spark: SparkSession, path, name: str, schema, row) -> tuple[DataFrame, dict]:
    """Entries of a file as ``row(entry)`` with their place, and its settings; none is refused."""
    entries, settings = _entries(path, name)
    _refuse([] if entries else [f"no {name} in the registry"])
    return spark.createDataFrame([(*row(e), at) for at, e in enumerate(entries)], schema), settings


def load_searches(spark: SparkSession, path) -> tuple[DataFrame, dict]:
    """Search registry and its settings. A blank query stays; ``usable_searches`` sets it aside."""
    searches, settings = _load(spark, path, "queries", schemas.SEARCH_REGISTRY,
                               lambda e: (e.get("q"), str(e.get("asset_hint") or "").strip()))
    return searches, {"display": int(settings.get("display", C.SEARCH_DISPLAY))}


def load_firehose(spark: SparkSession, path) -> tuple[DataFrame, dict]:
    """Firehose endpoints and settings: lookback, and hours of the blackout if there is one."""
    endpoints, settings = _load(spark, path, "endpoints", schemas.FIREHOSE_REGISTRY, lambda e: (e,))
    wanted = {"lookback_days": C.LOOKBACK_DAYS, "blackout_start_hour": None, "blackout_end_hour": None}
    given = {k: settings[k] for k in wanted if settings.get(k) is not None}
    return endpoints, {k: v if v is None else int(v) for k, v in {**wanted, **given}.items()}


def usable_searches(searches: DataFrame) -> DataFrame:
    """Queries that are not blank, stripped."""
    return searches.withColumn("q", strip("q")).filter(F.col("q") != "")


def duplicate_feeds(registry: DataFrame) -> DataFrame:
    """Feed ids that occur more than once, with their count."""
    return (
        registry.groupBy("feed_id").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    )


def invalid_feeds(registry: DataFrame) -> DataFrame:
    """Rows whose body mode or tier lies outside its domain."""
    return registry.filter(
        ~F.coalesce(F.col("body_mode").isin(*C.BODY_MODES), F.lit(False))
        | ~F.coalesce(F.col("tier").isin(*C.TIERS), F.lit(False))
    )


def distinct_sources(registry: DataFrame) -> DataFrame:
    """Source labels with the position where each first appears."""
    return registry.groupBy("source").agg(F.min("feed_pos").alias("first_pos"))


def source_tiers(registry: DataFrame) -> DataFrame:
    """Tier of each source, taken from its first feed."""
    return registry.groupBy("source").agg(F.min_by("tier", "feed_pos").alias("tier"))


def sources_meta(registry: DataFrame, key: str = "sources") -> DataFrame:
    """The published one-row document: ordered sources and their tiers.

    Arrays here hold one entry per source of the hand-written registry.
    """
    firsts = registry.groupBy("source").agg(
        F.min("feed_pos").alias("pos"), F.min_by("tier", "feed_pos").alias("tier")
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "source", "tier")))
    return firsts.agg(ordered.alias("s")).select(
        F.lit(key).alias("key"),
        F.col("s.source").alias("sources"),
        F.map_from_arrays("s.source", "s.tier").alias("tiers"),
    )


def selector_drift(selectors: DataFrame, registry: DataFrame) -> DataFrame:
    """Selector sources that no registry row has; must be empty."""
    return selectors.select("source").distinct().join(
        registry.select("source"), "source", "left_anti"
    )


def source_drift(published: DataFrame, registry: DataFrame) -> DataFrame:
    """Sources on one side only, with the side; must be empty."""
    left = published.select("source").distinct()
    right = registry.select("source").distinct()
    return left.join(right, "source", "left_anti").select(
        "source", F.lit("published only").alias("side")
    ).unionByName(
        right.join(left, "source", "left_anti").select(
            "source", F.lit("registry only").alias("side")
        )
    )


def missing_fields(df: DataFrame, schema) -> list[str]:
    """Contract fields that a stored table lacks."""
    return [f.name for f in schema if f.name not in df.columns]
