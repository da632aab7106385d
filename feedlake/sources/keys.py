"""Which days of the stored articles may hold a key: Bloom filters beside the article table.

Every append to ``items`` first adds filters of its keys, one or more per task and day, to the table
``key_filters``. An insert asks them with the keys of its batch and reads the key column of the days that
may hold one, mostly the few days that do. A filter takes FILTER_BITS per key and is wrong for one key in a
million. It is only ever too wide: filters written by a run that died before its articles make a day
be read for nothing, and a day without any filter is always read. The answer is that of reading all days.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.sources import store

#: Bits and hashes per key, and keys of one filter at most.
FILTER_BITS, HASHES, FILTER_KEYS = 32, 12, 1 << 17
#: Keys that are asked one by one; a larger batch meets the key column of all days.
ASKED_KEYS = 200_000

FILTER = "day date, bits binary"


def _hashes() -> list[Column]:
    return [F.xxhash64("item_id", F.lit(k)).alias(f"h{k}") for k in (1, 2)]


def _places(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    """Bits of each key, a row per hash."""
    step = h2.astype(np.int64).view(np.uint64) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)[:, None]
    mixed = h1.astype(np.int64).view(np.uint64) + turns * step
    return (mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)


def _filter(h1: np.ndarray, h2: np.ndarray) -> bytes:
    bits = np.zeros(max(64, len(h1) * FILTER_BITS + 7 & ~7), np.uint8)
    bits[_places(h1, h2, len(bits))] = 1
    return np.packbits(bits).tobytes()


def _may_hold(bits: bytes, h1: np.ndarray, h2: np.ndarray) -> bool:
    there = np.unpackbits(np.frombuffer(bits, np.uint8))
    return bool(there[_places(h1, h2, len(there))].all(axis=0).any())


def filters(rows: DataFrame) -> DataFrame:
    """day, bits of the keys of article rows; each task makes its own."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for day, part in batch.groupby("day", dropna=False):
                day = None if pd.isna(day) else day
                held[day] = pd.concat([held[day], part]) if day in held else part
                if len(held[day]) >= FILTER_KEYS:
                    yield made(day, held.pop(day))
        for day, part in held.items():
            yield made(day, part)

    def made(day, part):
        bits = _filter(part["h1"].to_numpy(), part["h2"].to_numpy())
        return pd.DataFrame({"day": pd.Series([day], dtype=object), "bits": pd.Series([bits], dtype=object)})

    day = F.to_date(store.CLOCKS["items"]).alias("day")
    # by day within a task, so that one day's keys are held at a time
    keyed = rows.select(day, *_hashes()).sortWithinPartitions("day")
    return keyed.mapInPandas(make, FILTER)


def append_items(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """Append articles (a stored result), their filters first."""
    filters(rows).write.mode("append").parquet(f"{root}/key_filters")
    store.append(root, "items", rows)


def rebuild(spark: SparkSession, root: str) -> None:
    """Write the filters of all stored articles anew: after a purge, or for a table without them."""
    items = store.read(spark, root, "items").select("item_id", store.CLOCKS["items"])
    filters(items.repartition(store.CLOCKS["items"])).write.mode("overwrite").parquet(f"{root}/key_filters")


def _read(spark: SparkSession, root: str) -> DataFrame:
    return store.read_folder(spark, f"{root}/key_filters", FILTER)


def _stored_days(spark: SparkSession, root: str) -> list:
    """Days of the article table, by its folders alone."""
    return [r[0] for r in store.read(spark, root, "items").select(store.DAY).distinct().collect()]


def days_that_may_hold(spark: SparkSession, root: str, batch: DataFrame) -> DataFrame:
    """The stored articles of the days that may hold a key of ``batch`` (item_id)."""
    items = store.read(spark, root, "items")
    keys = batch.select(*_hashes()).distinct().limit(ASKED_KEYS + 1).toPandas()  # 16 bytes a key
    if len(keys) > ASKED_KEYS:
        return items
    asked = spark.sparkContext.broadcast((keys["h1"].to_numpy(), keys["h2"].to_numpy()))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            hit = [_may_hold(bits, *asked.value) for bits in rows["bits"]]
            yield pd.DataFrame({"day": rows["day"], "hit": hit})

    found = _read(spark, root).mapInPandas(ask, "day date, hit boolean").groupBy("day").agg(
        F.max("hit").alias("hit")).collect()  # a row per day of the retention
    known = {r["day"] for r in found}
    held = {r["day"] for r in found if r["hit"]}
    return store.on_days(items, [d for d in _stored_days(spark, root) if d in held or d not in known])
