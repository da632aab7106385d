"""Insert, stamps, retention; and the same on keys that hold a third of all rows."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.values import NOW
from feedlake.operators import items as ops
from feedlake.schemas import ITEM, VECTOR

TTL = timedelta(days=365)  # restated here, so that a changed default fails


def naive(t):
    return t.replace(tzinfo=None)


def ids(df):
    return sorted(r["item_id"] for r in df.select("item_id").collect())


def test_insert_if_absent(items):
    first = ops.insert_if_absent(items({"item_id": "a"}, {"item_id": "b"}), items())
    assert ids(first) == ["a", "b"]
    second = ops.insert_if_absent(items({"item_id": "a", "title": "new"}, {"item_id": "c"}), first)
    assert ids(second) == ["c"]
    assert ids(ops.insert_if_absent(items({"item_id": "c"}), first.unionByName(second))) == []


def test_first_wins_by_time_family_and_position(items):
    later = NOW + timedelta(minutes=1)
    batch = items(
        {"item_id": "x", "title": "late", "fetched_at": later},
        {"item_id": "x", "title": "firehose", "family": "fmp"},
        {"item_id": "x", "title": "second feed", "feed_pos": 1},
        {"item_id": "x", "title": "first", "feed_pos": 0, "row_pos": 3},
        {"item_id": "x", "title": "after", "feed_pos": 0, "row_pos": 4})
    assert [r["title"] for r in ops.first_wins(batch).collect()] == ["first"]


def test_stamps(items):
    rows = {r["item_id"]: r for r in ops.stamp(items(
        {"item_id": "s", "title": "Class action"}, {"item_id": "n", "title": "News"})).collect()}
    assert (rows["s"]["kind"], rows["s"]["embed_pending"]) == ("spam", None)
    assert (rows["n"]["kind"], rows["n"]["embed_pending"]) == ("story", True)
    assert rows["n"]["expire_at"] == naive(NOW + TTL)


def test_new_rows_keep_copies(items):
    batch = items(*[{"item_id": i} for i in ("aaa", "bbb", "ccc", "bbb")])
    assert ids(ops.new_rows(batch, items({"item_id": "aaa"}))) == ["bbb", "bbb", "ccc"]
    assert ids(ops.new_rows(items(), items({"item_id": "aaa"}))) == []


def test_hot_key_holding_a_third_of_the_rows(items):
    rng = random.Random(7)
    rows = [{"item_id": "hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}",
             "feed_pos": rng.randrange(5), "title": str(i)} for i in range(3000)]
    batch, stored = items(*rows), items(*[{"item_id": f"k{i}"} for i in range(0, 300, 3)])
    want = {}
    for pos, r in enumerate(rows):
        rank = (r["feed_pos"], pos)
        if r["item_id"] not in want or rank < want[r["item_id"]][0]:
            want[r["item_id"]] = (rank, r["title"])
    got = {r["item_id"]: r["title"] for r in ops.first_wins(batch).collect()}
    assert got == {k: title for k, (_, title) in want.items()}
    held = {f"k{i}" for i in range(0, 300, 3)}
    kept = [r["item_id"] for r in rows if r["item_id"] not in held]
    assert ids(ops.new_rows(batch, stored)) == sorted(kept)
    assert ids(ops.insert_if_absent(batch, stored)) == sorted(set(kept))
    for insert in (ops.insert_if_absent, ops.insert_rescanned):
        fresh = {r["item_id"]: r["title"] for r in insert(batch, stored).collect()}
        assert fresh == {k: title for k, (_, title) in want.items() if k not in held}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_combines_before_the_shuffle(items):
    plan = plan_of(ops.first_wins(items({"item_id": "a"})))
    assert "partial_min_by" in plan and "Window" not in plan


def test_insert_reads_only_the_keys_of_the_store(spark, items, tmp_path):
    path = str(tmp_path / "stored")
    ops.as_item(ops.stamp(items({"item_id": "a"}))).write.parquet(path)
    stored = spark.read.schema(ITEM).parquet(path)
    scan = [line for line in plan_of(ops.insert_if_absent(items({"item_id": "b"}), stored))
            .splitlines() if "FileScan" in line]
    assert scan and all("ReadSchema: struct<item_id:string>" in line for line in scan)


def test_rescan_with_equal_positions_and_missing_ones(items):
    batch = items({"item_id": "a", "row_pos": 0}, {"item_id": "a", "row_pos": 0},
                  {"item_id": "b", "row_pos": None, "feed_pos": None}, {"item_id": "c"})
    assert ids(ops.insert_rescanned(batch, items({"item_id": "c"}))) == ["a", "b"]


def test_rescan_chooses_on_narrow_rows(spark, items, tmp_path):
    path = str(tmp_path / "batch")
    items({"item_id": "a"}).write.parquet(path)
    batch = spark.read.parquet(path)
    scans = [line for line in plan_of(ops.insert_rescanned(batch, items())).splitlines()
             if "FileScan" in line]
    assert len(scans) == 3 and sum("title#" in line for line in scans) == 1


def test_purge(items):
    rows = ops.stamp(items({"item_id": "old", "fetched_at": NOW - TTL}, {"item_id": "new"}))
    rows = rows.unionByName(
        ops.stamp(items({"item_id": "none"})).withColumn("expire_at", F.lit(None)))
    assert ids(ops.purge_expired(rows, NOW)) == ["new", "none"]
    assert ids(ops.purge_expired(rows, NOW - timedelta(seconds=1))) == ["new", "none", "old"]


def old_contract(spark, *rows):
    """(id, fetched_at, has_vector) rows written with a 60-day retention."""
    old = timedelta(days=60)
    items = [(i, "f", "S", "", "en", "", "t", "b", "", None, at,
              "story", (at or NOW) + old, None) for i, at, _ in rows]
    vectors = [(i, [0.1], "m", "t", at, at + old) for i, at, has in rows if has]
    return spark.createDataFrame(items, ITEM), spark.createDataFrame(vectors, VECTOR)


def test_retention_recompute(spark):
    oldest = NOW - timedelta(days=40)
    items, vectors = old_contract(
        spark, ("a", NOW, False), ("v", NOW, True), ("o", oldest, False), ("bad", None, False))
    orphan = spark.createDataFrame([("gone", [0.1], "m", "t", NOW, NOW)], VECTOR)
    vectors = vectors.unionByName(orphan)
    stats = ops.retention_stats(items, vectors).head().asDict()
    assert stats == {"scanned": 4, "items_updated": 3, "vectors_updated": 1, "already_ok": 0,
                     "no_fetched_at": 1, "oldest_fetched_at": naive(oldest)}
    new_vectors = ops.recompute_vector_expiry(vectors, items)
    new_items = ops.recompute_item_expiry(items)
    expiry = {r["item_id"]: r["expire_at"] for r in new_items.collect()}
    assert expiry["a"] == expiry["v"] == naive(NOW + TTL)
    assert expiry["bad"] == naive(NOW + timedelta(days=60))
    assert {r["item_id"]: r["expire_at"] for r in new_vectors.collect()} == {
        "v": naive(NOW + TTL), "gone": naive(NOW)}
    again = ops.retention_stats(new_items, new_vectors).head()
    assert (again["items_updated"], again["vectors_updated"], again["already_ok"]) == (0, 0, 3)


def test_new_counts(items):
    fresh = ops.insert_if_absent(
        items({"item_id": "a"}, {"item_id": "b", "feed_id": "f2"}, {"item_id": "c"}), items())
    assert {r["feed_id"]: r["new_count"] for r in ops.new_counts(fresh).collect()} == {
        "f1": 2, "f2": 1}


def test_timestamps_are_instants(items):
    assert ops.first_wins(items({"item_id": "a"})).head()["fetched_at"] == datetime(2026, 6, 12, 7)
