"""Streams give what the batch operators give, whatever the cut into batches."""

import random
import shutil
from datetime import timedelta

import pandas as pd
import pytest

from tests.values import NOW
from feedlake.operators import health
from feedlake.operators import items as ops
from feedlake.schemas import MAPPED_ITEM, POLL_LOG
from feedlake.sources import store
from feedlake.streaming import ingest


def land(df, path, name):
    df.coalesce(1).write.parquet(f"{path}/{name}")


def run(start, spark, source, schema, tmp_path, files):
    stream = ingest.stream_files(spark, f"{source}/*", schema, files_per_batch=files)
    query = start(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    return str(tmp_path / "out")


def test_insert(spark, items, tmp_path):
    source = str(tmp_path / "in")
    rows = [{"item_id": f"k{n % 7}", "title": str(n), "row_pos": n,
             "fetched_at": NOW + timedelta(minutes=n)} for n in range(40)]
    for part in range(4):
        land(items(*rows[part * 10:part * 10 + 10]), source, f"p{part}")
    store.append(str(tmp_path / "out"), "items", ops.as_item(ops.stamp(items({"item_id": "k1", "title": "batch"}))))
    out = run(ingest.stream_insert, spark, source, MAPPED_ITEM, tmp_path, 1)
    got = store.read(spark, out, "items").filter("title <> 'batch'")
    want = ops.insert_if_absent(items(*rows), items({"item_id": "k1"}))  # stored by the batch job
    key = ["item_id", "title", "kind", "expire_at"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(
        map(tuple, want.select(key).collect()))
    # late and repeated rows in a later start change nothing
    land(items(*rows[:20], {"item_id": "late", "fetched_at": NOW - timedelta(days=3)}), source, "p9")
    run(ingest.stream_insert, spark, source, MAPPED_ITEM, tmp_path, 1)
    assert store.read(spark, out, "items").count() == 8


def log(n, seed):
    rng = random.Random(seed)
    return [("rss", f"f{k % 5 if k % 3 else 0}", NOW + timedelta(minutes=k), k, rng.choice([200, 500, 304, 500, 503]),
             rng.random() < 0.9, str(k), None, 0, None) for k in range(n)]


@pytest.mark.parametrize("late", [False, True])
def test_feed_state_of_any_order_is_the_batch_fold(spark, tmp_path, monkeypatch, late):
    monkeypatch.setattr(ingest, "COMPACT_EVERY", 2)
    rows = log(90, 1)
    dealt = list(rows)
    if late:
        random.Random(2).shuffle(dealt)
    source = str(tmp_path / "in")
    for part in range(6):
        land(spark.createDataFrame(dealt[part * 15:part * 15 + 15], POLL_LOG), source, f"p{part}")
    out = run(ingest.stream_feed_state, spark, source, POLL_LOG, tmp_path, 1)
    want = health.fold_feed_state(spark.createDataFrame(rows, POLL_LOG))
    got = ingest.read_state(spark, out).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert len(list((tmp_path / "out" / "updates").glob("batch=*"))) <= 3  # older ones are joined


def test_a_late_success_takes_back_the_failures_before_it():
    polls = lambda *rows: pd.DataFrame(rows, columns=[
        "ts", "seq", "ok", "has_cursor", "etag", "last_modified", "message"], dtype=object)
    fail = lambda ts: (ts, 0, False, False, None, None, "HTTP 500")
    state = ingest._fold_slot((*[None] * 9, [], []), polls(fail(1), fail(3), fail(5)))
    assert state[9] == [1, 3, 5]
    state = ingest._fold_slot(state, polls((4, 0, True, True, "e", None, None), fail(2)))
    assert state[:2] == (4, 0) and state[4] == "e" and state[9] == [5] and state[8] == "HTTP 500"


def test_feed_state_costs_no_call_per_feed(spark, tmp_path, monkeypatch):
    """Many feeds, dealt out of order, and a batch that stopped after its base was written."""
    polls = spark.range(20_000).selectExpr(
        "'rss' family", "concat('f', id % 10000) feed_id", "timestamp_seconds(1700000000 + id * 7919 % 20000) ts",
        "id seq", "CASE id % 3 WHEN 0 THEN 200 ELSE 500 END status", "true is_feed", "CAST(id AS string) etag",
        "CAST(NULL AS string) last_modified", "0L new_count", "CAST(NULL AS string) error")
    source = str(tmp_path / "in")
    monkeypatch.setattr(ingest, "COMPACT_EVERY", 1)
    for part in range(2):
        land(polls.filter(f"seq % 2 = {part}"), source, f"p{part}")
    out = str(tmp_path / "out")
    stream = ingest.stream_feed_state(
        ingest.stream_files(spark, f"{source}/*", POLL_LOG, files_per_batch=1), out, str(tmp_path / "checkpoint"))
    stream.awaitTermination()
    assert [p["stateOperators"] for p in stream.recentProgress if p["numInputRows"]] == [[], []]
    want = health.fold_feed_state(polls)
    got = lambda: sorted(map(str, ingest.read_state(spark, out).select(want.columns).collect()))
    expected = sorted(map(str, want.collect()))
    assert got() == expected
    shutil.copytree(f"{out}/base/batch=0", f"{out}/updates/batch=0")  # the join was done, its parts not yet deleted
    assert got() == expected


def test_feed_state_is_the_fold_row_by_row(spark, tmp_path):
    rows = log(60, 3)
    random.Random(4).shuffle(rows)
    land(spark.createDataFrame(rows, POLL_LOG), str(tmp_path / "in"), "p0")
    out = run(ingest.stream_feed_state, spark, str(tmp_path / "in"), POLL_LOG, tmp_path, None)
    got = {r["feed_id"]: (r["etag"], r["consecutive_failures"], r["last_error"])
           for r in ingest.read_state(spark, out).collect()}
    for feed, (etag, failures, error) in got.items():
        own = [r for r in rows if r[1] == feed]
        ok = [r[4] == 304 or (r[4] == 200 and r[5]) for r in own]
        polls = pd.DataFrame({
            "ts": [r[3] for r in own], "seq": 0, "ok": ok, "etag": [r[6] for r in own], "last_modified": None,
            "has_cursor": [good and r[4] == 200 for good, r in zip(ok, own)],
            "message": [None if good else "not a parseable feed" if r[4] == 200 else f"HTTP {r[4]}"
                        for good, r in zip(ok, own)]}, dtype=object)
        state = ingest._fold_slot((*[None] * 9, [], []), polls)
        assert (etag, failures, error) == (state[4], len(state[9]), state[8])
