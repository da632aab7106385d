"""Deadlines of families that run side by side, and the stop of a whole embedding pass."""

import json
import sys
import threading
import time
from datetime import timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from feedlake import schemas
from feedlake.operators import embedding as emb
from feedlake.operators import items as ops
from feedlake.plans import collect, job_queries, upkeep
from feedlake.session import Scratch
from feedlake.sources import store
from feedlake.watch import DeadlineExceeded, Watched, side_by_side
from tests.values import NOW

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(IntegerType())
def hanging(status: pd.Series) -> pd.Series:
    time.sleep(600)
    return status


def tasks_running(spark):
    tracker = spark.sparkContext.statusTracker()
    return sum(tracker.getStageInfo(s).numActiveTasks for s in tracker.getActiveStageIds())


def test_parts_share_one_deadline_and_do_not_wait_for_each_other(spark):
    slow = lambda _: spark.range(1).select(hanging(F.col("id").cast("int"))).collect()
    both = threading.Barrier(2, timeout=30)

    def raises(fault):
        def work(_):
            raise fault
        return work

    begun = time.monotonic()
    values, markers = side_by_side(spark, {
        "a": slow, "b": lambda _: both.wait() >= 0, "c": lambda _: both.wait() >= 0, "d": raises(ValueError("x")),
        "e": raises(DeadlineExceeded()), "f": slow}, timeout=6, deadlines={"f": 2})
    assert values == {"b": True, "c": True}
    assert list(markers.items()) == [("a", "timeout"), ("d", "error"), ("e", "deadline"), ("f", "deadline")]
    assert time.monotonic() - begun < 30
    until = time.monotonic() + 30
    while tasks_running(spark) and time.monotonic() < until:
        time.sleep(0.2)
    assert tasks_running(spark) == 0


def test_no_step_begins_after_giving_up(spark):
    go, done = threading.Event(), []

    def work(watched):
        go.wait(30)
        watched.check()
        done.append(spark.range(3).count())

    part = Watched(spark, "late", work)
    part.give_up(grace=0.3)
    go.set()
    assert part.wait(30) and done == []


def test_without_limits_parts_are_waited_for(spark):
    values, markers = side_by_side(spark, {"a": lambda _: spark.range(7).count(), "b": lambda _: None})
    assert values == {"a": 7, "b": None} and markers == {}
    assert side_by_side(spark, {}) == ({}, {})


@pytest.fixture
def registries(spark):
    return collect.Registries(
        feeds=spark.createDataFrame([("f0", "u", "S", "", "en", "summary", None, "wire", 0)], schemas.FEED_REGISTRY),
        searches=spark.createDataFrame([("q1", "kr", 0)], schemas.SEARCH_REGISTRY))


def landed(spark, hang):
    feed = "<rss version='2.0'><channel><item><title>T</title><link>https://e/a</link></item></channel></rss>"
    found = json.dumps({"items": [{"title": "T", "originallink": "https://e/b", "link": "https://e/b",
                                   "description": "d", "pubDate": "Mon, 01 Jun 2026 10:00:00 +0900"}]})
    searches = spark.createDataFrame([("q1", NOW, 0, 200, found)], schemas.SEARCH_PAYLOAD)
    return collect.Landed(
        feeds=spark.createDataFrame([("f0", NOW, 0, 200, None, None, feed)], schemas.FEED_PAYLOAD),
        searches=searches.withColumn("status", hanging("status")) if hang else searches)


@pytest.mark.parametrize("marker,limits", [
    ("timeout", {"timeout": 30}), ("deadline", {"timeout": 60, "deadlines": {"naver": 3}})])
def test_a_family_that_hangs_is_marked_and_the_others_are_stored(spark, root, registries, marker, limits):
    ticks = iter(NOW + timedelta(seconds=s) for s in range(100))
    run = lambda hang, **more: collect.collect_run(
        spark, root, landed(spark, hang), registries, clock_now=lambda: next(ticks), embed=lambda: None, **more)
    with pytest.raises(collect.RunFailed, match=f"rss=ok naver={marker} fmp=ok embed=ok"):
        run(True, **limits)
    urls = lambda: {r["url"] for r in store.read(spark, root, "items").collect()}
    assert urls() == {"https://e/a"}
    health = store.read(spark, root, "job_health").head()
    assert health["last_status"] == "fail" and f"naver={marker}" in health["detail"]
    # the responses stayed landed: the next run takes what this one could not
    assert run(False) == "rss=ok naver=ok fmp=ok embed=ok"
    assert urls() == {"https://e/a", "https://e/b"}


def test_a_family_that_breaks_down_is_no_result(spark, root, registries, monkeypatch):
    def broken(*_):
        raise ValueError("broken")

    monkeypatch.setattr(collect, "search_pass", broken)
    monkeypatch.setattr(job_queries, "landed_responses", lambda *_: landed(spark, False))
    monkeypatch.setattr(job_queries, "job_registries", lambda *_: registries)
    with pytest.raises(collect.RunFailed, match="naver=error") as raised:
        job_queries.collect_ingest(spark, "no tables are read")
    assert str(raised.value.__cause__) == "broken"
    ingest = lambda **more: collect.ingest(
        spark, root, landed(spark, False), registries, stage, **more)
    with Scratch(spark, "marked") as stage:
        assert ingest(marked=True)[1] == {"naver": "error"}
    with Scratch(spark, "raised") as stage, pytest.raises(collect.RunFailed, match="naver=error"):
        ingest()
    assert {r["url"] for r in store.read(spark, root, "items").collect()} == {"https://e/a"}  # the others are stored
    monkeypatch.setattr(collect, "feed_pass", broken)
    with Scratch(spark, "none") as stage, pytest.raises(collect.RunFailed, match="rss=error naver=error"):
        ingest()


class Counting:
    """Each call leaves a file; the text 'denied' is refused for good, others take a while."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        def single(text):
            Path(self.folder, text.strip()).touch()
            if text.startswith("denied"):
                raise emb.ServiceRefused("no entry with ?key=abc123", code=403)
            time.sleep(0.3)
            return [0.1] * 4
        return single


def test_a_set_up_fault_stops_the_calls_of_all_tasks(spark, root, items, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = [{"item_id": f"a{n}", "title": f"a{n}", "body": ""} for n in range(800)]
    rows += [{"item_id": "denied", "title": "denied", "body": ""}]
    store.append(root, "items", ops.as_item(ops.stamp(items(*rows))))
    with pytest.raises(emb.SetupFault) as fault:
        upkeep.embed_pass(spark, root, emb.one_by_one(Counting(str(calls))), NOW, dim=4, per_call=1, partitions=8)
    assert "abc123" not in str(fault.value)
    # Spark ends a Python worker two seconds after its task; the other tasks had 30 seconds of calls each
    time.sleep(5)
    sent = {p.name: p.stat().st_mtime for p in calls.iterdir()}
    assert max(sent.values()) < sent["denied"] + 6 and len(sent) < 750
    assert store.read(spark, root, "item_vectors").count() == 0
    assert store.read(spark, root, "embed_failures").count() == 0
