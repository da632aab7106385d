"""Responses in folders by family, endpoint and date, and streamed from there."""

import random
from datetime import timedelta

import pytest

from feedlake import schemas
from feedlake.plans import collect
from feedlake.session import Scratch
from feedlake.sources import landing, store
from feedlake.streaming import collect as streaming
from tests.test_jobs import landed, registries, rss, row  # noqa: F401
from tests.values import NOW


def page(spark, day, endpoint="stock-latest", seq=0):
    at = None if day is None else NOW + timedelta(days=day)
    return spark.createDataFrame([(endpoint, 0, at, seq, 200, "[]")], schemas.FIREHOSE_PAYLOAD)


def test_window_reads_the_folders_of_its_dates(spark, tmp_path):
    folder = str(tmp_path / "in")
    for day in (-9, -4, -3, 0, 1, None):
        landing.land(folder, firehose=page(spark, day))
    landing.land(folder, firehose=page(spark, -1, "fmp-articles"))
    found = landing.split(landing.window(landing.read(spark, folder), NOW))["firehose"]
    assert found.columns == schemas.FIREHOSE_PAYLOAD.names
    days = [r["fetched_at"].date() for r in found.collect()]
    assert sorted(days) == [(NOW - timedelta(days=d)).date() for d in (3, 1, 0)]
    plan = found.filter("endpoint = 'fmp-articles'")._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert landing.read(spark, folder).count() == 7
    assert landing.read(spark, str(tmp_path / "none")).count() == 0


def test_families_come_back_as_they_landed(spark, tmp_path, landed):  # noqa: F811
    given = landed(NOW, feeds=[("f0", 200, "e", rss("a")), (None, 500, None, None)],
                   searches=[("q1", 200, {"items": []})], firehose=[("x", 3, 200, [])])
    given.feeds = given.feeds.selectExpr("*", "1 AS date", "'clash' AS family")
    landing.land(str(tmp_path / "in"), **{k: v for k, v in vars(given).items() if k != "pages"})
    found = landing.split(landing.read(spark, str(tmp_path / "in")))
    for kind in ("feeds", "searches", "firehose"):
        want = getattr(given, kind).select(*found[kind].columns)
        assert sorted(map(str, found[kind].collect())) == sorted(map(str, want.collect())), kind


def runs(landed):  # noqa: F811
    """Responses of six times; feed f0 fails at the last two, both endpoints answer at some."""
    for k in range(6):
        yield landed(
            NOW + timedelta(hours=k),
            feeds=[("f0", 500 if k > 3 else 200, f"e{k}", rss("a", f"n{k}")), ("f1", 200 if k == 2 else 503, None, rss("a"))],
            searches=[("q1", 200, {"items": [{"title": f"s{k}", "link": f"https://e/s{k}", "description": "d",
                                              "pubDate": "Fri, 12 Jun 2026 10:00:00 +0900"}]})],
            firehose=[("stock-latest", 0, 200, [row(k)])] if k % 2 else [])


def tables(spark, root):
    polls = store.read(spark, root, "poll_log").select("family", "feed_id", "ts", "status")
    items = store.read(spark, root, "items").select("url")
    state = store.read(spark, root, "feed_state")
    return [sorted(map(str, df.collect())) for df in (polls, items, state)]


@pytest.mark.parametrize("late", [False, True])
def test_a_stream_gives_what_one_run_gives(spark, tmp_path, landed, registries, late, monkeypatch):  # noqa: F811
    parts, folder = list(runs(landed)), str(tmp_path / "in")
    for part in parts:
        landing.land(str(tmp_path / "all"), feeds=part.feeds, searches=part.searches, firehose=part.firehose)
    with Scratch(spark, "test") as stage:
        whole = collect.landed_window(spark, str(tmp_path / "all"), NOW + timedelta(days=1), registries)
        collect.ingest(spark, str(tmp_path / "batch"), whole, registries, stage)
    if late:
        random.Random(3).shuffle(parts)
    root = str(tmp_path / "stream")

    def go():
        streaming.stream_collect(landing.stream(spark, folder), root, str(tmp_path / "checkpoint"),
                                 registries).awaitTermination()

    append = store.append
    for n, part in enumerate(parts[k:k + 2] for k in (0, 2, 4)):
        for one in part:
            landing.land(folder, feeds=one.feeds, searches=one.searches, firehose=one.firehose)
        if n == 1:  # dies after the articles, and is started again
            def dies(root_, table, rows):
                if table == "poll_log":
                    raise RuntimeError("lost")
                append(root_, table, rows)
            monkeypatch.setattr(store, "append", dies)
            with pytest.raises(Exception, match="lost"):
                go()
            monkeypatch.setattr(store, "append", append)
        go()
    assert tables(spark, root) == tables(spark, str(tmp_path / "batch"))


def test_a_broken_family_stops_the_stream_and_is_run_again(
        spark, tmp_path, landed, registries, monkeypatch):  # noqa: F811
    one = next(runs(landed))
    folder, root = str(tmp_path / "in"), str(tmp_path / "stream")
    landing.land(folder, feeds=one.feeds, searches=one.searches)

    def go():
        streaming.stream_collect(landing.stream(spark, folder), root, str(tmp_path / "checkpoint"),
                                 registries).awaitTermination()

    def broken(*_):
        raise ValueError("broken")
    monkeypatch.setattr(collect, "search_pass", broken)
    with pytest.raises(Exception, match="naver"):
        go()
    assert {r["family"] for r in store.read(spark, root, "poll_log").collect()} == {"rss"}
    monkeypatch.undo()
    go()
    polls = store.read(spark, root, "poll_log").groupBy("family").count().collect()
    assert dict(map(tuple, polls)) == {"rss": 2, "naver": 1}


def test_counts_come_from_footers(spark, root, items, monkeypatch):
    from feedlake.operators import items as ops
    rows = items(*[{"item_id": str(n), "fetched_at": NOW + timedelta(days=n % 3)} for n in range(10)])
    store.append(root, "items", ops.as_item(ops.stamp(rows)))
    seen = []
    collect_rows = type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: seen.append(
        df._jdf.queryExecution().executedPlan().toString()) or collect_rows(df))
    counts = store.counts(spark, root, "items")
    monkeypatch.undo()
    assert sorted(r["n"] for r in counts.collect()) == [3, 3, 4]
    assert "COUNT(*)" in seen[0].split("PushedAggregation")[1].split("]")[0]
    assert store.counts(spark, str(root) + "-none", "items").count() == 0
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
