"""Whole runs over stored tables: collect, embed, re-embed, retention, purge."""

import json
import sys
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tests.values import NOW
from feedlake import schemas
from feedlake.operators import embedding as emb
from feedlake.operators import items as ops
from feedlake.operators.embedding import ServiceRefused
from feedlake.plans import collect, upkeep
from feedlake.session import Scratch
from feedlake.sources import store


def rss(*links):
    items = "".join(f"<item><title>T {x}</title><link>https://e/{x}</link></item>" for x in links)
    return f'<rss version="2.0"><channel><title>c</title>{items}</channel></rss>'


@pytest.fixture
def registries(spark):
    feeds = [(f"f{i}", "u", f"S{i}", "", "en", "summary", None, "wire", i) for i in range(3)]
    return collect.Registries(
        feeds=spark.createDataFrame(feeds, schemas.FEED_REGISTRY),
        searches=spark.createDataFrame([("q1", "kr", 0), (" ", "", 1)], schemas.SEARCH_REGISTRY),
        endpoints=spark.createDataFrame(
            [("stock-latest", 0), ("fmp-articles", 1)], schemas.FIREHOSE_REGISTRY),
        settings={"page_size": 2, "caps": {"fmp-articles": 1}, "default_cap": 2,
                  "blackout_start_hour": 7, "blackout_end_hour": 9},
    )


@pytest.fixture
def landed(spark):
    def make(at, feeds=(), searches=(), firehose=()):
        f = [(i, at, n, s, etag, None, body) for n, (i, s, etag, body) in enumerate(feeds)]
        q = [(i, at, n, s, json.dumps(body)) for n, (i, s, body) in enumerate(searches)]
        p = [(e, page, at, n, s, json.dumps(body)) for n, (e, page, s, body) in enumerate(firehose)]
        return collect.Landed(
            feeds=spark.createDataFrame(f, schemas.FEED_PAYLOAD),
            searches=spark.createDataFrame(q, schemas.SEARCH_PAYLOAD),
            firehose=spark.createDataFrame(p, schemas.FIREHOSE_PAYLOAD))

    return make


@pytest.fixture
def ingest(spark, root, registries):
    """Ingest a run and return what was logged for it."""
    def run(landed):
        with Scratch(spark, "test") as stage:
            polls, broken = collect.ingest(spark, root, landed, registries, stage)
            assert broken == {}
            return outcomes(polls)

    return run


def row(n):
    return {"title": f"stock {n}", "url": f"https://e/{n}", "publishedDate": "2026-06-12 01:00:00"}


def outcomes(polls):
    return {r["feed_id"]: (r["status"], r["is_feed"], r["new_count"], r["error"])
            for r in polls.collect()}


def test_two_collect_runs(spark, root, ingest, landed):
    first = landed(
        NOW,
        feeds=[("f0", 200, "e0", rss("a", "b", "a")), ("f1", 304, None, None),
               ("f2", 200, "no", "<html>blocked</html>"), ("unknown", 200, None, rss("z"))],
        searches=[("q1", 200, {"items": [{"title": "b again", "originallink": "https://e/b"},
                                         {"title": "own", "originallink": "https://e/q"}]})],
        firehose=[("stock-latest", 0, 200, [row(1), row(2)]),
                  ("stock-latest", 1, 200, [row(3), row("a")]),
                  ("stock-latest", 2, 200, [row("beyond the fetcher's stop")]),
                  ("fmp-articles", 0, 200, [{"title": "m", "link": "https://e/m"}] * 2)])
    got = ingest(first)
    assert got == {
        "f0": (200, True, 2, None), "f1": (304, False, 0, None), "f2": (200, False, None, None),
        "naver:q1": (200, True, 1, None), "fmp:fmp-articles": (200, True, 1, None),
        "fmp:stock-latest": (200, True, 4, "truncated at page cap")}
    stored = {r["url"]: r["feed_id"] for r in store.read(spark, root, "items").collect()}
    assert stored == {
        "https://e/a": "f0", "https://e/b": "f0", "https://e/q": "naver:q1",
        "https://e/1": "fmp:stock-latest", "https://e/2": "fmp:stock-latest",
        "https://e/3": "fmp:stock-latest", "https://e/beyond the fetcher's stop": "fmp:stock-latest",
        "https://e/m": "fmp:fmp-articles"}
    state = {r["feed_id"]: r for r in store.read(spark, root, "feed_state").collect()}
    assert state["f0"]["etag"] == "e0" and state["f2"]["etag"] is None
    assert state["f2"]["consecutive_failures"] == 1
    assert state["fmp:stock-latest"]["last_error"] == "truncated at page cap"

    later = NOW + timedelta(minutes=15)
    second = landed(
        later, feeds=[("f0", 500, None, None), ("f2", 200, "e2", rss("a", "new"))],
        searches=[("q1", 200, {"items": None})],
        firehose=[("stock-latest", 0, 200, [row(1), row(9)]), ("stock-latest", 1, 500, None),
                  ("fmp-articles", 0, 200, [])])
    got = ingest(second)
    assert got == {
        "f0": (500, False, None, None), "f2": (200, True, 1, None),
        "naver:q1": (200, True, 0, None), "fmp:fmp-articles": (200, True, 0, None),
        "fmp:stock-latest": (500, False, None, None)}
    items = store.read(spark, root, "items")
    assert items.count() == 9 and items.select("item_id").distinct().count() == 9
    state = {r["feed_id"]: r for r in store.read(spark, root, "feed_state").collect()}
    assert state["f0"]["etag"] == "e0" and state["f0"]["consecutive_failures"] == 1
    assert state["f2"]["consecutive_failures"] == 0 and state["f2"]["etag"] == "e2"
    assert state["f1"]["last_success"] == NOW.replace(tzinfo=None)
    assert store.read(spark, root, "poll_log").count() == 11


def test_two_responses_at_one_time_count_once_each(spark, root, ingest, landed):
    got = landed(NOW, feeds=[("f0", 200, None, rss("a", "b")), ("f0", 200, None, rss("b", "c"))])
    ingest(got)
    polls = store.read(spark, root, "poll_log").orderBy("seq").collect()
    assert [(r["feed_id"], r["new_count"]) for r in polls] == [("f0", 2), ("f0", 1)]


@pytest.mark.parametrize("dies_at", ["items", "poll_log", "feed_state"])
def test_a_run_that_died_and_is_run_again_ends_as_one_run(spark, tmp_path, registries, landed, monkeypatch, dies_at):
    run = landed(NOW, feeds=[("f0", 200, "e", rss("a", "b")), ("f1", 500, None, None)],
                 searches=[("q1", 200, {"items": [{"title": "own", "originallink": "https://e/q"}]})])

    def collected(root):
        with Scratch(spark, "collect") as stage:
            collect.ingest(spark, root, run, registries, stage)

    def tables(root):
        return [sorted(map(str, store.read(spark, root, t).collect())) for t in ("items", "poll_log", "feed_state")]

    once, again = f"{tmp_path}/once", f"{tmp_path}/again"
    collected(once)
    real = {"append": store.append, "replace": store.replace}

    def dying(name):
        def write(*args):
            table = next(a for a in args if a in store.TABLES)
            real[name](*args)
            if table == dies_at:
                raise RuntimeError("killed")
        return write

    with monkeypatch.context() as m:
        for name in real:
            m.setattr(store, name, dying(name))
        with pytest.raises(RuntimeError, match="killed"):
            collected(again)
    collected(again)
    assert tables(again) == tables(once)
    collected(again)
    assert tables(again) == tables(once)


def test_a_page_landed_twice_is_its_last_good_response(spark, root, ingest, landed):
    run = landed(NOW, firehose=[
        ("stock-latest", 0, 500, None), ("stock-latest", 0, 200, [row(1)]), ("stock-latest", 0, 503, None),
        ("stock-latest", 1, 200, [row("beyond a short page")])])
    assert ingest(run) == {"fmp:stock-latest": (200, True, 1, None)}
    assert [r["url"] for r in store.read(spark, root, "items").collect()] == ["https://e/1"]


def test_a_broken_family_leaves_the_others(spark, root, registries, landed):
    ticks = iter(NOW + timedelta(seconds=s) for s in range(100))
    run = landed(NOW, feeds=[("f0", 200, None, rss("a"))], searches=[("q1", 200, {"items": []})])
    run.searches = run.searches.withColumn("status", F.raise_error(F.lit("unreadable")).cast("int"))
    with pytest.raises(collect.RunFailed, match="rss=ok naver=error fmp=ok embed=ok"):
        collect.collect_run(spark, root, run, registries, clock_now=lambda: next(ticks), embed=lambda: None)
    assert [r["url"] for r in store.read(spark, root, "items").collect()] == ["https://e/a"]
    assert [r["feed_id"] for r in store.read(spark, root, "poll_log").collect()] == ["f0"]


def test_blackout_leaves_no_trace(spark, root, ingest, landed):
    night = NOW.replace(hour=23)  # eight in the morning in Seoul
    run = landed(night, feeds=[("f0", 200, None, rss("a"))],
                 firehose=[("stock-latest", 0, 200, [row(1)])])
    assert set(ingest(run)) == {"f0"}
    assert store.read(spark, root, "feed_state").count() == 1


def test_run_verdict_and_health(spark, root, registries, landed):
    ticks = iter(NOW + timedelta(seconds=s) for s in range(100))
    good = landed(NOW, feeds=[("f0", 200, None, rss("a")), ("f1", 500, None, None)])
    calls = []
    line = collect.collect_run(spark, root, good, registries, clock_now=lambda: next(ticks),
                               embed=lambda: calls.append(1))
    assert line == "rss=ok naver=ok fmp=ok embed=ok" and calls == [1]
    health = store.read(spark, root, "job_health").head()
    assert (health["last_status"], health["detail"]) == ("ok", line)
    assert store.read(spark, root, "meta").head()["sources"] == ["S0", "S1", "S2"]

    bad = landed(NOW + timedelta(minutes=15), feeds=[("f0", 500, None, None), ("f1", 500, None, None)])
    with pytest.raises(collect.RunFailed, match=r"rss=fail\(2/2\) .*embed=fail\(no_key\)"):
        collect.collect_run(spark, root, bad, registries, clock_now=lambda: next(ticks))
    health = store.read(spark, root, "job_health").collect()
    assert len(health) == 1 and health[0]["last_status"] == "fail"
    assert "| ERROR: rss=fail(2/2)" in health[0]["detail"]
    assert store.read(spark, root, "run_log").count() == 4


# --- embedding over stored tables ------------------------------------------

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Scripted:
    def __call__(self, text):
        if "beta" in text:
            raise TimeoutError("later")
        if "gamma" in text:
            raise ServiceRefused("bad", code=400)
        if "denied" in text:
            raise ServiceRefused("who?", code=403)
        return [0.1] * 4


CALLS = {"dim": 4}
EMBEDDER = emb.one_by_one(Scripted)


def keep(spark, root, items, *titles):
    for n, title in enumerate(titles):
        store.append(root, "items", ops.as_item(ops.stamp(
            items({"item_id": title, "title": title, "fetched_at": NOW + timedelta(days=n)}))))


def waiting(spark, root):
    return {r["item_id"] for r in upkeep.waiting(spark, root, NOW).collect()}


def files(root, table):
    return {p: p.stat().st_mtime_ns for p in Path(root, table).rglob("*.parquet")}


def test_embed_pass_writes_no_article(spark, root, items):
    keep(spark, root, items, "alpha", "beta", "gamma")
    before = files(root, "items")
    stats = upkeep.embed_pass(spark, root, EMBEDDER, NOW, **CALLS)
    assert stats == {"pending": 3, "embedded": 1, "permanent": 1, "retryable": 1}
    assert waiting(spark, root) == {"beta"}
    assert [v["item_id"] for v in store.read(spark, root, "item_vectors").collect()] == ["alpha"]
    assert files(root, "items") == before
    assert upkeep.embed_pass(spark, root, EMBEDDER, NOW, **CALLS) == {
        "pending": 1, "embedded": 0, "permanent": 0, "retryable": 1}


def test_cap_empty_queue_and_abort(spark, root, items):
    assert upkeep.embed_pass(spark, root, EMBEDDER, NOW, **CALLS)["pending"] == 0
    keep(spark, root, items, "a", "b", "denied")
    assert upkeep.embed_pass(spark, root, EMBEDDER, NOW, cap=2, **CALLS)["embedded"] == 2
    with pytest.raises(emb.SetupFault):
        upkeep.embed_pass(spark, root, EMBEDDER, NOW, **CALLS)
    assert waiting(spark, root) == {"denied"}
    assert store.read(spark, root, "item_vectors").count() == 2


def test_drain(spark, root, items):
    keep(spark, root, items, "a", "b", "c")
    assert upkeep.drain(spark, root, EMBEDDER, NOW, cap=2, **CALLS) == {
        "embedded": 3, "permanent": 0, "stalled": False}
    keep(spark, root, items, "beta")
    assert upkeep.drain(spark, root, EMBEDDER, NOW, **CALLS) == {
        "embedded": 0, "permanent": 0, "stalled": True}
    assert waiting(spark, root) == {"beta"}


def test_contract_change_embeds_again(spark, root, items):
    keep(spark, root, items, "a", "b")
    upkeep.drain(spark, root, EMBEDDER, NOW, **CALLS)
    assert waiting(spark, root) == set()
    old = store.read(spark, root, "item_vectors").withColumn(
        "embed_task_type", F.when(F.col("item_id") == "a", "OLD").otherwise(F.col("embed_task_type")))
    store.overwrite_days(root, "item_vectors", old)
    assert waiting(spark, root) == {"a"}
    assert upkeep.drain(spark, root, EMBEDDER, NOW + timedelta(days=1), **CALLS)["embedded"] == 1
    upkeep.drop_stale_vectors(spark, root)
    vectors = store.read(spark, root, "item_vectors")
    assert vectors.count() == 2 and vectors.filter("embed_task_type = 'OLD'").count() == 0
    assert waiting(spark, root) == set()


def test_retention_and_purge(spark, root, items):
    keep(spark, root, items, "a", "b")
    upkeep.drain(spark, root, EMBEDDER, NOW, **CALLS)
    short = timedelta(days=60)
    stats = upkeep.recompute_retention(spark, root, ttl=short, dry_run=True)
    assert (stats["items_updated"], stats["vectors_updated"]) == (2, 2)
    day60 = NOW + short
    upkeep.purge(spark, root, day60)
    assert store.read(spark, root, "items").count() == 2
    assert upkeep.recompute_retention(spark, root, ttl=short)["items_updated"] == 2
    again = upkeep.recompute_retention(spark, root, ttl=short)
    assert (again["items_updated"], again["vectors_updated"], again["already_ok"]) == (0, 0, 2)
    before = files(root, "items")
    upkeep.purge(spark, root, day60)
    assert [r["item_id"] for r in store.read(spark, root, "items").collect()] == ["b"]
    assert [r["item_id"] for r in store.read(spark, root, "item_vectors").collect()] == ["b"]
    left = files(root, "items")
    assert len(left) < len(before) and left.items() <= before.items()  # gone, and the rest untouched
    upkeep.purge(spark, root, day60)
    assert files(root, "items") == left


def test_a_day_is_rewritten_only_where_rows_change(spark, root, items):
    both = ops.as_item(ops.stamp(items({"item_id": "x"}, {"item_id": "y"}))).withColumn(
        "expire_at", F.when(F.col("item_id") == "x", F.lit(NOW)).otherwise(F.col("expire_at")))
    store.append(root, "items", both)
    keep(spark, root, items, "other", "day")
    upkeep.purge(spark, root, NOW)
    assert {r["item_id"] for r in store.read(spark, root, "items").collect()} == {"y", "other", "day"}


def test_compact(spark, root, items):
    for n in range(3):
        store.append(root, "items", ops.as_item(ops.stamp(items({"item_id": f"k{n}"}))))
    rows = store.read(spark, root, "items")
    store.compact(spark, root, "items", [rows.head()["day"]])
    assert len(files(root, "items")) == 1
    assert store.read(spark, root, "items").count() == 3


def test_bodies_are_filled_before_the_insert(spark, root, registries, landed):
    page = "<article>" + "long enough text " * 10 + "</article>"
    run = landed(NOW, feeds=[("f0", 200, None, rss("a", "b")), ("f1", 200, None, rss("c"))])
    run.pages = spark.createDataFrame(
        [(f"https://e/{x}", NOW, 200, page) for x in "ac"], schemas.PAGE_PAYLOAD)
    registries.selectors = spark.createDataFrame([("S0", "article")], "source string, selector string")
    with Scratch(spark, "test") as stage:
        collect.ingest(spark, root, run, registries, stage)
    got = {r["url"]: len(r["body"]) > 80 for r in store.read(spark, root, "items").collect()}
    assert got == {"https://e/a": True, "https://e/b": False, "https://e/c": False}
