"""Reader views, bodies, reports and the status board."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.values import NOW
from feedlake.operators import bodies, views
from feedlake.operators import items as ops
from feedlake.schemas import JOB_HEALTH, PAGE_PAYLOAD

PAGE = "<html><body><article><p>" + "본문 내용입니다. " * 12 + "</p></article></body></html>"


def ago(**kw):
    return NOW - timedelta(**kw)


def test_reader_view(items):
    df = ops.stamp(items(
        {"item_id": "a", "title": "Same — News!", "fetched_at": ago(hours=2)},
        {"item_id": "b", "title": "same news", "fetched_at": ago(hours=1)},
        {"item_id": "c", "title": "same news", "published_at": ago(days=9)},
        {"item_id": "d", "title": "Class action"},
        {"item_id": "e", "title": "…"}, {"item_id": "f", "title": "!"}))
    got = {r["item_id"]: r["copies"] for r in views.reader_view(df).collect()}
    assert got == {"b": 3, "e": 1, "f": 1}
    plan = views.reader_view(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_lists(items):
    df = items(*[{"item_id": str(n), "source": "AB"[n % 2], "fetched_at": ago(hours=n)}
                 for n in range(6)])
    assert {r["source"]: r["item_id"] for r in views.latest_per_source(df).collect()} == {
        "A": "0", "B": "1"}
    listed = views.list_source(df, "B", limit=2, by="fetched_at")
    assert [r["item_id"] for r in listed.collect()] == ["1", "3"]
    assert "TakeOrderedAndProject" in listed._jdf.queryExecution().executedPlan().toString()
    assert views.latest_item(df).head()["item_id"] == "0"
    assert {r["source"]: r["n"] for r in views.source_volume(df).collect()} == {"A": 3, "B": 3}


def test_url_overlap(items):
    batch = items({"url": "u1"}, {"url": "u2"}, {"url": "u1"}, {"url": ""}, {"url": "u3"})
    stored = items({"url": "u1"}, {"url": "u1"}, {"url": "u9"}, {"url": ""})
    assert tuple(views.url_overlap(batch, stored).head()) == (4, 2, 50.0)
    assert tuple(views.url_overlap(items(), stored).head()) == (0, 0, None)


def test_probe_report(items, spark):
    registry = spark.createDataFrame([("a",), ("b",), ("c",)], "feed_id string")
    found = items({"feed_id": "a", "body": " "}, {"feed_id": "a", "body": "x"},
                  {"feed_id": "b", "body": "\t"})
    got = {r["feed_id"]: tuple(r)[1:] for r in views.probe_report(registry, found).collect()}
    assert got == {"a": (2, True, False), "b": (1, False, False), "c": (0, False, True)}


@pytest.mark.parametrize("status, age, level, text", [
    (None, 0, "bad", "미실행"), ("fail", 0, "bad", "실패"), ("running", 0, "warn", "실행 중"),
    ("running", 4500, "bad", "멈춤(정지)"), ("ok", 0, "ok", "정상"), ("ok", 4500, "bad", "지연(안 돎)"),
    ("ok", 2700, "ok", "정상"), ("ok", 2701, "bad", "지연(안 돎)"), ("ok", None, "bad", "지연(안 돎)")])
def test_job_verdict(spark, status, age, level, text):
    at = None if age is None else NOW - timedelta(seconds=age)
    df = spark.createDataFrame([(status, at)], "s string, t timestamp")
    assert tuple(df.select(views.job_verdict("s", "t", NOW).alias("v")).head()["v"]) == (level, text)


@pytest.mark.parametrize("age, rules, want", [
    (None, {}, (True, "empty")), (900, {}, (False, "ok")), (3600, {}, (True, "stale")),
    (2700, {}, (False, "ok")), (9 ** 6, {"market_data": True}, (False, "weekend-relaxed")),
    (None, {"market_data": True}, (True, "empty")),
    (23 * 86400, {"backfill_impossible": True, "ttl_days": 60}, (False, "ok")),
    (25 * 86400, {"backfill_impossible": True, "ttl_days": 60}, (True, "stale"))])
def test_overdue(spark, age, rules, want):
    saturday = NOW + timedelta(days=1)
    at = None if age is None else saturday - timedelta(seconds=age)
    df = spark.createDataFrame([(at,)], "t timestamp")
    assert tuple(df.select(views.overdue("t", saturday, **rules).alias("v")).head()["v"]) == want


def test_card_freshness(spark):
    rows = [("x", 300), ("x", 100), ("x", 200), ("y", 300), ("y", None), ("z", None)]
    df = spark.createDataFrame(
        [(c, None if s is None else NOW + timedelta(seconds=s)) for c, s in rows],
        "card string, last_fetched timestamp")
    got = {r["card"]: (r["last_fetched"], r["any_empty"]) for r in views.card_freshness(df).collect()}
    assert got == {"x": ((NOW + timedelta(seconds=100)).replace(tzinfo=None), False),
                   "y": (None, True), "z": (None, True)}


def test_board(spark, items):
    jobs = spark.createDataFrame(
        [("a", "Job A", 900), ("b", "Job B", 900)], "job string, label string, period_seconds int")
    health = spark.createDataFrame(
        [("a", "ok", ago(minutes=5), None, None, None, "rss=ok")], JOB_HEALTH)
    rows = {r["name"]: tuple(r)[2:] for r in views.job_rows(jobs, health, NOW).collect()}
    assert rows == {"Job A": ("ok", "rss=ok", "5분 전"), "Job B": ("bad", "미실행", "기록 없음")}
    fresh = views.card_row(items({"item_id": "i", "source": "CNBC", "title": "T" * 60}), NOW, label="n")
    assert tuple(fresh.head())[2:] == ("ok", "최근: CNBC · " + "T" * 44, "방금")
    empty = views.card_row(items(), NOW, label="n")
    assert tuple(empty.head())[2:] == ("bad", "수집된 데이터 없음", "없음")
    worst = views.worst_level(views.job_rows(jobs, health, NOW).unionByName(fresh))
    assert tuple(worst.head()) == ("bad", "점검이 필요합니다")
    assert tuple(views.worst_level(fresh).head()) == ("ok", "모두 정상")


def test_bodies(spark, items):
    selectors = spark.createDataFrame([("K", "article")], "source string, selector string")
    batch = items(*[{"item_id": f"k{n:02}", "source": "K", "url": f"u{n}", "body": "", "feed_id": "hot"}
                    for n in range(25)],
                  {"item_id": "o", "source": "other", "url": "u1", "body": ""},
                  {"item_id": "h", "source": "K", "url": "u1", "body": "has one"},
                  {"item_id": "late", "source": "K", "url": "missing", "body": "", "feed_id": "f2"})
    stored = items({"item_id": "k00"})
    targets = bodies.body_targets(batch, stored, selectors)
    assert sorted(r["item_id"] for r in targets.collect()) == [
        f"k{n:02}" for n in range(1, 25)] + ["late"]
    assert "Window" not in targets._jdf.queryExecution().executedPlan().toString()
    capped = bodies.body_targets(batch, stored, selectors, per_feed=10)
    assert sorted(r["item_id"] for r in capped.collect()) == [
        f"k{n:02}" for n in range(1, 11)] + ["late"]
    plan = capped._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any(line.endswith("Partial") for line in limits)  # top-k per task, then per feed
    pages = spark.createDataFrame(
        [(f"u{n}", NOW, 200 if n != 3 else 403, PAGE if n != 4 else "<article>짧음</article>")
         for n in range(25)] + [("u1", ago(days=1), 200, "<article>older</article>")], PAGE_PAYLOAD)
    out = bodies.enrich_bodies(batch, stored, selectors, pages)
    assert out.columns == batch.columns and out.count() == batch.count()
    text = {r["item_id"]: r["body"] for r in out.collect()}
    filled = {k for k, v in text.items() if v.startswith("본문 내용입니다.")}
    assert filled == {f"k{n:02}" for n in (1, 2, *range(5, 25))}
    assert text["h"] == "has one" and text["o"] == "" and text["late"] == ""
    rates = bodies.empty_body_rate(bodies.fetch_bodies(targets, pages))
    assert {r["feed_id"]: (r["targets"], r["empty"], r["alert"]) for r in rates.collect()} == {
        "hot": (24, 2, False), "f2": (1, 1, True)}


def test_body_targets_of_one_hot_url(spark, items):
    selectors = spark.createDataFrame([("K", "article")], "source string, selector string")
    batch = items(*[{"item_id": "hot", "source": "K", "body": "", "feed_id": f"f{n % 3}"}
                    for n in range(300)])
    targets = bodies.body_targets(batch, items(), selectors, per_feed=7)
    assert targets.groupBy("feed_id").agg(F.count("*").alias("n")).filter("n = 7").count() == 3
    assert bodies.body_targets(batch, items({"item_id": "hot"}), selectors).count() == 0
