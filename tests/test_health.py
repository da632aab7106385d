"""Folds of poll and run logs, and the verdicts of a run."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.values import NOW
from feedlake.operators import health
from feedlake.schemas import FEED_STATE, JOB_HEALTH, POLL_LOG, RUN_LOG


def naive(t):
    return t.replace(tzinfo=None)


@pytest.fixture
def polls(spark):
    def make(*rows):
        """(feed, minute, status[, extras]) in any order."""
        data = []
        for seq, (feed, minute, status, *more) in enumerate(rows):
            extra = more[0] if more else {}
            at = NOW + timedelta(minutes=minute)
            data.append((extra.get("family", "rss"), feed, at, seq, status,
                         extra.get("is_feed", True), extra.get("etag"), extra.get("lm"),
                         extra.get("new"), extra.get("error")))
        return spark.createDataFrame(data, POLL_LOG)

    return make


def states(df):
    return {r["feed_id"]: r for r in df.collect()}


def test_streak(polls):
    log = [("f", 0, 200), ("f", 1, 500), ("f", 2, 500), ("f", 3, 200)]
    for n, streak in enumerate([0, 1, 2, 0]):
        state = states(health.fold_feed_state(polls(*log[:n + 1])))["f"]
        assert state["consecutive_failures"] == streak
    assert state["last_error"] is None and state["last_error_at"] is None


def test_cursor_rules(polls):
    state = states(health.fold_feed_state(polls(
        ("keeps", 0, 200, {"etag": "e1", "lm": "m1"}), ("keeps", 1, 304, {"etag": "no"}),
        ("keeps", 2, 500, {"etag": "no"}),
        ("clears", 0, 200, {"etag": "e1"}), ("clears", 1, 200),
        ("blocked", 0, 200, {"etag": "no", "is_feed": False}),
        ("never", 0, -1, {"error": "x" * 400}),
        ("cut", 0, 200, {"error": "truncated at page cap"}),
    )))
    keeps = state["keeps"]
    assert (keeps["etag"], keeps["last_modified"]) == ("e1", "m1")
    assert keeps["last_fetched"] == naive(NOW + timedelta(minutes=1))
    assert (keeps["last_error"], keeps["last_error_at"]) == (
        "HTTP 500", naive(NOW + timedelta(minutes=2)))
    assert state["clears"]["etag"] is None
    blocked = state["blocked"]
    assert blocked["etag"] is None and blocked["last_fetched"] is None
    assert blocked["consecutive_failures"] == 1
    assert blocked["last_error"] == "not a parseable feed"
    assert state["never"]["last_error"] == "x" * 300
    assert state["cut"]["consecutive_failures"] == 0
    assert state["cut"]["last_error"] == "truncated at page cap"
    assert state["cut"]["last_success"] == naive(NOW)


def fold_by_hand(rows):
    """One feed at a time, row by row, in order of time."""
    state = {}
    for feed, at, seq, status, is_feed, etag in sorted(rows, key=lambda r: (r[1], r[2])):
        s = state.setdefault(feed, dict(etag=None, ok=None, n=0, err=None, err_at=None))
        if status == 304 or (status == 200 and is_feed):
            s.update(ok=at, n=0, err=None, err_at=None)
            if status == 200:
                s["etag"] = etag
        else:
            s.update(n=s["n"] + 1, err_at=at,
                     err="not a parseable feed" if status == 200 else f"HTTP {status}")
    return {f: (s["etag"], s["ok"], s["n"], s["err"], s["err_at"]) for f, s in state.items()}


@pytest.mark.parametrize("seed", [1, 32, 63])
def test_fold_equals_row_by_row(spark, seed):
    rng = random.Random(seed)
    rows = []
    for seq in range(4000):
        feed = "hot" if rng.random() < 0.4 else f"f{rng.randrange(60)}"
        rows.append((feed, naive(NOW + timedelta(minutes=rng.randrange(500))), seq,
                     rng.choice([200, 200, 304, 500, 503, 404, 500, 500]), rng.random() < 0.9,
                     rng.choice([None, "a", "b"])))
    rows += [("dead", naive(NOW + timedelta(minutes=i)), 9000 + i, 500, True, None)
             for i in range(300)]
    rng.shuffle(rows)
    df = spark.createDataFrame(
        [("rss", f, at, seq, st, ok, etag, None, 0, None) for f, at, seq, st, ok, etag in rows],
        POLL_LOG).repartition(6)

    def got(state):
        return {r["feed_id"]: (r["etag"], r["last_success"], r["consecutive_failures"],
                               r["last_error"], r["last_error_at"]) for r in state.collect()}

    assert got(health.fold_feed_state(df)) == fold_by_hand(rows)
    middle = F.lit(naive(NOW + timedelta(minutes=250)))
    prior = health.fold_feed_state(df.filter(F.col("ts") < middle))
    both = health.fold_feed_state(df.filter(F.col("ts") >= middle), prior)
    assert got(both) == fold_by_hand(rows)


def test_no_task_lists_the_polls_of_a_feed(polls):
    plan = health.fold_feed_state(polls(("f", 0, 500)))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan


def test_a_third_of_the_log_is_one_hour_of_one_feed(spark):
    n = F.col("id")
    log = spark.range(0, 90_000, 1, 8).select(
        F.lit("rss").alias("family"), F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), n % 500)).alias("feed_id"),
        F.timestamp_seconds(F.lit(1_780_000_000) + F.when(n % 3 == 0, n / 100 % 60).otherwise(n * 10)).alias("ts"),
        n.alias("seq"), F.when(n == 60_003, 200).otherwise(500).alias("status"), F.lit(True).alias("is_feed"),
        *[F.lit(None).cast(k).alias(c) for c, k in (("etag", "string"), ("last_modified", "string"),
                                                    ("new_count", "long"), ("error", "string"))])
    hot = log.filter("feed_id = 'hot'").selectExpr("ts", "seq", "status").collect()
    last = max((r["ts"], r["seq"]) for r in hot if r["status"] == 200)
    state = states(health.fold_feed_state(log))
    assert state["hot"]["consecutive_failures"] == sum((r["ts"], r["seq"]) > last for r in hot) > 0


def test_polls_that_a_state_holds_already_change_nothing(polls):
    log = polls(("f", 0, 200), ("f", 1, 500), ("f", 2, 500), ("g", 0, 500), ("h", 3, 304))
    state = health.fold_feed_state(log)
    again = health.fold_feed_state(health.later_polls(log, state), state)
    assert sorted(map(str, again.collect())) == sorted(map(str, state.collect()))


def test_streaks_by_run_are_those_of_a_fold_up_to_the_run(spark):
    rng = random.Random(3)
    rows = [("rss", f"f{rng.randrange(4)}", naive(NOW + timedelta(hours=rng.randrange(200))), seq,
             rng.choice([200, 500, 500, 304]), True, None, None, 0, None) for seq in range(300)]
    polls = spark.createDataFrame(rows, POLL_LOG).withColumn("run", F.to_date("ts"))
    got = {}
    for r in health.streaks_by_run(polls, "run").collect():
        got.setdefault(r["run"], {})[r["feed_id"]] = r["consecutive_failures"]
    for run, streaks in got.items():
        whole = states(health.fold_feed_state(polls.filter(F.col("run") <= run)))
        assert streaks == {f: whole[f]["consecutive_failures"] for f in streaks}


def test_prior_without_new_polls(spark, polls):
    prior = health.fold_feed_state(polls(("f", 0, 200, {"etag": "e"}), ("g", 0, 500)))
    state = states(health.fold_feed_state(polls(("g", 1, 500)), prior))
    assert state["f"]["etag"] == "e" and state["g"]["consecutive_failures"] == 2
    assert [f.name for f in health.fold_feed_state(polls(("g", 1, 500)), prior).schema] == [
        f.name for f in FEED_STATE]


def test_update_state(spark):
    now = spark.createDataFrame([("f", "e", "m", "x")], "feed_id string, etag string, lm string, z string")
    change = spark.createDataFrame(
        [("f", None, True, "m2", False), ("n", "e9", True, None, False)],
        "feed_id string, etag string, etag_given boolean, lm string, lm_given boolean")
    out = health.update_state(now, change, {"etag": "etag_given", "lm": "lm_given"},
                              key="feed_id", fields=["etag", "lm"])
    assert {tuple(r) for r in out.collect()} == {("f", None, "m"), ("n", "e9", None)}


def test_job_health(spark):
    def at(m):
        return NOW + timedelta(minutes=m)

    runs = spark.createDataFrame([
        ("done", at(0), 0, "start", None, None), ("done", at(1), 1, "ok", " rss=ok ", None),
        ("killed", at(0), 0, "start", None, None), ("killed", at(1), 1, "ok", "fine", None),
        ("killed", at(2), 2, "start", None, None),
        ("failed", at(0), 0, "start", None, None), ("failed", at(1), 1, "fail", "rss=fail", "boom"),
    ], RUN_LOG)
    folded = health.fold_job_health(runs)
    got = {r["job"]: r for r in folded.collect()}
    assert [f.name for f in folded.schema] == [f.name for f in JOB_HEALTH]
    assert (got["done"]["last_status"], got["done"]["detail"]) == ("ok", "rss=ok")
    assert got["done"]["last_success_at"] == got["done"]["fetched_at"] == naive(at(1))
    killed = got["killed"]
    assert (killed["last_status"], killed["detail"]) == ("running", "fine")
    assert killed["last_run_at"] == killed["fetched_at"] == naive(at(2))
    failed = got["failed"]
    assert failed["detail"] == "rss=fail | ERROR: boom" and failed["last_success_at"] is None
    assert failed["last_finished_at"] == naive(at(1))
    first = health.fold_job_health(runs.filter("seq = 0"))
    later = health.fold_job_health(runs.filter("seq > 0"), first)
    assert sorted(map(tuple, later.collect())) == sorted(map(tuple, folded.collect()))


def test_pass_summary_and_failure_split(polls, spark):
    summary = health.pass_summary(polls(
        ("ok1", 0, 200, {"new": 3}), ("same", 0, 304), ("f1", 0, 500), ("f2", 0, 500)))
    assert {r["feed_id"]: r["outcome"] for r in summary.collect()} == {
        "ok1": 3, "same": 0, "f1": -1, "f2": -1}
    state = health.fold_feed_state(polls(*[("f1", m, 500) for m in range(5)], ("f2", 0, 500)))
    split = health.classify_failures(summary, state)
    assert {r["feed_id"]: r["failure"] for r in split.collect()} == {"f1": "chronic", "f2": "new"}
    assert health.classify_failures(summary, state.limit(0)).filter("failure = 'new'").count() == 2


def verdict(spark, polls, *rows, state_rows=()):
    summary = health.pass_summary(polls(*rows))
    state = health.fold_feed_state(polls(*(state_rows or rows)))
    df = health.family_verdicts(spark, summary, state)
    return df, {r["family"]: (r["piece"], r["degraded"]) for r in df.collect()}


def many(family, n, failed):
    return [(f"{family}{i}", 0, 500 if i < failed else 200, {"family": family}) for i in range(n)]


def test_family_verdicts(spark, polls):
    _, got = verdict(spark, polls, *many("rss", 10, 5), *many("naver", 10, 4), *many("fmp", 6, 6))
    assert got == {"rss": ("rss=fail(5/10)", True), "naver": ("naver=ok", False),
                   "fmp": ("fmp=fail(6/6)", True)}
    _, got = verdict(spark, polls, *many("fmp", 6, 3))
    assert got["fmp"] == ("fmp=ok", False) and got["rss"] == ("rss=ok", False)


def test_chronic_failures_leave_the_base(spark, polls):
    rows = many("rss", 10, 5)
    history = [(f, m, 500) for f, *_ in rows[:5] for m in range(5)]
    _, got = verdict(spark, polls, *rows, state_rows=history)
    assert got["rss"] == ("rss=ok", False)
    _, got = verdict(spark, polls, *many("fmp", 2, 2),
                     state_rows=[(f"fmp{i}", m, 500) for i in range(2) for m in range(5)])
    assert got["fmp"] == ("fmp=ok", False)


@pytest.mark.parametrize("flag, args, piece", [
    (True, {"has_key": True}, "embed=ok"),
    (True, {"has_key": False}, "embed=fail(no_key)"),
    (None, {"has_key": False}, "embed=skip(no_key_no_pending)"),
    (None, {"has_key": True, "failed": True}, "embed=fail"),
])
def test_embed_verdict(spark, flag, args, piece):
    items = spark.createDataFrame([("a", flag)], "item_id string, embed_pending boolean")
    row = health.embed_verdict(items, **args).head()
    assert (row["piece"], row["degraded"]) == (piece, piece.startswith("embed=fail"))


def test_run_verdict(spark, polls):
    verdicts, _ = verdict(spark, polls, *many("rss", 10, 5))
    items = spark.createDataFrame([], "item_id string, embed_pending boolean")
    embed = health.embed_verdict(items, has_key=True)
    row = health.run_verdict(health.mark_errors(verdicts, {"naver": "deadline"}), embed).head()
    assert tuple(row) == ("rss=fail(5/10) naver=deadline fmp=ok embed=ok", True)
    fine, _ = verdict(spark, polls, *many("rss", 10, 0))
    assert tuple(health.run_verdict(fine, embed).head()) == (
        "rss=ok naver=ok fmp=ok embed=ok", False)
