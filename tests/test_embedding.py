"""Queue, outcomes and vector store of the embedding step."""

import sys
from datetime import timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tests.values import NOW
from feedlake.operators import embedding as emb
from feedlake.operators import items as ops
from feedlake.operators.embedding import ServiceRefused
from feedlake.schemas import ITEM, VECTOR


def naive(t):
    return t.replace(tzinfo=None)


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Scripted:
    """Answers by words in the text."""

    def __call__(self, text):
        if "transient" in text:
            raise TimeoutError("slow ?key=SECRET-1&x")
        if "refused" in text:
            raise ServiceRefused("bad key=SECRET-2 input", code=400)
        if "denied" in text:
            raise ServiceRefused("who?", code=401)
        if "short" in text:
            return [0.1] * 10
        return [0.5] * 768


LISTS = emb.one_by_one(Scripted)


@pytest.fixture
def stories(items):
    def make(*titles, **more):
        return ops.as_item(ops.stamp(items(*[
            {"item_id": f"i{n}", "title": t, "body": "b", **more} for n, t in enumerate(titles)])))

    return make


def test_queue(stories):
    queue = emb.pending_queue(stories("a", "Class action", "b", "c"), cap=2)
    assert queue.columns == ["item_id", "title", "body", "expire_at"]
    assert [r["item_id"] for r in queue.collect()] == ["i0", "i2"]
    assert emb.pending_queue(stories("a", "b", "c"), cap=None).count() == 3


def test_outcomes(stories):
    queue = emb.pending_queue(stories("good", "transient", "refused", ""))
    queue = queue.withColumn("body", F.when(F.col("title") != "", F.col("body")))
    got = {r["item_id"]: r for r in emb.embed_outcomes(
        queue, LISTS, concurrency=4, per_call=1, partitions=2).collect()}
    assert {k: r["outcome"] for k, r in got.items()} == {
        "i0": "ok", "i1": "retryable", "i2": "permanent", "i3": "permanent"}
    assert len(got["i0"]["vector"]) == 768 and got["i1"]["vector"] is None
    assert got["i1"]["reason"] == "slow ?key=[redacted]&x"
    assert got["i2"]["reason"] == "bad key=[redacted] input"
    assert got["i3"]["reason"] == "nothing to embed"


@pytest.mark.parametrize("title, reason", [
    ("denied", "who"), ("short", "10 numbers, 768 expected")])
def test_setup_faults_abort(stories, title, reason):
    outcomes = emb.embed_outcomes(emb.pending_queue(stories("good", title)), LISTS)
    with pytest.raises(emb.SetupFault, match=reason):
        emb.raise_if_fatal(outcomes)


class Counting:
    """Writes down every text that it is sent."""

    def __init__(self, path):
        self.path = path

    def __call__(self, texts):
        with open(self.path, "a") as log:
            log.writelines(f"{t}\n" for t in texts)
        for text in texts:
            yield ServiceRefused("who?", code=403) if "denied" in text else [0.5] * 768


def test_each_text_is_sent_once(stories, tmp_path):
    path = str(tmp_path / "sent")
    queue = emb.pending_queue(stories(*[f"title {n}" for n in range(40)])).coalesce(2)
    assert emb.embed_outcomes(queue, lambda: Counting(path), per_call=7).filter("outcome = 'ok'").count() == 40
    sent = open(path).read().split("\n")[:-1]
    assert len(sent) == len(set(sent)) == 40


def test_nothing_is_sent_after_a_fatal_answer(stories, tmp_path):
    path = str(tmp_path / "sent")
    queue = emb.pending_queue(stories("denied", *[f"title {n}" for n in range(60)])).coalesce(1).sort("item_id")
    got = emb.embed_outcomes(queue, lambda: Counting(path), per_call=5).collect()
    outcomes = [r["outcome"] for r in got]
    assert len(got) == 61 and outcomes.count("fatal") == 1
    assert [r["reason"] for r in got].count("not sent") == outcomes.count("retryable") == 60
    assert len(open(path).read().split("\n")[:-1]) == 5  # the first list alone


def test_a_call_that_fails_whole_may_be_retried(stories):
    def broken(texts):
        raise TimeoutError("slow ?key=SECRET-1&x")

    got = emb.embed_outcomes(emb.pending_queue(stories("a", "b")), lambda: broken).collect()
    assert {(r["outcome"], r["reason"]) for r in got} == {("retryable", "slow ?key=[redacted]&x")}


def test_embedding_input_is_cut(spark, items):
    queue = emb.pending_queue(ops.stamp(items({"item_id": "a", "title": "T", "body": "x" * 900})))
    seen = emb.embed_outcomes(
        queue, lambda: (lambda texts: [[float(len(t))] for t in texts]), dim=1).head()
    assert seen["vector"] == [502.0]


def test_save_vectors(stories, spark):
    held = stories("m", "k")
    queue = emb.pending_queue(held)
    entries = emb.vector_entries(emb.embed_outcomes(queue, LISTS), queue)
    saved = emb.vectors_to_save(entries, held.filter("item_id = 'i1'"), NOW)
    row = saved.collect()
    assert len(row) == 1 and row[0]["item_id"] == "i1"
    assert (row[0]["embed_model"], row[0]["embed_task_type"]) == (
        "gemini-embedding-001", "RETRIEVAL_DOCUMENT")
    assert row[0]["embedded_at"] == naive(NOW)
    assert row[0]["expire_at"] == naive(NOW + timedelta(days=365))
    old = spark.createDataFrame([("i1", [1.0], "old", None, NOW, NOW),
                                 ("z", [1.0], "old", None, NOW, NOW)], VECTOR)
    table = emb.upsert_vectors(old, saved)
    assert {r["item_id"]: r["embed_model"] for r in table.collect()} == {
        "i1": "gemini-embedding-001", "z": "old"}
    again = emb.upsert_vectors(table, saved)
    assert sorted(map(str, again.collect())) == sorted(map(str, table.collect()))


def test_flags(stories, spark):
    held = stories("a", "b")
    ids = spark.createDataFrame([("i0",), ("unknown",), ("i0",)], "item_id string")
    cleared = emb.set_pending(held, ids, False)
    assert cleared.columns == held.columns
    assert {r["item_id"]: r["embed_pending"] for r in cleared.collect()} == {
        "i0": None, "i1": True}
    assert emb.set_pending(cleared, ids, True).filter("embed_pending").count() == 2


def legacy(spark, item_id, kind="story", life=timedelta(days=20), pending=None):
    return (item_id, "f", "S", "", "en", "", "t", "b", "", None, NOW, kind,
            None if life is None else NOW + life, pending)


def test_unembedded(spark):
    items = spark.createDataFrame([
        legacy(spark, "take"), legacy(spark, "spam", kind="spam"), legacy(spark, "current"),
        legacy(spark, "dying", life=timedelta(days=1)), legacy(spark, "edge", life=timedelta(days=2)),
        legacy(spark, "queued", pending=True), legacy(spark, "endless", life=None),
        legacy(spark, "stale type"), legacy(spark, "no type"), legacy(spark, "stale model")], ITEM)
    model, task = "gemini-embedding-001", "RETRIEVAL_DOCUMENT"
    vectors = spark.createDataFrame([
        ("current", [0.1], model, task, NOW, NOW), ("stale type", [0.1], model, "OLD", NOW, NOW),
        ("no type", [0.1], model, None, NOW, NOW), ("stale model", [0.1], "m", task, NOW, NOW)],
        VECTOR)
    ids = emb.unembedded(items, vectors, NOW)
    assert sorted(r["item_id"] for r in ids.collect()) == [
        "edge", "no type", "stale model", "stale type", "take"]
    assert emb.unembedded(emb.set_pending(items, ids, True), vectors, NOW).count() == 0


def test_audit(spark):
    vectors = spark.createDataFrame([
        ("a", [0.6] + [0.0] * 767, "gemini-embedding-001", "RETRIEVAL_DOCUMENT", NOW, NOW),
        ("b", [0.3, 0.4], "gemini-embedding-001", "CLUSTERING", NOW + timedelta(hours=1), NOW),
        ("c", None, None, None, NOW + timedelta(hours=1), NOW)], VECTOR)
    row = emb.vector_audit(vectors).head()
    assert (row["vectors"], row["wrong_dim"], row["stale"]) == (3, 2, 2)
    assert round(row["min_norm"], 6) == 0.5 and round(row["max_norm"], 6) == 0.6
    assert emb.reembedding_complete(vectors, NOW).head()["complete"] is True
    late = emb.reembedding_complete(vectors, NOW + timedelta(minutes=1)).head()
    assert late["complete"] is False
