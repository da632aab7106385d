"""Filters of stored keys: an insert reads few days, and finds what reading all days finds."""

from datetime import timedelta

import numpy as np
from pyspark.sql import functions as F

from feedlake.operators import items as ops
from feedlake.sources import keys, store
from tests.values import NOW


def articles(items, days, each, start=0):
    return items(*[{"item_id": f"k{d}-{n}", "title": f"t{d}", "fetched_at": NOW + timedelta(days=d)}
                   for d in range(start, start + days) for n in range(each)])


def stored(spark, root, items, days, each):
    keys.append_items(spark, root, ops.as_item(ops.stamp(articles(items, days, each))))


def test_a_small_insert_opens_the_days_that_hold_its_keys(spark, root, items):
    stored(spark, root, items, 120, 20)
    rows = [{"item_id": f"new{n}", "title": "x", "fetched_at": NOW + timedelta(days=200)} for n in range(1000)]
    known = [{"item_id": "k7-3", "title": "x"}, {"item_id": "k90-19", "title": "x"}]
    batch = items(*rows, *known)
    some = keys.days_that_may_hold(spark, root, batch)
    days = {r["day"] for r in some.select("day").distinct().collect()}
    assert {(NOW + timedelta(days=d)).date() for d in (7, 90)} <= days and len(days) <= 4
    whole = store.read(spark, root, "items")
    files = [df.select(F.input_file_name()).distinct().count() for df in (some, whole)]
    assert files[0] <= 4 and files[1] >= 120
    plan = some.select("item_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    fresh = ops.insert_rescanned(batch, some).select("item_id").collect()
    assert sorted(fresh) == sorted(ops.insert_rescanned(batch, whole).select("item_id").collect())
    assert len(fresh) == 1000


def test_days_without_filters_are_read(spark, root, items):
    store.append(root, "items", ops.as_item(ops.stamp(articles(items, 3, 2))))  # from before the filters
    stored_later = ops.as_item(ops.stamp(articles(items, 3, 2, start=10)))
    keys.append_items(spark, root, stored_later)
    found = keys.days_that_may_hold(spark, root, items({"item_id": "k1-1"}))
    assert found.filter("item_id = 'k1-1'").count() == 1 and found.select("day").distinct().count() == 3
    keys.rebuild(spark, root)
    found = keys.days_that_may_hold(spark, root, items({"item_id": "k1-1"}))
    assert found.filter("item_id = 'k1-1'").count() == 1 and found.select("day").distinct().count() == 1


def test_a_large_batch_and_an_empty_store(spark, root, items, monkeypatch):
    assert keys.days_that_may_hold(spark, root, items({"item_id": "a"})).collect() == []
    stored(spark, root, items, 5, 2)
    monkeypatch.setattr(keys, "ASKED_KEYS", 3)
    assert keys.days_that_may_hold(spark, root, articles(items, 2, 2)).count() == 10
    assert keys.days_that_may_hold(spark, root, items({"item_id": "k0-0"})).count() == 2


def test_filters_have_no_false_negative_and_few_false_positives():
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(-1 << 62, 1 << 62, (2, 5000))
    bits = keys._filter(h1, h2)
    assert all(keys._may_hold(bits, h1[k:k + 1], h2[k:k + 1]) for k in range(5000))
    o1, o2 = rng.integers(-1 << 62, 1 << 62, (2, 20000))
    assert sum(keys._may_hold(bits, o1[k:k + 1], o2[k:k + 1]) for k in range(20000)) <= 2
