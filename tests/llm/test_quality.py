import zlib

import numpy as np
import pytest

from feedlake.llm import quality


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    rows = rng.normal(0, 1, (3000, 5))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 3] * rows[:, 1] > 0.2)).astype(float)
    forest = quality.fit(rows, labels)
    odds = np.full(50, forest.start)
    for i, row in enumerate(rows[:50]):
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf):
            node = 0
            while node < len(feature):
                right = np.searchsorted(forest.edges[feature[node]], row[feature[node]]) > cut[node]
                node = 2 * node + 1 + int(right)
            odds[i] += leaf[node - len(feature)]
    assert np.allclose(forest.score(rows[:50]), 1 / (1 + np.exp(-odds)))
    assert ((forest.score(rows) > 0.5) == labels).mean() > 0.95


def test_one_class_and_no_rows():
    rows = np.ones((4, 2))
    assert quality.fit(rows, np.ones(4)).score(rows).min() > 0.8
    none = quality.fit(np.empty((0, 2)), np.empty(0))
    assert none.score(rows).tolist() == [0.5] * 4


@pytest.fixture(scope="module")
def held(spark):
    from feedlake.llm.queries import op10_quality_trees
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op10_quality_trees(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    return [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]


def test_held_out_accuracy(held):
    assert len(held) > 500
    assert sum(a == b for a, b in held) / len(held) > 0.97


def labels_of(spark, *rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, features string")


def test_odd_rows(spark, odd, empty, docs):
    labels = labels_of(spark, (4, 1, 0, "x", "x"), (5, 0, 0, "x", "x"), (5, None, 0, "x", "x"), (None, 1, 0, "x", "x"),
                       (4, 1, 0, "x", "x"))
    out = quality.score(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] == 4}) == 1
    assert [r["held_out"] for r in out if r["doc_id"] is None] == [False]
    assert {r["score"] for r in quality.score(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.score(empty, labels).collect() == []


def test_held_out_labels_teach_nothing(spark, docs):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    df = docs(*[(i, "a b c") for i in ids])
    labels = labels_of(spark, *[(i, 0, 0, "x", "x") for i in ids])
    assert {r["score"] for r in quality.score(df, labels).collect()} == {0.5}


def test_each_id_teaches_once(spark):
    rows = spark.createDataFrame([(i % 50, [float(i)]) for i in range(400)] + [(7, [-1.0])] * 300,
                                 "doc_id long, features array<double>")
    labels = spark.createDataFrame([(i, q) for i in range(50) for q in (1, 0)] * 3, "doc_id long, quality int")
    got = quality.sample(rows, labels, 10).collect()
    again = quality.sample(rows.repartition(5), labels.repartition(3), 10).collect()
    assert got == again and len({r["doc_id"] for r in got}) == len(got) == 10
    everyone = quality.sample(rows, labels, 1000).collect()
    assert sorted(r["doc_id"] for r in everyone) == [i for i in range(50) if zlib.crc32(str(i).encode()) % 5]
    assert all(r["features"] == [-1.0 if r["doc_id"] == 7 else float(r["doc_id"])] and r["quality"] == 0 for r in everyone)
