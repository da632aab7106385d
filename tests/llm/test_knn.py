import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import knn


def brute(rows, k, is_query):
    """query_id -> [(vec_id, score)] by Python integers; rows of the query's own id are left out."""
    whole = {}
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, v in usable:
        if is_query(q) and v >= whole.get(q, v):
            whole[q] = v
            scores = [(sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q]
            out[q] = [(i, s) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
    return out


def search(spark, rows, k=5, every=3, n_pivots=8, monkeypatch=None):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumn("id", F.lit("clash")).withColumn("cell", F.lit("clash"))
    found = knn.top_k(df, F.col("id") % every == 0, k, n_pivots=n_pivots).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.fixture
def small(monkeypatch):
    """Blocks, tiles and groups so small that there are many."""
    monkeypatch.setattr(knn, "BLOCK_ROWS", 7)
    monkeypatch.setattr(knn, "TILE_QUERIES", 10)
    monkeypatch.setattr(knn, "GROUP_ROWS", 40)


def clustered(n, seed, width=6):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 20, (5, width))
    return [(i, (middles[rng.integers(5)] + rng.normal(0, 0.3, width)).tolist()) for i in range(n)]


def test_clusters(spark, small):
    rows = clustered(300, 1)
    assert search(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)


def test_bounds_leave_out_cells(spark, small, monkeypatch):
    spared = []
    exact = knn.needed_cells
    monkeypatch.setattr(knn, "needed_cells", lambda p, q, d, k: spared.append(
        (len(q) * len(d), out := exact(p, q, d, k))) or out)
    rows = clustered(400, 2)
    assert search(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)
    whole, needed = spared[0]
    assert sum(map(len, needed.values())) < whole


def test_ties_and_one_common_vector(spark, small):
    rows = [(i, [0.5, -0.25]) for i in range(100, 40, -1)] + [(i, [i / 10, 1.0]) for i in range(30)]
    assert search(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [float("inf"), 0.0]),
            (None, [1.0, 1.0]), (6, []), (9, [1.5]), (10, [-0.01, 0.01]), (12, [1e6, -1e6]), (5, [3.0, 4.0, 5.0])]
    assert search(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)


def test_long_scores_are_exact(spark):
    rows = [(i, [3e7 + i, 1e7 - i, i + 0.5]) for i in range(12)]
    assert search(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)


def test_repeated_rows(spark):
    rows = [(1, [1.0]), (1, [1.0]), (3, [2.0]), (3, [2.0]), (4, [0.5])]
    assert search(spark, rows) == {3: [(1, 8192), (1, 8192), (4, 4096)]}


def test_no_rows_and_no_queries(spark):
    assert search(spark, []) == {}
    assert search(spark, [(1, [1.0]), (2, [1.0])]) == {}
    assert search(spark, [(3, [1.0])]) == {}


def test_query(spark):
    from feedlake.llm.queries import op4_voronoi_knn
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = {}
    for r in op4_voronoi_knn(spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == brute(rows, 20, lambda i: i % 20 == 0)
