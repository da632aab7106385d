import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from feedlake.llm import components, simhash
from tests.llm.conftest import ODD


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [words[i:i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes_by_pairs(prints):
    """Smallest index reachable by steps of at most two bits."""
    own = list(range(len(prints)))
    array = np.array(prints, np.uint64)

    def find(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1:] ^ array[i]) <= 2).tolist():
            a, b = find(i), find(i + 1 + j)
            own[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    texts = [t for _, t, *_ in ODD if t != ODD[6][1]] + ["a b", "A b C", "É é\x1cx y", "x " * 50_000]
    for text in texts:
        assert simhash.fingerprint_of(text or "") % 2 ** 64 == plain_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def test_links_lose_no_pair_and_add_none(spark):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(20)] + [0, 2 ** 64 - 1, 0x1111111111111111]
    prints = set(centres)
    for c in centres:
        for _ in range(25):
            prints.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    prints = sorted(prints)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    got = {frozenset((r["a"] % 2 ** 64, r["b"] % 2 ** 64)) for r in simhash.links(df).collect()}
    want = {frozenset((a, b)) for i, a in enumerate(prints) for b in prints[i + 1:]
            if bin(a ^ b).count("1") <= 2}
    assert got == want


def test_points_are_not_broadcast_however_few_the_fingerprints_seem(spark, tmp_path):
    spark.range(50).select(F.col("id").alias("fingerprint")).write.parquet(str(tmp_path / "prints"))
    found = simhash.links(spark.read.parquet(str(tmp_path / "prints")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {(0, 1), (0, 3), (16, 48)} < {(r["a"], r["b"]) for r in found.collect()}
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(2)
    order = rng.sample(range(300), 300)
    pairs = list(zip(order, order[1:])) + [(1000, 1001 + i) for i in range(50)] + [(2000, 2000), (2001, 2000)]
    df = spark.createDataFrame(pairs + pairs + [(None, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(300)}, **{i: 1000 for i in range(1000, 1051)}, 2000: 2000, 2001: 2000}
    assert components.components(df.limit(0)).collect() == []


def test_classes(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    want = [(r["doc_id"], f"{p:016x}", rows[k]["doc_id"]) for r, p, k in zip(rows, prints, classes_by_pairs(prints))]
    from feedlake.llm.queries import op8_simhash_classes
    got = op8_simhash_classes(spark, folder).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_odd_rows(odd, docs, empty):
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.classes(odd).collect()}
    assert {(1, 0, 1), (2, 0, 1), (3, 0, 1)} < got
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 4, 5, 6, 7]
    assert simhash.classes(empty).collect() == [] and simhash.one_of_each(empty).collect() == []
    alone = simhash.classes(docs((None, "x y z"), (None, "x y z"))).collect()
    assert [r["component_id"] for r in alone] == [None, None]
