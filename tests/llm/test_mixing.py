from collections import defaultdict

from feedlake.llm import mixing


def waterfill(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing out again and again, as the rule says."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in stopped else share[s] for s in names}
        stopped |= over


def test_targets_are_the_fixed_point(docs):
    cases = [{"a": 500, None: 200}, {"a": 500, "b": 200, "c": 100, None: 500}, {"a": 1000, "b": 10, "c": 500}, {"a": 1, "b": 1, "c": 1, "d": 5000, None: 7}, {"x": 5},
             {"a": 0, "b": 3}, {"a": 0}, {"a": 10, "b": 100, "c": 1000, "d": 9, "e": 90, "f": 900, "g": 3}]
    for sizes in cases:
        df = docs(*[(i, "w " * n, "en", s) for i, (s, n) in enumerate(sizes.items())])
        got = {r["doc_id"]: r["target"] for r in mixing.plan(df).collect()}
        for (s, want), place in zip(waterfill(sizes).items(), range(len(sizes))):
            i = list(sizes).index(s)
            assert abs(got[i] - want) < 1e-6, (sizes, s)


def test_taken_words_come_near_the_targets(docs):
    rows = [(i, "w " * (1 + i % 40), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(6000)]
    taken, target = defaultdict(int), {}
    sizes = {r[0]: (r[3], len(r[1]) // 2) for r in rows}
    for r in mixing.plan(docs(*rows)).collect():
        source, size = sizes[r["doc_id"]]
        assert r["size"] == size and r["copies"] <= 3
        taken[source] += r["copies"] * r["size"]
        target[source] = r["target"]
    for source in target:
        assert abs(taken[source] - target[source]) < 0.15 * target[source] + 40


def test_runs_agree_and_emit_follows_the_plan(docs):
    rows = [(i, f"text number {i}", "en", f"s{i % 4}") for i in range(200)]
    df = docs(*rows)
    plan = {r["doc_id"]: r["copies"] for r in mixing.plan(df).collect()}
    assert plan == {r["doc_id"]: r["copies"] for r in mixing.plan(df.repartition(3)).collect()}
    out = mixing.emit(df)
    assert out.columns == df.columns
    emitted = defaultdict(int)
    for r in out.collect():
        assert r["text"] == f"text number {r['doc_id']}" and r["copies"] == 7  # the extra column
        emitted[r["doc_id"]] += 1
    assert emitted == {i: n for i, n in plan.items() if n}


def test_odd_rows(odd, empty):
    rows = mixing.plan(odd).collect()
    assert len(rows) == odd.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    assert [by_id[i][0]["size"] for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 3, 100_000]
    assert by_id[4][0] == by_id[4][1]  # repeated rows get the same
    assert mixing.plan(empty).collect() == [] and mixing.emit(empty).collect() == []
