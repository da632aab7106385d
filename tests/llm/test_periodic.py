import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from feedlake.llm import periodic
from tests.llm.conftest import ODD


def by_hand(words):
    """Runs by comparing all words on all lags; of one place the smallest lag."""
    out = {}
    for q in range(len(words) // 3, 0, -1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                out[i, j + q] = q
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def planted(words, doc_id):
    """The words with the tail that the rule repeats."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = [w for w in (text or "").translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    if doc_id is not None:
        words = planted(words, doc_id)
    found = by_hand(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (doc_id, len(found), *values, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def random_words(rng):
    alphabet, words = rng.choice([1, 2, 3, 30]), []
    while len(words) < rng.randrange(1, 220):
        if rng.random() < 0.4:
            period = [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(1, 25))]
            words += (period * rng.randrange(2, 9))[:rng.randrange(1, 130)]
        else:
            words.append(f"w{rng.randrange(alphabet)}")
    return words


def test_query_columns_against_brute_force(docs):
    rng = random.Random(1)
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(random_words(rng))) for i in range(400)]
    rows += [r[:2] for r in ODD if r[1] is None or len(r[1]) < 10_000] + [(50, "a b c " * 40), (50, "a b c " * 40)]
    found = periodic.scan(docs(*rows), repeat_tails=True).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(periodic.runs_text("runs"), 256), F.sha2("collapsed", 256))
    assert sorted(map(tuple, found.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)


def test_periods_of_every_size_and_edges():
    rng, cases = random.Random(2), []
    for q in [1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 100, 127, 128, 129, 200]:
        for extra in (-1, 0, 1):  # just too short, just long enough, longer
            for lead in (0, 3, q):
                period = [f"p{k}" for k in range(q)]
                n = max(24, 3 * q) + extra
                cases.append([f"l{rng.random()}" for _ in range(lead)] + (period * (n // q + 1))[:n] + ["end"] * (lead > 0))
    assert periodic.runs([[w.encode() for w in c] for c in cases]) == [by_hand(c) for c in cases]


def test_runs_inside_runs_and_grams_that_recur_sooner():
    rng = random.Random(3)
    block = {c: [f"{c}{k}" for k in range(40)] for c in "AB"}
    nested = sum((block[c] for c in "AAABABABBB" * 4), [])  # each gram recurs before the period is over
    inner = ((["x"] * 30 + ["y"]) * 5 + ["z"]) * 4
    noise = [rng.choice("ab") for _ in range(3000)]
    for words in (nested, inner, noise):
        assert periodic.runs([[w.encode() for w in words]]) == [by_hand(words)]


@pytest.mark.parametrize("words, n", [
    ([b"a"] * 400_000, 1), ([b"a", b"b"] * 200_000, 1), (([b"a"] * 500 + [b"b"]) * 400, 401),
    ([b"%d" % (bin(i).count("1") % 2) for i in range(1 << 15)], 0)])
def test_long_texts_of_few_words(words, n):
    assert len(periodic.runs([words])[0]) == n


def test_a_hash_that_agrees_by_chance_does_no_harm(monkeypatch):
    rng = random.Random(4)
    texts = [[w.encode() for w in random_words(rng)] for _ in range(150)]
    exact = periodic.runs(texts)
    monkeypatch.setattr(periodic, "hash", lambda w: len(w) if isinstance(w, bytes) else -w[1], raising=False)
    assert periodic.runs(texts) == exact


def test_documents_do_not_touch():
    words = [b"a"] * 12
    assert periodic.runs([words, words, [], [b"a"] * 24]) == [[], [], [], [(0, 24, 1)]]
    assert periodic.runs([]) == [] and periodic.runs([[]]) == [[]]


def test_odd_rows(odd, empty):
    rows = periodic.scan(odd).collect()
    assert len(rows) == odd.count()
    long = next(r for r in rows if r["doc_id"] == 5)
    assert long["n_runs"] == 1 and long["period"] == 5 and long["collapsed"] == "lorem ipsum dolor sit amet"
    assert periodic.scan(empty).collect() == []
