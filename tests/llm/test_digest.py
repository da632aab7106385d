import hashlib
from collections import Counter

import numpy as np

from feedlake.llm import digest
from tests.llm.conftest import ODD


def plain_votes(text, ranks):
    """Votes by the definition: one run of windows after another."""
    def entropy(window):
        terms = sum(round(c * np.log2(c) * digest._UNIT) for c in Counter(window).values())
        return int(1000.0 - terms * (1000.0 / round(64 * 6 * digest._UNIT)))

    rank = [int(ranks[entropy(text[i:i + 64])]) for i in range(len(text) - 63)]
    votes = [0] * len(rank)
    for start in range(max(1, len(rank) - 63) if rank else 0):
        run = [(r, i) for i, r in enumerate(rank[start:start + 64], start) if r != int(digest.NEVER)]
        if run:
            votes[min(run)[1]] += 1
    return votes


def texts(n, size, seed):
    rng = np.random.default_rng(seed)
    return [bytes(rng.integers(97, 117, size).astype(np.uint8)) for _ in range(n)]


def test_votes(monkeypatch):
    some = texts(3, 700, 1) + texts(2, 100, 2) + [b"a" * 200, b"short", b"", texts(1, 64, 3)[0]]
    ranks = digest.rarity(digest.entropy_counts(some))
    want = [plain_votes(t, ranks) for t in some]
    assert [v.tolist() for v in digest.Digest(ranks)._votes(some)] == want
    monkeypatch.setattr(digest, "SPAN", 100)  # texts in several parts
    assert [v.tolist() for v in digest.Digest(ranks)._votes(some)] == want


def test_likeness():
    a, b, c = (t.decode() for t in texts(3, 6000, 4))
    ranks = digest.rarity(digest.entropy_counts([a.encode(), b.encode()]))
    own, copy, half, other, none = digest.Digest(ranks).of([a, a, a[:3000] + b[:3000], c, ""])
    assert digest.likeness(own, copy) == 1.0
    assert 0.2 < digest.likeness(own, half) < 0.9
    assert digest.likeness(own, other) < 0.1
    assert digest.likeness(own, half) == digest.likeness(half, own)
    assert (digest.likeness(none, none), digest.likeness(own, none)) == (1.0, 0.0)


def test_edits_follow_the_order(docs):
    rows = [(i, f"{i} " + "".join(chr(97 + (i * k) % 26) for k in range(i * 7))) for i in range(60)]
    out = {r["doc_id"]: r for r in digest.compare_with_edits(docs(*rows).repartition(5)).collect()}
    for i, text in rows:
        following = dict(rows)[i - 1 if i else 59]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert out[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert out[i]["n_chars"] == len(text)
        assert out[i]["near_next"] == digest.likeness(out[i]["fingerprint"], out[i - 1 if i else 59]["fingerprint"])


def test_odd_rows(odd, docs, empty):
    out = digest.compare_with_edits(odd).collect()
    assert len(out) == len(ODD) and all(0 <= r["near_edited"] <= 1 for r in out)
    prints = {}
    for r in out:
        assert prints.setdefault(r["doc_id"], r["fingerprint"]) == r["fingerprint"]
    assert prints[1] == prints[2] == "0:"
    last = next(r for r in out if r["doc_id"] is None)  # a null id comes last; then the first again
    half = len("without an id") // 2
    edited = "without an id"[:-half] + "12 34 !!"[:half]
    assert last["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    alone = digest.compare_with_edits(docs((1, "all alone"))).collect()[0]
    assert alone["near_next"] == 1.0 and alone["n_chars"] == 9
    assert digest.compare_with_edits(empty).collect() == []
