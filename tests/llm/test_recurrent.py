import math
import zlib
from collections import Counter

import numpy as np

from feedlake.llm import recurrent
from tests.llm.conftest import ODD


def little(seed=0, n=30):
    counts = np.random.default_rng(seed).integers(1, 500, n).astype(float)
    classes = recurrent.Classes(counts)
    return recurrent.first_weights(counts, classes), classes


def plain(w, classes, ids):
    """Log probability of a document by the formulas, one step after another, without classes."""
    h, read, total = np.zeros(recurrent.STATE), recurrent.END, 0.0
    s = recurrent.STATE
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for target in [*ids, recurrent.END]:
        on = h @ w.on
        z, r = sigmoid(w.into[read, :s] + on[:s]), sigmoid(w.into[read, s:2 * s] + on[s:2 * s])
        h = (1 - z) * np.tanh(w.into[read, 2 * s:] + r * on[2 * s:]) + z * h
        odds = np.exp(h @ w.classes + w.class_bias)
        inside = np.exp(w.words @ h + w.word_bias)
        k = classes.of[target]
        total += math.log(odds[k] / odds.sum()) + math.log(inside[target] / inside[classes.members[k]].sum())
        read = target
    return total


def documents(n, seed=1, most=120):
    rng = np.random.default_rng(seed)
    return [rng.integers(1, 30, rng.integers(0, most)) for _ in range(n)]


def test_whole_documents_with_carried_state(monkeypatch):
    w, classes = little()
    docs = documents(12)
    want = [plain(w, classes, d) for d in docs]
    for lanes in (3, 256):
        monkeypatch.setattr(recurrent, "LANES", lanes)
        assert np.allclose(recurrent.likelihoods(w, classes, docs), want, rtol=1e-4)


def test_probabilities_of_all_words_add_up():
    w, classes = little()
    hidden = np.random.default_rng(2).normal(0, 1, (1, recurrent.STATE)).astype(np.float32)
    logs = [recurrent.outputs(w, classes, hidden, np.array([t]))[0][0] for t in range(30)]
    assert abs(np.exp(logs).sum() - 1) < 1e-5


def test_gradients(monkeypatch):
    monkeypatch.setattr(recurrent, "WINDOW", 64)
    monkeypatch.setattr(recurrent, "STRETCH", 64)
    w, classes = little()
    docs = documents(4, most=25)
    one = recurrent.Trainer(w, classes)
    (kept, read, target, doc), = recurrent.states(one.w, docs)
    at = np.flatnonzero(doc.ravel() >= 0)
    hidden = kept["hidden"].reshape(-1, recurrent.STATE)
    _, back = recurrent.outputs(one.w, classes, hidden[at], target.ravel()[at], one.grad)
    whole = np.zeros_like(hidden)
    whole[at] = back
    recurrent.back_through(one.w, kept, read, whole.reshape(*read.shape, -1), one.grad)
    start, flat = 0, w.flat().astype(np.float64)
    for array in one.grad.arrays():
        i = start + int(np.abs(array.ravel()).argmax())
        start += array.size
        ends = []
        for step in (1e-2, -1e-2):
            moved = flat.copy()
            moved[i] += step
            ends.append(-recurrent.likelihoods(w.like(moved), classes, docs).sum())
        assert abs((ends[0] - ends[1]) / 2e-2 - one.slope[i]) < 1e-2 * max(1, abs(one.slope[i]))


def test_training_lowers_the_loss(monkeypatch):
    monkeypatch.setattr(recurrent, "GRADIENT_EVERY", 1)
    w, classes = little()
    docs = [np.array([2, 3, 4, 5] * 10)] * 200
    one = recurrent.Trainer(w, classes)
    before = recurrent.likelihoods(w, classes, docs).sum()
    for _ in range(20):
        one.learn(docs)
    assert recurrent.likelihoods(one.w, classes, docs).sum() > 0.5 * before


def test_every_token_is_trained_on():
    w, classes = little()
    for docs in ([np.array([2, 3])], documents(40), documents(300, most=400)):
        one = recurrent.Trainer(w, classes)
        one.learn(docs)
        assert one.updates and one.seen == sum(len(d) + 1 for d in docs)


def check_base(rows, out):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts, ends = Counter(), 0
    for i, text in rows:
        if i is not None and not held(i):
            counts.update(recurrent.tokens(text or ""))
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    chance = lambda n: math.log10((n + 0.1) / (total + 0.1 * (distinct + 1)))
    want = Counter()
    for i, text in rows:
        words = recurrent.tokens(text or "")
        base = sum(chance(counts[w]) for w in words) + chance(ends)
        want[i, held(i), len(words) + 1, sum(w in counts for w in words) + (ends > 0), total, round(base, 5)] += 1
    assert want == Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                            round(r["base_score"], 5)) for r in out)


def test_base_scores(docs, monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"w{int(x)}" for x in rng.zipf(1.3, 4000) % 900]
    rows = [(i, " ".join(words[i * 20:i * 20 + 20]) + (" RARE%d" % i)) for i in range(200)]
    for known in (recurrent.KNOWN_WORDS, 10):  # nearly all words by the join
        monkeypatch.setattr(recurrent, "KNOWN_WORDS", known)
        out = recurrent.score(docs(*rows)).collect()
        check_base(rows, out)
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_odd_rows(odd, empty):
    rows = [(r[0], r[1]) for r in ODD]
    out = recurrent.score(odd).collect()
    check_base(rows, out)
    assert all(math.isfinite(r["score"]) for r in out)
    assert recurrent.score(empty).collect() == []
