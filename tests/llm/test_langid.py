import zlib

import numpy as np

from feedlake.llm import langid

PIECES = [langid.MARK, "t", "h", "e", "th", "he", langid.MARK + "th", "the", langid.MARK + "the"]


def model(seed=0):
    chances = np.random.default_rng(seed).random((len(PIECES) + 1, 2))
    return langid.Model(["a", "b"], np.zeros(2), PIECES, chances / chances.sum(axis=0))


def cuts(word):
    """All ways to cut a word into pieces, unknown characters as -1."""
    if not word:
        yield []
    for i, piece in enumerate(PIECES):
        if word.startswith(piece):
            yield from ([i, *rest] for rest in cuts(word[len(piece):]))
    if word and word[0] not in PIECES:
        yield from ([-1, *rest] for rest in cuts(word[1:]))


def chance(m, cut):
    return np.prod([m.chances[i] / (langid.CHARACTERS if i < 0 else 1) for i in cut], axis=0)


def test_forward_sums_all_segmentations():
    m = model()
    scorer = langid.Scorer(m)
    for word in ("the", "thehe", "hxet", "e", "xx", "thethethe"):
        want = sum(chance(m, cut) for cut in cuts(langid.MARK + word))
        assert np.allclose(scorer.likelihoods([[word]])[0], np.log(want))


def test_expected_counts_are_posteriors():
    m, words = model(1), ["the", "hte"]
    counts = np.array([[2.0, 1.0], [0.0, 3.0]])
    got = langid.expected(langid.Lattice(langid.trie_of(tuple(PIECES)), words), m.lifted(), counts)
    want = np.zeros_like(got)
    for word, n in zip(words, counts):
        every = [(cut, chance(m, cut)) for cut in cuts(langid.MARK + word)]
        total = sum(c for _, c in every)
        for cut, c in every:
            for i in cut:
                want[i] += n * c / total
    assert np.allclose(got, want)


def test_texts_are_sums_of_words_whatever_is_remembered(monkeypatch):
    texts = [langid.words_of(t) for t in ("the the he", "", "Thé xx " * 30, "he")]
    whole = langid.Scorer(model()).likelihoods(texts)
    monkeypatch.setattr(langid, "HELD_WORDS", 2)
    monkeypatch.setattr(langid, "KEPT_WORDS", 3)
    assert np.allclose(langid.Scorer(model()).likelihoods(texts), whole)
    assert "".join(langid.words_of("a" * 1000)) == "a" * 1000


def test_languages(spark, docs):
    english = "the man who was there had gone with them for the night and that was all of it".split()
    german = "der mann war nicht mehr da und das war schon alles was wir von ihm noch wissen".split()
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(w, 12)), lang, "s")
            for i, (lang, w) in enumerate([("en", english), ("de", german)] * 40)]
    rows += [(900, "12 34 -- !", "en", "s"), (901, None, "de", "s"), (902, "the night", None, "s"), (None, "das war", "de", "s")]
    df = docs(*rows)
    out = {r["doc_id"]: r for r in langid.detect(df).collect()}
    for i, _, lang, _ in rows[:80]:
        assert out[i]["language"]["lang_pred"] == lang and 0.5 < out[i]["language"]["score"] <= 1
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert tuple(out[900]["language"]) == tuple(out[901]["language"]) == ("und", 0.0)
    assert out[902]["language"]["lang_pred"] == "en"
    assert out[None]["language"]["lang_pred"] == "de" and out[None]["held_out"] is False
    assert set(df.columns) < set(langid.detect(df).columns)


def test_held_out_rows_teach_nothing(docs):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
    out = langid.detect(docs(*[(i, "some words here", "en", "s") for i in held])).collect()
    assert {r["language"]["lang_pred"] for r in out} == {"und"}


def test_odd_rows(odd, empty):
    out = langid.detect(odd).collect()
    assert len(out) == odd.count()
    assert langid.detect(empty).collect() == []
