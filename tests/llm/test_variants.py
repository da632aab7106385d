import random
import re
import zlib
from collections import Counter

from feedlake.llm import variants

LETTERS = "abcdeéñß×"


def near(a, b):
    """One code point inserted, deleted or replaced, by trying all places."""
    short, long = sorted((a, b), key=len)
    if len(short) == len(long):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def counted(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def by_hand(counts):
    rows, forms = {}, {}
    for word, n in counts.items():
        close = [w for w in counts if w != word and near(w, word)]
        best = min(close, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= 2 * n else None
        rows[word] = (n, len(close))
    out = []
    for word, (n, n_near) in rows.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        out.append((word, form, root, n, n_near, None if form is None else counts[form]))
    return sorted(out)


def misspelt(rng, word):
    at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    return word[:at] + (rng.choice(LETTERS) if kind else "") + word[at + (kind != 1):]


def test_against_all_pairs(docs):
    rng = random.Random(1)
    words = ["".join(rng.choices(LETTERS, k=rng.randint(4, 11))) for _ in range(60)]
    for _ in range(2):
        words += [misspelt(rng, w) for w in words]
    rows = []
    for i in range(120):
        text = " ".join(rng.choices(words, [1 / (k + 3) for k in range(len(words))], k=60))
        rows.append((i, text.upper().replace("SS", "ß") if i % 5 == 0 else text))
    rows += [(None, "héllo héllo hallo"), (7, None), (8, ""), (9, "ÀÁÂÃÄ straße×÷ Àáâãä " * 3), (9, "ÀÁÂÃÄ")]
    got = sorted(map(tuple, variants.of_documents(docs(*rows)).collect()))
    want = by_hand(counted(rows))
    assert got == want and sum(r[4] for r in want) > 200


def test_every_place_and_doubled_letters(spark):
    base = ["aaaaa", "abcde", "aabbcc", "zzzzzzzz"]
    words = set(base)
    for w in base:
        for i in range(len(w) + 1):
            words |= {w[:i] + c + w[i:] for c in "abz"} | {w[:i] + w[i + 1:]} | {w[:i] + c + w[i + 1:] for c in "az"}
    words = sorted(w for w in words if len(w) >= 4)
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = sorted(map(tuple, variants.neighbours(df).collect()))
    assert got == sorted((a, b) for a in words for b in words if a != b and near(a, b))


def test_long_words(spark):
    rng = random.Random(2)
    words = {"".join(rng.choices("abc", k=n)) for n in (46, 47, 48, 49, 60, 3000) for _ in range(3)}
    for w in list(words):
        words |= {misspelt(rng, w) for _ in range(4)} | {w[1:], w + "z", "z" + w[1:], w[:-1]}
    words |= {"ab" * 40, "ba" * 40}
    words = sorted(words)
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = sorted(map(tuple, variants.neighbours(df).collect()))
    assert got == sorted((a, b) for a in words for b in words if a != b and near(a, b))


def test_chains_end_at_the_root(spark):
    # each word twice as frequent as the one before, one letter apart
    words = ["aaaaaaaaaaaa"[:11 - k] + "b" * (k + 1) for k in range(11)]
    df = spark.createDataFrame([(w, 3 * 2 ** k) for k, w in enumerate(words)], "word string, n long")
    rows = {r["word"]: r for r in variants.variants(df).collect()}
    assert {r["root"] for r in rows.values()} == {words[-1]}
    assert [rows[w]["form"] for w in words] == [*words[1:], None]


def test_a_third_of_all_words_below_one_node(spark):
    words = [f"inter{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abc"] + ["other", "others"]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    rows = {r["word"]: r for r in variants.variants(df).collect()}
    assert rows["interaaa"]["n_near"] == 9 + 9 + 2 and rows["other"]["n_near"] == 1
    assert all(r["form"] is None and r["root"] == r["word"] for r in rows.values())


def test_odd_rows(odd, empty):
    rows = {r["word"]: r["n"] for r in variants.of_documents(odd).collect()}
    assert {w: n for w, n in rows.items() if n >= 20_000} == {w: 20_000 for w in ("lorem", "ipsum", "dolor")}
    assert variants.of_documents(empty).collect() == []
