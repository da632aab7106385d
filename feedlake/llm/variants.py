r"""Spelling variants: words one edit apart, found by walking a trie kept as a table.

Words are counted over whole texts. Their prefixes are the nodes of a trie, stored as an edge table (node,
letter, child) with what may follow each child. A state is a word, a position in it, a node and the edits
so far. A word's own path has no edits; there each state either replaces the next letter by a greater one
or has a letter more, which the edge table answers with the children to go on from. From then on a state
follows its word's letters exactly, level by level, each level one join with the edge table, until it ends
at the end of a word, which then is a neighbour. A pair is found from one side and listed for both.

Of any two words one edit apart at least one half is the same, so a word's own path is walked from its middle
on, in a trie of the words and in one of the words read backwards. There nodes have few children; near the
root each word would meet all letters. A node has one child per letter of the alphabet at most, so what a
join makes is bounded by its input however many words share a node, and adaptive execution splits these.

Words of LONGEST letters and more, for which a trie would take as many levels, are compared by the hashes
of what they become by one deletion, and candidates by themselves; this finds the same pairs.

Results by case: a null text has no words; a row without doc_id counts, with nothing for its id in the hash that
decides on the deletion. Repeated rows count repeatedly. Of forms equally frequent the first by code points
is taken. An empty table gives no rows. Only doc_id and text are read; columns of any other name are ignored.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import bounded_batches, staged, strings

RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: One in so many words of a text loses a letter.
PART = 97
#: Letters from which words leave the trie.
LONGEST = 48
#: Distinct words that a task counts before it sends them on; hashes of deletions made at a time.
COUNTED_WORDS, HELD_HASHES = 300_000, 1 << 20


# ---------------------------------------------------------------- counts

def damaged(word: str, doc_id: str | None, part: int = PART) -> str:
    """The word as it stands in a text of that id: one in ``part`` without a letter."""
    h = zlib.crc32(f"{doc_id or ''}:{word}".encode())
    if h % part:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, part: int | None = PART) -> DataFrame:
    """word, n of all texts, as the texts spell it; ``part`` None leaves all words as they are."""
    def count(batches):
        counts = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = Counter(RUN.findall((text or "").encode().lower().decode()))  # of bytes: only A to Z
                if part is None:
                    counts.update(own)
                else:
                    for word, n in own.items():
                        counts[damaged(word, doc_id, part)] += n
            if len(counts) > COUNTED_WORDS:
                yield rows(counts)
                counts = Counter()
        if counts:
            yield rows(counts)

    def rows(counts):
        return pd.DataFrame({"word": strings(counts), "n": list(counts.values())})

    bounded_batches(docs.sparkSession)
    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- trie

def _letter(word: str, at: Column) -> Column:
    return F.substring(F.col(word), at + 1, F.lit(1))


def edges(words: DataFrame) -> DataFrame:
    """way, node, child, letter, nexts (letters that may follow the child), ends (whether it is a word).

    ``words`` holds (way, word); each word gives a row per prefix.
    """
    prefix = words.select("way", "word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at"))
    each = prefix.select(
        "way", F.substring("word", F.lit(1), F.col("at")).alias("child"), _letter("word", F.col("at")).alias("next"))
    grouped = each.groupBy("way", "child").agg(  # the alphabet bounds the set
        F.array_join(F.collect_set(F.nullif("next", F.lit(""))), "").alias("nexts"),
        F.max(F.col("next") == "").alias("ends"))
    length = F.length("child")
    return grouped.select(
        "way", F.substring("child", F.lit(1), length - 1).alias("node"), "child",
        F.substring("child", length, F.lit(1)).alias("letter"), "nexts", "ends")


def _leads_on(at: Column) -> Column:
    """Whether a word, read up to ``at``, can go on from the child that was reached."""
    return F.when(at == F.length("word"), F.col("ends")).otherwise(F.instr("nexts", _letter("word", at)) > 0)


def _short_pairs(words: DataFrame) -> DataFrame:
    """word, near: pairs of distinct words (column ``word``) one edit apart, each from one side."""
    both = words.select(F.posexplode(F.array("word", F.reverse("word"))).alias("way", "word"))
    tree = staged(edges(both), "edges")
    # own paths, from the middle of each word on
    own = both.select("way", "word", F.explode(F.sequence(F.floor(F.length("word") / 2).cast("int"),
                                                          F.length("word"))).alias("at"))
    own = own.withColumn("node", F.substring("word", F.lit(1), F.col("at")))
    here, letter = _letter("word", F.col("at")), F.col("letter")
    replaced = F.when((here != "") & (letter > here) & _leads_on(F.col("at") + 1), F.col("at") + 1)
    # a letter more: equal ones side by side count once, behind the last of them
    longer = F.when((letter != here) & _leads_on(F.col("at")), F.col("at"))
    moved = own.join(tree, ["way", "node"]).select(
        "way", "word", "child", "ends", F.explode(F.array_compact(F.array(replaced, longer))).alias("at"))
    frontier, pairs = staged(moved, "frontier"), None
    while True:
        at_end = F.col("at") == F.length("word")
        found = frontier.where(at_end).select("way", "word", F.col("child").alias("near"))
        pairs = found if pairs is None else pairs.union(found)
        # one edit is made: on along the word's own letters
        states = frontier.where(~at_end).select(
            "way", "word", F.concat("child", _letter("word", F.col("at"))).alias("child"),
            (F.col("at") + 1).alias("at"))
        step = tree.select("way", "child", "nexts", "ends")
        frontier = staged(states.join(step, ["way", "child"]).where(_leads_on(F.col("at"))).select(
            "way", "word", "child", "ends", "at"), "frontier")
        if frontier.isEmpty():
            break
    read = lambda c: F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c)).alias(c)
    return pairs.select(read("word"), read("near"))


# ---------------------------------------------------------------- long words

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _hashes(word: str) -> np.ndarray:
    """Hashes of the word and of what each single deletion leaves, the word's own first."""
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    codes *= np.uint64(0xC2B2AE3D27D4EB4F)
    codes ^= codes >> np.uint64(29)
    powers = np.full(len(codes) + 1, _FACTOR)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    before = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers[:-1])])
    behind = np.concatenate([[np.uint64(0)], np.cumsum(codes[1:] * powers[:-2])])  # one place earlier
    return np.unique(np.concatenate([before[-1:], before[:-1] + (behind[-1] - behind)])).view(np.int64)


def _one_edit(a: str, b: str) -> bool:
    """Whether two different words differ by one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)):] == b[same + 1:]


def _long_pairs(words: DataFrame) -> DataFrame:
    """The same for long words: those that share a deletion's hash, then compared themselves."""
    def hashed(batches):
        for batch in batches:
            held, size = [], 0
            for word in batch["word"]:
                held.append((word, _hashes(word)))
                size += len(word)
                if size >= HELD_HASHES:
                    yield rows(held)
                    held, size = [], 0
            yield rows(held)

    def rows(held):
        return pd.DataFrame({"key": np.concatenate([np.empty(0, np.int64), *(h for _, h in held)]),
                             "id": strings(i for w, h in held for i in [digest(w)] * len(h))})

    def digest(word):
        return f"{zlib.crc32(word.encode()):08x}{len(word)}"

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([x != y and _one_edit(x, y) for x, y in zip(a, b)], dtype=bool)

    name = F.concat(F.lpad(F.lower(F.hex(F.crc32("word"))), 8, "0"), F.length("word").cast("string"))
    keys = staged(words.mapInPandas(hashed, "key long, id string"), "deletions")
    a, b = keys.select("key", F.col("id").alias("a")), keys.select("key", F.col("id").alias("b"))
    pairs = a.join(b, "key").where("a <= b").select("a", "b").distinct()
    of = lambda c, w: words.select(name.alias(c), F.col("word").alias(w))
    both = pairs.join(of("a", "word"), "a").join(of("b", "near"), "b")
    return both.where(near("word", "near")).select("word", "near")


# ---------------------------------------------------------------- words, forms and roots

def neighbours(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """word, near: all pairs of the distinct words (column ``word``) one edit apart, both ways round."""
    words = words.select("word")
    pairs = _short_pairs(words.where(F.length("word") <= longest))
    long = staged(words.where(F.length("word") >= longest), "long-words")
    if not long.isEmpty():
        pairs = pairs.union(_long_pairs(long))
    turned = pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))
    return pairs.union(turned).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the chain from word by ``form`` (null at an end), halved each round."""
    up = staged(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        above = up.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(up.join(above, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        up = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return up


def variants(counts: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of words with their counts (word, n; each word once).

    A word's form is its most frequent neighbour, if that is ``ratio`` times as frequent at least.
    """
    counts = staged(counts.select("word", "n"), "words")
    near = staged(neighbours(counts), "near")
    known = counts.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(known, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    is_form = -F.col("best.n") >= ratio * F.col("n")
    found = staged(counts.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")), "forms")
    return found.join(roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")


def of_documents(docs: DataFrame) -> DataFrame:
    """The same for the frequent words of all texts."""
    counts = count_words(docs).where((F.length("word") >= LEAST_LETTERS) & (F.col("n") >= LEAST_COUNT))
    return variants(counts)
