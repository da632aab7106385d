"""Quality of texts: gradient-boosted trees over statistics of the document.

Each text becomes a row of numbers, once. A bounded sample of the labelled rows is binned into
histograms, trees grow level by level on the gradients of the log loss, and all trees lie flat in
arrays, so that numpy moves many rows down many trees at once. The forest goes to the tasks.

Results by case: a null text counts as empty; an empty one has statistics like any other. A row
without doc_id, or without quality, teaches nothing but is scored. Each labelled pair of rows counts,
also repeated ones. Without a label every score is 0.5; with one class only, scores lie near it. Rows
are scored one by one, so ties and repeats get equal scores. An empty table gives no rows. Only
doc_id, text and quality are read.
"""

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from feedlake.llm.frames import bounded_batches, staged

#: Labelled rows that the forest is fitted on at most: chosen by a hash of doc_id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 60, 4, 64
RATE, RIDGE, LEAST_ROWS = 0.2, 1.0, 20

STATISTICS = (
    "log_characters", "log_words", "mean_word", "longest_word", "distinct_words", "commonest_word",
    "repeated_next", "log_lines", "distinct_lines", "mean_line", "short_lines", "sentence_lines",
    "letters", "capitals", "digits", "blanks", "stops", "exclamations", "bars", "marks", "beyond_ascii",
    "words_with_marks", "capital_words")


def _classes() -> np.ndarray:
    """Class of each byte, the columns from ``letters`` to ``beyond_ascii``."""
    of = np.full(256, 7)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            of[b] = 8
        elif c.isalpha():
            of[b] = 1 if c.isupper() else 0
        elif c.isdigit():
            of[b] = 2
        elif c.isspace():
            of[b] = 3
        elif c in ".,;:?'\"()-":
            of[b] = 4
        elif c == "!":
            of[b] = 5
        elif c == "|":
            of[b] = 6
    return of


_CLASS = _classes()


def statistics(text: str) -> list[float]:
    """The numbers of one text, in the order of STATISTICS."""
    words, lines = text.split(), text.split("\n")
    raw = text.encode()
    counts = Counter(words)
    n, size, rows = max(1, len(words)), max(1, len(raw)), len(lines)
    shares = np.bincount(_CLASS, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), 9) / size
    lengths = list(map(len, counts))
    marked = sum(c for w, c in counts.items() if not (w[-1].isalnum() or w[-1] in ".,;:?'\")-"))
    capital = sum(c for w, c in counts.items() if w.isupper())
    return [
        math.log1p(len(text)), math.log1p(len(words)),
        sum(c * m for c, m in zip(counts.values(), lengths)) / n, float(max(lengths, default=0)),
        len(counts) / n, max(counts.values(), default=0) / n, sum(map(eq, words, words[1:])) / n,
        math.log(rows), len(set(lines)) / rows, len(text) / rows,
        sum(len(x) < 20 for x in lines) / rows, sum(x.endswith((".", "!", "?")) for x in lines) / rows,
        *shares.tolist(), marked / n, capital / n]


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_column(texts: pd.Series) -> pd.Series:
    """Statistics of each text."""
    return pd.Series([statistics(t or "") for t in texts])


@dataclass
class Forest:
    """Trees as flat arrays: node i of a tree has the children 2i + 1 and 2i + 2."""

    edges: list  # of each statistic, the upper ends of its bins
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # a row goes right if its bin is above
    leaf: np.ndarray  # (trees, leaves), log odds
    start: float

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, k]) for k, e in enumerate(self.edges)], axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        odds = np.full(len(rows), self.start)
        if len(self.feature) and len(rows):
            binned, tree = self.bins(rows), np.arange(len(self.feature))
            node = np.zeros((len(rows), len(tree)), np.int64)
            for _ in range(DEPTH):
                seen = np.take_along_axis(binned, self.feature[tree, node], axis=1)
                node = 2 * node + 1 + (seen > self.cut[tree, node])
            odds = odds + self.leaf[tree, node - (2 ** DEPTH - 1)].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-odds))


def _grow(binned: np.ndarray, slope: np.ndarray, bend: np.ndarray) -> tuple[np.ndarray, ...]:
    """One tree on the gradients: at each level the best cut of each node's histograms."""
    n, width = binned.shape
    inner = 2 ** DEPTH - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS)
    node = np.zeros(n, np.int64)
    for level in range(DEPTH):
        first, here = 2 ** level - 1, 2 ** level
        place = node - first
        tables = np.empty((3, here, width, BINS))
        for k in range(width):
            slot = place * BINS + binned[:, k]
            for table, weights in zip(tables, (slope, bend, None)):
                table[:, k] = np.bincount(slot, weights, here * BINS).reshape(here, BINS)
        g, h, count = tables.cumsum(axis=3)
        all_g, all_h, all_n = (x[:, :, -1:] for x in (g, h, count))
        gain = (g ** 2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE)
                - all_g ** 2 / (all_h + RIDGE))
        gain[(count < LEAST_ROWS) | (all_n - count < LEAST_ROWS)] = 0.0
        flat = gain.reshape(here, -1)
        best = flat.argmax(axis=1)
        split = flat[np.arange(here), best] > 1e-9
        feature[first:first + here] = np.where(split, best // BINS, 0)
        cut[first:first + here] = np.where(split, best % BINS, BINS)
        node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > cut[node])
    end = node - inner
    leaf = -RATE * (np.bincount(end, slope, 2 ** DEPTH) / (np.bincount(end, bend, 2 ** DEPTH) + RIDGE))
    return feature, cut, leaf, leaf[end]


def fit(rows: np.ndarray, labels: np.ndarray) -> Forest:
    """A forest for labels 0 and 1."""
    ones = float(labels.sum())
    start = math.log((ones + 0.5) / (len(labels) - ones + 0.5))
    grid = np.arange(1, BINS) / BINS
    edges = [np.unique(np.quantile(rows[:, k], grid)) for k in range(rows.shape[1])] if len(rows) else []
    forest = Forest(edges, np.empty((0, 1)), np.empty((0, 1)), np.empty((0, 1)), start)
    if not 0 < ones < len(labels):
        return forest
    binned, odds, trees = forest.bins(rows), np.full(len(rows), start), []
    for _ in range(TREES):
        chance = 1.0 / (1.0 + np.exp(-odds))
        *tree, moved = _grow(binned, chance - labels, chance * (1 - chance))
        odds = odds + moved
        trees.append(tree)
    return Forest(edges, *(np.stack(part) for part in zip(*trees)), start)


def held_out(doc_id: str | Column, parts: int, which: int = 0) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == which, F.lit(False))


def sample(rows: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """features, quality of at most ``most`` labelled ids that may teach: those of the smallest hashes.

    An id teaches once, by the smallest of its labels and of its texts' statistics, however often either
    table repeats it.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out("doc_id", 5))
    usable = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, 1.2 * most / max(1, usable.count()) + 0.01)  # a little more than needed
    usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < math.ceil(1_000_000 * share))
    found = rows.join(usable, "doc_id").groupBy("doc_id").agg(
        F.min("features").alias("features"), F.first("quality").alias("quality"))
    return found.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)), "doc_id").limit(most)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    bounded_batches(docs.sparkSession)
    rows = staged(docs.select("doc_id", statistics_column("text").alias("features")), "statistics")
    taught = sample(rows, labels).toPandas().sort_values(["doc_id", "quality"], kind="stable")
    table = np.array(taught["features"].tolist(), np.float64).reshape(-1, len(STATISTICS))
    forest = fit(table, taught["quality"].to_numpy(np.float64))

    @F.pandas_udf(DoubleType())
    def judge(features: pd.Series) -> pd.Series:
        return pd.Series(forest.score(np.array(features.tolist(), np.float64).reshape(-1, len(STATISTICS))))

    scored = rows.select("doc_id", held_out("doc_id", 5).alias("held_out"), judge("features").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
