"""Similarity digests: rare byte windows of a text, gathered in a chain of Bloom filters.

Each window of 64 bytes has an entropy, counted in thousandths of the largest. How rare a value is
comes from its frequency over all documents. In each run of 64 neighbouring windows the rarest, and
of these the first, gets a vote; windows with enough votes are the features. Their SHA-1 sets five
bits of a filter of 2048; a filter is full after 160 features and the next one begins. Two digests
are compared filter by filter: shared bits beyond those expected by chance, as a share of the
possible ones; the mean over the filters of the shorter chain, each against its best partner.

Results by case: a null or empty text has no feature, and is like another such text (1.0) and
unlike any other (0.0). A text shorter than the smaller window is one feature as a whole, so equal
texts have equal digests at any length. Texts follow each other by doc_id downwards, rows of one id by
text, a null id last; after the last comes the first. Repeated rows have a row each. An empty table
gives no rows. Only doc_id and text are read.
"""

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from feedlake.llm.frames import bounded_batches, strings

WINDOW = 64
#: Entropies, in thousandths of the largest, that say too little or are next to noise.
LOW, HIGH = 100, 990
VOTES = 16
#: With fewer features than this any vote will do; of texts under so many bytes, and of texts
#: without a vote, each of the smaller windows is a feature.
FEW_FEATURES, SHORT_TEXT, SHORT_WINDOW = 16, 256, 16
FILTER_BITS, FILTER_FEATURES, FEATURE_BITS = 2048, 160, 5
#: Share of the range between chance and full overlap that counts as no likeness.
CHANCE_MARGIN = 0.3
#: Window starts handled at a time.
SPAN = 1 << 18
NEVER = np.uint32(0xFFFFFFFF)

_UNIT = 1 << 14
_TERMS = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 1)], np.int32)
_STEPS = np.diff(_TERMS)


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy of each window, 0 to 1000. The sum over byte counts moves on byte by byte."""
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    first = _TERMS[np.bincount(data[:WINDOW], minlength=256)].sum(dtype=np.int32)
    moves = _STEPS[before[WINDOW:]] - _STEPS[after[:len(data) - WINDOW]]
    sums = np.empty(len(data) - WINDOW + 1, np.int32)
    sums[0] = first
    np.cumsum(moves, out=sums[1:])
    sums[1:] += first
    full = int(_TERMS[WINDOW])
    return (1000.0 - sums * (1000.0 / full)).astype(np.int16)


class Spans:
    """Texts laid out one after another in buffers of bounded size, so that numpy works on much at once.

    Yields (data, parts); a part is (text, first window, number of windows, place in data). Long
    texts come in several parts, whose windows overlap by ``overlap``.
    """

    def __init__(self, texts: list[bytes], overlap: int):
        self.texts, self.overlap = texts, overlap

    def __iter__(self) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
        pieces, parts, size = [], [], 0
        gap = bytes(WINDOW)
        for k, text in enumerate(self.texts):
            windows = len(text) - WINDOW + 1
            start = 0
            while start < windows:
                n = min(windows - start, SPAN + self.overlap)
                pieces += [text[start:start + n + WINDOW - 1], gap]
                parts.append((k, start, n, size))
                size += n + 2 * WINDOW - 1
                if size >= SPAN:
                    yield np.frombuffer(b"".join(pieces), np.uint8), parts
                    pieces, parts, size = [], [], 0
                if start + n >= windows:
                    break
                start += SPAN
        if parts:
            yield np.frombuffer(b"".join(pieces), np.uint8), parts


def entropy_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows have each entropy."""
    counts = np.zeros(1001, np.int64)
    for data, parts in Spans(texts, 0):
        values = entropies(data)
        for _, _, n, at in parts:
            counts += np.bincount(values[at:at + n], minlength=1001)
    return counts


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy, the rarest first, equal ones by value; outer ones never win."""
    order = np.argsort(counts, kind="stable")
    ranks = np.empty(1001, np.uint32)
    ranks[order] = np.arange(1001, dtype=np.uint32)
    ranks[:LOW] = ranks[HIGH + 1:] = NEVER
    return ranks


def _run_winners(keys: np.ndarray) -> np.ndarray:
    """Smallest key of each run of WINDOW keys, by doubling."""
    width = 1
    while width < WINDOW:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    return keys


class Digest:
    """Makes digests by one table of ranks."""

    def __init__(self, ranks: np.ndarray):
        self.ranks = ranks

    def _votes(self, texts: list[bytes]) -> list[np.ndarray]:
        votes = [np.zeros(max(0, len(t) - WINDOW + 1), np.uint8) for t in texts]
        for data, parts in Spans(texts, WINDOW - 1):
            rank = self.ranks[entropies(data)]
            # a part and what follows it: windows outside of the part never win
            keys = np.full(len(rank) + WINDOW, NEVER, np.uint32)
            for _, _, n, at in parts:
                own = rank[at:at + n]
                place = np.arange(at, at + n, dtype=np.uint32)
                keys[at:at + n] = np.where(own == NEVER, NEVER, own << np.uint32(20) | place)
            winners = _run_winners(keys)
            for k, start, n, at in parts:
                runs = max(1, n - WINDOW + 1)
                won = winners[at:at + min(runs, SPAN)]
                won = (won[won != NEVER] & np.uint32((1 << 20) - 1)).astype(np.int64) - at
                votes[k][start:start + n] += np.bincount(won, minlength=n).astype(np.uint8)
        return votes

    def features(self, texts: list[bytes]) -> list[list[bytes]]:
        """SHA-1 of each feature in order, repeated ones once."""
        out, sha1 = [], hashlib.sha1
        for text, votes in zip(texts, self._votes(texts)):
            chosen, width = np.flatnonzero(votes >= VOTES), WINDOW
            if len(chosen) < FEW_FEATURES:
                chosen = np.flatnonzero(votes)
            if len(text) < SHORT_TEXT or not len(chosen):
                chosen, width = np.arange(max(1, len(text) - SHORT_WINDOW + 1)), SHORT_WINDOW
            found = dict.fromkeys(sha1(text[p:p + width]).digest() for p in chosen.tolist())
            out.append(list(found) if text else [])
        return out

    def of(self, texts: list[str]) -> list[str]:
        """Digests: the number of features, and the filters in base64."""
        out = []
        for features in self.features([t.encode() for t in texts]):
            n = len(features)
            words = np.frombuffer(b"".join(features), "<u4").reshape(-1, FEATURE_BITS)
            bits = np.zeros((-(-n // FILTER_FEATURES), FILTER_BITS), np.uint8)
            bits[np.arange(n)[:, None] // FILTER_FEATURES, words & np.uint32(FILTER_BITS - 1)] = 1
            out.append(f"{n}:{base64.b64encode(np.packbits(bits, axis=1).tobytes()).decode()}")
        return out


def likeness(a: str, b: str) -> float:
    """Likeness of two digests, 0 to 1."""
    if a == b:
        return 1.0
    chains = [np.frombuffer(base64.b64decode(x.split(":")[1]), np.uint64).reshape(-1, FILTER_BITS // 64)
              for x in (a, b)]
    few, many = sorted(chains, key=len)
    if not len(few):
        return 0.0
    if len(few) == len(many) and a > b:  # the same chain leads whichever comes first
        few, many = many, few
    sizes, total = np.bitwise_count(many).sum(axis=1, dtype=np.int64), 0.0
    for own in few:
        size = int(np.bitwise_count(own).sum(dtype=np.int64))
        shared = np.bitwise_count(many & own).sum(axis=1, dtype=np.int64)
        most = np.minimum(sizes, size)
        least = sizes * size / FILTER_BITS
        cut = least + CHANCE_MARGIN * (most - least)
        # a filter so full that chance explains all of it tells nothing
        scores = np.where(most > cut, (shared - cut) / np.maximum(most - cut, 1e-9), 0.0)
        total += float(np.clip(scores, 0.0, 1.0).max())
    return total / len(few)


def rarity_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Ranks of the entropies by their frequency over all texts; 1001 counts reach the driver."""
    bounded_batches(docs.sparkSession)

    def count(batches):
        counts = np.zeros(1001, np.int64)
        for batch in batches:
            counts += entropy_counts([(t or "").encode() for t in batch["text"]])
        seen = np.flatnonzero(counts)
        yield pd.DataFrame({"value": seen, "n": counts[seen]})

    rows = (docs.select(F.col(text).alias("text")).mapInPandas(count, "value long, n long")
            .groupBy("value").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(1001, np.int64)
    for row in rows:
        counts[row["value"]] = row["n"]
    return rarity(counts)


def _ranges(docs: DataFrame, per_partition: int = 4) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Cuts of the order key, and (head, range that needs it) of each range that has rows.

    Range r holds the keys above cuts[r - 1] and up to cuts[r]. The last document of a range is
    followed by the head, the largest key, of the next lower one.
    """
    spark = docs.sparkSession
    n = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    probabilities = [i / n for i in range(1, n)]
    cuts = np.unique(np.array(
        docs.where("key IS NOT NULL").approxQuantile("key", probabilities, 1 / (4 * n)), np.float64))
    place = _place(cuts)
    heads = docs.groupBy(place("key").alias("range")).agg(F.max("key").alias("head")).collect()
    heads = sorted((r["range"], r["head"]) for r in heads)
    return cuts, [(head, heads[(i + 1) % len(heads)][0]) for i, (_, head) in enumerate(heads)]


def _place(cuts: np.ndarray):
    @F.pandas_udf(IntegerType())
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(np.float64), side="left").astype(np.int32))

    return place


def beside_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, range, guest: partitions that hold whole ranges in order.

    Each range ends with a guest row, the text that follows its last document.
    """
    keyed = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"),
                                                     F.lit(-(1 << 63))).alias("key"))
    cuts, heads = _ranges(keyed)
    columns = ["doc_id", "text", "key", "range", "guest"]
    own = keyed.select("doc_id", "text", "key", _place(cuts)("key").alias("range"), F.lit(0).alias("guest"))
    # one row per range, and the ranges follow the number of partitions: small enough to send
    wanted = docs.sparkSession.createDataFrame(heads, "key long, range int")
    guests = (keyed.join(F.broadcast(wanted), "key").groupBy("key", "range")
              .agg(F.min(F.coalesce("text", F.lit(""))).alias("text")))
    guests = guests.select(F.lit(None).cast("long").alias("doc_id"), "text", "key", "range",
                           F.lit(1).alias("guest"))
    return (own.select(columns).union(guests.select(columns)).repartition("range")
            .sortWithinPartitions("range", "guest", F.col("key").desc(), F.coalesce("text", F.lit("")))
            .select(F.col("doc_id").cast("string"), "text", "range", "guest"))


COMPARED = ("doc_id string, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Digest of every text beside those of its edited text and of the next document."""
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    ranks = rarity_ranks(docs)

    def compare(batches):
        digest, held = Digest(ranks), None  # held: the row that waits for its next one
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            rows = list(zip(batch["doc_id"], texts, batch["range"], batch["guest"], digest.of(texts)))
            if held:
                rows.insert(0, held)
            held = rows[-1]
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[3] and a[2] == b[2]]
            if not pairs:
                continue
            edits = []
            for a, b in pairs:
                half = len(a[1]) // 2
                edits.append(a[1][:len(a[1]) - half] + b[1][:half])
            prints = digest.of(edits)
            yield pd.DataFrame({
                "doc_id": strings(a[0] for a, _ in pairs),
                "n_chars": [len(a[1]) for a, _ in pairs],
                "edited_sha256": strings(hashlib.sha256(e.encode()).hexdigest() for e in edits),
                "fingerprint": strings(a[4] for a, _ in pairs),
                "edited_fingerprint": strings(prints),
                "near_edited": [likeness(a[4], p) for (a, _), p in zip(pairs, prints)],
                "near_next": [likeness(a[4], b[4]) for a, b in pairs],
            })

    # as strings, for pandas has no nulls among its integers
    return beside_next(docs).mapInPandas(compare, COMPARED).withColumn(
        "doc_id", F.col("doc_id").cast("long"))
