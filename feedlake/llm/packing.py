"""Best-fit packing of documents into sequences, improved by exchanges between underfull ones.

Every text becomes ids and an end. Only what is longer than a sequence is cut, into whole sequences behind
a first piece that may be shorter. Pieces are dealt to groups of bounded size by the hash of their number,
so that each group is a likeness of the corpus, however many copies of one length that has. A group packs
its pieces by decreasing length, each into the fullest sequence that has room, and then exchanges: pieces
of the emptiest sequence move to another one, or go there in exchange for one or two shorter ones, which
always raises the sum of squared fills, until the sequence is empty or nothing fits. It ends when a lower
bound of the number of sequences is reached. Then the emptiest sequences of all groups meet in an eighth
of the groups and go on exchanging, until one group is left.

A task holds GROUP_PIECES pieces on average, as a few numbers each; the lengths of all open sequences come
to the driver as a histogram of as many rows as a sequence has places.

Results by case: a null or empty text is one end. Rows without doc_id and repeated rows are packed like
any other, each on its own. Ties of length go by the pieces' numbers. An empty table gives no rows. Only
doc_id and text are read; columns of any other name are ignored.
"""

import array
import functools
import json
import os
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedlake.llm.bpe import byte_characters
from feedlake.llm.frames import bounded_batches, staged

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Tokens of a sequence, and the id that ends a document.
ROOM, END = 1024, 2
#: Pieces of a group on average, and groups of a round that become one in the next.
GROUP_PIECES, FEWER = 1 << 15, 8
#: Passes of exchanges, and sequences tried in vain one after the other before a pass ends.
PASSES, PATIENCE = 3, 200


# ---------------------------------------------------------------- tokens

#: The byte-level pattern of the vocabulary file, and what it comes to where no two white-space characters
#: meet: without the look ahead it is several times as fast. Fixed values.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SIMPLE = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_MEET = re.compile(r"\s\s").search
_BEYOND = re.compile("[^\x00-\xff]").search


class Encoder:
    """Ids of texts.

    Texts within Latin-1, whose character classes no Unicode version changes, go through tiktoken with the
    file's own vocabulary, which takes a seventh of the time; all others through the tokenizers library.
    Both give the same ids.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        content = json.loads(model)
        special = {t["id"] for t in content["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in content["model"]["vocab"].items()
                 if i not in special}
        self.plain, self.simple = (tiktoken.Encoding(
            "latin", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) for pattern in (PATTERN, SIMPLE))

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if _BEYOND(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return array.array("I", ids).tobytes()
        latin = self.plain if _MEET(text) else self.simple
        return latin.encode_to_numpy(text, disallowed_special=()).tobytes()


@functools.lru_cache(2)
def _encoder(model: str) -> Encoder:
    return Encoder(model)


def cuts(n: int, room: int = ROOM) -> list[tuple[int, int]]:
    """(start, length) of each piece of n tokens: whole sequences behind a first one of the rest."""
    first = n % room or min(n, room)
    return [(0, first)] + [(at, room) for at in range(first, n, room)]


def pieces(docs: DataFrame, room: int = ROOM, vocabulary: str = VOCABULARY, end: int = END,
           with_ids: bool = False) -> DataFrame:
    """place, doc_id, piece, start, length, ids_crc32 of every piece; ``with_ids`` adds the packed ids.

    ``place`` numbers the pieces. The result is stored. The vocabulary is read on the driver and sent to the
    tasks, a few megabytes at any size of the corpus.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(vocabulary, encoding="utf-8") as file:
        model = spark.sparkContext.broadcast(file.read())
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches):
        encode = _encoder(model.value)
        last = end.to_bytes(4, "little")
        for batch in batches:
            rows, out = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text or "") + last
                for number, (start, length) in enumerate(cuts(len(ids) // 4, room)):
                    own = ids[4 * start:4 * (start + length)]
                    rows.append(row)
                    out.append((number, start, length, zlib.crc32(own), own))
            number, start, length, crc, own = zip(*out) if out else ((),) * 5
            arrays = [batch.column("doc_id").take(pa.array(rows, pa.int32())), pa.array(number, pa.int32()),
                      *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(own, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    found = docs.select("doc_id", "text").mapInArrow(cut, schema)
    return staged(found.withColumn("place", F.monotonically_increasing_id()), "pieces")


# ---------------------------------------------------------------- one group

def least_bins(lengths: np.ndarray, room: int = ROOM) -> int:
    """A lower bound of the bins that pieces shorter than ``room`` need.

    For each k: pieces longer than room - k have a bin alone, those over half a bin one each, and pieces of k
    and more that do not fit beside the latter need more.
    """
    count = np.bincount(lengths, minlength=room + 1).astype(np.int64)
    pieces_to, tokens_to = np.cumsum(count), np.cumsum(count * np.arange(room + 1))
    half, k = room // 2, np.arange(room // 2 + 1)
    alone = pieces_to[room] - pieces_to[room - k]
    over_half = pieces_to[room - k] - pieces_to[half]
    beside = over_half * room - (tokens_to[room - k] - tokens_to[half])
    small = tokens_to[half] - np.where(k > 0, tokens_to[np.maximum(k - 1, 0)], 0)
    return int((alone + over_half + np.maximum(0, -((beside - small) // room))).max())


def best_fit(lengths: list[int], order: list[int], room: int = ROOM) -> list[list[int]]:
    """Bins of piece numbers: in the given order, each into the fullest bin with room for it."""
    by_free: list[list[int]] = [[] for _ in range(room + 1)]
    there, bins = 0, []  # there: bit f is set if a bin has f free
    for piece in order:
        length = lengths[piece]
        fits = there >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                there ^= 1 << free
            bins[at].append(piece)
        else:
            free, at = room, len(bins)
            bins.append([piece])
        by_free[free - length].append(at)
        there |= 1 << free - length
    return bins


class Exchange:
    """Underfull bins by what each could take, alone or for one or two of its pieces.

    A bin with ``free`` places can take up to free + t tokens for pieces of t tokens together. It is listed
    under (free + t, t), for no piece or one (kind 0) and for two (kind 1); bits say which numbers are listed.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], room: int = ROOM):
        self.lengths, self.bins, self.room = lengths, bins, room
        self.fill = [sum(lengths[p] for p in b) for b in bins]
        self.listed: tuple[dict, dict] = {}, {}
        self.taken = [[0] * (room + 1) for _ in range(2)]  # by tokens it can take: bits of t
        self.most = [0, 0]  # bits of tokens that some bin can take
        for at, fill in enumerate(self.fill):
            if 0 < fill < room:
                self._enter(at)

    def _offers(self, at: int) -> tuple[set[int], set[int]]:
        own = sorted(self.lengths[p] for p in self.bins[at])
        single, pairs = {0, *own}, set()
        for i, t in enumerate(own):
            if i + 1 < len(own) and (i == 0 or own[i - 1] != t):
                pairs.update(t + u for u in set(own[i + 1:]))
        return single, pairs

    def _enter(self, at: int) -> None:
        free = self.room - self.fill[at]
        for kind, offers in enumerate(self._offers(at)):
            for t in offers:
                self.listed[kind].setdefault((free + t, t), {})[at] = None
                self.taken[kind][free + t] |= 1 << t
                self.most[kind] |= 1 << free + t

    def _leave(self, at: int) -> None:
        free = self.room - self.fill[at]
        for kind, offers in enumerate(self._offers(at)):
            for t in offers:
                bins = self.listed[kind][free + t, t]
                del bins[at]
                if not bins:
                    del self.listed[kind][free + t, t]
                    self.taken[kind][free + t] ^= 1 << t
                    if not self.taken[kind][free + t]:
                        self.most[kind] ^= 1 << free + t

    def _find(self, tokens: int, kinds) -> tuple[int, int, int] | None:
        """(bin, kind, t): the bin that is fullest after taking ``tokens`` for fewer of its own."""
        best = None
        for kind in kinds:
            most, below = self.most[kind] >> tokens << tokens, (1 << tokens) - 1
            while most:
                can = (most & -most).bit_length() - 1
                if best and can >= best[0]:
                    break
                fits = self.taken[kind][can] & below
                if fits:
                    t = (fits & -fits).bit_length() - 1
                    best = can, next(iter(self.listed[kind][can, t])), kind, t
                    break
                most &= most - 1
        return best and best[1:]

    def _of_length(self, at: int, kind: int, t: int) -> list[int]:
        """Pieces of a bin that have t tokens together."""
        if not t:
            return []
        own = sorted(self.bins[at], key=lambda p: (self.lengths[p], p))
        if kind == 0:
            return [next(p for p in own if self.lengths[p] == t)]
        seen: dict[int, int] = {}
        for p in own:
            if t - self.lengths[p] in seen:
                return [seen[t - self.lengths[p]], p]
            seen[self.lengths[p]] = p
        raise AssertionError("a listed pair is there")

    def _give(self, at: int, own: list[int], kinds) -> bool:
        """Give pieces of a bin (that is not listed) to another one, if one takes them."""
        found = self._find(sum(self.lengths[p] for p in own), kinds)
        if found is None:
            return False
        to, kind, t = found
        back = self._of_length(to, kind, t)
        self._leave(to)
        for source, target, moved in ((at, to, own), (to, at, back)):
            for p in moved:
                self.bins[source].remove(p)
                self.bins[target].append(p)
                self.fill[source] -= self.lengths[p]
                self.fill[target] += self.lengths[p]
        if self.fill[to] < self.room:
            self._enter(to)
        return True

    def _empty(self, at: int) -> None:
        """Give away what can be given of a listed bin; each step leaves it with fewer tokens."""
        self._leave(at)
        given = True
        while given and self.bins[at]:
            own = sorted(self.bins[at], key=lambda p: (-self.lengths[p], p))
            given = any(self._give(at, [p], (0, 1)) for p in own)
            if not given:  # two for one
                sums = {self.lengths[p] + self.lengths[q]: [p, q] for i, p in enumerate(own) for q in own[i + 1:]}
                given = any(self._give(at, sums[n], (0,)) for n in sorted(sums, reverse=True) if n <= self.room)
        if self.bins[at]:
            self._enter(at)

    def search(self, goal: int) -> list[list[int]]:
        """The bins that are left: the emptiest are emptied while that goes on, down to ``goal`` bins."""
        left = sum(f > 0 for f in self.fill)
        for _ in range(PASSES):
            emptied, in_vain = 0, 0
            for at in sorted(range(len(self.bins)), key=lambda b: (self.fill[b], b)):
                if left <= goal or in_vain > PATIENCE:
                    break
                if 0 < self.fill[at] < self.room:
                    self._empty(at)
                    gone = not self.bins[at]
                    emptied, left, in_vain = emptied + gone, left - gone, 0 if gone else in_vain + 1
            if not emptied or left <= goal:
                break
        return [b for b in self.bins if b]


def pack_group(lengths: np.ndarray, bins: np.ndarray | None = None, room: int = ROOM) -> list[list[int]]:
    """Bins of piece numbers, from ``bins`` (a number for each piece) or from nothing."""
    plain = lengths.tolist()
    if bins is None:
        start = best_fit(plain, np.lexsort((np.arange(len(plain)), -lengths)).tolist(), room)
    else:
        order = np.argsort(bins, kind="stable")
        start = [part.tolist() for part in np.split(order, np.flatnonzero(np.diff(bins[order])) + 1)]
    goal = least_bins(lengths, room)
    return start if len(start) <= goal else Exchange(plain, start, room).search(goal)


# ---------------------------------------------------------------- jobs

def pack(sizes: DataFrame, room: int = ROOM) -> DataFrame:
    """place, sequence_id, offset of pieces (place: a distinct long; length: 1 to ``room``).

    A sequence has the smallest place of its pieces as its number. ``sizes`` is read more than once and
    should be stored.
    """
    schema = "place long, length long, bin long, offset long, fill long"

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place", ignore_index=True)
        lengths, places = group["length"].to_numpy(), group["place"].to_numpy()
        given = None if group["bin"].iloc[0] < 0 else group["bin"].to_numpy()
        found = pack_group(lengths, given, room)
        order = np.concatenate([np.sort(b) for b in found])
        of = np.repeat(np.arange(len(found)), [len(b) for b in found])
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        before = np.cumsum(lengths[order]) - lengths[order]
        return pd.DataFrame({
            "place": places[order], "length": lengths[order], "bin": places[order[starts]][of],
            "offset": before - before[starts][of], "fill": np.add.reduceat(lengths[order], starts)[of]})

    done = [sizes.where(F.col("length") == room).select(
        "place", F.col("place").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    open_ = sizes.where(F.col("length") < room).select("place", "length", F.lit(-1).cast("long").alias("bin"))
    groups = -(-open_.count() // GROUP_PIECES)
    by = "place"
    while groups:
        mine = F.pmod(F.xxhash64(by, F.lit(groups)), F.lit(groups))
        settled = staged(open_.groupBy(mine.alias("group")).applyInPandas(settle, schema), "packed")
        named = settled.select("place", F.col("bin").alias("sequence_id"), "offset", "bin", "length", "fill")
        if groups == 1:
            done.append(named.select("place", "sequence_id", "offset"))
            break
        # the emptiest sequences of all groups, as many as the next round's groups hold
        groups, by = -(-groups // FEWER), "bin"
        level, share = _emptiest(settled, groups * GROUP_PIECES, room)
        part = F.pmod(F.xxhash64("bin"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
        again = F.coalesce((F.col("fill") < level) | ((F.col("fill") == level) & part), F.lit(False))
        done.append(named.where(~again).select("place", "sequence_id", "offset"))
        open_ = settled.where(again).select("place", "length", "bin")
    return functools.reduce(DataFrame.union, done)


def _emptiest(settled: DataFrame, most: int, room: int) -> tuple[int, float]:
    """A fill below which open sequences have ``most`` pieces, and the share of those with that fill."""
    held = {r["fill"]: r["n"] for r in settled.where(F.col("fill") < room).groupBy("fill").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # a row for each possible fill at most
    for fill in sorted(held):
        if held[fill] > most:
            return fill, most / held[fill]
        most -= held[fill]
    return room, 0.0


def pack_documents(docs: DataFrame, room: int = ROOM) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    found = pieces(docs, room)
    return found.join(pack(found, room), "place").drop("place")


def sequences(docs: DataFrame, room: int = ROOM) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, ids as little-endian unsigned 32-bit integers."""
    found = pieces(docs, room, with_ids=True)
    placed = found.join(pack(found.select("place", "length"), room), "place")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # ``room`` ids at most
    return placed.groupBy("sequence_id").agg(F.aggregate(
        ordered, F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"))
