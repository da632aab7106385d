"""Periodic runs of words, found from seeds on diagonals, and texts with the repetitions taken out.

A run is a stretch of words with smallest period q (words q apart are identical) of at least ``LEAST``
words and three periods, that no neighbouring word extends. On the diagonal of lag q, where words i and
i + q are compared, it is a stretch of at least max(LEAST - q, 2 q) matches. For lags from Q up to 2 Q that
is 2 Q or more, so it holds a gram of Q words that begins at a multiple of Q: these grams are the seeds, for
Q = 8 (these serve the lags below 8 as well), 16, 32 and so on. A seed is compared with the grams of the same document
that begin a lag later, by their rolling hashes, n comparisons in all for n words and one Q. Each pair that
agrees is extended to both sides by bisection over the hashes, unless it lies in a run known from a smaller
lag, or the table of the furthest word covered on its lag says that an earlier seed has led there. Stretches
of one place and several lags are one run with the smallest; its words are compared once more themselves,
so that no result rests on a hash.

Documents lie behind each other in one array, with words of their own between them, which no run can hold;
so short ones share each step. Work is n log n for n words whatever they are, also for one word repeated,
and memory goes with the longest text.

Results by case: a null text is one without words. A row without doc_id has no decimal id, and keeps its
words as they are. Repeated rows give repeated results. Of runs of equal exponent the one that starts first,
then that of the smaller period, is the greatest; the exponents are compared as fractions. An empty table
gives no rows. Only doc_id and text are read; columns of any other name are ignored.
"""

import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import bounded_batches, strings

#: Words and periods that a run has at least.
LEAST, PERIODS = 24, 3
#: Lags below which the first seeds serve; a match on a lag below it is 16 words or longer.
FIRST = 8
#: Words whose runs are looked for together, unless one document is longer; seed pairs held at a time.
HELD_WORDS, HELD_PAIRS = 1 << 18, 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks."""
    return (text or "").encode().split()


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, of a tenth of the ids with a tail that repeats a stretch of itself."""
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if not n or h is None or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


class Grams:
    """Rolling hashes of an array: any two stretches of one length can be compared at once."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers = np.empty(n + 1, np.uint64)
        powers[0] = 1
        powers[1:] = _ODD
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers[:n], out=self.sums[1:])
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        powers[1:] = inverse
        np.multiply.accumulate(powers, out=powers)
        self.inverse, self.n = powers, n

    def at(self, start, size):
        """Hash of the ``size`` values from ``start`` on."""
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]


def _reach(grams: Grams, a: np.ndarray, lag: np.ndarray, ahead: bool) -> np.ndarray:
    """How many values agree with those a lag later, from place a on or, not ``ahead``, before it."""
    low = np.zeros(len(a), np.int64)
    high = grams.n - a - lag if ahead else a.copy()
    while (open_ := low < high).any():
        middle = (low + high + 1) // 2
        start = a if ahead else a - middle
        same = grams.at(start, middle) == grams.at(start + lag, middle)
        low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
    return low


def _extended(grams: Grams, a: np.ndarray, lag: np.ndarray, covered: dict[int, int]) -> np.ndarray:
    """Rows (start, end, lag) of the stretches through the seed pairs; ``covered`` is the table by lag.

    Of the seeds of a lag that are not covered yet, the first one, then the next two, four and so on are extended
    together, so that neither one long stretch nor many short ones on a lag take many steps.
    """
    order = np.lexsort((a, lag))
    a, lag = a[order], lag[order]
    reached = np.array([covered.get(q, 0) for q in lag.tolist()], np.int64)
    found, together = [], 1
    while len(a):
        open_ = a >= reached
        a, lag, reached = a[open_], lag[open_], reached[open_]
        firsts = np.flatnonzero(np.diff(lag, prepend=-1))
        sizes = np.diff([*firsts, len(a)])
        taken = np.arange(len(a)) - np.repeat(firsts, sizes) < together
        at, q = a[taken], lag[taken]
        left, right = _reach(grams, at, q, False), _reach(grams, at, q, True)
        found.append(np.stack([at - left, at + right + q, q], axis=1))
        if len(at):
            last = np.flatnonzero(np.diff(q, append=-1))  # the furthest of each lag
            covered.update(zip(q[last].tolist(), (at + right)[last].tolist()))
            reached = np.repeat((at + right)[last], sizes)
        a, lag, reached, together = a[~taken], lag[~taken], reached[~taken], 2 * together
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def _within(known: np.ndarray, a: np.ndarray, lag: np.ndarray, size: int) -> np.ndarray:
    """Which seed pairs lie in a known run whose period divides their lag: they lead to that run again."""
    if not len(known):
        return np.zeros(len(a), bool)
    known = known[np.argsort(known[:, 0], kind="stable")]
    furthest = np.maximum.accumulate(known[:, 1])
    best = np.maximum.accumulate(np.where(known[:, 1] == furthest, np.arange(len(known)), 0))
    at = np.searchsorted(known[:, 0], a, side="right") - 1
    run = known[best[np.maximum(at, 0)]]
    return (at >= 0) & (run[:, 1] >= a + lag + size) & (lag % run[:, 2] == 0)


def stretches(values: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, end, lag) of stretches with LEAST words and PERIODS lags at least, for lags up to ``longest``."""
    grams, n = Grams(values), len(values)
    known = np.empty((0, 3), np.int64)
    low = 1
    while low <= longest and n > low:
        size = max(FIRST, low)  # of the grams; lags are from ``low`` to 2 * low - 1
        if n <= size:
            break
        hashes = grams.at(np.arange(n - size + 1), size)
        anchors, lags = np.arange(0, len(hashes), size), np.arange(low, min(2 * low, longest + 1))
        covered: dict[int, int] = {}
        fresh = []
        step = max(1, HELD_PAIRS // len(lags))
        for k in range(0, len(anchors), step):
            at = anchors[k:k + step]
            for j in range(0, len(lags), HELD_PAIRS):
                there = at[:, None] + lags[j:j + HELD_PAIRS]
                same = hashes[np.minimum(there, len(hashes) - 1)] == hashes[at][:, None]
                row, column = np.nonzero(same & (there < len(hashes)))
                a, q = at[row], lags[j + column]
                new = ~_within(known, a, q, size)
                if new.any():
                    rows = _extended(grams, a[new], q[new], covered)
                    fresh.append(rows[rows[:, 1] - rows[:, 0] >= np.maximum(LEAST, PERIODS * rows[:, 2])])
        known = np.concatenate([known, *fresh])
        low *= 2
    return known


def _is_run(words: list[bytes], start: int, end: int, q: int) -> bool:
    return (words[start:end - q] == words[start + q:end]
            and (start == 0 or words[start - 1] != words[start + q - 1])
            and (end == len(words) or words[end] != words[end - q]))


def _compared(words: list[bytes], lags: list[int]) -> list[Run]:
    """Runs by comparing all words on some lags: for texts whose hashes agree without their words."""
    ids = np.unique(np.array(words, object), return_inverse=True)[1]
    found = {}
    for q in sorted(lags, reverse=True):
        edge = np.diff(np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(np.int8))
        for start, end in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + q):
            if end - start >= max(LEAST, PERIODS * q):
                found[int(start), int(end)] = q
    return sorted((s, e - s, q) for (s, e), q in found.items())


def runs(documents: list[list[bytes]]) -> list[list[Run]]:
    """Runs of each document, by start and then period."""
    longest = max((len(d) for d in documents), default=0) // PERIODS
    out: list[list[Run]] = [[] for _ in documents]
    if not longest:
        return out
    codes = np.empty(sum(len(d) + 1 for d in documents), np.int64)
    starts, at = [], 0
    for k, words in enumerate(documents):
        starts.append(at)
        codes[at:at + len(words)] = np.fromiter(map(hash, words), np.int64, len(words))
        codes[at + len(words)] = hash(("end", k))
        at += len(words) + 1
    found = stretches(codes.view(np.uint64), longest)
    of = np.searchsorted(starts, found[:, 0], side="right") - 1
    order = np.lexsort((-found[:, 2], of))
    for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1) if len(found) else ():
        k = of[part[0]]
        own, mine = documents[k], {}
        here = found[part] - [starts[k], starts[k], 0]
        for s, e, q in here.tolist():
            mine[s, e] = q  # of one place the smallest lag stays
        if all(e <= len(own) and _is_run(own, s, e, q) for (s, e), q in mine.items()):
            out[k] = sorted((s, e - s, q) for (s, e), q in mine.items())
        else:  # hashes that differ have words that differ, so no lag is missing but multiples of others
            most = len(own) // PERIODS
            out[k] = _compared(own, sorted({m for q in set(here[:, 2].tolist()) for m in range(q, most + 1, q)}))
    return out


def greatest(found: list[Run]) -> Run | None:
    """The run of the greatest length / period; of equal ones the first, then of the smallest period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapsed(words: list[bytes], found: list[Run]) -> bytes:
    """The words that are not behind the first period of any run, joined by a blank."""
    if not found:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in found:
        edge[start + q] += 1
        edge[start + length] -= 1
    kept = np.cumsum(edge[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


FOUND = ("n_runs long, start long, length long, period long, exponent_milli long, "
         "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def scan(docs: DataFrame, repeat_tails: bool = False) -> DataFrame:
    """doc_id, n_runs, the greatest run's start, length, period and exponent_milli, runs, collapsed.

    ``runs`` lists all by start and period, ``collapsed`` is the text without repetitions. ``repeat_tails``
    has the words of some ids repeated first (``repeated``), which plants runs of known shape.
    """
    bounded_batches(docs.sparkSession)
    names = [f.split(":")[0].split()[0] for f in FOUND.split(", ")][:5]

    def rows(ids, documents):
        out = []
        for doc_id, words, found in zip(ids, documents, runs(documents)):
            best = greatest(found)
            values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            out.append((doc_id, len(found), *values,
                        [{"start": s, "length": n, "period": q} for s, n, q in found],
                        collapsed(words, found).decode()))
        table = pd.DataFrame(out, columns=["doc_id", *names, "runs", "collapsed"], dtype=object)
        return table.astype({"n_runs": "int64"} | dict.fromkeys(names[1:], "Int64"))

    def find(batches):
        ids, held, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                number = None if doc_id is None else int(doc_id)
                words = words_of(text)
                ids.append(doc_id)
                held.append(repeated(words, number) if repeat_tails else words)
                size += len(words) + 1
                if size >= HELD_WORDS:
                    yield rows(ids, held)
                    ids, held, size = [], [], 0
        if ids:
            yield rows(ids, held)

    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(find, f"doc_id string, {FOUND}")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def runs_text(found: str = "runs"):
    """``start,length,period`` of every run, a line each."""
    return F.array_join(F.transform(found, lambda r: F.concat(F.concat_ws(
        ",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
