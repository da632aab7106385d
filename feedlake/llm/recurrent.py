"""Texts scored by a gated recurrent language model, beside a unigram base.

Words are counted over all texts that may teach. The model knows the commonest ones; all others are
one word to it, inside of which the counts decide. The probability of a word is that of its class
times that of the word in its class, so a step needs a few dozen outputs instead of all. Training is
truncated backpropagation: lanes of documents run side by side, their states carry on from window to
window and start anew with each document, gradients stay within a window and are taken in each, so every
token of every text that may teach is in the loss once. Each task trains its own
copy on its documents; after each round the copies are averaged, weighted by their words. The state
carries through whole documents in scoring too, however long.

Counts are looked up in a table of the commonest words, bounded by KNOWN_WORDS, in the task; the rest
of a text's words, which grow with the corpus, are joined to the whole table.

Results by case: a null text counts as empty and is one end. A row without doc_id is scored, teaches
nothing and is not held out. Without any text to learn from all counts are 0. Repeated rows each
count, and each is scored. Equally frequent words come by their bytes. An empty table gives no rows.
Only doc_id and text are read.
"""

import functools
import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import bounded_batches, staged, strings

#: Words of the model, its classes and its state.
MODEL_WORDS, CLASSES, STATE = 2048, 45, 16
#: Words of the table that every task holds, and their longest in bytes.
KNOWN_WORDS, KNOWN_BYTES = 200_000, 64
#: Documents side by side, steps of a window; gradients are taken in every so many windows.
LANES, WINDOW, GRADIENT_EVERY = 256, 32, 1
#: Steps that are laid out at a time.
STRETCH = 8 * WINDOW
ROUNDS, RATE, CLIP = 2, 0.01, 5.0
#: Words that wait to be dealt to the lanes, and distinct ones counted before they are sent on.
HELD_WORDS, COUNTED_WORDS = 1 << 21, 300_000
#: Steps whose outputs are computed together in scoring.
OUTPUT_ROWS = 1 << 16
#: Those of them whose classes are computed at a time, so that they stay near the processor.
BLOCK = 1 << 11
ADDED = 0.1
END, OTHER = 0, 1


def tokens(text: str) -> list[bytes]:
    """Words in lower case; of bytes, so that only ASCII letters and blanks matter."""
    return text.encode().lower().split()


# ---------------------------------------------------------------- counts

def count_words(docs: DataFrame) -> DataFrame:
    """word, n over all texts; tasks add up before they send."""
    def count(batches):
        counts = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(tokens(text or ""))
            if len(counts) > COUNTED_WORDS:
                yield rows(counts)
                counts = Counter()
        if counts:
            yield rows(counts)

    def rows(counts):
        return pd.DataFrame({"word": strings(w.decode() for w in counts), "n": list(counts.values())})

    found = docs.select("text").mapInPandas(count, "word string, n long")
    return staged(found.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


@dataclass
class Vocabulary:
    """What the tasks know of the counts."""

    known: dict[bytes, int]  # the commonest words, most frequent first
    texts: int  # that taught: the count of the end
    words: int  # all that were counted
    distinct: int
    ids: dict[bytes, int]  # of the model's words, from 2 on
    counts: np.ndarray  # by id
    other_distinct: int

    @property
    def total(self) -> int:
        return self.words + self.texts

    def base(self, n: int) -> float:
        """log10 probability of a token with count n, ends among the tokens."""
        return math.log10((n + ADDED) / self.base_all)

    @functools.cached_property
    def base_all(self) -> float:
        return self.total + ADDED * (self.distinct + (self.texts > 0) + 1)

    @functools.cached_property
    def other_all(self) -> float:
        return self.counts[OTHER] + ADDED * (self.other_distinct + 1)


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """The commonest words, chosen by a threshold so that no task sorts them all."""
    level = F.floor(F.log2("n") * 16).cast("int")  # steps of 4 %
    short = counts.where(F.octet_length("word") <= KNOWN_BYTES)
    sizes = sorted(((r["level"], r["count"]) for r in short.groupBy(level.alias("level")).count().collect()),
                   reverse=True)
    least, held = math.inf, 0
    for at, size in sizes:
        held += size
        if held > KNOWN_WORDS:
            break
        least = at
    # at most KNOWN_WORDS rows of bounded length
    top = short.where(level >= least).collect() if sizes and least < math.inf else []
    ordered = sorted(((r["word"].encode(), r["n"]) for r in top), key=lambda x: (-x[1], x[0]))
    sums = counts.agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("distinct")).first()
    words, distinct = sums["words"] or 0, sums["distinct"]
    own = ordered[:MODEL_WORDS - 2]
    inside = np.array([n for _, n in own], np.float64)
    return Vocabulary(
        dict(ordered), texts, words, distinct, {w: i for i, (w, _) in enumerate(own, 2)},
        np.concatenate([[texts, words - inside.sum()], inside]), distinct - len(own))


# ---------------------------------------------------------------- model

@dataclass
class Weights:
    """Parameters; gates come in the order update, reset, candidate."""

    into: np.ndarray  # (words, 3 states), by the word that was read
    on: np.ndarray  # (state, 3 states)
    classes: np.ndarray  # (state, classes)
    class_bias: np.ndarray
    words: np.ndarray  # (words, state)
    word_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def like(self, flat: np.ndarray) -> "Weights":
        """Views into a flat array."""
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at:at + a.size].reshape(a.shape))
            at += a.size
        return Weights(*out)


class Classes:
    """Words sorted by frequency and cut where the sum of square roots passes equal shares."""

    def __init__(self, counts: np.ndarray):
        self.order = order = np.lexsort((np.arange(len(counts)), -counts))
        mass = np.sqrt(counts[order] + ADDED)
        share = np.cumsum(mass) / mass.sum()
        label = np.minimum((share - 0.5 * mass / mass.sum()) * CLASSES, CLASSES - 1).astype(np.int64)
        label = np.unique(label, return_inverse=True)[1]  # no class is empty
        self.of, self.members = np.empty(len(counts), np.uint16), []
        self.of[order] = label
        for k in range(label.max() + 1):
            self.members.append(order[label == k])
        self.place = np.empty(len(counts), np.int64)
        for members in self.members:
            self.place[members] = np.arange(len(members))


def first_weights(counts: np.ndarray, classes: Classes) -> Weights:
    """Biases say what the counts say; the rest is small and of fixed seed."""
    rng = np.random.default_rng(20)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    chance = (counts + ADDED) / (counts + ADDED).sum()
    by_class = np.bincount(classes.of, chance)
    return Weights(small(len(counts), 3 * STATE), small(STATE, 3 * STATE),
                   small(STATE, len(classes.members)) * 0.1, np.log(by_class).astype(np.float32),
                   small(len(counts), STATE) * 0.1, np.log(chance).astype(np.float32))


def run_window(w: Weights, state: np.ndarray, read: np.ndarray, fresh: np.ndarray) -> dict:
    """States of one window; ``fresh`` marks where a lane begins a document.

    Inside, lanes are the last axis, so that each gate is one stretch of memory. What comes
    out by step and lane is ``hidden``; the rest is kept for the gradients.
    """
    steps, lanes = read.shape
    s = STATE
    # update and reset by the logistic function, of what their exponential takes
    sign = np.repeat(np.float32([-1, -1, 1]), s)
    gates = np.ascontiguousarray((w.into * sign).take(read, axis=0).transpose(0, 2, 1))
    hidden, before, turned = (np.empty((steps, s, lanes), np.float32) for _ in range(3))
    keep, on_rows = (~fresh).astype(np.float32), np.ascontiguousarray((w.on * sign).T)
    h, on, move = state.T, np.empty((3 * s, lanes), np.float32), np.empty((s, lanes), np.float32)
    with np.errstate(over="ignore"):  # beyond the largest number: a gate of 0
        for t in range(steps):
            h = np.multiply(h, keep[t], out=before[t])
            np.matmul(on_rows, h, out=on)
            both, n = gates[t, :2 * s], gates[t, 2 * s:]
            both += on[:2 * s]
            np.exp(both, out=both)
            both += 1
            np.reciprocal(both, out=both)
            turned[t] = on[2 * s:]
            n += np.multiply(both[s:], turned[t], out=move)
            np.tanh(n, out=n)
            np.subtract(h, n, out=move)
            move *= both[:s]
            h = np.add(n, move, out=hidden[t])
    return {"gates": gates, "before": before, "turned": turned, "keep": keep,
            "hidden": np.ascontiguousarray(hidden.transpose(0, 2, 1))}


def _softmax(x: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of the wanted row in each column, and x as probabilities before they are divided by their sums."""
    x -= x.max(axis=0)
    there = x[wanted, np.arange(len(wanted))]
    np.exp(x, out=x)
    total = x.sum(axis=0)
    return there - np.log(total), total


def _slope(x: np.ndarray, total: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Gradient of the loss by what went into ``_softmax``."""
    x /= total
    x[wanted, np.arange(len(wanted))] -= 1
    return x


def outputs(w: Weights, classes: Classes, hidden: np.ndarray, target: np.ndarray, grad: Weights | None = None):
    """Log probabilities of the targets, and the gradient by the hidden states if ``grad`` takes the rest."""
    # rows in the order of their classes and as the last axis, so that sums run along memory
    wanted = classes.of[target]
    order = np.argsort(wanted, kind="stable")
    wanted, place = wanted[order], classes.place[target[order]]
    hidden = np.ascontiguousarray(hidden.take(order, axis=0).T)
    logs, back = np.empty(len(order)), np.empty_like(hidden) if grad is not None else None
    for start in range(0, len(order), BLOCK):
        at = slice(start, start + BLOCK)
        x = w.classes.T @ hidden[:, at]
        x += w.class_bias[:, None]
        logs[at], total = _softmax(x, wanted[at])
        if grad is not None:
            slope = _slope(x, total, wanted[at])
            grad.classes += hidden[:, at] @ slope.T
            grad.class_bias += slope.sum(axis=1)
            back[:, at] = w.classes @ slope
    tables, bias = w.words[classes.order], w.word_bias[classes.order, None]
    words, word_bias = np.zeros_like(tables), np.zeros_like(w.word_bias)
    cuts, end = np.searchsorted(wanted, np.arange(len(classes.members) + 1)), 0
    for k, members in enumerate(classes.members):
        own, at = slice(end, end + len(members)), slice(cuts[k], cuts[k + 1])
        end += len(members)
        if at.start == at.stop or len(members) == 1:
            continue
        x = tables[own] @ hidden[:, at]
        x += bias[own]
        inside, total = _softmax(x, place[at])
        logs[at] += inside
        if grad is not None:
            slope = _slope(x, total, place[at])
            words[own] = slope @ hidden[:, at].T
            word_bias[own] = slope.sum(axis=1)
            back[:, at] += tables[own].T @ slope
    out = np.empty_like(logs)
    out[order] = logs
    if grad is None:
        return out, None
    grad.words[classes.order] += words
    grad.word_bias[classes.order] += word_bias
    by_row = np.empty((len(order), STATE), np.float32)
    by_row[order] = back.T
    return out, by_row


def back_through(w: Weights, kept: dict, read: np.ndarray, back: np.ndarray, grad: Weights) -> None:
    """Gradients of one window, from its last step to its first; ``back`` is by step and lane."""
    steps, lanes = read.shape
    s = STATE
    back = np.ascontiguousarray(back.transpose(0, 2, 1))
    z, r, n = (kept["gates"][:, k * s:(k + 1) * s] for k in range(3))
    h = kept["before"]
    by_update, by_reset, inside = (h - n) * z * (1 - z), kept["turned"] * r * (1 - r), (1 - z) * (1 - n * n)
    moves, by_state = (np.empty((steps, 3 * s, lanes), np.float32) for _ in range(2))
    carried = np.zeros((s, lanes), np.float32)
    for t in range(steps - 1, -1, -1):
        carried += back[t]
        move, own = moves[t], by_state[t]
        dn = np.multiply(carried, inside[t], out=move[2 * s:])
        np.multiply(carried, by_update[t], out=move[:s])
        np.multiply(dn, by_reset[t], out=move[s:2 * s])
        own[:2 * s] = move[:2 * s]
        np.multiply(dn, r[t], out=own[2 * s:])
        carried *= z[t]
        carried += w.on @ own
        carried *= kept["keep"][t]
    grad.on += np.matmul(h, by_state.transpose(0, 2, 1)).sum(axis=0)
    words = read.ravel()
    for k in range(3 * s):
        grad.into[:, k] += np.bincount(words, moves[:, k].ravel(), len(grad.into))


# ---------------------------------------------------------------- lanes

def lanes_of(lengths: list[int]) -> list[list[int]]:
    """Documents dealt to lanes, the longest first, each to the shortest lane."""
    heap = [(0, k) for k in range(min(LANES, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    for doc in sorted(range(len(lengths)), key=lambda d: -lengths[d]):
        size, lane = heapq.heappop(heap)
        out[lane].append(doc)
        heapq.heappush(heap, (size + lengths[doc], lane))
    return out


def windows(docs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """(read, target, fresh, doc) by step and lane. A document is its ids and the end.

    ``fresh`` marks where a document begins, ``doc`` is -1 where a lane is through. The longest lanes
    come first, so lanes that end leave a shorter head of them.
    """
    lanes = sorted(lanes_of([len(d) + 1 for d in docs]), key=lambda lane: -sum(len(docs[d]) + 1 for d in lane))
    tapes = []
    for lane in lanes:
        target = np.concatenate([np.append(docs[d], END) for d in lane]).astype(np.int64)
        tapes.append((target, np.repeat(lane, [len(docs[d]) + 1 for d in lane])))
    last, before = np.zeros(len(tapes), np.int64), np.full(len(tapes), -1)
    for start in range(0, len(tapes[0][0]), STRETCH):
        steps = -(-min(STRETCH, len(tapes[0][0]) - start) // WINDOW) * WINDOW
        active = sum(len(t) > start for t, _ in tapes)
        target, doc = np.zeros((steps, active), np.int64), np.full((steps, active), -1)
        for lane, (t, o) in enumerate(tapes[:active]):
            n = min(steps, len(t) - start)
            target[:n, lane], doc[:n, lane] = t[start:start + n], o[start:start + n]
        read = np.concatenate([last[None, :active], target[:-1]])
        fresh = doc != np.concatenate([before[None, :active], doc[:-1]])
        read[fresh] = END
        last, before = target[-1], doc[-1]
        for at in range(0, steps, WINDOW):
            yield tuple(x[at:at + WINDOW] for x in (read, target, fresh, doc))


def states(w: Weights, docs: list[np.ndarray]) -> Iterator[tuple]:
    """Each window with its states, which go on from the window before."""
    state = np.zeros((LANES, STATE), np.float32)
    for read, target, fresh, doc in windows(docs):
        kept = run_window(w, state[:read.shape[1]], read, fresh)
        state = kept["hidden"][-1]
        yield kept, read, target, doc


class Trainer:
    """One task's copy of the model."""

    def __init__(self, weights: Weights, classes: Classes):
        self.flat = weights.flat().astype(np.float32)
        self.w, self.classes = weights.like(self.flat), classes
        self.mean, self.square = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.slope, self.part = np.zeros_like(self.flat), np.empty_like(self.flat)
        self.grad = weights.like(self.slope)
        self.updates, self.seen, self.turn = 0, 0, 0

    def learn(self, docs: list[np.ndarray]) -> None:
        for kept, read, target, doc in states(self.w, docs):
            self.turn += 1
            if self.turn % GRADIENT_EVERY == 0 and (doc >= 0).any():
                self._step(kept, read, target, doc >= 0)

    def _step(self, kept, read, target, there) -> None:
        at = np.flatnonzero(there.ravel())
        hidden = kept["hidden"].reshape(-1, STATE)
        self.slope[:] = 0
        _, back = outputs(self.w, self.classes, hidden[at], target.ravel()[at], self.grad)
        whole = np.zeros_like(hidden)
        whole[at] = back
        back_through(self.w, kept, read, whole.reshape(*read.shape, STATE), self.grad)
        slope = self.slope
        slope /= len(at)
        length = float(np.sqrt(slope @ slope))
        if length > CLIP:
            slope *= CLIP / length
        self.updates += 1
        self.seen += len(at)
        part = np.subtract(slope, self.mean, out=self.part)
        part *= 0.1
        self.mean += part
        np.multiply(slope, slope, out=part)
        part -= self.square
        part *= 0.01
        self.square += part
        step = RATE * math.sqrt(1 - 0.99 ** self.updates) / (1 - 0.9 ** self.updates)
        np.sqrt(self.square, out=part)
        part += 1e-8
        np.divide(self.mean, part, out=part)
        part *= step
        self.flat -= part


def likelihoods(w: Weights, classes: Classes, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document under the model, the end included."""
    out, held, size = np.zeros(len(docs)), [], 0

    def add():
        hidden, target, owner = (np.concatenate(part) for part in zip(*held))
        logs, _ = outputs(w, classes, hidden, target)
        out[:] += np.bincount(owner, logs, len(docs))
        held.clear()

    for kept, _, target, doc in states(w, docs):
        at = np.flatnonzero(doc.ravel() >= 0)
        if len(at):
            held.append((kept["hidden"].reshape(-1, STATE)[at], target.ravel()[at], doc.ravel()[at]))
            size += len(at)
        if size >= OUTPUT_ROWS:  # each class is worth its call
            add()
            size = 0
    if held:
        add()
    return out


# ---------------------------------------------------------------- jobs

#: Numbers of the model that travel together when copies are averaged.
PART = 1 << 13


def train(docs: DataFrame, words: Vocabulary) -> tuple[Weights, Classes]:
    """Rounds of training in all tasks, each on its share of the documents, and averaging."""
    classes = Classes(words.counts)
    weights = first_weights(words.counts, classes)
    spark = docs.sparkSession
    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast((weights, classes, words.ids))

        def learn(batches):
            weights, classes, ids = sent.value
            trainer, held, size = Trainer(weights, classes), [], 0
            for batch in batches:
                for text in batch["text"]:
                    held.append(np.array([ids.get(t, OTHER) for t in tokens(text or "")], np.uint16))
                    size += len(held[-1]) + 1
                    if size >= HELD_WORDS:
                        trainer.learn(held)
                        held, size = [], 0
            if held:
                trainer.learn(held)
            if trainer.seen:
                salt = uuid.uuid4().int % 64
                for part, at in enumerate(range(0, len(trainer.flat), PART)):
                    total = trainer.flat[at:at + PART].astype(np.float64) * trainer.seen
                    yield pd.DataFrame({"part": [part], "salt": [salt], "seen": [trainer.seen],
                                        "total": pd.Series([total.tobytes()], dtype=object)})

        schema = "part int, salt int, seen long, total binary"

        def add(group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(t, np.float64) for t in group["total"])
            return pd.DataFrame({"part": group["part"][:1], "salt": [0], "seen": [group["seen"].sum()],
                                 "total": pd.Series([total.tobytes()], dtype=object)})

        turn = docs.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == r).select("text")
        copies = turn.mapInPandas(learn, schema)
        sums = (copies.groupBy("part", "salt").applyInPandas(add, schema)
                .groupBy("part").applyInPandas(add, schema).orderBy("part").collect())
        if sums:
            flat = np.concatenate([np.frombuffer(s["total"], np.float64) / s["seen"] for s in sums])
            weights = weights.like(flat.astype(np.float32))
    return weights, classes


SCORED = ("doc_id string, n_tokens long, n_known long, base double, score double, "
          "rare array<string>, times array<long>")


def score(docs: DataFrame, parts: int = 10, hold: int = 0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Scores are log10 probabilities of the whole text.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string")) % parts
    teaching = docs.where(remainder != hold).select("text")
    counts = count_words(teaching)
    words = vocabulary(counts, teaching.count())
    weights, classes = train(teaching.select(F.coalesce("text", F.lit("")).alias("text")), words)
    sent = spark.sparkContext.broadcast((weights, classes, words))

    def judge(batches):
        weights, classes, words = sent.value
        place = {w: i for i, w in enumerate(words.known)}.get
        counts = np.array([*words.known.values(), 0], np.float64)  # the last: not in the table
        base = np.log10((counts + ADDED) / words.base_all)
        inside = np.log10((counts + ADDED) / words.other_all)
        own = len(words.ids)  # the commonest come first: ids 2 and on
        inside[:own] = base[-1] = inside[-1] = 0.0
        end, held, rows, size = words.base(words.texts), [], [], 0

        def flush():
            logs = likelihoods(weights, classes, held) / math.log(10)
            out = pd.DataFrame(rows, columns=["doc_id", "n_tokens", "n_known", "base", "score", "rare", "times"])
            out["score"] += logs
            out["doc_id"] = out["doc_id"].astype(object)
            return out

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = tokens(text or "")
                at = np.array([place(t, -1) for t in found], np.int64)
                held.append(np.where((at >= 0) & (at < own), at + 2, OTHER).astype(np.uint16))
                rare = Counter(found[i] for i in np.flatnonzero(at < 0).tolist())
                rows.append((
                    doc_id, len(found) + 1, int((at >= 0).sum()) + (words.texts > 0),
                    end + float(base[at].sum()), float(inside[at].sum()),
                    [w.decode() for w in rare], list(rare.values())))
                size += len(found) + 1
                if size >= HELD_WORDS:
                    yield flush()
                    held, rows, size = [], [], 0
        if held:
            yield flush()

    scored = staged(docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(judge, SCORED)
                    .withColumn("row", F.monotonically_increasing_id()), "scored")
    each = (scored.where(F.size("rare") > 0)
            .select("row", F.explode(F.arrays_zip("rare", "times")).alias("r"))
            .select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times")))
    looked_up = each.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    of = lambda whole: F.sum(F.col("times") * F.log10((F.col("n") + ADDED) / F.lit(whole)))
    rare = looked_up.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        of(float(words.base_all)).alias("more_base"), of(float(words.other_all)).alias("more_score"))
    doc_id = F.col("doc_id").cast("long")
    return scored.join(rare, "row", "left").select(
        doc_id.alias("doc_id"),
        F.coalesce(F.crc32("doc_id") % parts == hold, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
