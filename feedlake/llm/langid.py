"""Language of a text by unigrams over the pieces of a public vocabulary, all segmentations summed.

A word is a run of letters in lower case behind a word mark. Under one language its probability is the
sum, over every way to cut it into pieces, of the product of the pieces' probabilities; the forward
algorithm adds these up from left to right, for all languages and for many words of one length at
once. The probabilities are learnt by expectation and maximisation over the corpus' distinct words
with their counts per language: posterior counts of pieces are summed in tasks, then over tasks; one
number per piece and language reaches the driver. A text's score is the posterior of its best language.

Results by case: a text that is null or has no letter is ``und`` with score 0, as is every text when
nothing could be learnt. Characters outside of the vocabulary count as the unknown piece. Runs of
more than WORD_LENGTH letters are read as several words. Rows without doc_id are not learnt from and
not held out. Repeated rows each count in learning. Equal posteriors go to the first language by name.
Of more than MOST_LANGUAGES values of lang the ones of most texts are learnt; the others' texts are still
given one of these.
An empty table gives no rows. Only doc_id, text and, for learning, lang are read.
"""

import functools
import math
import re
import uuid
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.frames import CACHES, bounded_batches, forget, staged, strings

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
UNDETERMINED = "und"
#: Letters of a word that are segmented together.
WORD_LENGTH = 64
ITERATIONS = 2
#: Added to each piece's count.
SMOOTHING = 0.05
#: Unknown characters share the unknown piece's probability among so many.
CHARACTERS = 1 << 16
#: Forward sums carry this factor per character, which keeps them within a double's range.
LIFT = math.exp(6.0)
#: Words a worker keeps (distinct ones with their scores, or with counts before they are sent on),
#: and words that it looks up at a time.
KEPT_WORDS, HELD_WORDS = 250_000, 100_000
#: Languages that are learnt at most, the ones of most texts: a model has a column for each.
MOST_LANGUAGES = 1000

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case, long ones cut."""
    words = _LETTERS.findall(text.lower())
    if len(text) > WORD_LENGTH and max(map(len, words), default=0) > WORD_LENGTH:
        words = [w[i:i + WORD_LENGTH] for w in words for i in range(0, len(w), WORD_LENGTH)]
    return words


def letter_pieces(path: str = VOCABULARY) -> list[str]:
    """Pieces that can be part of a marked word."""
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    fits = re.compile(rf"{MARK}?(?:[^\W\d_])*")
    return [p for p in pieces
            if p and fits.fullmatch(p) and p == p.lower()]


class Trie:
    """The pieces as tables, by which many words step along together.

    Characters of longer pieces have a class each, all others class 0; node 0 is nowhere. Piece
    ``unknown`` stands for one character that is no piece, ``none`` for no piece at all.
    """

    def __init__(self, pieces: tuple[str, ...]):
        self.unknown, self.none = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)
        places, alphabet, steps = {"": 0}, {}, []
        for piece in pieces:
            if len(piece) > 1:
                for end in range(1, len(piece) + 1):
                    if piece[:end] not in places:
                        places[piece[:end]] = len(places)
                        letter = alphabet.setdefault(piece[end - 1], len(alphabet) + 1)
                        steps.append((places[piece[:end - 1]], letter))
        kind = np.uint16 if len(places) < 1 << 16 else np.int32  # the table is nodes by letters
        self.first = np.zeros(len(alphabet) + 1, kind)
        self.next = np.zeros((len(places), len(alphabet) + 1), kind)
        for node, (before, letter) in enumerate(steps, 1):
            (self.next[before] if before else self.first)[letter] = node
        self.piece = np.full(len(places), self.none, np.int32)
        self.single = np.full(0x110000, self.unknown, np.int32)
        for i, piece in enumerate(pieces):
            if len(piece) > 1:
                self.piece[places[piece]] = i
            else:
                self.single[ord(piece)] = i
        self.letter = np.zeros(0x110000, np.int32)
        for character, k in alphabet.items():
            self.letter[ord(character)] = k


@functools.lru_cache(1)
def trie_of(pieces: tuple[str, ...]) -> Trie:
    return Trie(pieces)


class Lattice:
    """All pieces of words of one length: (start, end, piece ids), ends ascending."""

    def __init__(self, trie: Trie, words: list[str]):
        text = "".join(MARK + w for w in words).encode("utf-32-le")
        codes = np.frombuffer(text, np.uint32).reshape(len(words), -1)
        letters, self.length = trie.letter[codes], codes.shape[1]
        by_end = [[(end - 1, end, trie.single[codes[:, end - 1]])] for end in range(1, self.length + 1)]
        for start in range(self.length - 1):
            node = trie.first[letters[:, start]]
            for end in range(start + 2, min(self.length, start + trie.longest) + 1):
                node = trie.next[node, letters[:, end - 1]]
                if not node.any():
                    break
                ids = trie.piece[node]
                if (ids != trie.none).any():
                    by_end[end - 1].append((start, end, ids))
        self.edges = [edge for edges in by_end for edge in edges]


def forward(lattice: Lattice, chances: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of each beginning: (length + 1, words, languages).

    ``chances`` holds the probabilities by piece and language, with LIFT per character.
    """
    n = len(lattice.edges[0][2])
    sums = np.zeros((lattice.length + 1, n, chances.shape[1]))
    sums[0] = 1.0
    for start, end, ids in lattice.edges:
        sums[end] += sums[start] * chances[ids]
    return sums


def expected(lattice: Lattice, chances: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Posterior counts of pieces by language; ``counts`` has those of the words."""
    ahead = forward(lattice, chances)
    behind = np.zeros_like(ahead)
    behind[-1] = counts / np.maximum(ahead[-1], 1e-300)
    size, languages = chances.shape
    every, shares = [], []
    for start, end, ids in reversed(lattice.edges):
        step = chances[ids] * behind[end]
        behind[start] += step
        every.append(ids)
        shares.append(ahead[start] * step)
    every, shares = np.concatenate(every), np.concatenate(shares)
    return np.stack([np.bincount(every, shares[:, k], size) for k in range(languages)], axis=1)


@dataclass
class Model:
    """Languages, their log priors, the pieces, and probabilities by piece and language."""

    languages: list[str]
    priors: np.ndarray
    pieces: list[str]
    chances: np.ndarray  # rows: the pieces, the unknown one

    def lifted(self) -> np.ndarray:
        lengths = np.array([len(p) for p in self.pieces] + [1])
        table = self.chances * LIFT ** lengths[:, None]
        table[-1] /= CHARACTERS
        return np.vstack([table, np.zeros((1, len(self.languages)))])


def by_length(words) -> list[list[str]]:
    groups = defaultdict(list)
    for word in words:
        groups[len(word)].append(word)
    # memory goes with words times length
    return [g[i:i + 4096] for g in groups.values() for i in range(0, len(g), 4096)]


class Scorer:
    """Log likelihoods of texts, remembering those of words."""

    def __init__(self, model: Model):
        self.model, self.chances = model, model.lifted()
        self.trie = trie_of(tuple(model.pieces))
        self.known: dict[str, int] = {}
        self.scores = np.zeros((KEPT_WORDS, len(model.languages)), np.float64)

    def _learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > KEPT_WORDS:
            raise ValueError("more words at a time than are kept")
        for group in by_length(words):
            lattice = Lattice(self.trie, group)
            sums = forward(lattice, self.chances)[-1]
            start = len(self.known)
            self.scores[start:start + len(group)] = (
                np.log(np.maximum(sums, 1e-300)) - lattice.length * math.log(LIFT))
            self.known.update(zip(group, range(start, start + len(group))))

    def _places(self, words: list[str]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            fresh = {w for w, f in zip(words, found) if f is None}
            if len(self.known) + len(fresh) > KEPT_WORDS:
                self.known.clear()
                fresh = set(words)
            self._learn(fresh)
            found = list(map(self.known.__getitem__, words))
        return np.array(found, np.int64)

    def likelihoods(self, texts: list[list[str]]) -> np.ndarray:
        """Sums of the words' log likelihoods, by text and language."""
        out = np.zeros((len(texts), len(self.model.languages)))
        words = [w for text in texts for w in text]
        owner = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
        for i in range(0, len(words), HELD_WORDS):
            scores, at = self.scores[self._places(words[i:i + HELD_WORDS])], owner[i:i + HELD_WORDS]
            starts = np.flatnonzero(np.diff(at, prepend=-1))
            out[at[starts]] += np.add.reduceat(scores, starts, axis=0)
        return out

    def __call__(self, texts) -> list[list[float] | None]:
        """Posterior of each language, none for a text without a letter."""
        words = [words_of(t or "") for t in texts]
        odds = self.likelihoods(words) + self.model.priors
        odds -= odds.max(axis=1, keepdims=True)
        chances = np.exp(odds)
        chances /= chances.sum(axis=1, keepdims=True)
        return [line if w else None for line, w in zip(chances.tolist(), words)]


def word_counts(docs: DataFrame, languages: list[str]) -> DataFrame:
    """word, counts (by language): the distinct words of all texts; tasks add up before they send."""
    place = {name: k for k, name in enumerate(languages)}

    def count(batches):
        forget(__name__)
        counts = [Counter() for _ in languages]
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                if lang in place and text:
                    counts[place[lang]].update(words_of(text))
            if sum(map(len, counts)) > KEPT_WORDS:
                yield _rows(counts)
                counts = [Counter() for _ in languages]
        if any(counts):
            yield _rows(counts)

    def _rows(counts):
        return pd.DataFrame({
            "word": strings(w for c in counts for w in c), "k": [k for k, c in enumerate(counts) for _ in c],
            "n": [n for c in counts for n in c.values()]})

    rows = docs.select("lang", "text").mapInPandas(count, "word string, k int, n long")
    sums = [F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)) for k in range(len(languages))]
    return staged(rows.groupBy("word").agg(F.array(*sums).alias("counts")), "word-counts")


def maximise(words: DataFrame, model: Model) -> Model:
    """One round: posterior counts under the model become the next model's probabilities."""
    size = len(model.pieces) + 1
    sent = words.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        forget(__name__)
        chances = sent.value.lifted()
        trie = trie_of(tuple(sent.value.pieces))
        total, held = np.zeros_like(chances), {}

        def add():
            for group in by_length(held):
                counts = np.array([held[w] for w in group], np.float64)
                total[:] += expected(Lattice(trie, group), chances, counts)
            held.clear()

        for batch in batches:
            held.update(zip(batch["word"], batch["counts"]))
            if len(held) > HELD_WORDS:  # many words of a length make a step worth its while
                add()
        add()
        at, k = np.nonzero(total[:size])
        yield pd.DataFrame({"piece": at, "k": k, "n": total[at, k]})

    # rounded to parts in a million, so that sums do not depend on the order of tasks
    found = (words.mapInPandas(count, "piece int, k int, n double")
             .groupBy("piece", "k").agg(F.sum(F.round(F.col("n") * 1e6).cast("long")).alias("n"))).toPandas()
    counts = np.full((size, len(model.languages)), SMOOTHING)
    counts[found["piece"], found["k"]] += found["n"].to_numpy(np.float64) / 1e6
    return Model(model.languages, model.priors, model.pieces, counts / counts.sum(axis=0))


def learn(docs: DataFrame, vocabulary: str = VOCABULARY, iterations: int = ITERATIONS) -> Model | None:
    """A model from all texts with a language; the vocabulary's order gives the first guess."""
    bounded_batches(docs.sparkSession)
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    found = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not found:
        return None
    found.sort(key=lambda r: r["lang"])
    numbers = np.array([r["count"] for r in found], np.float64)
    pieces = letter_pieces(vocabulary)
    guess = np.append(1.0 / np.arange(10, len(pieces) + 10), 1e-3)
    chances = np.repeat((guess / guess.sum())[:, None], len(found), axis=1)
    model = Model([r["lang"] for r in found], np.log((numbers + 1) / (numbers.sum() + len(found))),
                  pieces, chances)
    words = word_counts(docs, model.languages)
    for _ in range(iterations):
        model = maximise(words, model)
    return model


_SCORERS: dict[str, Scorer] = {}
CACHES[__name__] += [_SCORERS.clear, trie_of.cache_clear]


def predictor(spark: SparkSession, model: Model | None):
    """A column function: the struct (lang_pred, score) of a text, computed once wherever it is used."""
    if model is None:
        return lambda text: F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if key not in _SCORERS:  # one model per worker at a time
            _SCORERS.clear()
            forget(__name__)
            _SCORERS[key] = Scorer(sent.value)
        names = sent.value.languages
        found = [(names[chances.index(max(chances))], max(chances)) if chances else (UNDETERMINED, 0.0)
                 for chances in _SCORERS[key](texts)]
        return pd.DataFrame({"lang_pred": strings(name for name, _ in found),
                             "score": np.array([score for _, score in found], np.float64)})

    # else a filter by the prediction is pushed below it with a copy, and both run at once, each in workers of its own
    return predict.asNondeterministic()


def remainder(doc_id: str | Column, parts: int = 3) -> Column:
    """crc32 of the id as text, by which documents are held out."""
    return F.crc32(F.col(doc_id).cast("string")) % parts


def detect(docs: DataFrame, parts: int = 3, hold: int | None = 1, vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows with ``held_out`` and ``language`` (lang_pred, score), learnt from those not held out.

    With ``hold`` None no row is held out and all that have a language teach, also those without doc_id.
    """
    kept_out = F.lit(False) if hold is None else remainder("doc_id", parts) == hold
    teaching = docs if hold is None else docs.where(~kept_out)
    model = learn(teaching.select("lang", "text"), vocabulary)
    predict = predictor(docs.sparkSession, model)
    return docs.withColumns({
        "held_out": F.coalesce(kept_out, F.lit(False)),
        "language": predict(F.col("text"))})
