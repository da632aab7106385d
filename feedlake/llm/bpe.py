"""Byte-level BPE: a sentencepiece model written straight from a rank file, and its inverse.

Each vocabulary entry becomes one piece: its bytes, each as one printable character, with the
negative rank as score, so that the best-scored merge is the merge of lowest rank. The model has
identity normalisation and no white-space handling. Texts are cut into pre-tokens by the
vocabulary's pattern; each pre-token is encoded on its own.

Results by case: a null or empty text has no ids. A pre-token that is itself an entry is that
entry, as in the tiktoken library. Rows are independent: ties, repeats and nulls elsewhere change
nothing. A column of the output's name is replaced.
"""

import base64
import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.frames import CACHES, bounded_batches, forget

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Pre-tokens a worker remembers, and the longest (in characters) that it does.
CACHE_ENTRIES = 400_000
CACHE_LENGTH = 32
#: Characters of text that are cut into pre-tokens at a time, unless one text is longer.
HELD_CHARACTERS = 1 << 19


def read_ranks(path: str) -> dict[bytes, int]:
    """Entries of a rank file: base64 of the bytes, blank, rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, lines)}


def byte_characters() -> str:
    """One printable character for each byte: itself where Latin-1 prints it, else from U+0100 on."""
    out, spare = [], 0x100
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return "".join(out)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; the unknown piece comes last.

    Field numbers are those of the public sentencepiece_model.proto.
    """
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2 and so on")
    letters = byte_characters()
    pieces = []
    for entry in sorted(ranks, key=ranks.get):
        text = "".join(letters[b] for b in entry).encode()
        score = b"\x15" + struct.pack("<f", -ranks[entry])  # field 2, 32 bits
        pieces.append(_block(1, _block(1, text) + score + _number(3, 1)))
    pieces.append(_block(1, _block(1, b"<unk>") + _number(3, 2)))
    none = (1 << 64) - 1  # -1: no such piece
    trainer = (_number(3, 2) + _number(4, len(pieces)) + _number(40, len(ranks))
               + b"".join(_number(field, none) for field in (41, 42, 43)))
    normalizer = _block(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(pieces) + _block(2, trainer) + _block(3, normalizer)


def differing_classes() -> dict[str, str]:
    """Code points that the regex module counts as letters or numbers, but tiktoken does not.

    Both follow Unicode, of different years. As ranges, for use in a character class.
    """
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    alphabet, out = {bytes([b]): b for b in range(256)}, {}
    for name in (r"\p{L}", r"\p{N}"):
        there = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=alphabet, special_tokens={})
        known = set(bytes(there.encode_ordinary(everything)).decode())
        points = sorted(ord(c) for c in set(regex.findall(name, everything)) ^ known)
        ranges = []
        for p in points:
            if ranges and ranges[-1][1] == p - 1:
                ranges[-1][1] = p
            else:
                ranges.append([p, p])
        out[name] = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
    return out


class Splitter:
    """Pre-tokens of a text, as tiktoken cuts them."""

    def __init__(self, pattern: str, differing: dict[str, str]):
        self.plain = regex.compile(pattern).findall
        self.exact, self.rare = self.plain, None
        if any(differing.values()):
            first = min(int(x, 16) for d in differing.values() for x in re.findall(r"U(\w{8})", d))
            self.rare = regex.compile(f"[\\U{first:08x}-\\U0010ffff]").search
            self.exact = regex.compile(_without(pattern, differing), regex.V1).findall

    def __call__(self, text: str) -> list[str]:
        return self.exact(text) if self.rare and self.rare(text) else self.plain(text)


def _without(pattern: str, differing: dict[str, str]) -> str:
    """The pattern with narrower classes, each a set difference."""
    for name, ranges in differing.items():
        if ranges:
            pattern = pattern.replace(name, f"[{name}--[{ranges}]]")
    return pattern


class Codec:
    """Encodes pre-tokens with the serialised model, remembering the short ones."""

    def __init__(self, model: bytes, pattern: str, differing: dict[str, str]):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = Splitter(pattern, differing)
        letters = byte_characters()
        self.to_letters = {b: ord(c) for b, c in enumerate(letters)}
        from_letters = {ord(c): b for b, c in enumerate(letters)}
        size = self.processor.get_piece_size() - 1
        self.pieces = [self.processor.id_to_piece(i).translate(from_letters).encode("latin-1")
                       for i in range(size)]
        self.ranks = {piece: i for i, piece in enumerate(self.pieces)}
        self.known: dict[str, bytes] = {}

    def learn(self, tokens: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens as little-endian unsigned 32-bit integers; the short ones are kept."""
        if not tokens:
            return {}
        raw = [token.encode() for token in tokens]
        merged = self.processor.encode(
            [r.decode("latin-1").translate(self.to_letters) for r in raw], num_threads=1)
        whole = self.ranks.get
        packed = {}
        for token, r, ids in zip(tokens, raw, merged):
            entry = whole(r)
            packed[token] = (struct.pack(f"<{len(ids)}I", *ids) if entry is None
                             else entry.to_bytes(4, "little"))
        if len(self.known) + len(packed) > CACHE_ENTRIES:
            self.known.clear()
        self.known.update((t, p) for t, p in packed.items() if len(t) <= CACHE_LENGTH)
        return packed

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; what is new to the cache is encoded in one call."""
        found = []
        split = [self.split(text) for text in texts]
        for tokens in split:
            found.append(list(map(self.known.get, tokens)))
        fresh = self.learn(list({
            t for tokens, packed in zip(split, found) if None in packed
            for t, ids in zip(tokens, packed) if ids is None}))
        return [b"".join(packed if None not in packed else
                         [fresh[t] if ids is None else ids for t, ids in zip(tokens, packed)])
                for tokens, packed in zip(split, found)]

    def encode_all(self, texts) -> Iterator[bytes]:
        """As encode, for few characters at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= HELD_CHARACTERS:
                yield from self.encode(held)
                held, size = [], 0
        yield from self.encode(held)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(2)
def _codec(model: bytes, pattern: str, differing: tuple) -> Codec:
    forget(__name__)
    return Codec(model, pattern, dict(differing))


CACHES[__name__].append(_codec.cache_clear)


@functools.cache
def _model(path: str) -> bytes:
    return serialise_model(read_ranks(path))


@functools.cache
def _differing() -> tuple:
    return tuple(differing_classes().items())


class Tokenizer:
    """Encoding and decoding of columns.

    The vocabulary is read on the driver; its model, bounded by the vocabulary, goes to the
    executors as a broadcast variable.
    """

    def __init__(self, spark: SparkSession, path: str = VOCABULARY,
                 pattern: str = public_tokenizers.PATTERN):
        bounded_batches(spark)
        model, differing = spark.sparkContext.broadcast(_model(path)), _differing()

        @F.pandas_udf("binary")
        def encode(texts: pd.Series) -> pd.Series:
            codec = _codec(model.value, pattern, differing)
            return pd.Series(list(codec.encode_all(t or "" for t in texts)), dtype=object)

        @F.pandas_udf("binary")
        def decode(ids: pd.Series) -> pd.Series:
            codec = _codec(model.value, pattern, differing)
            return pd.Series([codec.decode(i or b"") for i in ids], dtype=object)

        self._encode, self._decode = encode, decode

    def encode(self, df: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        """Add the ids of a text as packed little-endian unsigned 32-bit integers."""
        return df.withColumn(ids, self._encode(F.col(text)))

    def decode(self, df: DataFrame, ids: str = "ids", to: str = "decoded") -> DataFrame:
        """Add the bytes that packed ids stand for."""
        return df.withColumn(to, self._decode(F.col(ids)))


def n_ids(ids: str = "ids") -> Column:
    """How many ids a packed column holds."""
    return (F.octet_length(ids) / 4).cast("long")
