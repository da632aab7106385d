import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from feedlake.llm import packing
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def held(rows):
    """Pieces by sequence, in order; each sequence is gapless from 0 and fits."""
    out = defaultdict(list)
    for r in rows:
        out[r["sequence_id"]].append(r)
    for members in out.values():
        members.sort(key=lambda r: r["offset"])
        at = 0
        for r in members:
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.ROOM
    return out


def expected_pieces(docs, reference):
    out = []
    for doc_id, text, *_ in docs:
        ids = [*reference(text), packing.END]
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))
            out.append((doc_id, k, a, b - a, crc))
    return sorted(out, key=str)


def test_ids_are_those_of_the_library(reference):
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "\t ", "a", "'s", "'LL", "bé", "1", "!?", "\xa0", "　", "\x1c", "\x85", "<|endoftext|>",
            "𝔘", "٣", "​", "word", "ß×÷", "ſ", "\x00"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(t for t in rng.choices(bits, k=30) if max(t) <= "\xff") for _ in range(3000)]
    encode = packing.Encoder(open(packing.VOCABULARY, encoding="utf-8").read())
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == reference(text), text


def test_pieces_and_sequences(docs, odd, reference):
    rng = random.Random(2)
    rows = [*ODD] + [(100 + i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=rng.randrange(1, 900))))
                     for i in range(150)]
    got = packing.pack_documents(docs(*rows)).collect()
    assert sorted((tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got),
                  key=str) == expected_pieces(rows, reference)
    for rows in (got, packing.pack_documents(odd).collect()):
        lengths = np.array([r["length"] for r in rows])
        least = (lengths == 1024).sum() + packing.least_bins(lengths[lengths < 1024])
        assert least <= len(held(rows)) <= least + len(rows) // 50


def test_sequences_hold_the_ids(docs, reference):
    rows = [(i, f"text number {i} " * (i % 90)) for i in range(60)] + [(None, None), (5, "again")]
    got = [np.frombuffer(r["ids"], "<u4").tolist() for r in packing.sequences(docs(*rows)).collect()]
    assert all(len(s) <= 1024 for s in got)
    assert sum(s.count(packing.END) for s in got) == len(rows)
    wanted = sorted(tuple(reference(t)) for _, t in rows if len(reference(t)) < 1024)
    found = []
    for ids in got:
        while packing.END in ids:
            cut = ids.index(packing.END)
            found.append(tuple(ids[:cut]))
            ids = ids[cut + 1:]
    assert set(wanted) <= set(found) or len(wanted) != len(rows)


def fewest(lengths, room):
    """By trying all, for a handful of pieces."""
    best = [len(lengths)]

    def put(rest, bins):
        if len(bins) >= best[0]:
            return
        if not rest:
            best[0] = len(bins)
            return
        for k, b in enumerate(bins):
            if b + rest[0] <= room:
                put(rest[1:], [*bins[:k], b + rest[0], *bins[k + 1:]])
        put(rest[1:], [*bins, rest[0]])

    put(sorted(lengths, reverse=True), [])
    return best[0]


def test_small_groups_against_all_packings():
    rng = random.Random(3)
    over = 0
    for _ in range(300):
        lengths = np.array([rng.choice([rng.randint(1, 100), rng.randint(20, 60)]) for _ in range(rng.randint(1, 9))])
        bins = packing.pack_group(lengths, room=100)
        assert sorted(p for b in bins for p in b) == list(range(len(lengths)))
        assert all(lengths[b].sum() <= 100 for b in bins)
        want = fewest(lengths.tolist(), 100)
        assert packing.least_bins(lengths, 100) <= want <= len(bins)
        over += len(bins) - want
    assert over <= 6


def test_exchanges_empty_sequences_that_best_fit_leaves():
    # one, two-for-one and moves each save a bin
    for lengths, bins, want in (([60, 40, 55, 44], [0, 2, 1, 3], 2), ([50, 30, 40, 20, 60], [0, 0, 1, 1, 2], 2),
                                ([70, 20, 9, 50, 50], [0, 1, 2, 3, 4], 2)):
        found = packing.pack_group(np.array(lengths), np.array(bins), room=100)
        assert len(found) <= want + 0 and sorted(sum(found, [])) == list(range(len(lengths)))
    rng = np.random.default_rng(4)
    before = after = least = 0
    for _ in range(20):
        lengths = rng.integers(200, 700, 400)
        before += len(packing.best_fit(lengths.tolist(), np.argsort(-lengths, kind="stable").tolist()))
        after += len(packing.pack_group(lengths))
        least += packing.least_bins(lengths)
    assert least <= after < before


def test_groups_of_a_bounded_size_come_near_one_group(spark, monkeypatch):
    rng = random.Random(5)
    lengths = [700] * 700 + [rng.randint(1, 1024) for _ in range(1300)]
    sizes = spark.createDataFrame(list(enumerate(lengths)), "place long, length long")
    alone = {r["sequence_id"] for r in packing.pack(sizes).collect()}
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    rows = packing.pack(sizes).join(sizes, "place").collect()
    assert sorted(r["place"] for r in rows) == list(range(2000))
    grouped = held(rows)
    assert len(alone) <= len(grouped) <= 1.04 * len(alone)
    assert all(s == min(r["place"] for r in members) for s, members in grouped.items())


def test_empty_and_one_length(spark, empty):
    assert packing.pack_documents(empty).collect() == [] and packing.sequences(empty).collect() == []
    same = spark.createDataFrame([(i, 600) for i in range(500)], "place long, length long")
    assert len({r["sequence_id"] for r in packing.pack(same).collect()}) == 500
