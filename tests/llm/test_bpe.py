import hashlib
import random

import public_tokenizers
import tiktoken

from feedlake.llm import bpe
from tests.llm.conftest import ODD


def reference():
    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=bpe.read_ranks(bpe.VOCABULARY), special_tokens={})


def codec():
    return bpe.Codec(bpe._model(bpe.VOCABULARY), public_tokenizers.PATTERN, bpe.differing_classes())


def unpacked(packed):
    return [int.from_bytes(packed[i:i + 4], "little") for i in range(0, len(packed), 4)]


def test_ids_are_those_of_the_reference():
    rng = random.Random(5)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0xD800),
                                     rng.randrange(0xE000, 0x110000), 32, 10])) for _ in range(50))
             for _ in range(500)]
    texts += ["".join(map(chr, [*range(0xD800), *range(0xE000, 0x30000)])), "a" * 50_000, " " * 999 + "x"]
    mine, encode = list(codec().encode_all(texts)), reference().encode_ordinary
    assert [unpacked(m) for m in mine] == [encode(t) for t in texts]


def test_round_trip_of_all_bytes():
    one = codec()
    texts = ["".join(map(chr, range(0x800))), "", "汉字 and 𝔘"]
    assert [one.decode(ids) for ids in one.encode(texts)] == [t.encode() for t in texts]


def test_columns(spark, odd):
    tokenizer = bpe.Tokenizer(spark)
    rows = tokenizer.decode(tokenizer.encode(odd)).select("doc_id", "text", "ids", "decoded",
                                                          bpe.n_ids().alias("n")).collect()
    encode = reference().encode_ordinary
    assert len(rows) == len(ODD)
    for row in rows:
        ids = encode(row["text"] or "")
        assert unpacked(row["ids"]) == ids and row["n"] == len(ids)
        assert bytes(row["decoded"]) == (row["text"] or "").encode()


def test_empty_table(spark, empty):
    assert bpe.Tokenizer(spark).encode(empty).collect() == []


def test_query(spark):
    from feedlake.llm.queries import op1_byte_bpe
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    encode = reference().encode_ordinary
    for row in op1_byte_bpe(spark, folder).collect():
        ids = encode(texts[row["doc_id"]])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
