"""SimHash near-copies: fingerprints, links by a popcount grid, classes of linked documents.

A fingerprint is cut into 16 segments of 4 bits; the bit counts of the segments are a point on an
integer grid. One differing bit moves one coordinate by one, so the Manhattan distance of two points
is a lower bound of their differing bits. Two points at a distance of 2 or less share a grid point
at a distance of 1 or less from both, which is the join key; the differing bits are then counted.

Results by case: a null text counts as empty; texts without a word have fingerprint zero, linked
like any other. Texts of one or two words are one shingle. Repeated rows share a class. A row
without doc_id has its class but never names it; a class of such rows alone is null. An empty table
gives no rows. Only doc_id and text are read.
"""

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from feedlake.llm.components import components
from feedlake.llm.frames import bounded_batches, staged

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 16
#: Hashes whose bits are counted at a time.
BLOCK = 1 << 15


def shingle_hashes(text: str, size: int = SHINGLE_WORDS) -> Iterator[int]:
    """XXH64 of each run of ``size`` words, or of all words if there are fewer."""
    words = text.encode().lower().split()  # of bytes: ASCII letters and blanks only
    if not words:
        return iter(())
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return iter((digest(joined, SEED),))
    return (digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[size - 1:]))


def fingerprint_of(text: str, size: int = SHINGLE_WORDS) -> int:
    """The 64 bits as a signed integer; a bit is 1 if set in over half of the hashes."""
    counts, total, hashes = np.zeros(64, np.int64), 0, shingle_hashes(text, size)
    while len(block := np.fromiter((h for _, h in zip(range(BLOCK), hashes)), np.uint64)):
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(block)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    """Fingerprint of each text."""
    return pd.Series([fingerprint_of(t or "") for t in texts], dtype="int64")


def segment_counts(bits: Column) -> Column:
    """Bit counts of the 16 segments, four bits each, in one long."""
    ones = F.lit(0x1111111111111111)
    return sum((F.shiftrightunsigned(bits, k).bitwiseAND(ones) for k in (1, 2, 3)),
               bits.bitwiseAND(ones))


def _near_points(point: Column) -> Column:
    """The point and its neighbours on the grid, coordinates 0 to 4."""
    near = [point]
    for k in range(SEGMENTS):
        step = F.lit(1 << 4 * k)
        count = F.shiftrightunsigned(point, 4 * k).bitwiseAND(F.lit(15))
        near += [F.when(count < 4, point + step), F.when(count > 0, point - step)]
    return F.array_compact(F.array(*near))


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a < b: distinct fingerprints (column ``fingerprint``, each once) that differ in few bits.

    Spark takes the exploded points to be as few as the fingerprints, so it is told to sort and merge: else it would
    send up to 33 times its limit to the driver and to every executor.
    """
    if not 1 <= max_bits <= 2:
        raise ValueError("the grid's neighbours cover one or two bits")
    keyed = fingerprints.select("fingerprint", F.explode(_near_points(segment_counts(
        F.col("fingerprint")))).alias("point"))
    a = keyed.select("point", F.col("fingerprint").alias("a"))
    b = keyed.select("point", F.col("fingerprint").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return a.join(b.hint("merge"), (a["point"] == b["point"]) & (F.col("a") < F.col("b")) & close).select("a", "b")


def classes(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint, component_id of every row.

    Copies meet in one row per fingerprint before anything is compared, however many there are.
    """
    bounded_batches(docs.sparkSession)
    rows = staged(docs.select("doc_id", fingerprint("text").alias("fingerprint")), "fingerprints")
    distinct = staged(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct")
    found = components(links(distinct, max_bits)).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(found, "fingerprint", "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    rooted = staged(rooted, "rooted")
    smallest = staged(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    named = staged(rooted.join(smallest, "root").select("fingerprint", "component_id"), "named")
    return rows.join(named, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay: of each class the one with the smallest doc_id.

    Repeated rows of that id stay once; rows without doc_id cannot be told apart and all stay.
    """
    kept = classes(docs, max_bits).where("doc_id = component_id").select(
        F.col("doc_id").alias("_kept")).distinct()
    kept = staged(kept, "kept")
    stay = docs.join(kept, F.col("doc_id") == F.col("_kept"), "left_semi").dropDuplicates(["doc_id"])
    return stay.unionByName(docs.where("doc_id IS NULL"))


def as_hex(fingerprint: str | Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
