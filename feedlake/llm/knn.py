"""Exact top-k by inner product: a Voronoi join of queries with data.

Queries and data go to the cell of their nearest pivot. Summaries of the cells (counts, radii) bound
the inner products between any query of one cell and any row of another, which gives each query cell
a score that its k best surely reach, and so the data cells it can do without. Small query cells that
lie near each other form one pack, large ones are cut into tiles. The data cells that a pack needs
are sent to its tiles, in groups of bounded size; each is solved by matrix products, best bounds
first, skipping blocks that cannot reach a query's k-th score so far. The k best per query remain.

Results by case: vectors that are null, or hold a null or non-finite component, and rows without an
id take no part. Shorter vectors count as zero beyond their end. Equal scores go to the smaller id.
Candidates are rows: repeated rows each count, except those with the query's own id. Repeated query
rows are one query, the largest vector of the id. With fewer than k candidates all are returned. An
empty table gives no rows. Scores beyond a long stop at its ends.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import staged

PIVOTS = 64
BLOCK_ROWS = 1024
TILE_QUERIES = 1024
#: Data rows that meet a tile in one task at a time.
GROUP_ROWS = 16_384
BLOCKS = "cell int, n long, radius double, longest double, kind string, ids binary, data binary"
_KINDS = (("<i1", 1 << 7), ("<i2", 1 << 15), ("<i4", 1 << 31))


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, vector of the rows that take part; vector is still to be scaled."""
    doubles = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < math.inf))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & good)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(doubles, lambda x: x * F.lit(float(scale))).alias("vector")))


def matrix(vectors, width: int) -> np.ndarray:
    """Floors of the vectors as rows, shorter ones filled with zeros."""
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        row[:len(vector)] = vector
    return np.floor(out)


def _pack(ids: np.ndarray, rows: np.ndarray, cell: int, pivot: np.ndarray) -> dict:
    most = np.abs(rows).max(initial=0.0)
    kind = next((k for k, limit in _KINDS if most < limit), "<f8")
    return {"cell": cell, "n": len(ids), "radius": float(np.linalg.norm(rows - pivot, axis=1).max()),
            "longest": float(np.linalg.norm(rows, axis=1).max()), "kind": kind,
            "ids": ids.astype("<i8").tobytes(), "data": rows.astype(kind).tobytes()}


def _unpack(block, width: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(block.ids, "<i8"),
            np.frombuffer(block.data, block.kind).reshape(-1, width).astype(np.float64))


def blocks(rows: DataFrame, pivots: np.ndarray, label: str) -> DataFrame:
    """Rows packed by cell, at most BLOCK_ROWS together; a task holds one open block per cell."""
    width = pivots.shape[1]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            ids, data = batch["id"].to_numpy(np.int64), matrix(batch["vector"], width)
            gaps = (pivots ** 2).sum(axis=1) - 2 * data @ pivots.T
            cells, full = gaps.argmin(axis=1), []
            for cell in np.unique(cells).tolist():
                mine = cells == cell
                old_ids, old = held.pop(cell, (np.empty(0, np.int64), np.empty((0, width))))
                own_ids, own = np.concatenate([old_ids, ids[mine]]), np.concatenate([old, data[mine]])
                whole = len(own) // BLOCK_ROWS * BLOCK_ROWS
                full += [_pack(own_ids[i:i + BLOCK_ROWS], own[i:i + BLOCK_ROWS], cell, pivots[cell])
                         for i in range(0, whole, BLOCK_ROWS)]
                if whole < len(own):
                    held[cell] = own_ids[whole:], own[whole:]
            if full:
                yield pd.DataFrame(full)
        if held:
            yield pd.DataFrame([_pack(i, r, cell, pivots[cell]) for cell, (i, r) in held.items()])

    return staged(rows.mapInPandas(pack, BLOCKS), label)


def choose_pivots(rows: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """Distinct vectors of the n rows with the smallest hashes."""
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(n).collect()
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    return np.unique(matrix([r["vector"] for r in picked], width), axis=0)


def _chain(pivots: np.ndarray) -> list[int]:
    """An order in which each pivot is followed by the nearest one left."""
    left, order = set(range(1, len(pivots))), [0]
    while left:
        here = pivots[order[-1]]
        order.append(min(left, key=lambda j: float(((pivots[j] - here) ** 2).sum())))
        left.remove(order[-1])
    return order


def needed_cells(pivots: np.ndarray, queries: dict, data: dict, k: int) -> dict[int, set[int]]:
    """For each query cell the data cells that may hold one of the k best of any of its queries.

    Both map a cell to (count, radius). A query is p + a with |a| up to its cell's radius, a row
    is s + b likewise, and (p + a)(s + b) stays within |a||s| + |p||b| + |a||b| of ps.
    """
    length = np.linalg.norm(pivots, axis=1)
    out = {}
    for i, (_, r) in queries.items():
        cells = list(data)
        middle = pivots[cells] @ pivots[i]
        spread = np.array([r * length[j] + (length[i] + r) * data[j][1] for j in cells])
        spread = spread * (1 + 1e-9) + 1e-6  # more than rounding can amount to
        low, reached, sure = middle - spread, 0, -math.inf
        for at in np.argsort(-low):
            reached += data[cells[at]][0]
            if reached >= k:
                sure = low[at]
                break
        out[i] = {j for j, high in zip(cells, middle + spread) if high >= sure}
    return out


def packs_of(pivots: np.ndarray, counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Query cell -> (pack, number of tiles of the pack)."""
    packs: list[list[int]] = [[]]
    for cell in (c for c in _chain(pivots) if c in counts):
        if packs[-1] and sum(counts[c] for c in packs[-1]) + counts[cell] > TILE_QUERIES:
            packs.append([])
        packs[-1].append(cell)
    return {cell: (p, -(-sum(counts[c] for c in cells) // TILE_QUERIES))
            for p, cells in enumerate(packs) for cell in cells}


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond what doubles hold exactly, by Python's own integers."""
    reach = np.abs(queries).max(initial=0.0) * np.abs(rows).max(initial=0.0) * queries.shape[1]
    if reach < 2.0 ** 53:
        return (queries @ rows.T).astype(np.int64)
    exact = [[sum(int(a) * int(b) for a, b in zip(q, x)) for x in rows] for q in queries]
    return np.array([[max(-(1 << 63) + 1, min((1 << 63) - 1, v)) for v in line] for line in exact], np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row by score, then smaller id. ``ids`` ascend along a row."""
    n = scores.shape[1]
    if n > k:
        if np.abs(scores[scores > NONE]).max(initial=0) < (1 << 62) // n:
            keys = np.where(scores > NONE, scores, -((1 << 62) // n)) * n - np.arange(n)
            top = np.argpartition(keys, n - k, axis=1)[:, n - k:]
        else:
            top = np.argsort(-scores.astype(object), axis=1, kind="stable")[:, :k].astype(np.int64)
        scores = np.take_along_axis(scores, top, axis=1)
        ids = np.take_along_axis(ids, top, axis=1)
    return scores, ids


NONE = np.int64(-(1 << 63))


def _solve(k: int, pivots: np.ndarray):
    width = pivots.shape[1]

    def solve(query_blocks: pd.DataFrame, data_blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(query_blocks) or not len(data_blocks):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        parts = [_unpack(b, width) for b in query_blocks.itertuples()]
        query_ids, queries = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        length = np.linalg.norm(queries, axis=1)
        toward = queries @ pivots.T
        best = np.full((len(queries), k), NONE), np.zeros((len(queries), k), np.int64)
        rows = list(data_blocks.itertuples())
        high = np.array([toward[:, b.cell] + length * b.radius for b in rows])  # by block, by query
        high = high + np.abs(high) * 1e-9 + 1e-6
        for at in np.argsort(-high.max(axis=1)):
            worst = best[0].min(axis=1)
            open_ = np.flatnonzero(high[at] >= worst.astype(np.float64))
            if not len(open_):
                continue
            ids, data = _unpack(rows[at], width)
            order = np.argsort(ids, kind="stable")
            ids, data = ids[order], data[order]
            scores = _products(queries[open_], data)
            scores[query_ids[open_][:, None] == ids[None, :]] = NONE
            found = _best(scores, np.broadcast_to(ids, scores.shape), k)
            both = [np.concatenate([b[open_], f], axis=1) for b, f in zip(best, found)]
            order = np.lexsort((both[1], -(both[0] + (both[0] == NONE))), axis=1)[:, :k]
            best[0][open_], best[1][open_] = (np.take_along_axis(b, order, axis=1) for b in both)
        at, place = np.nonzero(best[0] > NONE)
        return pd.DataFrame({"query_id": query_ids[at], "vec_id": best[1][at, place],
                             "score": best[0][at, place]})

    return solve


def top_k(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 64, n_pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each query row.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = integers(vectors, id_col, vector_col, scale)
    pivots = choose_pivots(rows, n_pivots)
    if not len(pivots):
        return none
    data = blocks(rows, pivots, "data-blocks")
    chosen = rows.where(is_query).groupBy("id").agg(F.max("vector").alias("vector"))
    queries = blocks(chosen, pivots, "query-blocks")
    summary = {name: {r["cell"]: (r["n"], r["radius"]) for r in frame.groupBy("cell").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius")).collect()}
        for name, frame in (("data", data), ("queries", queries))}
    if not summary["queries"]:
        return none
    # rows of one id that may stand in the way of counting k others
    own = rows.groupBy("id").count().agg(F.max("count")).first()[0]
    needed = needed_cells(pivots, summary["queries"], summary["data"], k + own)
    packs = packs_of(pivots, {c: n for c, (n, _) in summary["queries"].items()})

    # at most PIVOTS squared rows each
    of_query = spark.createDataFrame([(c, p, t) for c, (p, t) in packs.items()], "cell int, pack int, tiles int")
    of_data = spark.createDataFrame(
        sorted({(j, *packs[i]) for i, cells in needed.items() for j in cells}), "cell int, pack int, tiles int")
    groups = -(-sum(n for n, _ in summary["data"].values()) // GROUP_ROWS)
    block = [c.split()[0] for c in BLOCKS.split(", ")]
    tiled = queries.join(F.broadcast(of_query), "cell").select(
        "pack", F.pmod(F.xxhash64("ids"), "tiles").cast("int").alias("tile"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), *block)
    sent = data.join(F.broadcast(of_data), "cell").select(
        "pack", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
        F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int").alias("part"), *block)
    key = ["pack", "tile", "part"]
    solved = tiled.groupBy(key).cogroup(sent.groupBy(key)).applyInPandas(
        _solve(k, pivots), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (solved.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
