"""Exact top-k search by Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are cut into blocks of bounded size, straight from the scan's partitions; each block gets one list per dimension,
its rows sorted by that component. A query walks the lists of a block from their better ends (the largest components where
its own is positive, the smallest where it is negative), scores each row it meets for the first time exactly, and stops
when the bound on unseen rows, the sum over dimensions of its component times the one last met, is below its kth best
score so far. That score carries over from block to block.

Queries are rows of the table. They are packed into blocks of their own, with the places of their rows, and meet the vector
blocks by an equi-join on the group that a block belongs to; tasks hold one block of either kind at a time. Blocks
hold their bounds at hand: one whose bound can't beat a query's kth best score is left out for that query.

Rows with a component beyond +-LARGEST are packed into blocks of their own, of wider integers; scores that might pass a long
are computed as Python integers and ranked by their bytes.

Defined cases: components become floor(256 * x); vectors that are null or hold null or non-finite components, and those with
a null id, take no part; an empty vector scores 0 with all; a score that doesn't fit a long is ranked exactly and given as
null; a shorter vector counts as having zeros; a query's candidates are all rows but its own, also those with the same id;
repeated query rows are queries each, with the same query_id; equal scores go to the smaller id; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

K = 5
QUERY_EVERY = 50
SCALE = 256
#: Rows of a block (at most 65,536) and of a query block.
BLOCK, QUERY_BLOCK = 2048, 128
#: Vector blocks in a group, at most, unless there are too few for all cores.
GROUP = 32
LARGEST = 1 << 26
FIRST_DEPTH = 8


def _packed(block: int):
    """Packs scan batches (id, vector, whether asked) into blocks: the ids, which rows are queries, the integer components row by row, and of each dimension the rows by ascending component."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of components within LARGEST, and the others
        kept: list[tuple[list[int], list[bool], list[np.ndarray]]] = [([], [], []), ([], [], [])]

        def out(ids: list[int], asked: list[bool], rows: list[np.ndarray]) -> pa.RecordBatch:
            d = max(1, *map(len, rows))
            matrix = np.zeros((len(rows), d), rows[0].dtype)
            for m, r in zip(matrix, rows, strict=True):
                m[: len(r)] = r
            lists = np.argsort(matrix, axis=0, kind="stable").T.astype(np.uint16)
            return pa.RecordBatch.from_pydict({"n": pa.array([len(ids)], pa.int32()), "d": pa.array([d], pa.int32()), "ids": [np.array(ids, np.int64).tobytes()], "asked": [np.flatnonzero(asked).astype(np.int32).tobytes()], "matrix": [_bytes(matrix)], "lists": [lists.tobytes()]})

        for batch in batches:
            for at in range(0, batch.num_rows, block):
                for row in zip(*_rows(batch.slice(at, block)), strict=True):
                    lists = kept[row[2].dtype == object]
                    for cells, cell in zip(lists, row, strict=True):
                        cells.append(cell)
                    if len(lists[0]) == block:
                        yield out(*lists)
                        for cells in lists:
                            cells.clear()
        for lists in kept:
            if lists[0]:
                yield out(*lists)

    return pack


def _asked(size: int):
    """Packs the queries of blocks into query blocks: their ids, their own blocks and places in these, and their components."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[tuple[int, int, int, np.ndarray]]] = [[], []]

        def out(rows: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
            d = max(len(r[3]) for r in rows)
            matrix = np.zeros((len(rows), d), rows[0][3].dtype)
            for m, r in zip(matrix, rows, strict=True):
                m[: len(r[3])] = r[3]
            ids, own, places = (np.array([r[i] for r in rows], np.int64).tobytes() for i in range(3))
            return pa.RecordBatch.from_pydict({"qd": pa.array([d], pa.int32()), "own": [own], "qids": [ids], "places": [places], "qmatrix": [_bytes(matrix)]})

        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda c: batch.column(c)[row].as_py()  # noqa: B023, E731
                at, block = np.frombuffer(cell("asked"), np.int32), cell("block")
                matrix = _matrix(cell("matrix"), cell("n"), cell("d"))[at]
                rows = kept[matrix.dtype == object]
                for i, place, r in zip(np.frombuffer(cell("ids"), np.int64)[at].tolist(), at.tolist(), matrix, strict=True):
                    rows.append((i, block, place, r))
                    if len(rows) == size:
                        yield out(rows)
                        rows.clear()
        for rows in kept:
            if rows:
                yield out(rows)

    return pack


def _bytes(matrix: np.ndarray) -> bytes:
    """The components row by row: of four bytes each, or of eight or more where they are Python integers."""
    if matrix.dtype != object:
        return matrix.tobytes()
    width = max(8, max(x.bit_length() for x in matrix.flat) // 8 + 1)
    return b"".join(x.to_bytes(width, "little", signed=True) for x in matrix.flat)


def _matrix(data: bytes, n: int, d: int) -> np.ndarray:
    """What _bytes has written, as n rows of d components."""
    if (width := len(data) // (n * d)) == 4:
        return np.frombuffer(data, np.int32).reshape(n, d)
    out = np.empty(n * d, object)
    out[:] = [int.from_bytes(data[at : at + width], "little", signed=True) for at in range(0, len(data), width)]
    return out.reshape(n, d)


def _ordered(score: int) -> bytes:
    """Bytes that sort as integers of any size do."""
    size = score.bit_length() // 8 + 1
    at = size if score >= 0 else -size
    return (at + (1 << 31)).to_bytes(4, "big") + (score + (0 if score >= 0 else 1 << 8 * size)).to_bytes(size, "big")


def _rows(batch: pa.RecordBatch) -> tuple[list[int], list[bool], list[np.ndarray]]:
    """The ids, whether asked, and scaled components of a batch's rows that take part, as Python integers where one is beyond LARGEST."""
    ids, asked, rows = [], [], []
    for key, vector, query in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
        if not (key.is_valid and vector.is_valid):
            continue
        v = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if not np.isfinite(v).all():
            continue
        ids.append(key.as_py())
        asked.append(query.as_py() is True)
        if np.abs(v).max(initial=0) <= LARGEST // SCALE:
            rows.append(np.floor(SCALE * v).astype(np.int32))
        else:  # doubles this large are integers already, and 256 times them might pass the largest double
            rows.append(np.array([math.floor(SCALE * x) if abs(x) < 1 << 60 else SCALE * int(x) for x in v.tolist()], object))
    return ids, asked, rows


class Block:
    """A block of vectors with its per-dimension lists."""

    def __init__(self, n: int, d: int, ids: bytes, matrix: bytes, lists: bytes):
        self.whole = _matrix(matrix, n, d)
        self.ids = np.frombuffer(ids, np.int64)
        self.largest = int(np.abs(self.whole).max(initial=0))
        # sums of products stay exact in doubles up to 2^53; beyond that, in longs; beyond those, in Python's integers
        self.kind = object if self.whole.dtype == object else np.float64 if d * self.largest < 1 << 26 else np.int64
        self.rows = self.whole.astype(self.kind)
        self.lists = np.frombuffer(lists, np.uint16).reshape(d, n)
        self.values = np.take_along_axis(self.whole, self.lists.T, axis=0).T.astype(object if self.kind is object else np.int64)

    def bounds(self, up: np.ndarray, down: np.ndarray) -> np.ndarray | None:
        """What any row can score at most with each query, given the queries' positive and negative parts; None where doubles aren't exact."""
        width = min(up.shape[1], len(self.values))
        if self.kind is not np.float64 or width * self.largest * max(up.max(initial=0), -down.min(initial=0)) >= 1 << 53:
            return None
        return up[:, :width] @ self.values[:width, -1] + down[:, :width] @ self.values[:width, 0]

    def top(self, own: int, query: np.ndarray, k: int, best: list[tuple[int, int]]) -> int:
        """Adds the block's rows but the one at place `own` (-1: none) to the heap `best` of (score, -id) by the threshold algorithm; returns the depth it went to."""
        n, d = self.rows.shape
        width = min(d, len(query))
        dims = np.flatnonzero(query[:width])
        q = query[dims]
        size = width * int(np.abs(q).max(initial=0))
        kind = object if size * self.largest >= 1 << 62 or self.kind is object else np.int64 if size >= 1 << 26 else self.kind
        weights = np.zeros(d, kind)
        weights[dims] = q
        rows = self.rows if kind is self.kind else self.whole.astype(kind)
        up = q > 0
        seen = np.zeros(n, bool)
        at, depth = 0, FIRST_DEPTH
        while at < n:
            to = min(depth, n)
            if len(dims):
                heads = np.concatenate([self.lists[dims[up], n - to : n - at].ravel(), self.lists[dims[~up], at:to].ravel()])
                met = np.zeros(n, bool)
                met[heads] = True
                new = np.flatnonzero(met & ~seen)
            else:
                new, to = np.arange(n), n
            seen[new] = True
            new = new[new != own]
            if len(new):
                scores = rows[new] @ weights
                if len(best) == k:
                    new = new[scores >= best[0][0]]
                    scores = scores[scores >= best[0][0]]
                elif len(scores) > k:
                    least = np.partition(scores, len(scores) - k)[len(scores) - k]
                    new, scores = new[scores >= least], scores[scores >= least]
                for i, s in zip(self.ids[new].tolist(), scores.tolist(), strict=True):
                    item = (int(s), -i)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
            at, depth = to, 2 * to
            if len(best) == k and at < n:
                ends = np.concatenate([self.values[dims[up], n - at], self.values[dims[~up], at - 1]])
                signed = np.concatenate([q[up], q[~up]])
                bound = sum(map(mul, signed.tolist(), ends.tolist())) if kind is object else int(signed @ ends)
                if bound < best[0][0]:
                    break
        return at


def _search(k: int):
    """Over joined rows of a query block and a vector block: the best of each query, kept over the blocks that a query block meets in a row."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_block, block_id, block, ids, places, own, queries, parts, best = None, None, None, [], [], [], [], None, []

        def out() -> pa.RecordBatch:
            found = [(o, p, q, -i, s if -1 << 63 <= s < 1 << 63 else None, _ordered(s)) for o, p, q, heap in zip(own, places, ids, best, strict=True) for s, i in heap]
            return pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.binary() if c == 5 else pa.int64()) for c in range(6)], names=["own", "place", "query_id", "vec_id", "score", "order"])

        for batch in batches:
            for at in range(batch.num_rows):
                cell = lambda c: batch.column(c)[at].as_py()  # noqa: B023, E731
                if cell("qb") != query_block:
                    if best:
                        yield out()
                    query_block = cell("qb")
                    ids, places, own = (np.frombuffer(cell(c), np.int64).tolist() for c in ("qids", "places", "own"))
                    queries = _matrix(cell("qmatrix"), len(ids), cell("qd"))
                    queries = queries if queries.dtype == object else queries.astype(np.int64)
                    # numbers that doubles can't hold are left to top() itself
                    parts = None if queries.dtype == object else (np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64))
                    best = [[] for _ in ids]
                if cell("block") != block_id:
                    block_id, block = cell("block"), Block(*map(cell, ("n", "d", "ids", "matrix", "lists")))
                bounds = block.bounds(*parts) if parts else None
                for n, (o, p, v, heap) in enumerate(zip(own, places, queries, best, strict=True)):
                    if bounds is None or len(heap) < k or bounds[n] >= heap[0][0]:
                        block.top(p if block_id == o else -1, v, k, heap)
        if best:
            yield out()

    return search


def top_k(vectors: DataFrame, asked: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each row where `asked` holds its k others of the largest inner product."""
    spark = vectors.sparkSession
    shape = "n int, d int, ids binary, asked binary, matrix binary, lists binary"
    rows = vectors.select(F.col(key).cast("long"), F.col(vector).cast("array<double>"), asked)
    blocks = stored(rows.mapInArrow(_packed(block), shape).withColumn("block", F.monotonically_increasing_id()), "blocks")
    queries = blocks.where(F.octet_length("asked") > 0).select("block", "n", "d", "ids", "asked", "matrix")
    queries = queries.mapInArrow(_asked(query_block), "qd int, own binary, qids binary, places binary, qmatrix binary")
    queries = stored(queries.withColumn("qb", F.monotonically_increasing_id()), "asked")
    groups = max(1, -(-(count := blocks.count()) // GROUP), min(count, 4 * spark.sparkContext.defaultParallelism))
    blocks = blocks.drop("asked").withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    queries = queries.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    # a merge join keeps the blocks that one query block meets together
    found = queries.hint("merge").join(blocks, "group").mapInArrow(_search(k), "own long, place long, query_id long, vec_id long, score long, order binary")
    order = Window.partitionBy("own", "place").orderBy(F.desc("order"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, CASE WHEN len(q.e) = 0 THEN 0 ELSE CAST(list_dot_product(q.e, c.e) AS BIGINT) END AS score
  FROM v q JOIN v c ON q.n <> c.n WHERE q.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {K}
"""
