"""Centroid clustering (Lloyd's rounds over integer vectors) by annulus search.

Centroids are sorted by norm. A vector's distance to any one centroid bounds that to its nearest, which by the triangle
inequality has a norm within that bound of the vector's own: two binary searches over the sorted norms give the centroids of
this annulus, and only these are compared exactly, in integers. The bound of the first assignment is the distance to the
centroid of the nearest norm; the cluster it finds is stored with the vector as its home, and the home's centroid, which
moves with its members, gives the bound of all later assignments. The annulus is widened by more than the rounding of the
norms, so that no tie at its rim is lost; equal distances go to the smaller number.

Tasks assign Arrow batches and add up counts and componentwise sums of their clusters; these meet by cluster, and only the
K centroids come to the driver.

Defined cases: components become floor(256 * x); vectors that are null, have another number of components or hold null or
non-finite ones take no part; rows are vectors of their own, also those that repeat an id; the starts are ordered by the hash
of the id, then by their components, and rows with a null id come last and are clustered like others; with fewer vectors
than K there are as many centroids as vectors; components beyond +-LARGEST are computed as Python integers, and a distance or
an inertia that doesn't fit a long is ranked exactly and given as null; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

K, ROUNDS, DIMENSIONS, SCALE = 40, 5, 64, 256
#: Components up to which squared distances of DIMENSIONS components, and sums over a batch, fit 64 bits.
LARGEST = 1 << 26
LONG = 1 << 63


def _integers(column: pa.Array, d: int) -> np.ndarray:
    """floor(256 * x) row by row: 64-bit integers, or Python's own where one is beyond LARGEST."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d) * SCALE)
    if x.size and np.abs(x).max() > LARGEST:
        return np.array([[int(v) for v in row] for row in x], object).reshape(-1, d)
    return x.astype(np.int64)


def _norms(x: np.ndarray) -> np.ndarray:
    """Euclidean norms, rounded."""
    return np.array([math.sqrt(v) for v in (x * x).sum(1)], np.float64) if x.dtype == object else np.sqrt((x * x).sum(1).astype(np.float64))


class Rings:
    """Centroids in the order of their norms."""

    def __init__(self, centroids: list[list[int]]):
        c = np.array(centroids, object)
        self.wide = any(abs(v) > LARGEST for row in centroids for v in row)
        self.centroids = c if self.wide else c.astype(np.int64)
        norms = _norms(self.centroids)
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]

    def squared(self, x: np.ndarray, number) -> np.ndarray:
        """Exact squared distances of rows to the centroid of a number, or to one each."""
        step = x - self.centroids[number]
        return (step * step).sum(1)

    def nearest_norm(self, norms: np.ndarray) -> np.ndarray:
        at = np.clip(np.searchsorted(self.norms, norms), 1, max(1, len(self.norms) - 1))
        low = np.abs(norms - self.norms[at - 1]) <= np.abs(self.norms[np.minimum(at, len(self.norms) - 1)] - norms)
        return self.order[np.where(low, at - 1, np.minimum(at, len(self.norms) - 1))]

    def assign(self, x: np.ndarray, home: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid's number and the squared distance, row by row; home bounds the search."""
        if self.wide or x.dtype == object:
            x = x.astype(object)
        norms = _norms(x)
        best = self.nearest_norm(norms) if home is None else home.astype(np.int64)
        distance = self.squared(x, best)
        bound = np.array([math.sqrt(v) for v in distance], np.float64) if x.dtype == object else np.sqrt(distance.astype(np.float64))
        bound += 1e-6 + (norms + bound) * 1e-9  # far beyond the rounding of the roots
        first, last = np.searchsorted(self.norms, norms - bound, "left"), np.searchsorted(self.norms, norms + bound, "right")
        best = best.copy()
        for place in range(int(first.min(initial=len(self.norms))), int(last.max(initial=0))):
            rows = np.flatnonzero((first <= place) & (place < last))
            number = int(self.order[place])
            found = self.squared(x[rows], number)
            won = (found < distance[rows]) | ((found == distance[rows]) & (number < best[rows]))
            distance[rows[won]], best[rows[won]] = found[won], number
        return best, distance


def kept(df: DataFrame, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """id and x of the vectors that take part."""
    x = F.col(vector)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return df.where(x.isNotNull() & (F.size(x) == dimensions) & whole).select(F.col(key).alias("id"), x.cast("array<double>").alias("x"))


def starts(vectors: DataFrame, k: int = K, salt: str = "2") -> list[list[int]]:
    """The k vectors with the smallest hashes of their ids: a top-k of bounded rows."""
    hashed = vectors.select("x", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).alias("h"))
    rows = hashed.orderBy(F.col("h").asc_nulls_last(), F.transform("x", lambda v: F.floor(v * SCALE).cast("double"))).limit(k).collect()
    return [[math.floor(v * SCALE) for v in r.x] for r in rows]


def _assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vectors with cluster and distance (null beyond a long)."""
    d, bounded = len(centroids[0]), "home" in vectors.columns
    id_type = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rings = Rings(centroids)
        for batch in batches:
            home = batch.column("home").to_numpy(zero_copy_only=False) if bounded else None
            best, distance = rings.assign(_integers(batch.column("x"), d), home)
            fits = [int(v) if v < LONG else None for v in distance] if distance.dtype == object else distance
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), pa.array(best, pa.int32()), pa.array(fits, pa.int64())], ["id", "x", "cluster", "distance"])

    return vectors.mapInArrow(run, f"id {id_type}, x array<double>, cluster int, distance long")


def _sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """How many vectors each cluster has and their componentwise sums; added up in the tasks, then by cluster."""

    def local(rows: Iterator) -> Iterator[tuple[int, tuple[int, list[int]]]]:
        rings, found, ready = Rings(centroids), {}, []

        def add() -> None:
            x = np.floor(np.array([r.x for r in ready], np.float64) * SCALE)
            x = np.array([[int(v) for v in row] for row in x], object) if np.abs(x).max() > LARGEST else x.astype(np.int64)
            best, _ = rings.assign(x, np.array([r.home for r in ready], np.int64))
            for number in np.unique(best).tolist():
                own = x[best == number]
                n, sums = found.get(number, (0, [0] * x.shape[1]))
                found[number] = (n + len(own), [a + int(b) for a, b in zip(sums, own.sum(0), strict=True)])
            ready.clear()

        for row in rows:
            ready.append(row)
            if len(ready) == 2048:
                add()
        if ready:
            add()
        yield from found.items()

    merge = lambda a, b: (a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)])
    return dict(vectors.select("x", "home").rdd.mapPartitions(local).reduceByKey(merge, min(len(centroids), 8)).collect())  # K rows at most


def fit(df: DataFrame, k: int = K, rounds: int = ROUNDS, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS) -> tuple[DataFrame, list[list[int]]]:
    """The vectors (id, x, home) as a stored table, and the centroids after the rounds; an empty list where no vector takes part."""
    vectors = kept(df, key, vector, dimensions)
    centroids = starts(vectors, k)
    if not centroids:
        return vectors.withColumn("home", F.lit(0)), centroids
    vectors = stored(_assigned(vectors, centroids).select("id", "x", F.col("cluster").alias("home")), "homes")
    for _ in range(rounds):
        for number, (n, sums) in _sums(vectors, centroids).items():
            centroids[number] = [s // n for s in sums]
    return vectors, centroids


def clusters(df: DataFrame, k: int = K, rounds: int = ROUNDS, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    vectors, centroids = fit(df, k, rounds, key, vector, dimensions)
    spark = df.sparkSession
    if not centroids:
        names = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
        return vectors.where(F.lit(False)).select(F.col("id").alias("vec_id"), *[F.lit(None).cast(t).alias(n) for n, t in names.items()])
    found = stored(_assigned(vectors, centroids).select("id", "cluster", "distance"), "clusters")
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"), F.count_if(F.col("distance").isNull()).alias("beyond")).collect()  # K rows at most
    fitting = lambda rows: int(v) if not any(r.beyond for r in rows) and (v := sum(r.inertia for r in rows)) < LONG else None
    total = fitting(per)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    own = spark.createDataFrame([(r.cluster, fitting([r]), total, digests[r.cluster]) for r in per], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(own), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    distance = "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    parts = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
             f"c0 AS MATERIALIZED (SELECT n, x FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS n, x FROM v) WHERE n < {K})"]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, x, b.n AS n, b.d AS d FROM (SELECT v.vec_id, v.x, min({{'d': {distance}, 'n': c.n}}) AS b FROM v, c{r} c GROUP BY v.vec_id, v.x))""")
        if r < ROUNDS:
            parts.append(f"""s{r} AS (SELECT n, i, sum(x[i])::HUGEINT AS s, count(*)::HUGEINT AS m FROM a{r}, range(1, {DIMENSIONS + 1}) t(i) GROUP BY n, i),
c{r + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (SELECT n, list(CAST((s - ((s % m) + m) % m) / m AS BIGINT) ORDER BY i) AS x FROM s{r} GROUP BY n) m ON m.n = c.n)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.n AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.n) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.n = a.n
"""


ORACLE = _oracle()
