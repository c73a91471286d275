"""Centroid clustering of integer vectors, exact, with n-simplex filtering.

Distances between a few pivots span a simplex; a vector's distances to them make it the
apex of a larger one, whose coordinates depend on nothing else (Connor, Vadicamo, Cardillo
and Rabitti, 2018).  For two apexes x and y the Euclidean distance of the vectors is at
least |x - y| and at most |x - y'|, where y' has the sign of its last coordinate, the
altitude, turned.  Each vector's apex is computed once and stored beside it; a round places
the centroids among the pivots in the same way, and a centroid whose lower bound exceeds
another's upper bound cannot be the nearest.  What remains is compared exactly in integers,
so assignments, ties and the floors of the means do not depend on rounding: the bounds only
say what need not be compared, with a margin far above their rounding error.

A round is one pass over the stored vectors that sends a row of exact sums for each task
and centroid; only the centroids (k vectors) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import free_name, packed, schema_with, stored

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3"
#: components beyond it (after scaling) could make a squared distance too large for a long
LARGEST = 1 << 27
#: least part of a pivot's squared distance to the others' span, relative to the largest, at
#: which it adds a dimension; margin of the bounds, relative to the largest distance
INDEPENDENT = 1e-6
MARGIN = 1e-6


class Simplex:
    """The pivots' base simplex: coordinates from squared distances to the pivots."""

    def __init__(self, pivots: np.ndarray):
        """Pivots in the span of those before them (repeated ones, or more than a plane
        needs) are left out; the first is the origin."""
        origin = pivots[0]
        rows, kept, base = [], [], []
        gaps = pivots - origin
        square = (gaps * gaps).sum(axis=1)              # exact integers
        largest = float(square.max()) if len(square) else 0.0
        for i in range(1, len(pivots)):
            along = [float(gaps[i] @ gaps[j]) for j in kept]
            row = np.linalg.solve(np.array(base), along) if base else np.zeros(0)
            rest = float(square[i]) - float(row @ row)
            if rest > INDEPENDENT * largest:
                base = [np.append(r, 0.0) for r in base] + [np.append(row, np.sqrt(rest))]
                kept.append(i)
        self.pivots = pivots[[0, *kept]]
        self.base = np.array(base).reshape(len(kept), len(kept))
        self.square = square[kept].astype(float)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates of each vector, the altitude (never negative) last."""
        to = squared(vectors, self.pivots).astype(float)
        along = (to[:, :1] + self.square - to[:, 1:]) / 2          # inner products with the pivots
        at = np.linalg.solve(self.base, along.T).T if len(self.base) else along
        return np.c_[at, np.sqrt(np.maximum(to[:, 0] - (at * at).sum(axis=1), 0.0))]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of two integer arrays (columns: rows of y)."""
    out = np.empty((len(x), len(y)), dtype=np.int64)
    for j, row in enumerate(y):
        gap = x - row
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out


def bounds(apexes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances."""
    flat = ((apexes[:, None, :-1] - others[None, :, :-1]) ** 2).sum(axis=2)
    x, y = apexes[:, None, -1], others[None, :, -1]
    return flat + (x - y) ** 2, flat + (x + y) ** 2


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, placed: np.ndarray):
    """For each vector the nearest centroid (of equally near ones the smallest number), its
    squared distance, and how many centroids were compared."""
    lower, upper = bounds(apexes, placed)
    margin = MARGIN * (1.0 + upper.max(axis=1))
    open_ = lower <= (upper.min(axis=1) + margin)[:, None]
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    which = np.full(len(vectors), -1, dtype=np.int32)
    for j in range(len(centroids)):
        at = np.flatnonzero(open_[:, j])
        found = squared(vectors[at], centroids[j:j + 1])[:, 0]
        closer = found < best[at]
        best[at[closer]], which[at[closer]] = found[closer], j
    return which, best, int(open_.sum())


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS,
             k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """All columns of the kept vectors with cluster, distance (squared), cluster_inertia,
    inertia (summed distances of the cluster and of all) and centroid_sha256.

    Kept are vectors of exactly ``dimensions`` components, none null or non-finite; each
    component x counts as floor(scale * x).  The first centroids are the ``k`` kept vectors
    whose "seed:id" has the smallest sha256 (repeated ids: the smaller vector first; rows
    without an id come last), all kept vectors where they are fewer.  Repeated rows are
    vectors of their own.  Input columns named as the results are replaced.  Components whose
    integer is beyond 2^27 would allow distances that no long can hold: they raise an error.
    An empty table, or one without a kept vector, gives an empty result.
    """
    results = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    keep = [c for c in vectors.columns if c not in results]
    v = F.col(f"`{vector_col}`")
    whole = F.size(v) == dimensions
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * float(scale)))
    fits = F.forall(scaled, lambda x: F.abs(x) <= LARGEST)
    far = F.raise_error(F.lit("a component is beyond 2^27 after scaling: squared distances would not fit a long"))
    data = vectors.where(whole & finite).select(
        packed(keep).alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.when(fits, scaled.cast("array<int>")).otherwise(far.cast("array<int>")).alias("q"))
    data = stored(data, "centroid_vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = [r["q"] for r in data.select("q", digest.alias("h")).orderBy(F.col("h").asc_nulls_last(), "q").limit(k).collect()]
    centroids = np.array(first, dtype=np.int64).reshape(-1, dimensions)
    schema_in = vectors.select(*keep).schema
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema_in).select(
            "*", *[F.lit(None).cast(t).alias(c) for c, t in zip(results, ("int", "long", "long", "long", "string"))])

    simplex = Simplex(centroids)
    n_apex = len(simplex.base) + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = simplex.apexes(_matrix(batch.column("q"), dimensions, np.int64))
            cut = pa.array(np.arange(batch.num_rows + 1) * n_apex, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("q"),
                                              pa.ListArray.from_arrays(cut, pa.array(at.ravel()))], names=["row", "q", "apex"])

    data = data.select("row", "q")
    data = stored(data.mapInArrow(place, schema_with(data, "apex array<double>")), "centroid_apexes")

    def assigned(batch: pa.RecordBatch, now: np.ndarray, around: np.ndarray):
        q = _matrix(batch.column("q"), dimensions, np.int64)
        which, best, _ = nearest(q, _matrix(batch.column("apex"), n_apex, np.float64), now, around)
        return q, which, best

    sums = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dimensions)]
    for _ in range(rounds):
        around = simplex.apexes(centroids)

        def add(batches: Iterator[pa.RecordBatch], now=centroids, around=around) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((len(now), dimensions), np.int64), np.zeros(len(now), np.int64)
            for batch in batches:
                q, which, _ = assigned(batch, now, around)
                for j in np.unique(which).tolist():
                    total[j] += q[which == j].sum(axis=0)
                count += np.bincount(which, minlength=len(now))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(now)), pa.int32()), pa.array(count),
                                              pa.array(total.tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

        moved = centroids.copy()
        parts = data.select("q", "apex").mapInArrow(add, "cluster int, n long, total array<long>").where("n > 0")
        for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():           # k rows
            moved[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dimensions)]
        if (moved == centroids).all():           # as it is, it stays in all rounds to come
            break
        centroids = moved

    around = simplex.apexes(centroids)

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, which, best = assigned(batch, centroids, around)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(which), pa.array(best)],
                                             names=["row", "cluster", "distance"])

    last = stored(data.mapInArrow(end, schema_with(data.select("row"), "cluster int, distance long")), "centroid_clusters")
    inertia = {r["cluster"]: int(r["n"]) for r in last.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}                     # k rows
    of = {j: (n, hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, n in inertia.items()}

    def looked_up(i: int, kind: str):
        out = F.lit(None).cast(kind)
        for j, values in of.items():
            out = F.when(F.col("cluster") == j, F.lit(values[i]).cast(kind)).otherwise(out)
        return out
    row = free_name(results, "row")
    last = last.withColumnRenamed("row", row).withColumns({
        "cluster_inertia": looked_up(0, "long"), "inertia": F.lit(sum(inertia.values())).cast("long"),
        "centroid_sha256": looked_up(1, "string")})
    return last.select(*[F.col(f"{row}.`{c}`").alias(c) for c in keep], *results)


def clusters_sql(dimensions: int = DIMENSIONS, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
                 seed: str = SEED) -> str:
    """DuckDB SQL for the columns of the registered query."""
    square = "list_sum(list_transform(list_zip(v.q, c.q), lambda p: CAST(p[1] - p[2] AS HUGEINT) * (p[1] - p[2])))"
    floor = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"

    def assign(i: int) -> str:
        return (f"a{i} AS MATERIALIZED (SELECT id, any_value(vec_id) AS vec_id, any_value(q) AS q, min(d) AS distance, "
                f"arg_min(c, (d, c)) AS c FROM (SELECT v.id, v.vec_id, v.q, c.c, {square} AS d FROM kept v CROSS JOIN c{i} c) GROUP BY id)")

    def move(i: int) -> str:
        return (f"c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.q, o.q) AS q FROM c{i} o LEFT JOIN (SELECT c, list({floor} ORDER BY i) AS q "
                f"FROM (SELECT c, i, sum(CAST(x AS HUGEINT)) AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, "
                f"unnest(range({dimensions})) AS i FROM a{i}) GROUP BY c, i) GROUP BY c) m ON m.c = o.c)")
    steps = ",\n".join(f"{assign(i)},\n{move(i)}" for i in range(rounds))
    return f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = {dimensions}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, q) - 1 AS c, q FROM (
  SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, q FROM kept ORDER BY h NULLS LAST, q LIMIT {k})),
{steps},
{assign(rounds)}
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c"""
