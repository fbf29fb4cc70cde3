"""Centroid clustering on integers by Shallot search.

Vectors are scaled to integers, centroids are integers as well, and every decision is
made on exact squared distances; ties go to the smaller number. Floating point serves
bounds only, which are widened by more than any rounding could be.

A vector remembers an upper bound of the distance to its centroid, a lower bound of the
distance to any other, and which centroid was second nearest. Where the bounds, moved
on by how far centroids went, still tell the nearest one, nothing is computed. Else both
remembered centroids are measured, and the closer one is where the search starts: its
neighbours are scanned in the order of their distance from it, in a ball whose radius is
the sum of the distances to it and to the second nearest found so far. A neighbour
outside can be neither nearest nor second nearest. The ball shrinks as closer centroids
are found, and the scan ends at the first neighbour outside.

A round is one pass over the table: it writes the vectors with their bounds, and for
every task the sums of its clusters, which are then added up per cluster and component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import drop_folder, ship_code
from tickloom.session import scratch_path

CLUSTERS, ROUNDS, WIDTH, SCALE = 40, 5, 64, 256
#: Components beyond this times SCALE would let squared distances leave 64 bits.
MOST = 1 << 27
#: Far more than the relative error of a bound, which is a few roundings of doubles.
SLACK = 1e-9
STATE = ("vec_id", "q", "near", "second", "upper", "lower")


def lengths(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    apart = left - right
    return np.einsum("ij,ij->i", apart, apart)


@dataclass
class Centroids:
    """Centroids with what a search needs of them."""

    points: np.ndarray  # (k, width) int64

    def __post_init__(self) -> None:
        k = len(self.points)
        self.apart = np.stack([lengths(squared(self.points, p[None, :])) for p in self.points])
        ranked = self.apart.copy()
        np.fill_diagonal(ranked, -1.0)
        self.order = np.argsort(ranked, axis=1, kind="stable")
        np.fill_diagonal(ranked, np.inf)
        # A vector closer to its centroid than half the way to any other is decided.
        self.half = ranked.min(axis=1) / 2 if k > 1 else np.full(1, np.inf)

    def moved(self, before: "Centroids | None") -> tuple[np.ndarray, np.ndarray]:
        """How far each centroid went, and the farthest of all others."""
        if before is None:
            return np.zeros(len(self.points)), np.zeros(len(self.points))
        went = lengths(squared(self.points, before.points)) * (1 + SLACK)
        others = np.full(len(went), went.max())
        top = int(went.argmax())
        others[top] = np.delete(went, top).max(initial=0.0)
        return went, others


@dataclass
class Bounded:
    """Vectors with their nearest and second-nearest centroids and bounds."""

    q: np.ndarray
    near: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray

    @classmethod
    def new(cls, q: np.ndarray, k: int) -> "Bounded":
        n = len(q)
        return cls(q, np.zeros(n, np.int32), np.full(n, min(1, k - 1), np.int32),
                   np.full(n, np.inf), np.zeros(n))


def less(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether (distance, number) comes first."""
    return (a < b) | ((a == b) & (i < j))


def search(rows: Bounded, now: Centroids, went: np.ndarray, others: np.ndarray) -> int:
    """Gives every vector its nearest centroid; returns the distances computed."""
    rows.upper = (rows.upper + went[rows.near]) * (1 + SLACK)
    rows.lower = (rows.lower - others[rows.near]) * (1 - SLACK)
    k = len(now.points)
    if k == 1:
        return 0
    safe = np.maximum(rows.lower, now.half[rows.near] * (1 - SLACK))
    todo = np.flatnonzero(rows.upper >= safe)
    d_near = squared(rows.q[todo], now.points[rows.near[todo]])
    work = len(todo)
    rows.upper[todo] = lengths(d_near) * (1 + SLACK)
    left = rows.upper[todo] >= safe[todo]
    todo, d_near = todo[left], d_near[left]
    if not len(todo):
        return work
    d_second = squared(rows.q[todo], now.points[rows.second[todo]])
    work += len(todo)
    near, second = rows.near[todo].copy(), rows.second[todo].copy()
    swap = less(d_second, second, d_near, near)
    near[swap], second[swap] = second[swap], near[swap]
    d_near[swap], d_second[swap] = d_second[swap], d_near[swap]
    start, reach = near.copy(), lengths(d_near)
    live = np.arange(len(todo))
    for step in range(1, k):
        j = now.order[start[live], step].astype(np.int32)
        radius = (reach[live] + lengths(d_second[live])) * (1 + SLACK)
        inside = now.apart[start[live], j] <= radius
        live, j = live[inside], j[inside]
        if not len(live):
            break
        fresh = (j != near[live]) & (j != second[live])
        some, j = live[fresh], j[fresh]
        d = squared(rows.q[todo[some]], now.points[j])
        work += len(some)
        first = less(d, j, d_near[some], near[some])
        behind = ~first & less(d, j, d_second[some], second[some])
        won, lost = some[first], some[behind]
        d_second[won], second[won] = d_near[won], near[won]
        d_near[won], near[won] = d[first], j[first]
        d_second[lost], second[lost] = d[behind], j[behind]
    rows.near[todo], rows.second[todo] = near, second
    rows.upper[todo] = lengths(d_near) * (1 + SLACK)
    rows.lower[todo] = lengths(d_second) * (1 - SLACK)
    return work


def cluster_sums(rows: Bounded, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of each cluster, and their sums by component."""
    counts = np.bincount(rows.near, minlength=k)
    order = np.argsort(rows.near, kind="stable")
    sums = np.zeros((k, rows.q.shape[1]), np.int64)
    held = np.flatnonzero(counts)
    if len(held):
        starts = (np.cumsum(counts) - counts)[held]
        sums[held] = np.add.reduceat(rows.q[order], starts, axis=0)
    return counts, sums


def scaled(table: DataFrame, vec_id: str, embedding: str, width: int, scale: int) -> DataFrame:
    """(vec_id, q) of the vectors kept: the right size, no component missing."""
    value = F.col(embedding)
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = table.where(value.isNotNull()).where(F.size(value) == width).where(fine)
    problem = F.raise_error(F.lit(f"a component times {scale} is beyond {MOST}")).cast("bigint")

    def whole(x):
        x = scale * x.cast("double")
        return F.when(F.abs(x) <= MOST, F.floor(x)).otherwise(problem).cast("int")

    return kept.select(F.col(vec_id).alias("vec_id"), F.transform(value, whole).alias("q"))


SCHEMA = "vec_id {}, q binary, near int, second int, upper double, lower double, members bigint, sums array<bigint>"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), "<i4")
    return flat.reshape(-1, width).astype(np.int64)


def _packed(q: np.ndarray) -> pa.Array:
    size = 4 * q.shape[1]
    data = q.astype("<i4").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(q), [None, pa.py_buffer(data)]).cast(pa.binary())


def _first_table(vectors: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            q = _packed(flat.reshape(-1, width).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), q], ["vec_id", "q"])

    kind = dict(vectors.dtypes)["vec_id"]
    return vectors.mapInArrow(run, f"vec_id {kind}, q binary")


def _round(table: DataFrame, now: Centroids, before: Centroids | None) -> DataFrame:
    """The vectors with new centroids and bounds, and sums per task and cluster."""
    went, others = now.moved(before)
    k, width = now.points.shape
    fresh = before is None
    kind = dict(table.dtypes)["vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        names, id_type = None, None
        for batch in batches:
            q = _matrix(batch.column(1), width)
            if fresh:
                rows = Bounded.new(q, k)
            else:
                rows = Bounded(q, *(batch.column(i).to_numpy().copy() for i in range(2, 6)))
            search(rows, now, went, others)
            more = cluster_sums(rows, k)
            counts, sums = counts + more[0], sums + more[1]
            n, id_type = len(q), batch.schema.field(0).type
            names = [*STATE, "members", "sums"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows.near), pa.array(rows.second),
                 pa.array(rows.upper), pa.array(rows.lower), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.list_(pa.int64()))],
                names,
            )
        held = np.flatnonzero(counts)
        if len(held):
            n = len(held)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, id_type), pa.nulls(n, pa.binary()), pa.array(held.astype(np.int32)),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()),
                 pa.array(counts[held]), pa.array(sums[held].tolist(), pa.list_(pa.int64()))],
                names,
            )

    columns = ["vec_id", "q"] if fresh else list(STATE)
    return table.select(*columns).mapInArrow(run, SCHEMA.format(kind))


def _written(rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _moved_on(table: DataFrame, now: Centroids) -> Centroids:
    """Every non-empty centroid becomes the floored mean of its vectors."""
    totals = table.where("members IS NOT NULL")
    members = totals.groupBy("near").agg(F.sum("members").alias("n"))
    sums = totals.select("near", F.posexplode("sums").alias("place", "s")).groupBy("near", "place").agg(
        F.sum("s").alias("s")
    )
    points = now.points.copy()
    # At most clusters times components rows come to the driver.
    counts = {r.near: r.n for r in members.collect()}
    for r in sums.collect():
        points[r.near, r.place] = r.s // counts[r.near]
    return Centroids(points)


def first_centroids(points: DataFrame, count: int, prefix: str, width: int) -> np.ndarray:
    """The vectors with the smallest hashes of ids, in that order; ties by components."""
    text = F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = points.select(F.sha2(text, 256).alias("h"), "q").orderBy("h", "q").limit(count).collect()
    flat = np.frombuffer(b"".join(bytes(r.q) for r in rows), "<i4")
    return flat.reshape(-1, width).astype(np.int64)


def assign(
    table: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    prefix: str = "2:",
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> tuple[DataFrame, Centroids | None]:
    """(vec_id, cluster, distance) of every vector kept, and the final centroids.

    Left out are vectors that are null or of another size, or hold a null or non-finite
    component. Null and repeated ids keep a row each; a null id is hashed as the empty
    one. With fewer vectors than ``clusters`` each starts a cluster; equal ones then
    share the smallest, and the others stay empty. A component so large that squared
    distances could leave 64 bits is an error. An empty table gives no row and no
    centroids. Other columns are not read.
    """
    ship_code(table.sparkSession)
    vectors = scaled(table, vec_id, embedding, width, scale)
    points, folder = _written(_first_table(vectors, width), "vectors")
    first = first_centroids(points, clusters, prefix, width)
    kind = dict(points.dtypes)["vec_id"]
    if not len(first):
        empty = points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return empty, None
    now, before = Centroids(first), None
    for _ in range(rounds + 1):
        after, written = _written(_round(points, now, before), "assigned")
        # What a round read is not needed behind the table that it wrote.
        drop_folder(table.sparkSession, folder)
        points, folder, before = after.where("q IS NOT NULL"), written, now
        now = _moved_on(after, now)
    # The last round's move is not made.
    last = before.points

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column(2).to_numpy()
            d = squared(_matrix(batch.column(1), width), last[near])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(d)], ["vec_id", "cluster", "distance"]
            )

    found = points.select("vec_id", "q", "near").mapInArrow(
        measure, f"vec_id {kind}, cluster int, distance bigint"
    )
    return found, before


def digest(point: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, point.tolist())).encode()).hexdigest()


def clustered(table: DataFrame, **settings) -> DataFrame:
    """Adds to ``assign``: ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    found, final = assign(table, **settings)
    spark = table.sparkSession
    found, _ = _written(found, "clusters")
    # One row per cluster.
    sums = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    names = [] if final is None else [digest(p) for p in final.points]
    rows = [(c, d, sum(sums.values()), names[c]) for c, d in sums.items()]
    per_cluster = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    # Bounded by the number of clusters.
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
