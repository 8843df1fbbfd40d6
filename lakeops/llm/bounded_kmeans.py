"""k-means over integer vectors that skips distances by bounds loosened with the geometry of moving centroids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import scratch_path, written

#: Components become whole numbers of this part of one.
SCALE = 1024
#: Larger components are refused: a squared distance of 64 of them would not fit in 64 bits.
LARGEST = 1 << 27
#: Up to this size all sums of 64 products are whole numbers that a double holds exactly.
EXACT = 1 << 20
#: Bounds are widened by this share, more than rounding can make them wrong by.
SLACK = 1e-9


def whole_vectors(vectors: DataFrame, id: str, vector: str, components: int) -> DataFrame:
    """``id`` and ``point`` (whole numbers) of the vectors with ``components`` finite components; the others go."""
    values = F.col("vector")
    # Null for a null, an infinite or an undefined component.
    finite = F.coalesce(F.forall(values, lambda x: F.abs(x) < float("inf")), F.lit(False))
    largest = F.lit(float(LARGEST))

    def whole(x: Column) -> Column:
        scaled = F.floor(x * SCALE)
        too_large = F.raise_error(F.lit(f"a component is larger than {LARGEST // SCALE}")).cast("int")
        return F.when(F.abs(x * SCALE) < largest, scaled.cast("int")).otherwise(too_large)

    kept = (
        vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .filter(F.size("vector") == components)
        .filter(finite)
    )
    return kept.select("id", F.transform(values, whole).alias("point"))


def first_centroids(points: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The points whose id has the smallest hash, in the order of the hashes; of the same hash the smallest point first.

    Only as many rows as there are clusters reach the driver. A null id comes last.
    """
    hashed = points.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    first = hashed.orderBy(F.col("hash").asc_nulls_last(), "point").limit(clusters).collect()
    return np.array([row["point"] for row in first], np.int64)


def squared_distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row per point and a column per centroid."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
        x, c = points.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(1) for c in centroids.astype(np.int64)], axis=1)


def loosening(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """How much nearer the centroid that moves from ``old`` to ``new`` can come to any point of a sphere, at most.

    The points for which a centroid comes nearer by the same amount lie on one sheet of a hyperboloid around the line of
    the move, and that sheet lies inside its asymptotic cone around the middle of the move: a point seen from the middle
    under the angle a to the move is come nearer to by at most drift * cos(a). In the plane through the move and the
    centre of the sphere, the smallest such angle of a point of the sphere is that of the centre less that of the
    sphere's half width. It is zero, and the bound the whole drift, only where the sphere reaches the line ahead.
    """
    move = (new - old).astype(np.float64)
    drift = float(np.linalg.norm(move))
    if drift == 0.0:
        return 0.0
    ray = centre - (old + new) / 2
    far = float(np.linalg.norm(ray))
    if far <= radius:
        return drift
    angle = np.arccos(np.clip(float(ray @ move) / (far * drift), -1.0, 1.0)) - np.arcsin(min(1.0, radius / far))
    return drift * max(0.0, float(np.cos(max(angle, 0.0))))


class Move:
    """What a round has to know of the move of all centroids from the last one."""

    def __init__(self, old: np.ndarray, new: np.ndarray, radius: np.ndarray):
        """``radius``: of the sphere around each old centroid that holds all points assigned to it."""
        k = len(new)
        self.new = new
        self.drift = np.linalg.norm((new - old).astype(np.float64), axis=1) * (1 + SLACK)
        nearer = np.array([[loosening(old[a], radius[a], old[j], new[j]) for j in range(k)] for a in range(k)])
        np.fill_diagonal(nearer, 0.0)
        #: By how much the nearest other centroid can have come nearer to a point of each cluster.
        self.loose = nearer.max(axis=1) * (1 + SLACK) + SLACK
        between = np.sqrt(squared_distances(new, new).astype(np.float64))
        np.fill_diagonal(between, np.inf)
        #: Nearer than this to its own centroid a point is nearer to no other.
        self.safe = between.min(axis=1) / 2 * (1 - SLACK)


def scanned(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of each point (of equally near ones the first), a bound above its distance and one below the
    distance to every other centroid."""
    squared = squared_distances(points, centroids)
    nearest = squared.argmin(axis=1).astype(np.int32)
    rows = np.arange(len(points))
    upper = np.sqrt(squared[rows, nearest].astype(np.float64)) * (1 + SLACK)
    if squared.shape[1] == 1:
        return nearest, upper, np.full(len(points), np.inf)
    squared[rows, nearest] = np.iinfo(np.int64).max
    return nearest, upper, np.sqrt(squared.min(axis=1).astype(np.float64)) * (1 - SLACK)


def reassigned(
    points: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, move: Move
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Clusters and bounds after the centroids moved, and which points had to be scanned.

    A point stays without a look where its widened bounds still part; else its distance to its own centroid is worked
    out, and only if that does not settle it are all centroids compared.
    """
    cluster, lower = cluster.copy(), lower - move.loose[cluster]
    upper = (upper + move.drift[cluster]) * (1 + SLACK)
    other = np.maximum(lower, move.safe[cluster])
    unsure = np.flatnonzero(~(upper < other))
    for own in np.unique(cluster[unsure]):
        rows = unsure[cluster[unsure] == own]
        upper[rows] = np.sqrt(squared_distances(points[rows], move.new[own : own + 1])[:, 0].astype(np.float64)) * (1 + SLACK)
    unsure = unsure[~(upper[unsure] < other[unsure])]
    if len(unsure):
        cluster[unsure], upper[unsure], lower[unsure] = scanned(points[unsure], move.new)
    looked = np.zeros(len(points), bool)
    looked[unsure] = True
    return cluster, upper, lower, looked


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of the same length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def _assign(centroids: np.ndarray, move: Move | None):
    """One round over batches of points, or of points with the state of the round before."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            points = _matrix(batch.column(1))
            if move is None:
                state = (*scanned(points, centroids), np.ones(len(batch), bool))
            else:
                state = reassigned(points, *(batch.column(k).to_numpy() for k in (2, 3, 4)), move)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, state)],
                names=["id", "point", "cluster", "upper", "lower", "scanned"],
            )

    return assign


def _measure(centroids: np.ndarray):
    """The exact squared distance of every assigned point."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, cluster = _matrix(batch.column(1)), batch.column(2).to_numpy()
            distance = ((points - centroids[cluster]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"]
            )

    return measure


def _means(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids after a round (those without points stay), and the radius of each cluster around its last centroid.

    Points are added up where they are read; a row per cluster is all that moves.
    """
    sums = [F.sum(F.col("point")[at].cast("bigint")) for at in range(centroids.shape[1])]
    found = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("upper").alias("radius"), F.array(*sums).alias("sums"))
    moved, radius = centroids.copy(), np.zeros(len(centroids))
    for row in found.collect():
        moved[row["cluster"]] = [total // row["n"] for total in row["sums"]]
        radius[row["cluster"]] = row["radius"]
    return moved, radius


def kmeans(
    vectors: DataFrame,
    clusters: int,
    rounds: int,
    seed: int,
    components: int = 64,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every vector
    with ``components`` finite components, in whole numbers of 1 / SCALE.

    Points carry their cluster and two bounds from round to round, in two folders written in turn: a lost executor costs
    its tasks of one round, and the disk holds two rounds at most. Only sums per cluster reach the driver. Vectors of
    another length, with a null, infinite or undefined component, and null vectors go. Repeated rows, also with one id,
    are points of their own; with fewer vectors than clusters there are as many clusters as vectors; an empty table gives
    an empty result. Components beyond LARGEST / SCALE raise an error. Other columns are not read.
    """
    spark, id_type = vectors.sparkSession, vectors.schema[id].dataType.simpleString()
    points = written(whole_vectors(vectors, id, vector, components), "points")
    centroids = first_centroids(points, clusters, seed)
    state_schema = f"id {id_type}, point array<int>, cluster int, upper double, lower double, scanned boolean"
    folders = [scratch_path(spark, f"kmeans-{name}") for name in ("even", "odd")]

    def assigned(source: DataFrame, move: Move | None, number: int) -> DataFrame:
        made = source.mapInArrow(_assign(centroids, move), state_schema)
        made.write.mode("overwrite").parquet(folders[number % 2])
        return spark.read.schema(state_schema).parquet(folders[number % 2])

    state, move = points, None
    for number in range(rounds if len(centroids) else 0):
        state = assigned(state, move, number)
        last = centroids
        centroids, radius = _means(state, last)
        move = Move(last, centroids, radius)
    if len(centroids):
        state = assigned(state, move, rounds)
    else:
        state = points.withColumn("cluster", F.lit(0))
    placed = state.select("id", "point", "cluster")
    distances = placed.mapInArrow(_measure(centroids), f"id {id_type}, cluster int, distance bigint")
    measured = written(distances, "distances")
    totals = measured.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()
    inertia = {row["cluster"]: row["total"] for row in totals}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> Column:
        return F.get(F.array(*(F.lit(value).cast(kind) for value in values)).cast(f"array<{kind}>"), F.col("cluster"))

    return measured.select(
        F.col("id").alias(id),
        "cluster",
        "distance",
        of_cluster([inertia.get(number, 0) for number in range(len(digests))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )
