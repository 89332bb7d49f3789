"""k-means over integer vectors that scans a vector only where bounds leave its centroid open.

Every vector carries its centroid and a lower bound of its distance to all others. When centroids
move, the members of cluster i lie in a sphere around its old centroid c. For another centroid that
moved from a to b, the most by which any point of the sphere can have come nearer, the largest
|x - a| - |x - b|, is bounded in the plane through a, b and c. Points for which that difference is at
least t lie within one branch of a hyperbola with foci a and b, thus within the cone around the
direction of the move, from the middle of a and b, whose angle has the cosine t / |a - b|. So if the
sphere, seen from there, stays at least an angle w off that direction, no member has come nearer by
more than |a - b| cos w, or at all if w is a right angle or more. The lower bound falls by the largest
of these over all other centroids, never by more than the largest move. A vector whose exact distance
to its own centroid stays strictly under its lower bound keeps it; all others, ties included, are
compared with every centroid in integers.

State between rounds is one narrow row a vector (packed integers, centroid, bound), written to the
checkpoint folder; the driver holds the centroids and one sum a cluster.

Defined cases: rows whose vector is NULL, of another length, or has a NULL, NaN or infinite component
are dropped; a NULL id sorts last among the start vectors, rows that share an id by their components;
fewer vectors than clusters give fewer clusters; a component over ``vectors.LARGEST / scale`` is an
error; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spellcast.llm.vectors import matrix, scaled, summed, usable
from spellcast.session import checkpointed

WIDTH, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
#: Relative slack of floating bounds, many times their rounding error.
SLACK = 1e-9
BLOCK = 8192


def nearer_by(a: np.ndarray, b: np.ndarray, c: np.ndarray, radius: float) -> float:
    """A bound of |x - a| - |x - b| over the sphere of ``radius`` around ``c``: 0 at least, |a - b| at most."""
    move = math.sqrt(float(((a - b) ** 2).sum())) * (1 + SLACK)
    if move == 0:
        return 0.0
    seen = c - (a + b) / 2
    away = math.sqrt(float((seen**2).sum()))
    radius *= 1 + SLACK
    if away <= radius:
        return move
    cos_c = float(seen @ (b - a)) / (away * math.sqrt(float(((a - b) ** 2).sum())))
    cos_c = min(1.0, cos_c + SLACK)
    sin_r = min(1.0, radius / away + SLACK)
    cos_r = math.sqrt(1 - sin_r * sin_r)
    if cos_c >= cos_r:
        return move
    cosine = cos_c * cos_r + math.sqrt(max(0.0, 1 - cos_c * cos_c)) * sin_r + SLACK
    return move * min(1.0, max(0.0, cosine))


def loosening(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """By how much the lower bounds of each cluster's members fall when the centroids move."""
    a, b = old.astype(float), new.astype(float)
    return np.array([max((nearer_by(a[j], b[j], a[i], r) for j in range(len(a)) if j != i), default=0.0) for i, r in enumerate(radii)])


def _squares(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.stack([((v - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _scan(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (lowest of ties), its squared distance, and a lower bound of the others' distance."""
    d = _squares(v, centroids)
    own = d.argmin(axis=1)
    square = d[np.arange(len(d)), own]
    d[np.arange(len(d)), own] = np.iinfo(np.int64).max
    return own, square, np.sqrt(d.min(axis=1)) * (1 - SLACK)


def reassign(state: DataFrame, centroids: np.ndarray, fall: np.ndarray | None) -> DataFrame:
    """Rows (vec_id, packed, cluster, square, bound, scanned) under ``centroids``.

    ``fall`` is what the bounds of each cluster's members lose first; None stands for rows without
    a cluster yet, which are all scanned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = batch.slice(start, BLOCK)
                n = block.num_rows
                packed = block.column("packed").to_pylist()
                v = np.stack([_unpacked(p) for p in packed])
                if fall is None:
                    own, square, bound = _scan(v, centroids)
                    scanned = np.ones(n, dtype=bool)
                else:
                    own = block.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
                    bound = block.column("bound").to_numpy(zero_copy_only=False) * (1 - SLACK) - fall[own]
                    square = ((v - centroids[own]) ** 2).sum(axis=1)
                    scanned = ~(np.sqrt(square) * (1 + SLACK) < bound)
                    if scanned.any():
                        own[scanned], square[scanned], bound[scanned] = _scan(v[scanned], centroids)
                yield pa.RecordBatch.from_arrays(
                    [block.column("vec_id"), block.column("packed"), pa.array(own.astype(np.int32)), pa.array(square), pa.array(bound), pa.array(scanned)],
                    names=["vec_id", "packed", "cluster", "square", "bound", "scanned"],
                )

    kind = dict(state.dtypes)["vec_id"]
    columns = ["vec_id", "packed"] + ([] if fall is None else ["cluster", "bound"])
    return state.select(*columns).mapInArrow(run, f"vec_id {kind}, packed binary, cluster int, square long, bound double, scanned boolean")


def _packed(v: np.ndarray) -> list[bytes]:
    """Every row in 16-bit integers, or 32-bit ones where a component needs them."""
    wide = np.abs(v).max(axis=1, initial=0) >= 2**15
    return [row.astype("<i4" if w else "<i2").tobytes() for row, w in zip(v, wide)]


def _unpacked(row: bytes) -> np.ndarray:
    return np.frombuffer(row, "<i4" if len(row) == 4 * WIDTH else "<i2").astype(np.int64)


def packed_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, packed) of the vectors that can be used."""
    v = F.col(vector_col)
    good = rows.filter(usable(v) & (F.size(v) == WIDTH)).select(F.col(id_col).alias("vec_id"), scaled(v, SCALE).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(_packed(matrix(batch.column("v"), WIDTH)), pa.binary())], names=["vec_id", "packed"])

    return good.mapInArrow(run, f"vec_id {dict(good.dtypes)['vec_id']}, packed binary")


def start_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest digests of seed and id, in that order."""
    v = F.col(vector_col)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    good = rows.filter(usable(v) & (F.size(v) == WIDTH)).select(digest.alias("digest"), scaled(v, SCALE).alias("v"))
    first = good.orderBy(F.col("digest").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r.v for r in first], dtype=np.int64).reshape(-1, WIDTH)


def cluster_sums(state: DataFrame) -> DataFrame:
    """Per cluster: vectors, sums of components, summed and largest squared distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = batch.slice(start, BLOCK)
                v = np.stack([_unpacked(p) for p in block.column("packed").to_pylist()])
                own, square = block.column("cluster").to_numpy(), block.column("square").to_numpy()
                for c in np.unique(own).tolist():
                    mine = own == c
                    n, s, d, far = total.get(c, (0, np.zeros(WIDTH, dtype=np.int64), 0, 0))
                    total[c] = [n + int(mine.sum()), s + v[mine].sum(axis=0), d + int(square[mine].sum()), max(far, int(square[mine].max()))]
        rows = [{"cluster": c, "n": n, "sums": s.tolist(), "inertia": d, "farthest": far} for c, (n, s, d, far) in sorted(total.items())]
        kind = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("inertia", pa.int64()), ("farthest", pa.int64())])
        yield pa.RecordBatch.from_pylist(rows, schema=kind)

    parts = state.select("packed", "cluster", "square").mapInArrow(run, "cluster int, n long, sums array<long>, inertia long, farthest long")
    return summed(parts, ["cluster"], WIDTH, F.sum("inertia").alias("inertia"), F.max("farthest").alias("farthest"))


def moved(centroids: np.ndarray, sums: list) -> np.ndarray:
    """Centroids replaced by the exact floor of their members' mean; those without members stay."""
    out = centroids.copy()
    for r in sums:
        out[r.cluster] = np.array(r.sums, dtype=np.int64) // r.n
    return out


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", rounds: int = ROUNDS) -> DataFrame:
    """Per vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid (components)."""
    spark = rows.sparkSession
    centroids = start_vectors(rows, id_col, vector_col)
    if not len(centroids):
        kind = dict(rows.dtypes)[id_col]
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>, scanned boolean")
    state = checkpointed(reassign(packed_vectors(rows, id_col, vector_col), centroids, None))
    sums = cluster_sums(state).collect()
    for _ in range(rounds):
        new = moved(centroids, sums)
        radii = np.zeros(len(centroids))
        for r in sums:
            radii[r.cluster] = math.sqrt(r.farthest) * (1 + SLACK)
        state = checkpointed(reassign(state, new, loosening(centroids, new, radii)))
        centroids, sums = new, cluster_sums(state).collect()
    every = sum(r.inertia for r in sums)
    # One row a cluster, so at most as many as the parameter says.
    table = spark.createDataFrame(
        [(r.cluster, r.inertia, every, centroids[r.cluster].tolist()) for r in sums], "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    )
    out = state.join(F.broadcast(table), "cluster")
    return out.select("vec_id", "cluster", F.col("square").alias("distance"), "cluster_inertia", "inertia", "centroid", "scanned")
