"""Centroid clustering over a VA-file: few-bit cells give distance intervals, full vectors are read where these overlap."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pa_schema
from tidemark.session import cut_lineage

DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Bits of a cell.
BITS = 6
#: Scaled components beyond this are taken as it, so that every squared distance is exact in 64 bits.
LARGEST = 1 << 26
#: Vectors compared at once.
TOGETHER = 4_096

_STATE = "row bigint, cells binary, cluster int, mask int"
_SUMS = "cluster int, n bigint, sums array<bigint>"


def scaled(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(row, ``key``, q): of the vectors with ``dimensions`` components, none null or non-finite, floor(scale * x)."""
    x = F.transform(column, lambda v: v.cast("double"))
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    q = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), v * scale))).cast("int"))
    rows = vectors.filter((F.size(column) == dimensions) & F.coalesce(whole, F.lit(False)))
    return cut_lineage(rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias(key), q.alias("q")))


def cut_range(low: int, high: int, quantiles: list[int], cells: int) -> list[int]:
    """First values of at most ``cells`` cells of low ... high, and what is beyond: the quantiles, then halves of the widest cells."""
    cuts = sorted({low, *(q for q in quantiles if low < q <= high)})
    widths = [(a - b, a) for a, b in zip(cuts, [*cuts[1:], high + 1])]
    heapify(widths)
    while len(widths) < cells and widths[0][0] < -1:
        width, first = heappop(widths)
        half = first + -width // 2
        heappush(widths, (first - half, first))
        heappush(widths, (half - first + width, half))
    cuts = [*sorted(first for _, first in widths), high + 1]
    return cuts + [high + 1] * (cells + 1 - len(cuts))


def boundaries(vectors: DataFrame, bits: int = BITS, dimensions: int = DIMENSIONS) -> np.ndarray:
    """For each dimension the first values of its cells and, last, what is beyond all: (dimensions, cells + 1).

    The ends are the exact least and greatest values, so a cell's values are
    known to lie in it.  Half of the cells follow the mean quantiles of slices of
    the vectors; they decide how often intervals overlap, not the result.
    """
    half = 1 << bits - 1
    at = [i / half for i in range(1, half)]
    schema = "d int, low bigint, high bigint, middle array<double>"

    def run(batches):
        low = high = middle = None
        n = 0
        for batch in _slices(batches):
            q = _matrix(batch.column("q"), dimensions)
            low = q.min(axis=0) if low is None else np.minimum(low, q.min(axis=0))
            high = q.max(axis=0) if high is None else np.maximum(high, q.max(axis=0))
            found = np.quantile(q, at, axis=0).T
            middle = found if middle is None else middle + found
            n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dimensions), pa.int32()), pa.array(low), pa.array(high), pa.array((middle / n).tolist(), pa.list_(pa.float64()))], schema=pa_schema(schema))

    each = cut_lineage(vectors.select("q").mapInArrow(run, schema))  # a row for each task and dimension
    ends = each.groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()
    middles: dict[int, list[int]] = {}
    for r in each.select("d", F.posexplode("middle").alias("i", "v")).groupBy("d", "i").agg(F.avg("v").alias("v")).collect():
        middles.setdefault(r["d"], []).append(round(r["v"]))
    return np.array([cut_range(r["low"], r["high"], middles[r["d"]], 1 << bits) for r in ends], np.int64)


def cells_of(q: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(bounds[d, 1:-1], q[:, d], "right") for d in range(q.shape[1])], axis=1).astype(np.uint8)


def pack_cells(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Each row's cells, ``bits`` each, one behind the other."""
    planes = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits :]
    return [row.tobytes() for row in np.packbits(planes.reshape(len(cells), -1), axis=1)]


def unpack_cells(column: pa.Array, bits: int = BITS, dimensions: int = DIMENSIONS) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), dimensions * bits // 8)
    planes = np.unpackbits(raw, axis=1).reshape(len(column), dimensions, bits)
    return (planes @ (1 << np.arange(bits - 1, -1, -1))).astype(np.uint8)


def intervals(bounds: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each cell adds at least and at most to the squared distance of each centroid: (dimensions, cells, centroids)."""
    first, last = bounds[:, :-1, None], bounds[:, 1:, None] - 1
    c = centroids.T[:, None, :]
    below, above = first - c, c - last
    return np.maximum(np.maximum(below, above), 0) ** 2, np.maximum(np.abs(below), np.abs(above)) ** 2


def candidates(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each row of packed cells which centroids can be the nearest: no other is nearer for certain."""
    near, far = (np.zeros((len(cells), tables[0].shape[2]), np.int64) for _ in range(2))
    for d in range(cells.shape[1]):
        near += tables[0][d, cells[:, d]]
        far += tables[1][d, cells[:, d]]
    return near <= far.min(axis=1, keepdims=True)


def distances(q: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.stack([((q - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def nearest(q: np.ndarray, centroids: np.ndarray, possible: np.ndarray) -> np.ndarray:
    """The nearest of the possible centroids, the smaller number on ties; distances only where several are possible."""
    out = possible.argmax(axis=1)
    several = np.flatnonzero(possible.sum(axis=1) > 1)
    if len(several):
        far = np.iinfo(np.int64).max
        out[several] = np.where(possible[several], distances(q[several], centroids), far).argmin(axis=1)
    return out


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dimensions).astype(np.int64)


def _sums(cluster: np.ndarray, q: np.ndarray, weight: int, held: dict) -> None:
    for c in np.unique(cluster).tolist():
        own = cluster == c
        n, s = held.get(c, (0, 0))
        held[c] = (n + weight * int(own.sum()), s + weight * q[own].sum(axis=0))


def _give_sums(held: dict) -> pa.RecordBatch:
    names = sorted(held)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([held[c][0] for c in names], pa.int64()), pa.array([held[c][1].tolist() for c in names], pa.list_(pa.int64()))], schema=pa_schema(_SUMS))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(at, TOGETHER)  # never empty


def _collected(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Count and sums of each cluster; ``rows`` has at most one row a task and cluster."""
    each = rows.select("cluster", F.posexplode(F.concat(F.array("n"), F.col("sums"))).alias("at", "v")).groupBy("cluster", "at").agg(F.sum("v").alias("v"))
    out: dict[int, list[int]] = {}
    for r in each.orderBy("cluster", "at").collect():
        out.setdefault(r["cluster"], []).append(r["v"])
    return {c: (v[0], v[1:]) for c, v in out.items()}


class VaFile:
    """Scaled vectors, their cells and the clusters they were last given."""

    def __init__(self, vectors: DataFrame, key: str = "vec_id", column: str = "embedding"):
        self.key = key
        self.vectors = scaled(vectors, key, column)
        self.fetched: list[int] = []  # vectors read in full, by round
        self.size = self.vectors.count()
        self.bounds = boundaries(self.vectors) if self.size else None

    def first_centroids(self, k: int = CENTROIDS) -> np.ndarray:
        """The ``k`` vectors with the smallest SHA-256 of ``1:`` and their key; rows of one key in order of their components."""
        name = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(self.key).cast("string"), F.lit(""))), 256)
        rows = self.vectors.select(name.alias("name"), "q").orderBy("name", "q").limit(k).collect()
        return np.array([r["q"] for r in rows], np.int64)

    def _bounded(self, state: DataFrame, centroids: np.ndarray) -> DataFrame:
        """``state`` with ``new``, the cluster that the intervals alone decide (else -1), and the possible ones in ``mask``."""
        tables = intervals(self.bounds, centroids)
        power = 1 << np.arange(len(centroids), dtype=np.int64)

        def run(batches):
            for batch in _slices(batches):
                possible = candidates(unpack_cells(batch.column("cells")), tables)
                new = np.where(possible.sum(axis=1) == 1, possible.argmax(axis=1), -1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("cells"), batch.column("cluster"), pa.array((possible @ power).astype(np.int32)), pa.array(new.astype(np.int32))],
                    schema=pa_schema(_STATE + ", new int"),
                )

        return cut_lineage(state.mapInArrow(run, _STATE + ", new int"))

    def round(self, state: DataFrame, centroids: np.ndarray) -> tuple[DataFrame, dict]:
        """Every vector's nearest centroid as new ``state``, and what that adds to count and sums of each cluster.

        Full vectors are joined only where intervals overlap or the cluster
        changed: a vector that stays adds nothing.
        """
        bounded = self._bounded(state, centroids)
        asked = bounded.filter("new < 0 OR new <> cluster").drop("cells")
        k = len(centroids)

        def run(batches):
            for batch in _slices(batches):
                q = _matrix(batch.column("q"), DIMENSIONS)
                possible = (batch.column("mask").to_numpy()[:, None] >> np.arange(k)) & 1 == 1
                new = nearest(q, centroids, possible)
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("cluster"), pa.array(new.astype(np.int32)), batch.column("q")], schema=pa_schema(schema))

        schema = "row bigint, cluster int, new int, q array<int>"
        full = asked.join(self.vectors.select("row", "q"), "row").select("row", "cluster", "mask", "q").mapInArrow(run, schema)
        full = cut_lineage(full)
        self.fetched.append(full.count())

        def moved(batches):
            held: dict = {}
            for batch in _slices(batches):
                q = _matrix(batch.column("q"), DIMENSIONS)
                old, new = (batch.column(n).to_numpy() for n in ("cluster", "new"))
                _sums(new, q, 1, held)
                _sums(old[old >= 0], q[old >= 0], -1, held)
            if held:
                yield _give_sums(held)

        gains = _collected(full.filter("new <> cluster").select("cluster", "new", "q").mapInArrow(moved, _SUMS))
        settled = bounded.join(full.select("row", F.col("new").alias("read")), "row", "left")
        return settled.select("row", "cells", F.coalesce("read", "new").alias("cluster"), F.lit(0).alias("mask")), gains

    def first_round(self, centroids: np.ndarray) -> tuple[DataFrame, dict]:
        """As ``round`` for vectors in no cluster yet: all are summed, so cells and vectors are read in one pass."""
        bounds, tables, k = self.bounds, intervals(self.bounds, centroids), len(centroids)
        schema = _STATE + ", n bigint, sums array<bigint>, overlaps bigint"

        def run(batches):
            held: dict = {}
            overlaps = 0
            for batch in _slices(batches):
                q = _matrix(batch.column("q"), DIMENSIONS)
                cells = cells_of(q, bounds)
                possible = candidates(cells, tables)
                overlaps += int((possible.sum(axis=1) > 1).sum())
                new = nearest(q, centroids, possible)
                _sums(new, q, 1, held)
                n = len(new)
                nothing = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(pack_cells(cells), pa.binary()), pa.array(new.astype(np.int32)), pa.array(np.zeros(n, np.int32)), *nothing], schema=pa_schema(schema))
            if held:
                s = _give_sums(held)
                n = s.num_rows
                seen = pa.array([overlaps] + [0] * (n - 1), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), s.column("cluster"), pa.nulls(n, pa.int32()), s.column("n"), s.column("sums"), seen], schema=pa_schema(schema))

        both = cut_lineage(self.vectors.select("row", "q").mapInArrow(run, schema))
        sums = both.filter("row IS NULL")
        self.fetched.append(sums.agg(F.sum("overlaps")).first()[0] or 0)
        return both.filter("row IS NOT NULL").select("row", "cells", "cluster", "mask"), _collected(sums.select("cluster", "n", "sums"))

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """(key, cluster, distance) of every vector; each is read in full, as its exact distance is asked for."""
        bounds, tables, key = self.bounds, intervals(self.bounds, centroids), self.key
        schema = f"{key} bigint, cluster int, distance bigint"

        def run(batches):
            for batch in _slices(batches):
                q = _matrix(batch.column("q"), DIMENSIONS)
                new = nearest(q, centroids, candidates(cells_of(q, bounds), tables))
                far = ((q - centroids[new]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(new.astype(np.int32)), pa.array(far)], schema=pa_schema(schema))

        return self.vectors.select(key, "q").mapInArrow(run, schema)


def cluster(file: VaFile, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after ``rounds`` rounds; a non-empty one becomes the floor of its vectors' mean, an empty one stays."""
    centroids = file.first_centroids(k)
    totals: dict[int, tuple[int, list[int]]] = {}
    state = None
    for number in range(rounds if len(centroids) else 0):
        state, gains = file.first_round(centroids) if state is None else file.round(state, centroids)
        for c, (n, sums) in gains.items():
            before = totals.get(c, (0, [0] * DIMENSIONS))
            totals[c] = (before[0] + n, [a + b for a, b in zip(before[1], sums)])
        centroids = np.array([[s // totals[c][0] for s in totals[c][1]] if totals.get(c, (0,))[0] else old.tolist() for c, old in enumerate(centroids)], np.int64)
    return centroids


def centroid_clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key``, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector.

    Vectors of another length, null, or with a null or non-finite component are
    left out.  Repeated rows and keys are vectors of their own; a null key is
    hashed as the empty string.  With fewer than ``k`` vectors each is a centroid; equal
    vectors go to the smaller number.  An empty table gives no rows; extra
    columns are ignored.  Components beyond ``LARGEST`` once scaled are taken as that.
    """
    file = VaFile(vectors, key, column)
    centroids = cluster(file, k, rounds)
    spark = vectors.sparkSession
    if not len(centroids):
        return spark.createDataFrame([], f"{key} bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    rows = cut_lineage(file.assigned(centroids))
    names = [(c, hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest()) for c, v in enumerate(centroids)]
    # as many rows as there are centroids
    inertia = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    about = spark.createDataFrame([(c, inertia.get(c, 0), sum(inertia.values()), sha) for c, sha in names], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(about, "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
