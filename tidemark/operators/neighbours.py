"""Exact k nearest neighbours of a set of targets, without a cross join."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.frames import empty, plain

#: Shared pivots: candidates whose distances to every block and target are known.
PIVOTS = 8
#: Distances that one step of a task computes at once, times dimensions.
STEP = 4_000_000


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=float) for x in vectors]) if len(vectors) else np.zeros((0, 0))


def _distances(points: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Distances (asked, points)."""
    return np.sqrt(((points[None, :, :] - asked[:, None, :]) ** 2).sum(axis=2))


class Cells:
    """Blocks of candidates around shared pivots, and which of them a target has to open.

    A candidate belongs to its nearest pivot; the candidates of a pivot are cut
    into rings of about equal size by their distance.  For every block the least
    and greatest distance to each pivot is known, so the triangle inequality
    gives each target a least distance to the block's members, and the sizes of
    the blocks nearest for certain a greatest distance of its ``k``-th neighbour.
    Only pivots, ring edges and bounds, a few numbers a block, reach the driver.
    """

    def __init__(self, candidates: DataFrame, candidate_id: Sequence[str], k: int, blocks: int, embargo: int | None):
        self.k, self.embargo = k, embargo
        order = F.xxhash64(*[F.col(c).cast("string") for c in candidate_id])
        rows = candidates.where(F.col("vector").isNotNull()).select("vector", order.alias("_o")).orderBy("_o").limit(PIVOTS).collect()
        self.pivots = np.unique(_matrix([r["vector"] for r in rows]), axis=0)
        if not len(self.pivots):
            self.edges, self.low, self.high, self.size = [], *(np.zeros((0, 0)),) * 2, np.zeros(0)
            return
        each = self._measured(candidates)
        share = [i / blocks for i in range(1, blocks)] or [0.5]
        found = each.groupBy("_pivot").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_own", share, 1000).alias("at")).collect()
        total = sum(r["n"] for r in found)
        self.edges = [np.zeros(0)] * len(self.pivots)
        for r in found:  # as many rings as its share of all candidates
            rings = max(1, round(blocks * r["n"] / total))
            self.edges[r["_pivot"]] = np.unique([r["at"][round(i * blocks / rings) - 1] for i in range(1, rings)])
        self.first = np.cumsum([0] + [len(e) + 1 for e in self.edges])
        self.low = np.full((self.first[-1], len(self.pivots)), np.inf)
        self.high = np.full((self.first[-1], len(self.pivots)), -np.inf)
        self.size = np.zeros(self.first[-1], np.int64)
        spans = [f(F.col("_far")[i]).alias(f"{n}{i}") for i in range(len(self.pivots)) for n, f in (("lo", F.min), ("hi", F.max))]
        for r in self.dealt(candidates, keep_far=True).groupBy("_block").agg(F.count(F.lit(1)).alias("n"), *spans).collect():
            self.size[r["_block"]] = r["n"]
            self.low[r["_block"]] = [r[f"lo{i}"] for i in range(len(self.pivots))]
            self.high[r["_block"]] = [r[f"hi{i}"] for i in range(len(self.pivots))]

    def _measured(self, candidates: DataFrame) -> DataFrame:
        """Candidates with their distances to all pivots; those with a missing component are nobody's neighbour."""
        far = F.array(*[F.sqrt(F.aggregate(F.zip_with("vector", F.array(*map(F.lit, p.tolist())), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)) for p in self.pivots])
        rows = candidates.withColumn("_far", far).withColumn("_own", F.array_min("_far"))
        rows = rows.where(F.col("_own").isNotNull() & ~F.isnan(F.array_max("_far")))
        return rows.withColumn("_pivot", (F.array_position("_far", F.col("_own")) - 1).cast("int"))

    def dealt(self, candidates: DataFrame, keep_far: bool = False) -> DataFrame:
        """Candidates with the number of their block."""
        block = None
        for p, edges in enumerate(self.edges):
            ring = sum((F.when(F.col("_own") > float(e), 1).otherwise(0) for e in edges), F.lit(0)) + F.lit(int(self.first[p]))
            block = F.when(F.col("_pivot") == p, ring) if block is None else block.when(F.col("_pivot") == p, ring)
        rows = self._measured(candidates).withColumn("_block", block.cast("int")).drop("_own", "_pivot")
        return rows if keep_far else rows.drop("_far")

    def opened(self, vectors: np.ndarray, left_out: np.ndarray) -> np.ndarray:
        """For each target and block whether one of its ``k`` nearest can be there; ``left_out`` candidates may not count."""
        d = _distances(self.pivots, vectors)[:, None, :]
        with np.errstate(invalid="ignore"):
            least = np.maximum(np.maximum(self.low[None] - d, d - self.high[None]).max(axis=2), 0)
            most = (d + self.high[None]).min(axis=2)
        order = np.argsort(most, axis=1, kind="stable")
        held = np.cumsum(self.size[order], axis=1) >= (self.k + left_out)[:, None]
        at = np.where(held.any(axis=1), held.argmax(axis=1), len(self.size) - 1)
        rows = np.arange(len(vectors))
        reach = np.where(held.any(axis=1), most[rows, order[rows, at]], np.inf)
        # a little wider than computed, as distances are rounded
        return (least <= (reach * (1 + 1e-9) + 1e-12)[:, None]) & (self.size > 0)

    def asked(self, targets: DataFrame, candidates: DataFrame, own: Sequence[str]) -> DataFrame:
        """A row (target, own..., vector, _block) for each cell that a target opens."""
        rows = targets.select("target", *own, "vector")
        if self.embargo is not None:  # candidates of its own place may be left out
            at_home = candidates.groupBy("place").agg(F.count(F.lit(1)).alias("_home"))
            rows = rows.join(at_home, "place", "left")
        rows = rows.withColumn("_home", F.coalesce("_home", F.lit(0)) if self.embargo is not None else F.lit(0))
        schema = T.StructType([*targets.select("target", *own, "vector").schema.fields, T.StructField("_block", T.IntegerType())])
        names = schema.fieldNames()

        def cells(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                pdf = pdf[[x is not None for x in pdf["vector"]]]
                for at in range(0, len(pdf), 1024):
                    part = pdf.iloc[at : at + 1024]
                    row, block = np.nonzero(self.opened(_matrix(part["vector"]), part["_home"].to_numpy()))
                    out = part.iloc[row].copy()
                    out["_block"] = block.astype(np.int32)
                    yield plain(out[names].reset_index(drop=True))

        return rows.mapInPandas(cells, schema)


def nearest(
    candidates: DataFrame,
    targets: DataFrame,
    k: int,
    candidate_id: Sequence[str],
    payload: Sequence[str] = (),
    embargo: int | None = None,
    blocks: int | None = None,
    slices: int | None = None,
) -> DataFrame:
    """The ``k`` candidates closest to each target by Euclidean distance.

    ``targets`` is (target, vector) and ``candidates`` (candidate_id...,
    payload..., vector).  Candidates are dealt into about ``blocks`` blocks
    around shared pivots; a target meets only the blocks that can hold one of
    its neighbours (:class:`Cells`), the targets of a block are dealt into
    ``slices``, and each task keeps only its own best ``k``.  So a task holds at
    most one block and one slice, a shuffle carries ``k`` rows per opened cell,
    and the result is exact.

    By default there are as many blocks as shuffle partitions and one slice.

    With ``embargo`` both sides carry ``place`` and ``month``: candidates of the
    target's own place within that many months are left out.
    """
    blocks = blocks or int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = slices or 1
    own = ["place", "month"] if embargo is not None else []
    ids = list(dict.fromkeys([*candidate_id, *own]))
    kinds = {f.name: f.dataType for f in candidates.schema}
    schema = T.StructType(
        [T.StructField("target", targets.schema["target"].dataType)]
        + [T.StructField(c, kinds[c]) for c in (*candidate_id, *payload)]
        + [T.StructField("distance", T.DoubleType())]
    )
    names = [f.name for f in schema]
    # in an order of their own, so that a target's ties do not depend on the blocks
    rows = candidates.select(*ids, *payload, "vector")
    cells = Cells(rows, candidate_id, k, blocks, embargo)
    if not len(cells.pivots):
        return candidates.sparkSession.createDataFrame([], schema).withColumn("position", F.lit(0))
    dealt = cells.dealt(rows).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    asked = cells.asked(targets, rows, own).withColumn("_slice", F.pmod(F.xxhash64("target"), F.lit(slices)).cast("int"))

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return empty(names)
        left = left.sort_values(list(candidate_id), kind="stable").reset_index(drop=True)
        points, vectors = _matrix(left["vector"]), _matrix(right["vector"])
        if embargo is not None:
            places, months = left["place"].to_numpy(), left["month"].to_numpy()
            homes, times = right["place"].to_numpy(), right["month"].to_numpy()
        found = []
        step = max(1, STEP // max(1, points.size))
        for at in range(0, len(vectors), step):
            distance = _distances(points, vectors[at : at + step])
            if embargo is not None:
                here = slice(at, at + step)
                distance[(places[None, :] == homes[here, None]) & (np.abs(months[None, :] - times[here, None]) <= embargo)] = np.inf
            # all that reach the k-th smallest, so that ties keep the order of the candidates
            edge = np.partition(distance, k - 1, axis=1)[:, k - 1 : k] if k < len(points) else np.full((len(distance), 1), np.inf)
            row, member = np.nonzero((distance <= edge) & (distance < np.inf))
            order = np.lexsort((member, distance[row, member], row))
            row, member = row[order], member[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            row, member = row[rank < k], member[rank < k]
            part = left.iloc[member][[*candidate_id, *payload]].copy()
            part["target"], part["distance"] = right["target"].to_numpy()[at + row], distance[row, member]
            found.append(part)
        return plain(pd.concat(found, ignore_index=True)[names])

    partial = dealt.groupBy("_block", "_slice").cogroup(asked.groupBy("_block", "_slice")).applyInPandas(best, schema)
    order = Window.partitionBy("target").orderBy("distance", *candidate_id)
    return partial.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)
