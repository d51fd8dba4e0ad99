import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import vafile as V


def brute(rows, k=16, rounds=3):
    kept = [(i, np.floor(64 * np.array(x, float)).astype(np.int64)) for i, x in rows if x is not None and len(x) == 64 and all(v is not None and np.isfinite(v) for v in x)]
    q = np.array([v for _, v in kept])
    name = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1].tolist())
    centroids = [v for _, v in sorted(kept, key=name)[:k]]
    for turn in range(rounds + 1):
        d = np.stack([((q - c) ** 2).sum(axis=1) for c in centroids], axis=1)
        own = d.argmin(axis=1)
        if turn < rounds:
            centroids = [np.array([s // int((own == c).sum()) for s in q[own == c].sum(axis=0).tolist()]) if (own == c).any() else v for c, v in enumerate(centroids)]
    near = d.min(axis=1)
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return sorted((str(i), int(c), int(x), int(near[own == c].sum()), int(near.sum()), sha[c]) for (i, _), c, x in zip(kept, own, near))


def rows_of(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(2)
    middles = rng.normal(0, 0.5, (9, 64))
    rows = [(i, (middles[i % 9] + rng.normal(0, 0.1, 64)).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(40)]  # one very common vector
    rows += [(7, rows[7][1]), (None, rows[8][1]), (None, rows[9][1]), (7, rows[1][1])]
    bad = [None, [], [0.1] * 63, [0.1] * 65, [None, *[0.1] * 63], [float("nan"), *[0.1] * 63], [float("-inf"), *[0.1] * 63]]
    rows += [(500 + i, x) for i, x in enumerate(bad)]
    random.Random(1).shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, q int, cluster string").repartition(3)


def test_equals_all_distances(spark, points):
    assert rows_of(V.centroid_clusters(frame(spark, points))) == brute(points)


def test_few_equal_and_no_vectors(spark, points):
    few = points[:5]
    assert rows_of(V.centroid_clusters(frame(spark, few))) == brute(few)
    same = [(i, [0.25] * 64) for i in range(30)]
    assert rows_of(V.centroid_clusters(frame(spark, same))) == brute(same)
    assert V.centroid_clusters(frame(spark, points).limit(0)).count() == 0
    huge = V.centroid_clusters(frame(spark, [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)])).collect()
    assert len(huge) == 3 and all(r.distance == 0 for r in huge)


def test_full_vectors_are_read_only_where_intervals_overlap(spark, points):
    # distinct vectors of which no dimension has more values than cells, so only equal distances overlap
    rng = np.random.default_rng(3)
    middles = rng.uniform(-0.4, 0.4, (9, 64))
    apart = [(i, np.clip(middles[i % 9] + rng.normal(0, 0.04, 64), -0.49, 0.49).tolist()) for i in range(400)]
    file = V.VaFile(frame(spark, apart))
    centroids = V.cluster(file)
    assert len(centroids) == 16
    assert file.fetched[0] < 0.2 * file.size and file.fetched[2] < 0.2 * file.size
    assert file.fetched[1] < file.size


@pytest.mark.parametrize("bits", [2, 4, 6])
def test_intervals_hold_the_distances(bits):
    rng = np.random.default_rng(bits)
    q = rng.integers(-90, 300, (200, 64))
    bounds = np.array([V.cut_range(int(c.min()), int(c.max()), np.quantile(c, [0.25, 0.5, 0.75]).astype(int).tolist(), 1 << bits) for c in q.T])
    cells = V.cells_of(q, bounds)
    import pyarrow as pa

    assert (V.unpack_cells(pa.array(V.pack_cells(cells, bits)), bits) == cells).all()
    centroids = rng.integers(-90, 300, (5, 64))
    near, far = V.intervals(bounds, centroids)
    at = np.arange(64)
    d = V.distances(q, centroids)
    for i in range(200):
        assert (near[at, cells[i]].sum(axis=0) <= d[i]).all() and (d[i] <= far[at, cells[i]].sum(axis=0)).all()
    possible = V.candidates(cells, (near, far))
    assert possible[np.arange(200), d.argmin(axis=1)].all()
    assert (V.nearest(q, centroids, possible) == d.argmin(axis=1)).all()
