import numpy as np
import pytest
from pyspark.sql import functions as F

from quaywise.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, a string, list string, score string"


def table(spark, given):
    return spark.createDataFrame([(i, v, 0, "clash", "clash", "clash", "clash") for i, v in given], SCHEMA)


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(given, most=10, step=100):
    held = sorted({(i, tuple(np.array(v, "f4").tolist())) for i, v in given if i is not None and usable(v) and len(v) == 8})
    ids = np.array([i for i, _ in held])
    x = np.array([v for _, v in held], "f8")
    out = {}
    for k, (i, _) in enumerate(held):
        if i % step == 0:
            d = np.sqrt(np.square(x - x[k]).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:most]
            out[i] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def sample(n, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((n, 8)).astype("f4"))]


def odd():
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [nan] * 8, [inf] + [1.0] * 7, [1.0, 2.0]]
    return [(5000 + 100 * k, v) for k, v in enumerate(bad)] + [(None, [1.0] * 8)]


def result(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def test_all_lists_give_exact_results(spark, monkeypatch):
    """With every list read, results are those of brute force: ties, copies and odd rows included."""
    monkeypatch.setattr(neighbours, "PROBE_SHARE", 1.0)
    monkeypatch.setattr(neighbours, "LIST_ROWS", 20)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbours, "DEGREE", 8)
    same = sample(1, 9)[0][1]
    given = sample(400) + [(600 + i, same) for i in range(300)] + [(3, sample(400)[3][1])] + odd()
    given += [(2000, [1.0] + [0.0] * 7)] + [(2001 + k, [1.0] + [0.0] * k + [2.0] + [0.0] * (6 - k)) for k in range(7)]
    found = result(neighbours.search(table(spark, given), F.col("vec_id") % 100 == 0, probe_ratio=1e9))
    expected = brute(given)
    assert found.keys() == expected.keys()
    for q, rows in expected.items():
        assert [i for i, _ in found[q]] == [i for i, _ in rows]
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in rows], rel=1e-12)


def test_recall(spark):
    given = sample(4000, 4)
    found = result(neighbours.search(table(spark, given), F.col("vec_id") % 100 == 0))
    expected = brute(given)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in rows}) for q, rows in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_lonely_queries_get_all_their_neighbours(spark):
    """Vectors with a list of their own, at and near its centroid, read on until they have enough."""
    given = sample(3000, 6) + [(10_000 + 100 * k, [1000.0 * (k + 1)] + [0.0] * 7) for k in range(6)]
    given += [(20_000 + k, [5000.0, 1.0 + k] + [0.0] * 6) for k in range(12)] + [(20_100, [5000.0] + [0.0] * 7)]
    found = result(neighbours.search(table(spark, given), F.col("vec_id") % 100 == 0))
    expected = brute(given)
    assert found.keys() == expected.keys()
    assert all(len(rows) == 10 for rows in found.values())
    assert [i for i, _ in found[20_100]] == [i for i, _ in expected[20_100]]


def test_few_and_none(spark):
    given = sample(3)
    found = result(neighbours.search(table(spark, given), F.col("vec_id") % 100 == 0))
    assert [i for i, _ in found[0]] == [i for i, _ in brute(given)[0]]
    assert neighbours.search(table(spark, []), F.col("vec_id") % 100 == 0).collect() == []
    assert neighbours.search(table(spark, odd()[:6]), F.col("vec_id") % 100 == 0).collect() == []


def test_walk_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    centroids = rng.standard_normal((300, 16)).astype("f4")
    g = neighbours.graph(centroids)
    vectors = rng.standard_normal((100, 16))
    at, _ = neighbours.walk(g, vectors, 20)
    d = np.square(vectors[:, None] - centroids).sum(axis=2)
    best = np.argsort(d, axis=1)[:, :20]
    hits = sum(len(set(a) & set(b)) for a, b in zip(at.tolist(), best.tolist(), strict=True))
    assert hits >= 0.95 * best.size


def test_clusters_are_balanced():
    rng = np.random.default_rng(3)
    crowd = np.concatenate([rng.standard_normal((3000, 4)) * 0.1, rng.standard_normal((300, 4)) * 5])
    centroids = neighbours.fit(crowd, 16)
    near = np.square(crowd[:, None] - centroids).sum(axis=2).argmin(axis=1)
    assert np.bincount(near, minlength=16).max() < 0.5 * len(crowd)


def test_recall_of_clustered_rows(spark, monkeypatch):
    """Far clusters, each of several lists whose centroids are about equally far from a query."""
    monkeypatch.setattr(neighbours, "LIST_ROWS", 40)
    rng = np.random.default_rng(8)
    middle = rng.standard_normal((30, 32)) * 20
    x = (middle[rng.integers(0, 30, 8000)] + rng.standard_normal((8000, 32))).astype("f4")
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = result(neighbours.search(rows, F.col("vec_id") % 100 == 0))
    hits = 0
    for q, near in found.items():
        d = np.square(x.astype("f8") - x[q]).sum(axis=1)
        d[q] = np.inf
        hits += len({i for i, _ in near} & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert len(found) == 80 and hits >= 0.9 * 800


def test_walk_finds_centroids_of_far_clusters():
    rng = np.random.default_rng(7)
    middle = rng.standard_normal((12, 16)) * 100
    centroids = (np.repeat(middle, 50, axis=0) + rng.standard_normal((600, 16))).astype("f4")
    vectors = middle[rng.integers(0, 12, 200)] + rng.standard_normal((200, 16))
    at, _ = neighbours.walk(neighbours.graph(centroids), vectors, 4)
    best = np.square(vectors[:, None] - centroids).sum(axis=2).argmin(axis=1)
    assert (at[:, 0] == best).mean() >= 0.95
