import hashlib
import math
import random

import duckdb
import pytest

from quaywise.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, blocks string, vector string"


def vectors(spark, given):
    return spark.createDataFrame([(i, v, 0, "clash", "clash", "clash") for i, v in given], SCHEMA)


def expected(given, k=16, rounds=3):
    kept = [
        (i, [math.floor(64 * x) if abs(x) < 2.0**46 else 64 * int(x) for x in v])
        for i, v in given
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    start = sorted(kept, key=lambda x: (x[0] is None, sha(f"1:{x[0]}"), x[1]))[:k]
    centroids = [v for _, v in start]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (a, _) in zip(kept, found, strict=True) if a == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = assign()
    per = [sum(d for a, d in found if a == c) for c in range(len(centroids))]
    fits = lambda x: x if x < 2**63 else None
    return sorted(
        ((i, c, fits(d), fits(per[c]), fits(sum(per)), sha(",".join(map(str, centroids[c]))))
         for (i, _), (c, d) in zip(kept, found, strict=True)),
        key=str,
    )


def cases(seed, n=150):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 0.125) for _ in range(64)]) for i in range(n)]
    out += [(i, out[0][1]) for i in range(200, 230)]  # equal vectors
    out += [
        (300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 65), (304, [None] + [0.5] * 63),
        (305, [math.nan] + [0.5] * 63), (306, [math.inf] + [0.5] * 63), (307, [-math.inf] * 64), (308, [0.0] * 64),
        (309, [-0.0] * 64), (None, [0.25] * 64), (None, [-0.25] * 64), (5, out[5][1]), (5, out[6][1]),
    ]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    given = cases(seed)
    assert sorted(map(tuple, clusters.cluster_vectors(vectors(spark, given)).collect()), key=str) == expected(given)


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    given = [(i, [rng.choice([1, -1]) * rng.random() * 2.0 ** rng.choice([0, 20, 30, 50]) for _ in range(64)]) for i in range(60)]
    given += [(100 + i, [2.0**e] * 64) for i, e in enumerate((45, 46, 47, 100, 900, 1023))]
    given += [(200 + i, [x / 7 for x in range(64)]) for i in range(3)]
    assert sorted(map(tuple, clusters.cluster_vectors(vectors(spark, given)).collect()), key=str) == expected(given)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    given = cases(4)[:n]
    assert sorted(map(tuple, clusters.cluster_vectors(vectors(spark, given)).collect()), key=str) == expected(given)


def test_chunks_lose_nothing(spark, monkeypatch):
    given = [(i, v) for i, v in cases(5) if i is not None]
    kept = clusters.usable(vectors(spark, given))
    found = {}
    for row in clusters.encoded(kept).collect():
        for k, i in enumerate(row.vec_id):
            found.setdefault(i, []).append(tuple(
                block["values"][2 * code + d]
                for block in row.blocks
                for code in [int.from_bytes(block["codes"][2 * k : 2 * k + 2], "little")]
                for d in range(2)
            ))
    wanted = {}
    for r in kept.collect():
        wanted.setdefault(r.vec_id, []).append(tuple(r.vector))
    assert {i: sorted(v) for i, v in found.items()} == {i: sorted(v) for i, v in wanted.items()}


def test_chunks_are_bounded_and_do_not_matter():
    import pyarrow as pa

    rng = random.Random(6)
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(40), pa.int64()), pa.array([[rng.random() for _ in range(64)] for _ in range(40)])],
        names=["vec_id", "vector"],
    )
    one = clusters.chunk([rows], 64)
    two = clusters.chunk([rows.slice(0, 15), rows.slice(15)], 64)
    assert one.equals(two)


def test_limbs():
    for x in (0, 1, -1, 2**40, -(2**40) - 1, 3**200, -(3**200)):
        assert sum(v << (clusters.LIMB * i) for i, v in enumerate(clusters.limbs(x))) == x


def test_sql_states_the_same(spark):
    given = [(i, v) for i, v in cases(7) if i is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, 0)", given)
    found = clusters.cluster_vectors(vectors(spark, given))
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(clusters.ORACLE).fetchall())
