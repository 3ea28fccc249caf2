"""Centroid clustering over dictionaries of subvectors.

Vectors are cut into blocks of two dimensions. A chunk of up to 32 768 vectors
keeps, for every block, its distinct subvectors and one code for each vector,
which loses nothing. A round computes the exact squared distance of each
distinct subvector to each centroid once; the distance of a vector is the sum
of what its codes point at. The sums of a cluster come from counts of codes.

Chunks are rows of a stored table, so a task holds one chunk at a time and a
round shuffles a few hundred numbers of each task. The driver gets the centroids.

All figures are whole numbers: machine integers where no component is larger
than 2**21, Python's beyond that. Sums travel as signed limbs of 40 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.llm.common import map_batches, stored, table

SIZE = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
BLOCK = 2
#: Vectors of a chunk at most; their codes fit 16 bits.
CHUNK = 1 << 15
#: Components up to here give distances that fit 63 bits.
PLAIN = 1 << 21
LIMB = 40
#: Rows of the statistics that are no dimension.
COUNT, INERTIA = -1, -2

CHUNKS = pa.schema(
    {
        "vec_id": pa.list_(pa.int64()),
        "blocks": pa.list_(pa.struct({"values": pa.list_(pa.float64()), "codes": pa.binary()})),
    }
)
_CHUNK_DDL = "vec_id array<long>, blocks array<struct<values: array<double>, codes: binary>>"
_RESULT_DDL = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def usable(vectors: DataFrame, size: int = SIZE) -> DataFrame:
    """``vec_id`` and ``vector`` of the rows with ``size`` finite components.

    Components are floored to multiples of 1/64 (exact in double precision, so
    a large component does not overflow). A null id stays; repeated rows stay.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v))
    kept = vectors.where((F.size(x) == size) & finite)
    # beyond 2**52 a double is a whole number already
    floored = F.transform(
        x, lambda v: F.when(F.abs(v) < float(1 << 46), F.floor(v * SCALE).cast("double") / SCALE).otherwise(v)
    )
    return kept.select(F.col("vec_id").cast("long"), floored.alias("vector"))


def first_centroids(kept: DataFrame, k: int = CENTROIDS) -> list[list[int]]:
    """The vectors with the ``k`` least hashes of their ids, as whole numbers.

    Rows with one id are taken in the order of their vectors, rows without id last.
    """
    by = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = kept.select(by.alias("h"), "vector").orderBy(F.col("h").asc_nulls_last(), "vector").limit(k)
    return [[whole(x) for x in r.vector] for r in first.collect()]


def whole(x: float) -> int:
    return int(x * SCALE) if abs(x) < 1 << 46 else int(x) * SCALE


def encoded(kept: DataFrame, size: int = SIZE) -> DataFrame:
    """Chunks of vectors as dictionaries and codes, one row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                if n + part.num_rows > CHUNK:
                    yield chunk(held, size)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield chunk(held, size)

    return map_batches(kept, run, _CHUNK_DDL)


def chunk(parts: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
    ids = [x for p in parts for x in p.column("vec_id").to_pylist()]
    x = np.concatenate([p.column("vector").flatten().to_numpy(zero_copy_only=False) for p in parts])
    x = x.reshape(-1, size)
    blocks = []
    for b in range(0, size, BLOCK):
        sub = np.ascontiguousarray(x[:, b : b + BLOCK]) + 0.0  # one zero
        # equal subvectors are equal bytes
        keys = sub.view(np.dtype((np.void, sub.dtype.itemsize * sub.shape[1]))).ravel()
        _, first, codes = np.unique(keys, return_index=True, return_inverse=True)
        blocks.append({"values": sub[first].ravel(), "codes": codes.astype("<u2").tobytes()})
    return pa.RecordBatch.from_arrays(
        [pa.array([ids], CHUNKS.field("vec_id").type), pa.array([blocks], CHUNKS.field("blocks").type)], schema=CHUNKS
    )


def opened(row: dict, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Subvectors as whole numbers, and codes, of every block of a chunk."""
    out = []
    for b, block in zip(range(0, size, BLOCK), row["blocks"], strict=True):
        values = np.array(block["values"])
        if np.abs(values).max() < PLAIN:
            sub = (values * SCALE).astype("i8")
        else:
            sub = np.array([whole(v) for v in values.tolist()], dtype=object)
        out.append((sub.reshape(-1, min(BLOCK, size - b)), np.frombuffer(block["codes"], "<u2")))
    return out


def nearest(blocks: list, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Centroid (the smaller number on ties) and distance of every vector of a chunk."""
    plain = all(s.dtype != object for s, _ in blocks) and max(map(abs, sum(centroids, []))) < PLAIN * SCALE
    total, at = 0, 0
    for sub, codes in blocks:
        width = sub.shape[1]
        given = np.array([c[at : at + width] for c in centroids], dtype="i8" if plain else object)
        difference = sub[:, None, :] - given[None]
        total = total + (difference * difference).sum(-1)[codes]
        at += width
    cluster = np.argmin(total, axis=1)
    return cluster, total[np.arange(len(cluster)), cluster]


def limbs(x: int) -> list[int]:
    sign, x, out = (-1 if x < 0 else 1), abs(x), []
    while x or not out:
        out.append(sign * (x & ((1 << LIMB) - 1)))
        x >>= LIMB
    return out


def statistics(chunks: DataFrame, centroids: list[list[int]], size: int) -> dict[tuple[int, int], int]:
    """(cluster, dimension) -> exact sum over all vectors; also counts and inertia.

    Every task adds up its chunks first; Spark adds the limbs of all tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], int] = {}
        k = len(centroids)

        def add(cluster: int, dim: int, x: int) -> None:
            found[cluster, dim] = found.get((cluster, dim), 0) + x

        for batch in batches:
            for row in rows_of(batch):
                blocks = opened(row, size)
                cluster, distance = nearest(blocks, centroids)
                for c, n in enumerate(np.bincount(cluster, minlength=k).tolist()):
                    if n:
                        add(c, COUNT, n)
                        add(c, INERTIA, sum(distance[cluster == c].tolist()))
                for b, (sub, codes) in enumerate(blocks):
                    n = np.bincount(cluster * len(sub) + codes, minlength=k * len(sub)).reshape(k, len(sub))
                    for c, sums in enumerate((n.astype(sub.dtype) @ sub).tolist()):
                        for d, x in enumerate(sums):
                            add(c, b * BLOCK + d, x)
        out = [(c, d, i, x) for (c, d), s in found.items() for i, x in enumerate(limbs(s))]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["cluster", "dim", "limb", "x"]
            )

    parts = chunks.mapInArrow(run, "cluster long, dim long, limb long, x long")
    sums: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum("x").alias("x")).collect():
        sums[r.cluster, r.dim] = sums.get((r.cluster, r.dim), 0) + (r.x << (LIMB * r.limb))
    return sums


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Chunks of a batch one after another; ids stay in Arrow's form."""
    ids, blocks = batch.column("vec_id"), batch.column("blocks")
    for i in range(batch.num_rows):
        one = blocks[i].values
        lists = one.field("values")
        yield {
            "vec_id": ids[i].values,
            "blocks": [
                {"values": lists[k].values.to_numpy(), "codes": codes}
                for k, codes in enumerate(one.field("codes").to_pylist())
            ],
        }


def moved(centroids: list[list[int]], sums: dict[tuple[int, int], int]) -> list[list[int]]:
    """Every centroid that has vectors becomes the floor of their mean."""
    return [
        [sums[c, d] // sums[c, COUNT] for d in range(len(old))] if (c, COUNT) in sums else old
        for c, old in enumerate(centroids)
    ]


def cluster_vectors(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE
) -> DataFrame:
    """``vec_id``, cluster, distance and the figures of its cluster for every usable vector.

    Vectors that are null, of another length, or hold a null or non-finite
    component take no part. A null id stays, repeated rows each count, and with
    fewer than ``k`` vectors each of them starts a centroid. A distance or a sum
    that does not fit a long is null. An empty table gives no rows; other columns
    are not read.
    """
    kept = usable(vectors, size)
    centroids = first_centroids(kept, k)
    if not centroids:
        return kept.sparkSession.createDataFrame([], _RESULT_DDL)
    chunks = stored(encoded(kept, size), "subvectors")
    for _ in range(rounds):
        centroids = moved(centroids, statistics(chunks, centroids, size))
    sums = statistics(chunks, centroids, size)
    per = [sums.get((c, INERTIA), 0) for c in range(len(centroids))]
    return chunks.mapInArrow(assigner(centroids, per, size), _RESULT_DDL)


def fits(x: int) -> int | None:
    return x if x < 1 << 63 else None


def assigner(centroids: list[list[int]], per: list[int], size: int) -> Callable:
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia, total = pa.array(map(fits, per), pa.int64()), fits(sum(per))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                cluster, distance = nearest(opened(row, size), centroids)
                at = pa.array(cluster, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        row["vec_id"], at, pa.array(map(fits, distance.tolist()), pa.int64()), inertia.take(at),
                        pa.array([total] * len(at), pa.int64()), pa.array(digests).take(at),
                    ],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return run


def op12_subvector_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable ``embeddings`` in 16 clusters after three rounds."""
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    steps = [
        f"""kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: isfinite(x))) = {SIZE}),
x AS (SELECT r, unnest(range({SIZE})) AS d, unnest(v) AS x FROM kept),
start AS (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {CENTROIDS})),
c0 AS (SELECT c, unnest(range({SIZE})) AS d, unnest(v) AS x FROM start)"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS (
  SELECT r, min({{'distance': distance, 'c': c}}) AS best FROM (
    SELECT r, c, sum((x.x - c{i}.x) * (x.x - c{i}.x))::BIGINT AS distance FROM x JOIN c{i} USING (d) GROUP BY r, c)
  GROUP BY r)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""c{i + 1} AS (
  SELECT c, d, coalesce((s - ((s % n) + n) % n) // n, c{i}.x)::BIGINT AS x
  FROM c{i} LEFT JOIN (
    SELECT best.c AS c, d, sum(x)::BIGINT AS s, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY ALL) USING (c, d))"""
            )
    last = ROUNDS
    return f"""
WITH {", ".join(steps)},
digest AS (SELECT c, sha256(string_agg(x, ',' ORDER BY d)) AS centroid_sha256 FROM c{last} GROUP BY c)
SELECT vec_id, best.c::INTEGER AS cluster, best.distance AS distance,
  (sum(best.distance) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
  (sum(best.distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN digest ON digest.c = best.c
"""


ORACLE = _oracle()
