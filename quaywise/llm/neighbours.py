"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted by k-means with a price on crowded clusters, on a bounded
sample of the vectors. Every vector goes to the list of its nearest centroid
and, where others are nearly as near, to those lists as well. The nearest
centroids of a vector are found by a best-first walk over a graph of centroids
that each task holds in memory. The
walk starts at some centroids that lie far apart, so that it ends in the right
place where vectors are clustered. A query reads the lists whose centroids are
within a fixed ratio of its nearest one's distance. How many lists that takes
differs from table to table: a bounded sample of the queries is compared with
every entry, and where the usual lists would miss too many of their neighbours,
all queries read as many as find them (:func:`enough_lists`). Lists are read in
blocks of bounded size, so a crowded list is shared by many tasks.

Equal vectors are one entry of the index, with the smallest ids that a result
could hold; results are the same as if each were an entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywise.llm.common import stored, table, with_fields

NEAREST = 10
QUERY_STEP = 100
#: Different vectors that centroids are fitted on, at most.
SAMPLE = 24_000
#: Entries that a list should have, and bounds of the number of lists.
LIST_ROWS, MAX_LISTS = 200, 4096
ROUNDS, SEED = 12, 5
#: Neighbours of a centroid in the graph, and candidates that a walk keeps.
DEGREE = 24
#: Lists an entry may be in, and how much farther than the nearest they may be.
COPIES, COPY_RATIO = 4, 1.08
#: Lists a query may read, as a share of all but at least so many, and how much farther they may be.
PROBE_SHARE, LEAST_PROBES, PROBE_RATIO = 0.2, 16, 1.25
#: Queries that are compared with every entry, and the share of their neighbours that lists must hold.
MEASURED, TARGET = 256, 0.95
#: Entries of a block.
BLOCK_ROWS = 4096


def usable(vector: str = "embedding") -> Column:
    """Whether a vector takes part: no null or non-finite component, and not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce((F.size(vector) > 0) & fine & some, F.lit(False))


def fit(vectors: np.ndarray, lists: int, seed: int = SEED) -> np.ndarray:
    """Centroids by k-means, where a cluster costs more the more it holds."""
    rng = np.random.default_rng(seed)
    centroids = vectors[rng.choice(len(vectors), lists, replace=False)].astype("f4")
    # around their middle, so that single precision is enough wherever they lie
    middle = vectors.mean(axis=0)
    centroids, vectors = (centroids - middle).astype("f4"), (vectors - middle).astype("f4")
    squares = np.square(vectors).sum(axis=1)
    size = np.full(lists, len(vectors) / lists)
    for _ in range(ROUNDS):
        d = squares[:, None] - 2 * vectors @ centroids.T + np.square(centroids).sum(axis=1)
        price = d.min(axis=1).mean() * 0.1 * (size * lists / len(vectors) - 1)
        near = (d + price).argmin(axis=1)
        counted = np.bincount(near, minlength=lists)
        size = 0.5 * size + 0.5 * counted
        sums = np.zeros(centroids.shape, "f8")
        np.add.at(sums, near, vectors)
        some = counted > 0
        centroids[some] = (sums[some] / counted[some, None]).astype("f4")
    return (centroids + middle).astype("f4")


@dataclass
class Graph:
    """Centroids with their nearest ones, and those to start from."""

    centroids: np.ndarray
    near: np.ndarray
    starts: np.ndarray


def far_apart(centroids: np.ndarray) -> np.ndarray:
    """Some centroids, each the farthest from those before it; the first is nearest to the middle.

    Groups of centroids that lie apart get one each, or, if there are more of
    them than that, are smaller than a centroid's number of neighbours.
    """
    most = min(len(centroids), 4 * int(np.ceil(np.sqrt(len(centroids)))))
    found = [int(np.square(centroids - centroids.mean(axis=0)).sum(axis=1).argmin())]
    left = np.square(centroids - centroids[found[0]]).sum(axis=1)
    while len(found) < most:
        found.append(int(left.argmax()))
        left = np.minimum(left, np.square(centroids - centroids[found[-1]]).sum(axis=1))
    return np.unique(found)


def graph(centroids: np.ndarray, degree: int = DEGREE) -> Graph:
    """Each centroid linked to its nearest ones, and, so that all can be reached, to the next."""
    n = len(centroids)
    degree = min(degree, n)
    near = np.empty((n, degree + 1), "i4")
    own = centroids.astype("f8") - centroids.mean(axis=0, dtype="f8")
    squares = np.square(own).sum(axis=1)
    for at in range(0, n, 1024):
        d = squares - 2 * own[at : at + 1024] @ own.T
        near[at : at + 1024, :degree] = np.argpartition(d, degree - 1, axis=1)[:, :degree]
    near[:, degree] = (np.arange(n) + 1) % n
    return Graph(centroids, near, far_apart(centroids))


def all_distances(g: Graph, vectors: np.ndarray) -> np.ndarray:
    """Squared distances from vectors to every centroid."""
    middle = g.centroids.mean(axis=0, dtype="f8")
    own, vectors = g.centroids - middle, vectors - middle
    d = np.square(own).sum(axis=1) - 2 * vectors @ own.T + np.square(vectors).sum(axis=1)[:, None]
    return np.maximum(d, 0)


def walk(g: Graph, vectors: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` nearest centroids that a best-first walk finds, and their squared distances.

    All vectors walk side by side: each opens its nearest unopened candidate
    until its ``keep`` best are open. Places that were not filled have -1.
    """
    n, keep = len(g.centroids), min(keep, len(g.centroids))
    vectors = vectors.astype("f4")
    rows = np.arange(len(vectors))
    found = np.full((len(vectors), n), np.inf, "f4")  # distances known so far
    open_ = np.zeros((len(vectors), n), "?")
    for start in g.starts:
        found[:, start] = np.square(vectors - g.centroids[start]).sum(axis=1)
    busy = rows
    while len(busy):
        waiting = np.where(open_[busy], np.inf, found[busy])
        best = waiting.argmin(axis=1)
        if keep < n:
            bound = np.partition(found[busy], keep - 1, axis=1)[:, keep - 1]
        else:
            bound = np.full(len(busy), np.inf, "f4")
        go = waiting[np.arange(len(busy)), best] <= bound
        go &= np.isfinite(waiting[np.arange(len(busy)), best])
        busy, best = busy[go], best[go]
        open_[busy, best] = True
        ahead = g.near[best]
        d = np.square(vectors[busy][:, None, :] - g.centroids[ahead]).sum(axis=2)
        found[busy[:, None], ahead] = d
    at = np.argsort(found, axis=1, kind="stable")[:, :keep]
    d = np.take_along_axis(found, at, axis=1)
    return np.where(np.isfinite(d), at, -1), d


def chosen(
    g: Graph, vectors: np.ndarray, keep: int, ratio: float, rows: np.ndarray, needed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and lists: the nearest, others up to ``ratio`` times its distance, and
    as many more as it takes until they hold ``needed`` rows; ``rows`` are those of each list."""
    if keep * WALKED >= len(g.centroids):
        # a walk would open a large share of the graph
        d = all_distances(g, vectors)
        at = np.argsort(d, axis=1, kind="stable")[:, :keep]
        d = np.take_along_axis(d, at, axis=1)
    else:
        at, d = walk(g, vectors, keep)
    near = np.ones(at.shape, "?") if np.isinf(ratio) else np.sqrt(d) <= ratio * np.sqrt(d[:, :1])
    held = rows[at]
    near |= np.cumsum(held, axis=1) - held < needed
    near &= at >= 0
    row, k = np.nonzero(near)
    return row, at[row, k]


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(len(column), -1)


#: A walk is taken for this part of the centroids at most; more are ranked by their distances.
WALKED = 8
#: Vectors that walk side by side.
STEP = 1024


def listed(
    rows: DataFrame, g: Graph, keep: int, ratio: float, held: np.ndarray | None = None, needed: int = 1
) -> DataFrame:
    """``rows`` (``a``, ``b``, ``vector``), once for each ``list`` chosen (see :func:`chosen`).

    Without ``held`` every list counts as filled: the nearest one is enough.
    """
    held = np.ones(len(g.centroids), "i8") if held is None else held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                row, found = chosen(g, matrix(part.column("vector")), keep, ratio, held, needed)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(found.astype("i4"))], names=[*taken.schema.names, "list"]
                )

    return rows.mapInArrow(run, with_fields(rows, list=T.IntegerType()))


def closest(queries: np.ndarray, entries: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the places of its nearest entries, all with the last one's distance, and the distances."""
    squares = np.square(entries).sum(axis=1)
    step = max(1, (1 << 21) // max(len(entries), 1))
    for at in range(0, len(queries), step):
        some = queries[at : at + step]
        rough = squares - 2 * some @ entries.T + np.square(some).sum(axis=1)[:, None]
        slack = 1e-9 * (1 + squares.max() + np.square(some).sum(axis=1))
        if len(entries) > most:
            last = np.partition(rough, most - 1, axis=1)[:, most - 1] + slack
        else:
            last = np.full(len(some), np.inf)
        for i, q in enumerate(some):
            places = np.flatnonzero(rough[i] <= last[i])
            yield at + i, places, np.sqrt(np.square(entries[places] - q).sum(axis=1))


def true_neighbours(entries: DataFrame, queries: pa.Table, most: int) -> DataFrame:
    """``query`` (its place), ``a`` and ``b`` of the nearest entries, all compared; the query's own is left out."""
    asked = matrix(queries.column("vector").combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, places, d in closest(asked, matrix(batch.column("vector")), most + 1):
                places, d = places[d > 0], d[d > 0]
                rows = pa.array(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(places), i, "i4")), batch.column("a").take(rows),
                     batch.column("b").take(rows), pa.array(d)], names=["query", "a", "b", "d"],
                )

    found = entries.mapInArrow(run, "query int, a long, b long, d double")
    order = W.partitionBy("query").orderBy("d", "a", "b")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).drop("nth", "d")


def enough_lists(
    g: Graph, queries: np.ndarray, held: np.ndarray, keep: int, ratio: float, target: float = TARGET
) -> tuple[int, float]:
    """How many lists to read, and how much farther they may be, to find ``target`` of the neighbours.

    ``held`` has a row (query, neighbour, list) for each list that a true
    neighbour is in. The given number and ratio stay if they are enough; if not,
    the ratio goes and the number is the least that is.
    """
    if not len(held):
        return keep, ratio
    d = all_distances(g, queries)
    rank = d.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
    query, _, at = held.T
    near = np.sqrt(d[query, at]) <= ratio * np.sqrt(d.min(axis=1))[query]
    _, pair = np.unique(held[:, :2], axis=0, return_inverse=True)
    pair = pair.reshape(-1)
    found = np.zeros(pair.max() + 1, "?")
    np.logical_or.at(found, pair, near & (rank[query, at] < keep))
    if found.mean() >= target:
        return keep, ratio
    least = np.full(len(found), len(g.centroids))
    np.minimum.at(least, pair, rank[query, at])
    return int(np.sort(least)[int(np.ceil(target * len(least))) - 1]) + 1, np.inf


def search(
    vectors: DataFrame, queries: Column, most: int = NEAREST, probe_ratio: float = PROBE_RATIO
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` for the rows of ``vectors`` that ``queries`` selects.

    Needs ``vec_id`` and ``embedding``. Rows without id and vectors that are
    not ``usable`` take no part, nor do those whose length is not the most
    common one. Rows with one id and one vector count once. A query whose own
    list holds little reads more lists until it has enough. Equal distances go
    to the smaller id; a query is never its own neighbour, an equal vector with
    another id is. An empty table gives no rows. The index holds every vector.
    """
    # single precision stays as it is, in half the space; distances are computed in double
    kept = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    vector = F.col("embedding") if kept else F.col("embedding").cast("array<double>")
    own = vectors.select(F.col("vec_id").cast("long"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & usable("vector")
    )
    sizes = own.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    size = common["size"] if common else 0
    ids = own.where(F.size("vector") == size).select(
        "vec_id", F.xxhash64("vector").alias("a"), F.xxhash64(F.lit("second"), "vector").alias("b"), "vector"
    ).distinct()
    # the ids that any result can hold: as many as are asked for, and the query's own
    order = W.partitionBy("a", "b").orderBy("vec_id")
    few = stored(
        ids.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most + 1), "ids"
    )
    entries = few.where("nth = 1").select("a", "b", "vector")
    n = entries.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = min(1.0, 1.5 * SAMPLE / n)
    sample = entries.where(F.pmod("a", F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).orderBy("a", "b").limit(SAMPLE)
    fitted = matrix(sample.select("vector").toArrow().column("vector").combine_chunks())
    lists = max(1, min(MAX_LISTS, n // LIST_ROWS, len(fitted) // 4))
    g = graph(fit(fitted, lists))

    asked = stored(ids.where(queries).select(F.col("vec_id").alias("query_id"), "a", "b", "vector"), "queries")
    postings = stored(listed(entries, g, COPIES, COPY_RATIO), "postings")
    # one row for each list, MAX_LISTS at most
    blocks = stored(
        postings.groupBy("list").agg(
            F.count("*").alias("n"), F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")
        ),
        "blocks",
    )
    rows = np.zeros(lists, "i8")
    for r in blocks.collect():
        rows[r["list"]] = r["n"]
    # so many rows hold as many different entries as a result can need, or all there are
    needed = COPIES * (most + 1)
    enough = int(np.searchsorted(np.cumsum(np.sort(rows)), needed)) + 1
    different = asked.select("a", "b", "vector").dropDuplicates(["a", "b"])
    keep = min(lists, max(LEAST_PROBES, round(lists * PROBE_SHARE)))
    measured = different.orderBy("a", "b").limit(MEASURED).toArrow()
    if measured.num_rows and lists > 1:
        truth = F.broadcast(true_neighbours(entries, measured, most))
        # a row for each list that one of the sampled queries' neighbours is in: bounded by the constants
        where = postings.join(truth, ["a", "b"]).select("query", "a", "list").collect()
        held_in = np.array([tuple(r) for r in where], "i8").reshape(-1, 3)
        there = matrix(measured.column("vector").combine_chunks())
        keep, probe_ratio = enough_lists(g, there, held_in, keep, probe_ratio)
    probes = listed(different, g, min(lists, max(keep, enough)), probe_ratio, rows, needed)
    blocks = F.broadcast(blocks.drop("n"))
    held = postings.join(blocks, "list").withColumn("block", F.pmod("b", F.col("blocks")).cast("int"))
    read = probes.join(blocks, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def run(entries: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if entries.num_rows and queries.num_rows:
            there = matrix(entries.column("vector").combine_chunks())
            for i, places, d in closest(matrix(queries.column("vector").combine_chunks()), there, most + 1):
                out.append((np.full(len(places), i), places, d))
        at, places, d = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, "i8"),) * 3
        return pa.table({
            "qa": queries.column("a").take(pa.array(at)), "qb": queries.column("b").take(pa.array(at)),
            "a": entries.column("a").take(pa.array(places)), "b": entries.column("b").take(pa.array(places)),
            "score": pa.array(d.astype("f8")),
        })

    found = held.select("list", "block", "a", "b", "vector").groupBy("list", "block").cogroup(
        read.select("list", "block", "a", "b", "vector").groupBy("list", "block")
    ).applyInArrow(run, "qa long, qb long, a long, b long, score double")
    # an entry may have been read in several lists
    pairs = found.groupBy("qa", "qb", "a", "b").agg(F.min("score").alias("score"))
    with_ids = pairs.join(few.select("a", "b", "vec_id"), ["a", "b"])
    nearest = W.partitionBy("qa", "qb").orderBy("score", "vec_id")
    best = with_ids.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= most + 1)
    results = asked.select("query_id", F.col("a").alias("qa"), F.col("b").alias("qb")).join(best, ["qa", "qb"])
    final = W.partitionBy("query_id", "qa", "qb").orderBy("score", "vec_id")
    return (
        results.where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= most)
        .select("query_id", "rank", "vec_id", "score")
    )


def op10_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth id."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)
