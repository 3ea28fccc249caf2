"""Near-duplicate documents by SimHash fingerprints and segment bit counts.

A fingerprint of 64 bits is mapped to the bit counts of its eight bytes. Two
fingerprints that differ in ``k`` bits have count vectors at a Manhattan
distance of ``k`` at most, so vectors within ``LINK_BITS`` hold every link.
These pairs of vectors are found by a range join on a grid, and the
fingerprints behind them are compared exactly.

The grid has a cell for the bit counts of a few coarse segments. Every distinct
fingerprint goes to its own cell, and as a guest to those cells within the
distance that lie on one side, so each pair meets once. In a cell, vectors are
sorted numbers, and the vectors within the distance of a given one are searched
there. A cell hands on a spanning forest of its links, never the links
themselves, so groups of copies of any size stay small. The forests of all
cells are joined to components by alternating star contractions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywise.llm.common import byte_texts, map_batches, slices, stored, table, with_fields

SHINGLE_WORDS = 3
SEED = 42
LINK_BITS = 3
#: Distinct fingerprints up to which the grid has 2 or 4 segments; 8 beyond. The
#: links are the same for any number; more segments make smaller cells and more guests.
GRID = ((4_000_000, 2), (1_000_000_000, 4))
#: Pairs that are compared at a time.
PAIRS = 1 << 21

_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes | None) -> int:
    """Fingerprint of a text; 0 for one without words.

    Each bit is set if it is set in more than half of the XXH64 hashes of the
    lower-cased three-word shingles, repeats counted; fewer words are one shingle.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= SHINGLE_WORDS:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], "u8")
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
        begins = np.concatenate([[0], ends[:-SHINGLE_WORDS] + 1]).tolist()
        digest = xxhash.xxh64_intdigest
        spans = zip(begins, ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), "u8", len(begins))
    # eight bit counts at a time, in the bytes of a word; 255 rows fit a byte
    counts = np.zeros((8, 8), "i8")
    cuts = np.arange(0, len(hashes), 255)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, cuts)
        counts[:, bit] = sums.view("u1").reshape(-1, 8).sum(axis=0, dtype="i8")
    return int(np.packbits((2 * counts > len(hashes)).reshape(-1), bitorder="little").view("u8")[0])


def fingerprints(docs: DataFrame, key: str) -> DataFrame:
    """``key`` and ``fp``, the fingerprint as a signed number, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(x.as_py()) for x in byte_texts(batch.column("text"))], "u8")
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found.view("i8"))], names=[key, "fp"])

    rows = docs.select(key, "text")
    return map_batches(rows, run, with_fields(rows.select(key), fp=T.LongType()))


def ball(dimensions: int, radius: int) -> np.ndarray:
    """All whole-numbered offsets within a Manhattan distance, as rows."""
    rows: list[tuple[int, ...]] = [()]
    for _ in range(dimensions):
        rows = [(*r, d) for r in rows for d in range(-radius, radius + 1) if sum(map(abs, r)) + abs(d) <= radius]
    return np.array(rows, "i8")


#: Offsets between vectors of eight counts; as differences of their codes (four
#: bits a count, with room for an offset either way).
OFFSETS = ball(8, LINK_BITS)
_UNITS = np.array([1 << (4 * k) for k in range(8)], "i8")
CODE_OFFSETS = OFFSETS @ _UNITS


def codes(fps: np.ndarray) -> np.ndarray:
    """Bit counts of the eight bytes of each fingerprint, as one number."""
    counts = np.bitwise_count(fps.view("u1").reshape(-1, 8)).astype("i8")
    return (counts + LINK_BITS) @ _UNITS


class Forest:
    """Disjoint sets of 0..n-1, joined many pairs at a time; a root is its set's least member."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := root[root], root):
                root[:] = up


def links(own: np.ndarray, guests: np.ndarray, segment_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked positions in ``own + guests``, some pairs at a time; both lists hold distinct fingerprints.

    Guests are compared with own ones only. For a guest, only offsets that
    agree with the difference between its cell and this one can lead here.
    """
    order = np.argsort(codes(own), kind="stable")
    own_codes = codes(own)[order]
    values, first, count = np.unique(own_codes, return_index=True, return_counts=True)
    everyone = np.concatenate([own, guests])
    segments = 64 // segment_bits
    coarse = OFFSETS.reshape(len(OFFSETS), segments, -1).sum(axis=2)
    here = coarse_counts(own[:1], segment_bits)[0]
    away = here - coarse_counts(everyone, segment_bits)
    kinds, kind = np.unique(away, axis=0, return_inverse=True)
    kind = kind.reshape(-1)
    all_codes = codes(everyone)
    for k, difference in enumerate(kinds):
        offsets = CODE_OFFSETS[(coarse == difference).all(axis=1)]
        if not difference.any():  # pairs of own ones: one side, and those of the same code
            offsets = offsets[offsets >= 0]
        if not len(offsets):
            continue
        members = np.flatnonzero(kind == k)
        step = max(1, PAIRS // len(offsets))
        for at in range(0, len(members), step):
            some = members[at : at + step]
            wanted = (all_codes[some][:, None] + offsets).reshape(-1)
            spot = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
            hit = np.flatnonzero(values[spot] == wanted)
            yield from compare(everyone, order, np.repeat(some, len(offsets))[hit], first[spot[hit]], count[spot[hit]])


def compare(
    fps: np.ndarray, order: np.ndarray, left: np.ndarray, first: np.ndarray, count: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Exact comparison of each of ``left`` with a run of ``count`` sorted places, in blocks."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    for at in range(0, total, PAIRS):
        flat = np.arange(at, min(total, at + PAIRS))
        run = np.searchsorted(ends, flat, side="right")
        a = left[run]
        b = order[first[run] + flat - (ends[run] - count[run])]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= LINK_BITS
        yield a[near], b[near]


def coarse_counts(fps: np.ndarray, segment_bits: int) -> np.ndarray:
    counts = np.bitwise_count(fps.view("u1").reshape(-1, 8)).astype("i8")
    return counts.reshape(len(fps), 64 // segment_bits, -1).sum(axis=2)


def grid_cells(nodes: DataFrame, segments: int) -> DataFrame:
    """``cell``, ``fp`` and whether it is a guest: one row in its own cell, one for each to visit."""
    bits, size = 64 // segments, 128
    masks = [((1 << bits) - 1) << (bits * k) for k in range(segments)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    cell: Column = F.lit(0).cast("long")
    for mask in signed:
        cell = cell * size + F.bit_count(F.col("fp").bitwiseAND(F.lit(mask).cast("long"))) + 8
    offsets = ball(segments, LINK_BITS)
    units = np.array([size ** (segments - 1 - k) for k in range(segments)], "i8")
    ahead = sorted(int(x) for x in offsets @ units if x >= 0)
    visits = F.explode(F.array(*(F.lit(x).cast("long") for x in ahead)))
    return nodes.select("fp", cell.alias("cell"), visits.alias("visit")).select(
        (F.col("cell") + F.col("visit")).alias("cell"), "fp", (F.col("visit") != 0).alias("guest")
    )


def cell_forest(cells: DataFrame, segments: int) -> DataFrame:
    """Links of each cell as a spanning forest: rows ``u``, ``v`` with ``v`` the least of its set."""
    bits = 64 // segments

    def run(rows: pa.Table) -> pa.Table:
        fps = rows.column("fp").to_numpy().astype("i8").view("u8")
        guest = rows.column("guest").to_numpy()
        own, guests = np.sort(fps[~guest]), np.sort(fps[guest])
        u = v = np.empty(0, "u8")
        if len(own):
            everyone = np.concatenate([own, guests])
            forest = Forest(len(everyone))
            for a, b in links(own, guests, bits):
                forest.join(a, b)
            child = np.flatnonzero(forest.root != np.arange(len(everyone)))
            u, v = everyone[child], everyone[forest.root[child]]
        return pa.table({"u": u.view("i8"), "v": v.view("i8")})

    return cells.groupBy("cell").applyInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``u`` and ``v``, the least node of its component, for all nodes that edges join except ``v`` itself.

    Alternating large-star and small-star steps (Kiveris and others, 2014): a
    step hangs neighbours on the least one, until nothing changes. A node's
    neighbours are never gathered: the least is an aggregate that combines
    before the shuffle, and the join back can be split where a node has many.
    """
    state = ("u", "v")
    now = stored(edges.where("u <> v").select(F.greatest(*state).alias("u"), F.least(*state).alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum((F.col("v") % 1000003))).first())
        if mark == seen or not mark[0]:
            return now
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(below, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))
        )
        now = stored(small.where("u <> v").distinct(), "edges")


def grid_segments(distinct: int) -> int:
    return next((m for most, m in GRID if distinct <= most), 8)


def near_rows(docs: DataFrame, key: str) -> DataFrame:
    """``key``, ``fp`` and ``component``, a fingerprint of the row's group, for every row."""
    found = stored(fingerprints(docs, key), "fingerprints")
    nodes = stored(found.select("fp").distinct(), "nodes")
    segments = grid_segments(nodes.count())
    root = components(cell_forest(grid_cells(nodes, segments), segments))
    linked = root.select(F.col("u").alias("fp"), F.col("v").alias("component"))
    return found.join(linked, "fp", "left").select(key, "fp", F.coalesce("component", "fp").alias("component"))


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every row.

    Null and empty texts have fingerprint zero and are linked like any other.
    ``component_id`` is the least id of the group, null if all its ids are.
    Repeated rows stay. An empty table gives no rows. Other columns are not read.
    """
    rows = near_rows(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id")
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group, the one with the least id, with all its columns.

    Of rows that share this id one stays: that with the least hash of its text,
    language and source, and of rows that share these too, any. Rows without
    id come after all others.
    """
    columns = [docs[c] for c in ("text", "lang", "source") if c in docs.columns]
    key = F.struct(docs["doc_id"].isNull().alias("none"), docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(*columns).alias("row"))
    # the given columns are one, so that none of them can meet a name used here
    held = docs.select(key.alias("key"), F.col("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("given"))
    # the key stands in for the id, so that groups are of rows
    groups = near_rows(held.select("key", "text"), "key")
    first = groups.groupBy("component").agg(F.min("key").alias("key")).select("key")
    return held.join(first, "key").dropDuplicates(["key"]).select("given.*")


def op7_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and groups of all documents."""
    return near_groups(table(spark, sf_dir, "documents"))
