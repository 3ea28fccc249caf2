"""Packing documents into sequences of a fixed number of tokens.

Documents are dealt to random groups; each group is packed by first-fit
decreasing, independent of all others. Whole sequences are cut off a long
document first; what remains of it is one item. The bin for an item is the
first one with room, found in a tournament tree over the bins' free room.
Bins that first-fit decreasing leaves with more than ``max_gap`` free places
are put end to end and cut anew, so that equal awkward sizes cannot leave
half-empty sequences; one sequence of a group may stay short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.llm.common import map_batches, table
from quaywise.llm.tokens import encoder, vocabulary_path

SEQUENCE_TOKENS = 2048
END_ID = 1
#: A group is closed at so many tokens; about a thousand sequences.
GROUP_TOKENS = 2 << 20
#: Bytes of text of one task, about: its last group is the only one that may be short.
TASK_BYTES = 8 << 20
#: Free places that a sequence may keep without being cut anew.
MAX_GAP = 16

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

Piece = tuple[int, int, int]  # document, start, length


class Bins:
    """Free room of bins; the first bin with enough of it in O(log n)."""

    def __init__(self, most: int, capacity: int):
        self.width = 1 << max(0, most - 1).bit_length()
        self.best = [capacity] * (2 * self.width)

    def place(self, size: int) -> int:
        """Take ``size`` from the first bin that has it; the bin's number."""
        best, node = self.best, 1
        while node < self.width:
            node *= 2
            if best[node] < size:
                node += 1
        best[node] -= size
        found = node - self.width
        while node > 1:
            node //= 2
            best[node] = max(best[2 * node], best[2 * node + 1])
        return found


def pack(lengths: list[int], capacity: int = SEQUENCE_TOKENS, max_gap: int = MAX_GAP) -> list[list[Piece]]:
    """Sequences of pieces for documents of the given token counts.

    Equal sizes keep the order of the documents; a document without tokens
    has no piece; no documents give no sequences.
    """
    full: list[list[Piece]] = []
    items: list[Piece] = []
    for doc, length in enumerate(lengths):
        cut = length - length % capacity
        full += [[(doc, start, capacity)] for start in range(0, cut, capacity)]
        if cut < length:
            items.append((doc, cut, length - cut))
    items.sort(key=lambda x: -x[2])
    bins: list[list[Piece]] = []
    tree = Bins(len(items), capacity)
    for item in items:
        at = tree.place(item[2])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    loose: list[Piece] = []
    for pieces in bins:
        if capacity - sum(p[2] for p in pieces) > max_gap:
            loose += pieces
        else:
            full.append(pieces)
    room = 0
    for doc, start, length in loose:
        while length:
            if not room:
                full.append([])
                room = capacity
            part = min(room, length)
            full[-1].append((doc, start, part))
            start, length, room = start + part, length - part, room - part
    return full


def packed_pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = SEQUENCE_TOKENS,
    group_tokens: int = GROUP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all sequences, with their token ids if ``with_ids``.

    A null text counts as empty: its document is the end id alone. Repeated
    rows, also with equal or null ``doc_id``, are documents of their own. An
    empty table gives no pieces. Other columns are not read. The texts are
    shuffled once, by a hash that spreads repeated rows as well, and sorted by
    it, so a task that is run again deals the same groups, if ``docs`` has its
    rows in a fixed order, as a stored table has. There are as many tasks as the
    texts have bytes for, at any size. A task holds the ids of one group and one
    document.
    """
    path = vocabulary_path(vocabulary)
    spread = F.xxhash64("doc_id", F.length("text"), F.monotonically_increasing_id(), F.lit(capacity))
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path).ids
        end = np.array([END_ID], "<u2")
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        held = 0
        sequence = TaskContext.get().partitionId() << 36

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, held
            out: list[tuple] = []
            for pieces in pack([len(x) for x in ids], capacity):
                offset = 0
                for doc, start, length in pieces:
                    own = ids[doc][start : start + length].astype("<u4")
                    row = (names[doc], start, length, zlib.crc32(own.tobytes()), len(ids[doc]), sequence, offset)
                    out.append((*row, own.astype("<i4")) if with_ids else row)
                    offset += length
                sequence += 1
            ids.clear()
            names.clear()
            held = 0
            if out:
                columns = list(zip(*out, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
                if with_ids:
                    arrays.append(pa.array(columns[7], pa.list_(pa.int32())))
                fields = [x.strip().split(" ")[0] for x in schema.split(",")]
                yield pa.RecordBatch.from_arrays(arrays, names=fields)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids.append(np.concatenate([ids_of(text.as_py() or ""), end]))
                names.append(doc_id)
                held += len(ids[-1])
                if held >= group_tokens:
                    yield from close()
        yield from close()

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // TASK_BYTES))
    dealt = (
        docs.select(F.col("doc_id").cast("long"), F.col("text"), spread.alias("spread"))
        .repartition(parts, "spread")
        .sortWithinPartitions("spread")
        .select("doc_id", "text")
    )
    return map_batches(dealt, run, schema)


def op8_pack_ffd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packed_pieces(table(spark, sf_dir, "documents"))
