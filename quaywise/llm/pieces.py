"""Encoding with a SentencePiece vocabulary as a weighted finite-state transducer.

Three transducers are compiled into one machine, which is composed with each
input position by position:

- the normaliser reads a space and writes a word mark, writes one before a text
  that is not empty, and copies the rest; so every arc of the pieces that reads
  a mark reads a space too, and the input begins with one;
- the pieces: their letters are arcs between numbered states, and from the last
  letter of a piece the machine goes on in the state "this piece was last". The
  weight of a piece is 0 where it may follow the last one and infinite where the
  vocabulary's merges would have joined or cut the two in another way;
- the byte fallback: a character that is no piece has an arc of weight 1 that
  writes its UTF-8 bytes.

The result is the shortest path in the tropical semiring (weights add along a
path, the least total wins). States are expanded only when they are reached, by
least weight and then furthest position, where a character that no piece holds
is counted beforehand, as every path has to pay for it.

Whether two pieces may follow each other is decided by their borders. Merges run
by priority, so for every rank it is known which symbol stands at the end of the
one and which at the beginning of the other when all better merges are done. The
two are the vocabulary's own result exactly if no two such symbols join into a
piece of just the rank at which both stand there. A sequence of pieces is the
result exactly if every two neighbours are, so the last piece is all the memory
the machine needs.

No piece goes over the border between letters and other characters, or has a
word mark after another character; this is checked when a vocabulary is
compiled. Paths between such borders are independent, and those of short
stretches are kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.llm.common import slices, table

MARK = "▁"
#: Letters, by exclusion of other word characters; raised digits are among those.
_LETTERS = r"[^\W\d_\u00b2\u00b3\u00b9]"
STRETCH = re.compile(rf"[ {MARK}]*{_LETTERS}+|[ {MARK}]*(?:(?!{_LETTERS})[^ {MARK}])+|[ {MARK}]+", re.DOTALL)
#: Stretches and pairs of pieces whose results a worker keeps.
KEPT_STRETCHES, KEPT_PAIRS = 400_000, 1_000_000
#: Last piece before the first one, and after a character that is no piece.
UNKNOWN = ""
NONE = -1
#: Numbers of symbols fit so many bits.
BITS = 21

#: A symbol at a border of a piece, from one rank to another.
Border = tuple[int, float, float]


def vocabulary_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class _Paths(dict):
    def __init__(self, shortest):
        super().__init__()
        self.shortest = shortest

    def __missing__(self, stretch: str) -> bytes:
        ids = np.array(self.shortest(stretch), "<u4").tobytes()
        if len(self) < KEPT_STRETCHES and len(stretch) <= 48:
            self[stretch] = ids
        return ids


class Transducer:
    """A compiled vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        given = sentencepiece.SentencePieceProcessor(model_file=path)
        size = given.get_piece_size()
        self.pieces = [given.id_to_piece(i) for i in range(size)]
        plain = [
            i for i in range(size)
            if not (given.is_byte(i) or given.is_control(i) or given.is_unknown(i) or given.is_unused(i))
        ]
        self.ids = {self.pieces[i]: i for i in plain}
        self.priority = {self.pieces[i]: given.get_score(i) for i in plain}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if given.is_byte(i)}
        self.unknown = given.unk_id()
        self.raw = {i: bytes([b]) for b, i in self.bytes.items()}
        self.split = all(len(STRETCH.findall(x)) == 1 for x in self.ids)
        self.text = [x.replace(MARK, " ") if x in self.ids else "" for x in self.pieces]
        # pieces have their own numbers, other characters of pieces numbers beyond them
        self.symbols = dict(self.ids)
        for c in sorted({c for x in self.ids for c in x}):
            self.symbols.setdefault(c, size + len(self.symbols))
        self.joins = {
            self.symbols[x[:k]] << BITS | self.symbols[x[k:]]: -self.priority[x]
            for x in self.ids for k in range(1, len(x)) if x[:k] in self.symbols and x[k:] in self.symbols
        }
        self.whole: set[int] = set()
        self.left: dict[int, list[Border]] = {}
        self.right: dict[int, list[Border]] = {}
        for x, i in self.ids.items():
            parts, self.left[i], self.right[i] = self.merged(x)
            if len(parts) == 1:
                self.whole.add(i)
        self.arcs: list[dict[str, int]] = [{}]
        self.last: list[int] = [NONE]
        for x, i in self.ids.items():
            if i in self.whole:
                self._add(x, i)
        self.pairs: dict[int, bool] = {}
        self.paths = _Paths(self.shortest)

    def _add(self, piece: str, number: int) -> None:
        """Arcs for the letters of a piece; what reads a word mark reads a space."""
        state = 0
        for c in piece:
            arcs = self.arcs[state]
            if c not in arcs:
                self.arcs.append({})
                self.last.append(NONE)
                for label in (c, " ") if c == MARK else (c,):
                    arcs[label] = len(self.arcs) - 1
            state = arcs[c]
        self.last[state] = number

    def merged(self, text: str) -> tuple[list[str], list[Border], list[Border]]:
        """The vocabulary's result for a short text, and what stands at its borders meanwhile.

        The best neighbours join until none can, leftmost first. A border is a
        symbol with the rank after which it stands there and that at which it goes;
        ranks are the worst of all merges so far, as a better one that comes up
        later runs at once.
        """
        parts, priority, level = list(text), self.priority, -np.inf
        left = [(self.symbols[parts[0]], -np.inf, np.inf)]
        right = [(self.symbols[parts[-1]], -np.inf, np.inf)]
        while True:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):
                found = priority.get(parts[k] + parts[k + 1])
                if found is not None and found > best:
                    best, at = found, k
            if at < 0:
                return parts, left, right
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            level = max(level, -best)
            for chain, stands in ((left, at == 0), (right, at == len(parts) - 1)):
                if stands:
                    symbol, since, _ = chain.pop()
                    if since < level:  # else no rank sees it
                        chain.append((symbol, since, level))
                    chain.append((self.symbols[parts[at]], level, np.inf))

    def may_follow(self, last: int, piece: int) -> bool:
        """Whether the weight of ``piece`` after ``last`` is 0; both are their own results."""
        joins = self.joins
        for a, since, until in self.right[last]:
            for b, after, before in self.left[piece]:
                rank = joins.get(a << BITS | b)
                # of equal ranks the merge further left runs first
                if rank is not None and since <= rank < until and after < rank <= before:
                    return False
        return True

    def follows(self, last: str, piece: str) -> bool:
        """The same for pieces as strings."""
        i = self.ids[piece]
        return i in self.whole and (last == UNKNOWN or self.may_follow(self.ids[last], i))

    def shortest(self, text: str) -> list[int]:
        """Ids on the shortest path through the composition with ``text``."""
        all_arcs, ends, pairs, n = self.arcs, self.last, self.pairs, len(text)
        ids, symbols = self.ids, self.symbols
        # (position, last piece, the state before) by weight, the furthest on top
        level: list[tuple] = [(0, NONE, None)]
        later: list[tuple] = []
        seen: set[int] = set()
        while True:
            if not level:
                level, later = later, []
            state = level.pop()
            start, last, _ = state
            if start == n:
                break
            key = start << BITS | last + 1
            if key in seen:
                continue
            seen.add(key)
            c = text[start]
            if c not in ids and c != " ":
                (level if c not in symbols else later).append((start + 1, NONE, state))
            arcs = all_arcs[0].get(c)
            at = start + 1
            while arcs is not None:
                piece = ends[arcs]
                if piece >= 0:
                    if last < 0:
                        level.append((at, piece, state))
                    else:
                        pair = last << BITS | piece
                        zero = pairs.get(pair)
                        if zero is None:
                            zero = self.may_follow(last, piece)
                            if len(pairs) < KEPT_PAIRS:
                                pairs[pair] = zero
                        if zero:
                            level.append((at, piece, state))
                if at == n:
                    break
                arcs = all_arcs[arcs].get(text[at])
                at += 1
        out: list[int] = []
        while state[2] is not None:
            before = state[2]
            out += [state[1]] if state[1] >= 0 else reversed(self.fallback(text[before[0]]))
            state = before
        return out[::-1]

    def fallback(self, character: str) -> list[int]:
        """Ids of the bytes of a character."""
        return [self.bytes.get(b, self.unknown) for b in character.encode()]

    def encode(self, text: str) -> np.ndarray:
        found = " " + text if text else ""
        stretches = STRETCH.findall(found) if self.split else [found] if found else []
        return np.frombuffer(b"".join(map(self.paths.__getitem__, stretches)), "<u4")

    def decode(self, ids: list[int]) -> str:
        """The text behind ids, word marks as spaces, without the first one; bytes that are no UTF-8 are replaced."""
        text = self.text
        if self.raw.keys().isdisjoint(ids):
            out = "".join([text[i] for i in ids])
        else:
            raw = self.raw
            out = b"".join([raw.get(i) or text[i].encode() for i in ids]).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def encoded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` of every row. A null or empty text has none.

    Repeated rows and null ids stay; an empty table gives no rows; other
    columns are not read. Control strings in a text are ordinary text.
    """
    path = vocabulary_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = transducer(path).encode
        for batch in slices(batches, "text"):
            ids = [encode(x.as_py() or "").view("<i4") for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of rows of ids; null ids give a null text."""
    path = vocabulary_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = transducer(path).decode
        for batch in batches:
            texts = [None if x is None else decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Digests of each row's ids and of the text they decode to, in one pass."""
    path = vocabulary_path(vocabulary)
    schema = "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_crc32 long, round_trip boolean"
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        is_byte = np.zeros(len(t.pieces), "?")
        is_byte[list(t.raw)] = True
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = value.as_py() or ""
                ids = t.encode(text)
                back = t.decode(ids.tolist())
                rows.append((
                    doc_id, len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.tobytes()), zlib.crc32(back.encode()),
                    back == text.replace(MARK, " "),
                ))
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, schema)


def op4_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, as digests, and whether they decode to the text."""
    return round_trips(table(spark, sf_dir, "documents"))
