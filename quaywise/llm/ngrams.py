"""Text scores by an interpolated modified Kneser-Ney model of word pairs.

Pairs of neighbouring tokens of all training texts are counted in Spark. Tasks
hand on sorted blocks of distinct pairs with counts; the block of a pair goes
to the shard of its first word, or, where that word is very common, to that of
the pair, so that no shard grows with one word. A shard merges its blocks,
writes its counts as sorted hash arrays to the shared folder and hands on what
it knows of each word: tokens and distinct continuations that follow it, and
distinct words before it. Those meet in shards by word, which are written in
the same way.

Workers memory-map all shards, so a model of any size takes page cache and not
memory of a process, and look up the distinct words and pairs of a few megabytes
of text at a time, in the order of the arrays.

The order is two: three would need more than the disk that the limits allow
(see README), and nothing is pruned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.llm.common import byte_texts, map_batches, map_shared, remainder, slices, table, write_shared
from quaywise.session import scratch_path

#: Bytes of training text whose pairs make one shard, about, and the least number of shards.
SHARD_BYTES, LEAST_SHARDS = 8 << 20, 16
#: Tokens whose pairs a task counts before it hands them on.
BLOCK_TOKENS = 2_000_000
#: Bytes of text that are scored at a time.
SCORED_BYTES = 5 << 20
#: Words whose hash a worker keeps.
KEPT_WORDS = 400_000
#: A word with more than 1 / HOT of a shard's fair share of the pairs spreads over all shards.
HOT = 4
#: Common words are looked for in one of so many documents; this steers rows to
#: shards only, so the model is the same for any choice.
HOT_SAMPLE = 16

BEGIN = xxhash.xxh64_intdigest(b" begin")
END = xxhash.xxh64_intdigest(b" end")

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads neighbouring numbers over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _MIX[0] + second)


def pair_shard(first: np.ndarray, pair: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    own = mixed(first)
    if len(hot):
        own = np.where(np.isin(first, hot), pair, own)
    return (own % np.uint64(shards)).astype("i4")


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < KEPT_WORDS:
            self[word] = value
        return value


_words = _Words()


def token_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the lower-cased words, then of the end."""
    words = text.lower().split() if text else []
    out = np.empty(len(words) + 1, "u8")
    out[:-1] = np.fromiter(map(_words.__getitem__, words), "u8", len(words))
    out[-1] = END
    return out


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length; the first, sorted one as differences."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    raw = b"".join([np.int64(len(first)).tobytes(), first.tobytes(), *(c.tobytes() for c in columns[1:])])
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpacked(block: bytes, *kinds: str) -> list[np.ndarray]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(block))
    n, at, out = int(np.frombuffer(raw[:8], "i8")[0]), 8, []
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += size
    return [np.cumsum(out[0], dtype=kinds[0]), *out[1:]]


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, and the sums of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, "i8")
    if not len(starts):
        return keys, *(v[:0].astype("i8") for v in values)
    return keys[starts], *(np.add.reduceat(v[order].astype("i8"), starts) for v in values)


def dealt(shard: np.ndarray, shards: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """One block for each shard that has rows, sorted by the first column."""
    order = np.lexsort((columns[0], shard))
    shard = shard[order]
    columns = tuple(c[order] for c in columns)
    bounds = np.searchsorted(shard, np.arange(shards + 1))
    for k in range(shards):
        part = slice(bounds[k], bounds[k + 1])
        if bounds[k] < bounds[k + 1]:
            yield k, packed(*(c[part] for c in columns))


BLOCKS = "shard int, block binary"
PAIR_KINDS = ("u8", "u8", "u4")
WORD_KINDS = ("u8",) * 6


def block_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
        names=["shard", "block"],
    )


def pair_blocks(texts: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """Blocks of distinct pairs with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            second = np.concatenate(held)
            first = np.empty_like(second)
            first[1:] = second[:-1]
            ends = np.cumsum([len(x) for x in held])[:-1]
            first[np.concatenate([[0], ends]).astype("i8")] = BEGIN
            pair, at, count = np.unique(pair_hash(first, second), return_index=True, return_counts=True)
            first, second = first[at], second[at]
            shard = pair_shard(first, pair, hot, shards)
            return block_batch(list(dealt(shard, shards, first, second, count.astype("u4"))))

        for batch in slices(batches, "text"):
            for text in byte_texts(batch.column("text")):
                held.append(token_hashes(text.as_py()))
                size += len(held[-1])
                if size >= BLOCK_TOKENS:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    return map_batches(texts, run, BLOCKS)


SHARD = "kind string, shard int, name string, rows long, tokens long, n1 long, n2 long, n3 long, n4 long"


def counts_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def merge_pairs(blocks: DataFrame, folder: str, shards: int) -> DataFrame:
    """Write the shards of pairs; their facts, and blocks of what they know of words.

    A row is either a fact about the shard or a block for another one.
    """

    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        parts = [unpacked(x.as_py(), *PAIR_KINDS) for x in rows.column("block")]
        first, second, count = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        pair = pair_hash(first, second)
        order = np.argsort(pair, kind="stable")
        pair, first, second, count = pair[order], first[order], second[order], count[order]
        starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        pair, first, second = pair[starts], first[starts], second[starts]
        count = np.add.reduceat(count.astype("i8"), starts)
        # a byte is enough for nearly all counts; the others follow in full
        large = np.flatnonzero(count >= 255)
        content = [
            np.array([len(pair), len(large)], "i8"), pair, pair[large], count[large],
            np.minimum(count, 255).astype("u1"),
        ]
        name = write_shared(folder, f"pairs-{shard:05d}", b"".join(c.tobytes() for c in content))
        one = np.ones(len(count), "i8")
        stats = summed(first, count, count == 1, count == 2, count > 2)
        before = summed(second, one)
        words = np.concatenate([stats[0], before[0]])
        columns = [np.concatenate([s, np.zeros(len(before[0]), "i8")]) for s in stats[1:]]
        columns.append(np.concatenate([np.zeros(len(stats[0]), "i8"), before[1]]))
        words, *columns = summed(words, *columns)
        out = list(dealt((mixed(words) % np.uint64(shards)).astype("i4"), shards, words, *(c.astype("u8") for c in columns)))
        fact = {"kind": "pairs", "shard": shard, "name": name, "rows": len(pair), "tokens": int(count.sum())}
        fact |= dict(zip(("n1", "n2", "n3", "n4"), counts_of_counts(count), strict=True))
        rows_out = [fact | {"block": None}] + [{"kind": "words", "shard": k, "block": b} for k, b in out]
        return pa.Table.from_pylist(rows_out, schema=_MERGED)

    return blocks.groupBy("shard").applyInArrow(run, f"{SHARD}, block binary")


_MERGED = pa.schema(
    [("kind", pa.string()), ("shard", pa.int32()), ("name", pa.string())]
    + [(c, pa.int64()) for c in ("rows", "tokens", "n1", "n2", "n3", "n4")]
    + [("block", pa.binary())]
)


def merge_words(blocks: DataFrame, folder: str) -> DataFrame:
    """Write the shards of words; their facts. ``rows`` counts those that are tokens."""

    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        parts = [unpacked(x.as_py(), *WORD_KINDS) for x in rows.column("block")]
        words, *columns = summed(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        before = columns[-1]
        content = [np.array([len(words)], "i8"), words, *columns]
        name = write_shared(folder, f"words-{shard:05d}", b"".join(c.tobytes() for c in content))
        fact = {"kind": "words", "shard": shard, "name": name}
        fact |= {"rows": int(np.count_nonzero(before)), "tokens": int(before.sum())}
        fact |= dict(zip(("n1", "n2", "n3", "n4"), counts_of_counts(before[before > 0]), strict=True))
        return pa.Table.from_pylist([fact], schema=pa.schema(list(_MERGED)[:-1]))

    return blocks.groupBy("shard").applyInArrow(run, SHARD)


def discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more; the usual ones, held within what a count can give."""
    n1, n2, n3, n4 = (max(x, 0) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    given = [
        1 - 2 * y * n2 / n1 if n1 else 0.5,
        2 - 3 * y * n3 / n2 if n2 else 1.0,
        3 - 4 * y * n4 / n3 if n3 else 1.5,
    ]
    return np.array([0.0, *(min(max(d, 0.05), k + 0.95) for k, d in enumerate(given))])


@dataclass
class Model:
    """Where the arrays are, and the figures of the whole corpus."""

    folder: str
    pairs: list[str | None]
    words: list[str | None]
    hot: np.ndarray
    tokens: int
    vocabulary: int
    distinct_pairs: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    unseen: float  # share that the lowest order keeps for words never seen


def hot_words(texts: DataFrame, shards: int) -> np.ndarray:
    """Words with more than 1 / (HOT * shards) of the tokens of some documents: HOT * shards at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            tokens = np.concatenate([token_hashes(x.as_py()) for x in byte_texts(batch.column("text"))])
            words, count = np.unique(tokens, return_counts=True)
            often = count * HOT * shards > len(tokens)
            words, count = np.append(words[often], 0).view("i8"), np.append(count[often], len(tokens))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words), pa.array(count), pa.array([*[False] * (len(words) - 1), True])],
                names=["word", "n", "all"],
            )

    some = texts.where(F.pmod(F.xxhash64("doc_id", F.lit("hot")), F.lit(HOT_SAMPLE)) == 0)
    found = map_batches(some, run, "word long, n long, all boolean")
    counts = found.groupBy("word", "all").agg(F.sum("n").alias("n"))
    total = counts.where("all").agg(F.sum("n")).first()[0] or 0
    found = counts.where(~F.col("all") & (F.col("n") * HOT * shards > total)).orderBy(F.desc("n")).limit(HOT * shards)
    words = np.array([r.word for r in found.collect()], "i8").view("u8")
    return np.append(words, np.array([BEGIN, END], "u8"))


def learn(texts: DataFrame) -> Model:
    """Count the pairs of all ``texts`` and write the model below the shared folder."""
    spark = texts.sparkSession
    # a task holds one shard, so their number follows the texts
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-size // SHARD_BYTES))
    folder = scratch_path(spark, "ngrams")
    hot = hot_words(texts, shards)
    # written, so that shards are merged and their files made once
    merged_at = scratch_path(spark, "merged")
    merge_pairs(pair_blocks(texts, hot, shards), folder, shards).write.parquet(merged_at)
    merged = spark.read.schema(f"{SHARD}, block binary").parquet(merged_at)
    pairs = merged.where("kind = 'pairs'").drop("block").collect()
    words = merge_words(merged.where("kind = 'words'").select("shard", "block"), folder).collect()

    def names(rows: list) -> list[str | None]:
        out: list[str | None] = [None] * shards
        for r in rows:
            out[r.shard] = r.name
        return out

    total = lambda rows, c: sum(r[c] for r in rows)
    of = lambda rows: [total(rows, c) for c in ("n1", "n2", "n3", "n4")]
    vocabulary, distinct = total(words, "rows"), total(pairs, "rows")
    word_discounts, n = discounts(of(words)), of(words)
    kept = word_discounts[1] * n[0] + word_discounts[2] * n[1] + word_discounts[3] * (vocabulary - n[0] - n[1])
    return Model(
        folder, names(pairs), names(words), hot, total(pairs, "tokens"), vocabulary, distinct,
        discounts(of(pairs)), word_discounts, kept / distinct if distinct else 1.0,
    )


class Arrays:
    """The memory-mapped arrays of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.pairs = [self._pairs(map_shared(model.folder, x)) if x else None for x in model.pairs]
        self.words = [self._words(map_shared(model.folder, x)) if x else None for x in model.words]
        self.documents = int(self.word_stats(np.array([BEGIN], "u8"))[0, 0])

    @staticmethod
    def _pairs(raw: np.ndarray) -> tuple[np.ndarray, ...]:
        n, large = raw[:16].view("i8").tolist()
        at = [16, 16 + 8 * n, 16 + 8 * (n + large), 16 + 8 * (n + 2 * large)]
        return raw[at[0] : at[1]].view("u8"), raw[at[1] : at[2]].view("u8"), raw[at[2] : at[3]].view("i8"), raw[at[3] :]

    @staticmethod
    def _words(raw: np.ndarray) -> tuple[np.ndarray, ...]:
        n = int(raw[:8].view("i8")[0])
        body = raw[8:].reshape(-1, 8 * n)
        return body[0].view("u8"), [c.view("i8") for c in body[1:]]

    def _by_shard(self, shard: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        order = np.lexsort((keys, shard))
        bounds = np.searchsorted(shard[order], np.arange(len(self.model.pairs) + 1))
        for k in range(len(self.model.pairs)):
            if bounds[k] < bounds[k + 1]:
                own = order[bounds[k] : bounds[k + 1]]
                yield k, own, keys[own]

    def pair_counts(self, first: np.ndarray, pair: np.ndarray) -> np.ndarray:
        out = np.zeros(len(pair), "i8")
        for k, own, keys in self._by_shard(pair_shard(first, pair, self.model.hot, len(self.model.pairs)), pair):
            if self.pairs[k] is None:
                continue
            there, large, counts, small = self.pairs[k]
            at = np.minimum(np.searchsorted(there, keys), len(there) - 1)
            count = np.where(there[at] == keys, small[at], 0).astype("i8")
            if len(full := np.flatnonzero(count == 255)):
                count[full] = counts[np.searchsorted(large, keys[full])]
            out[own] = count
        return out

    def word_stats(self, words: np.ndarray) -> np.ndarray:
        """Rows of: tokens that follow, distinct ones seen once, twice, more often; distinct words before."""
        out = np.zeros((len(words), 5), "i8")
        shard = (mixed(words) % np.uint64(len(self.model.words))).astype("i4")
        for k, own, keys in self._by_shard(shard, words):
            if self.words[k] is None:
                continue
            there, columns = self.words[k]
            at = np.minimum(np.searchsorted(there, keys), len(there) - 1)
            found = there[at] == keys
            for c, column in enumerate(columns):
                out[own, c] = np.where(found, column[at], 0)
        return out

    def score(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """For each text: tokens, known tokens, base score and score."""
        model = self.model
        hashes = [token_hashes(x) for x in texts]
        lengths = np.array([len(x) for x in hashes])
        starts = np.cumsum(lengths) - lengths
        second = np.concatenate(hashes)
        words, at = np.unique(np.append(second, np.uint64(BEGIN)), return_inverse=True)
        stats = self.word_stats(words)
        tokens = stats[:, 0].copy()
        tokens[np.searchsorted(words, np.uint64(END))] = self.documents
        own = at[:-1]
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[starts] = at[-1]
        count = tokens[own]
        base = np.log10((count + 1) / (model.tokens + model.vocabulary + 1))

        follows = stats[:, 4]
        lower = follows - model.word_discounts[np.minimum(follows, 3)]
        lower = (lower / max(model.distinct_pairs, 1) + model.unseen / (model.vocabulary + 1))[own]
        pairs, first_at, pair_at = np.unique(pair_hash(words[before], second), return_index=True, return_inverse=True)
        pair_count = self.pair_counts(words[before][first_at], pairs)
        higher = (pair_count - model.pair_discounts[np.minimum(pair_count, 3)])[pair_at]
        total = stats[:, 0]
        kept = stats[:, 1:4] @ model.pair_discounts[1:]
        seen = total > 0
        weight = np.where(seen, kept / np.maximum(total, 1), 1.0)
        p = np.where(seen[before], higher / np.maximum(total[before], 1), 0.0) + weight[before] * lower
        return [
            lengths, np.add.reduceat((count > 0).astype("i8"), starts),
            np.add.reduceat(base, starts), np.add.reduceat(np.log10(p), starts),
        ]


_arrays: Arrays | None = None


def arrays(model: Model) -> Arrays:
    global _arrays
    if _arrays is None or _arrays.model.folder != model.folder:
        _arrays = Arrays(model)
    return _arrays


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every row.

    Logarithms are to base ten; the perplexity of a text is
    ``10 ** (-score / n_tokens)``. A null or empty text is its end alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SCORED_BYTES):
            n, known, base, score = arrays(model).score(byte_texts(batch.column("text")).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(known), pa.array(base), pa.array(score)],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text")), run, schema)


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Scores of all rows by a model of those that are not held out.

    Repeated rows count as often as they occur; a null id is never held out; an
    empty table gives no rows; without training rows every token has
    probability one, in both scores. Columns besides ``doc_id`` and ``text`` are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    held_out = remainder(F.col("doc_id"), 7) == 2
    model = learn(rows.where(~held_out))
    return scored(rows, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return held_out_scores(table(spark, sf_dir, "documents"))
