"""Quality rules: robust multivariate outliers of text statistics.

Each text gives a vector of transformed statistics. For every language and
source the minimum covariance determinant estimate (location and scatter of the
``H`` share of its documents that lie closest together) is found by
concentration steps over all of its documents. Several starts per group, the
coordinate-wise medians and small random subsets, take a few steps side by side
in the same aggregates; the one whose scatter has the least determinant goes on
until its determinant stands still. Documents whose Mahalanobis distance from it
is too large are rejected. Two plain rules on length and repetition come first;
documents that fail them take no part in the estimates.

Statistics are rounded to whole thousandths and every sum is a sum of whole
numbers, so an estimate doesn't depend on how rows are dealt out or on tasks
that ran twice. Distances at which the closest share ends are read off
histograms of fixed, narrow bins. Nothing but sums and histograms of a group is
ever gathered, so a source may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaywise.llm.common import byte_texts, map_batches, slices, stored, table

SYMBOLS = "#*$%&|<>"
_SYMBOLS = list(SYMBOLS.encode())
_SPACE = [0x20, *range(0x09, 0x0E)]
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Statistics of the vector, in order, with the least standard deviation that
#: an estimate may have: most documents have no symbol or repeated line at all.
STATISTICS = {
    "words_log": 0.5,
    "word_length": 0.35,
    "symbols": 0.35,
    "dup_lines": 0.12,
    "repeat_words": 0.12,
    "upper_share": 0.05,
    "line_words_log": 0.5,
    "letter_share": 0.03,
}
N = len(STATISTICS)
#: Statistics are kept as whole multiples of 1 / SCALE.
SCALE = 1000
#: Share of a group that an estimate is taken from.
H = 0.75
#: Random starts of a group beside its medians, each a subset of one in so many documents.
STARTS, SUBSET = 3, 24
#: Steps of all starts, and of the best one at most; it ends where its determinant's logarithm falls by less.
ROUGH_STEPS, MOST_STEPS, STILL = 2, 3, 0.01
#: Groups with fewer documents are estimated together, first by language, then overall.
MIN_GROUP = 100
#: Upper share of a chi-squared distribution that counts as an outlier. Very
#: small, as the statistics of clean text have heavier tails than normal ones.
TAIL = 1e-9
#: Bins in a doubling of the squared distance.
BINS = 32

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def text_counts(text: bytes | None) -> tuple[int, int, int, int, int, list[int]]:
    """Words, their code points, symbols, duplicate lines, words in repeated
    three-word windows; and the vector of statistics in thousandths.

    A null or empty text, or one of white space, has no words and a vector of
    zeros. ``bytes.split`` and ``strip`` divide at exactly the white space of
    the rules.
    """
    words = text.split() if text else []
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, [0] * N
    of_byte = np.bincount(np.frombuffer(text, "u1"), minlength=256)
    following = int(of_byte[0x80:0xC0].sum())
    chars = len(text) - following - int(of_byte[_SPACE].sum())
    n_symbols = int(of_byte[_SYMBOLS].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    upper = int(of_byte[65:91].sum())
    letters = upper + int(of_byte[97:123].sum()) + int(of_byte[0xC0:].sum())
    vector = (
        np.log1p(n),
        min(chars / n, 40.0),
        np.log1p(100 * n_symbols / n),
        dup_lines / len(lines),
        repeated / n,
        upper / max(letters, 1),
        np.log1p(n / len(lines)),
        letters / chars,
    )
    return n, chars, n_symbols, dup_lines, repeated, [round(float(x) * SCALE) for x in vector]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more, the first included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), "i8", n)
    if len(number) == n:
        return 0
    if len(number) < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        _, inverse, count = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        windows = np.stack([ids[:-2], ids[1:-1], ids[2:]], 1)
        _, inverse, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    twice = count[inverse.reshape(-1)] > 1
    covered = np.zeros(n, "?")
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(np.count_nonzero(covered))


def statistics(docs: DataFrame) -> DataFrame:
    """Counts and vectors ``s0..`` of all documents, with ``base_failed``; texts are not kept."""
    fields = [f"s{k}" for k in range(N)]
    schema = f"doc_id long, text_hash long, lang string, source string, {COUNTS}, " + ", ".join(
        f"{x} long" for x in fields
    )
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [text_counts(x.as_py()) for x in byte_texts(batch.column("text"))]
            counts = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            vectors = [pa.array([r[5][k] for r in rows], pa.int64()) for k in range(N)]
            kept = [batch.column(c) for c in names[:4]]
            yield pa.RecordBatch.from_arrays([*kept, *counts, *vectors], names=names)

    given = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"),
        F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text"),
    )
    return map_batches(given, run, schema).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def _key(*names: str) -> Column:
    """Values as one string, null apart from every value."""
    return F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.col(n)), F.lit("-")) for n in names))


def grouped(rows: DataFrame) -> DataFrame:
    """``rows`` with ``grp``: language and source, or what small ones share.

    Sources with fewer than ``MIN_GROUP`` documents share the group of their
    language, and languages that are still smaller share one. No estimate is
    made of a group that stays below ``MIN_GROUP``. ``grp`` is null where no
    document of the source passed the plain rules.
    """
    sizes = rows.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = sizes.where(F.col("n") < MIN_GROUP).groupBy(F.col("lang").alias("small_lang")).agg(F.sum("n").alias("lang_n"))
    sizes = sizes.join(small, F.col("lang").eqNullSafe(F.col("small_lang")), "left").select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
        F.when(F.col("n") >= MIN_GROUP, F.concat(F.lit("s"), _key("lang", "source")))
        .when(F.col("lang_n") >= MIN_GROUP, F.concat(F.lit("l"), _key("lang")))
        .otherwise("o").alias("grp"),
    )
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    return rows.join(sizes, same, "left").drop("g_lang", "g_source")


def gamma_share(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    if x <= 0:
        return 0.0
    from math import exp, lgamma, log

    term = total = 1 / a
    k = a
    while term > total * 1e-15:
        k += 1
        term *= x / k
        total += term
    return min(1.0, total * exp(-x + a * log(x) - lgamma(a)))


def chi2_point(share: float, degrees: int) -> float:
    """Where a chi-squared distribution has ``share`` below it, by bisection."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if gamma_share(degrees / 2, mid / 2) < share else (low, mid)
    return (low + high) / 2


#: Factor that makes the scatter of the closest share that of all, for normal rows.
CONSISTENCY = H / gamma_share(N / 2 + 1, chi2_point(H, N) / 2)
CUTOFF = chi2_point(1 - TAIL, N)

_MEANS = [f"m{k}" for k in range(N)]
_PAIRS = [(i, j) for i in range(N) for j in range(i, N)]
_INVERSE = [f"p{i}_{j}" for i, j in _PAIRS]
PARAMS = "grp string, start int, logdet double, " + ", ".join(f"{c} double" for c in [*_MEANS, *_INVERSE])


def _params(groups: list[str], starts: list[int], means: np.ndarray, scatters: np.ndarray) -> pa.RecordBatch:
    """Means, inverse scatters and their determinants, with the least deviations added to the scatter."""
    least = np.diag(np.square(list(STATISTICS.values())))
    inverse = np.linalg.inv(scatters + least) if len(groups) else scatters
    logdet = np.linalg.slogdet(scatters + least)[1] if len(groups) else np.empty(0)
    columns = {"grp": pa.array(groups, pa.string()), "start": pa.array(starts, pa.int32()), "logdet": pa.array(logdet)}
    columns |= {m: pa.array(means[:, k].copy()) for k, m in enumerate(_MEANS)}
    columns |= {p: pa.array(inverse[:, i, j] * (1 if i == j else 2)) for p, (i, j) in zip(_INVERSE, _PAIRS, strict=True)}
    return pa.RecordBatch.from_pydict(columns)


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Columns of a batch as a matrix of doubles."""
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype("f8") for c in names], axis=1)


def start_params(rows: DataFrame) -> DataFrame:
    """Medians and median deviations of each group, exact to a hundredth."""
    value = F.explode(F.map_from_arrays(F.array(*(F.lit(k) for k in range(N))), F.array(
        *(F.floor(F.col(f"s{k}") / 10).cast("long") for k in range(N)))))
    cells = rows.select("grp", value.alias("stat", "v")).groupBy("grp", "stat", "v").agg(F.count("*").alias("n"))

    def middle(cells: DataFrame, by: str, out: str) -> DataFrame:
        w = W.partitionBy("grp", "stat")
        up = cells.withColumn("below", F.sum("n").over(w.orderBy(by))).withColumn("all", F.sum("n").over(w))
        up = up.where((F.col("all") >= MIN_GROUP) & (2 * F.col("below") >= F.col("all")))
        return up.groupBy("grp", "stat").agg(F.min(by).alias(out))

    med = middle(cells, "v", "med")
    away = cells.join(med, ["grp", "stat"]).withColumn("away", F.abs(F.col("v") - F.col("med")))
    away = away.groupBy("grp", "stat", "away").agg(F.sum("n").alias("n"))
    both = med.join(middle(away, "away", "mad"), ["grp", "stat"])
    wide = both.groupBy("grp").agg(
        *(F.max(F.when(F.col("stat") == k, F.col(c))).alias(f"{c}{k}") for k in range(N) for c in ("med", "mad"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            means = _matrix(x, [f"med{k}" for k in range(N)]) / 100
            deviations = 1.4826 * _matrix(x, [f"mad{k}" for k in range(N)]) / 100
            scatters = np.einsum("gi,ij->gij", deviations**2, np.eye(N))
            yield _params(x.column("grp").to_pylist(), [0] * x.num_rows, means, scatters)

    return wide.mapInArrow(run, PARAMS)


def squared_distance() -> Column:
    """Squared Mahalanobis distance of a row from the estimate joined to it."""
    centred = [F.col(f"s{k}") / F.lit(float(SCALE)) - F.col(m) for k, m in enumerate(_MEANS)]
    terms = [centred[i] * centred[j] * F.col(p) for p, (i, j) in zip(_INVERSE, _PAIRS, strict=True)]
    total = terms[0]
    for term in terms[1:]:
        total += term
    return F.greatest(total, F.lit(0.0))


def concentrate(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step: estimates from each group's closest share of rows."""
    fields = [f"s{k}" for k in range(N)]
    judged = rows.join(params, "grp").select(
        "grp", "start", *fields, F.floor(BINS * F.log2(1 + squared_distance())).cast("long").alias("bin")
    )
    by_bin = judged.groupBy("grp", "start", "bin").agg(*_sums())
    group = W.partitionBy("grp", "start")
    closest = by_bin.withColumn("before", F.sum("n").over(group.orderBy("bin")) - F.col("n")).withColumn(
        "all", F.sum("n").over(group)
    ).where(F.col("before") < F.col("all") * H)
    sums = closest.groupBy("grp", "start").agg(
        F.sum("n").alias("n"),
        *(F.sum(f).cast("double").alias(f) for f in fields),
        *(F.sum(f"x{i}_{j}").cast("double").alias(f"x{i}_{j}") for i, j in _PAIRS),
    )
    return _of_sums(sums, CONSISTENCY)


def _sums() -> list[Column]:
    """Number, sums and sums of products of the rows of a group."""
    return [
        F.count("*").alias("n"),
        *(F.sum(f"s{k}").alias(f"s{k}") for k in range(N)),
        *(F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"x{i}_{j}") for i, j in _PAIRS),
    ]


def _of_sums(sums: DataFrame, factor: float) -> DataFrame:
    """Estimates from sums by group and start; scatters are made larger by ``factor``."""
    fields = [f"s{k}" for k in range(N)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            n = _matrix(x, ["n"])
            means = _matrix(x, fields) / n
            scatters = np.empty((x.num_rows, N, N))
            for i, j in _PAIRS:
                moment = _matrix(x, [f"x{i}_{j}"])[:, 0] / n[:, 0] - means[:, i] * means[:, j]
                scatters[:, i, j] = scatters[:, j, i] = moment
            given = x.column("grp").to_pylist(), x.column("start").to_pylist()
            yield _params(*given, means / SCALE, factor * scatters / SCALE**2)

    return sums.mapInArrow(run, PARAMS)


def subset_params(rows: DataFrame) -> DataFrame:
    """Estimates from small subsets of each group, dealt by a hash of the row; empty ones give none."""
    of = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("start")), F.lit(SUBSET)).cast("int") + 1
    some = rows.withColumn("start", of).where(F.col("start") <= STARTS)
    sizes = rows.groupBy("grp").agg(F.count("*").alias("all")).where(F.col("all") >= MIN_GROUP).select("grp")
    sums = some.groupBy("grp", "start").agg(*_sums()).join(sizes, "grp", "left_semi")
    exact = [F.col(c).cast("double").alias(c) for c in sums.columns if c not in ("grp", "start", "n")]
    return _of_sums(sums.select("grp", "start", "n", *exact), 1.0)


def estimates(rows: DataFrame) -> DataFrame:
    """The estimate of each group: the best of several starts, stepped until it stands still.

    A group of fewer than ``MIN_GROUP`` rows has none.
    """
    params = stored(start_params(rows).unionByName(subset_params(rows)), "estimates")
    for _ in range(ROUGH_STEPS):
        params = stored(concentrate(rows, params), "estimates")
    best = params.groupBy("grp").agg(F.min(F.struct("logdet", "start")).alias("best")).select("grp", "best.start")
    params = stored(params.join(best, ["grp", "start"]).select(*params.columns), "estimates")
    for _ in range(MOST_STEPS):
        before = params.select("grp", F.col("logdet").alias("before"))
        params = stored(concentrate(rows, params), "estimates")
        falls = params.join(before, "grp").where(F.col("before") - F.col("logdet") > STILL)
        if falls.isEmpty():
            break
    return params.drop("start", "logdet")


def judge(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` and ``kept`` of every document.

    Null texts have no words and fail the plain rules. Null languages and
    sources are groups of their own. Repeated rows are judged alike. An empty
    table gives no rows; without enough documents for any estimate the plain
    rules alone decide (``distance`` is null). Needs ``doc_id``, ``text``,
    ``lang`` and ``source``; other columns are not read.
    """
    rows = stored(grouped(statistics(docs)), "statistics")
    clean = rows.where(~F.col("base_failed") & F.col("grp").isNotNull())
    judged = rows.join(estimates(clean), "grp", "left").withColumn("distance", F.sqrt(squared_distance()))
    far = F.coalesce(F.col("distance") ** 2 > CUTOFF, F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~far).select(
        "doc_id", "text_hash", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "distance",
    )


def keep_clean(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The rejected ones are looked up by every column a verdict rests on, so
    repeated ids with different texts are judged apart.
    """
    bad = judge(docs).where(~F.col("kept")).select(
        F.struct("doc_id", "text_hash", "lang", "source").alias("bad")
    ).distinct()
    own = F.struct(
        docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"),
        docs["lang"].cast("string").alias("lang"), docs["source"].cast("string").alias("source"),
    )
    # the given columns are one, so that none of them can meet a name used here
    held = docs.select(own.alias("own"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return held.join(bad, F.col("own").eqNullSafe(F.col("bad")), "left_anti").select("row.*")


def op1_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    return judge(table(spark, sf_dir, "documents")).drop("text_hash", "lang", "source")
