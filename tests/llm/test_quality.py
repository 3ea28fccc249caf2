import random

import numpy as np
from samples import documents, prose, rows

from quaywise.llm import quality

SPACE = " \t\n\r\x0b\x0c"


def brute(text):
    """Counts by the plain definitions, a character and a window at a time."""
    text = text or ""
    for c in SPACE[1:]:
        if c != "\n":
            text = text.replace(c, " ")
    lines = text.split("\n")
    words = [w for w in text.replace("\n", " ").split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in lines:
        if line.strip(" "):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def test_counts_match_definitions(spark):
    given = [r for r in rows() if not r[1] or len(r[1]) < 6000]
    given += [(900, "a # b\n a\r\n<c> | é ß\x0b\n\n x y z x y z", "en", "s")]
    found = quality.judge(documents(spark, given)).collect()
    assert len(found) == len(given)
    expected = sorted((str(i), *brute(t)) for i, t, _, _ in given)
    assert sorted(
        (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found
    ) == expected
    assert all(not (r.base_failed and r.kept) for r in found)


def test_outliers_go_and_clean_documents_stay(spark):
    rng = random.Random(3)
    clean = [(i, prose(rng, "en", rng.randint(60, 900)), "en", "src0") for i in range(300)]
    junk = [(1000 + i, " ".join(f"{w}###" for w in prose(rng, "en", 200).split()), "en", "src0") for i in range(40)]
    shout = [(2000 + i, prose(rng, "en", 200).upper(), "en", "src0") for i in range(40)]
    kept = {r.doc_id for r in quality.judge(documents(spark, clean + junk + shout)).where("kept").collect()}
    assert kept == {i for i, *_ in clean}


def test_estimate_matches_numpy(spark):
    """The last estimate is a fixed point of steps computed on whole arrays."""
    rng = random.Random(5)
    given = [(i, prose(rng, "en", rng.randint(60, 900)), "en", "src0") for i in range(200)]
    docs = documents(spark, given)
    rows_ = quality.grouped(quality.statistics(docs)).cache()
    fields = [f"s{k}" for k in range(quality.N)]
    x = np.array(rows_.select(*fields).collect(), "f8") / quality.SCALE
    params = quality.start_params(rows_)
    p = params.toPandas().iloc[0]
    middle = np.sort(np.floor(x * 100) / 100, axis=0)[99]
    assert np.allclose([p[f"m{k}"] for k in range(quality.N)], middle)
    inverse = np.zeros((quality.N, quality.N))
    for i, j in quality._PAIRS:
        inverse[i, j] = inverse[j, i] = p[f"p{i}_{j}"] / (1 if i == j else 2)
    d = np.einsum("ni,ij,nj->n", x - middle, inverse, x - middle)
    bins = np.floor(quality.BINS * np.log2(1 + d))
    cut = np.sort(bins)[int(np.ceil(len(x) * quality.H)) - 1]
    near = x[bins <= cut]
    after = quality.concentrate(rows_, params).toPandas().iloc[0]
    assert np.allclose([after[f"m{k}"] for k in range(quality.N)], near.mean(axis=0))


def test_chi_squared():
    assert abs(quality.chi2_point(0.95, 8) - 15.507) < 0.01
    assert abs(quality.chi2_point(0.5, 2) - 1.3863) < 0.001


def test_keep_clean_keeps_columns_and_repeated_rows(spark):
    docs = documents(spark)
    kept = quality.keep_clean(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 3 and 300 not in ids and 301 not in ids and 305 not in ids
    assert None in ids  # a row without id is judged by its text


def test_empty(spark):
    assert quality.judge(documents(spark, [])).collect() == []
    assert quality.keep_clean(documents(spark, [])).collect() == []


def clean_rows(spark, given):
    rows_ = quality.grouped(quality.statistics(documents(spark, given)))
    return rows_.where("not base_failed")


def test_the_best_of_several_starts_goes_on(spark):
    """A third of a group are outliers that stand close together: the estimate covers the others."""
    rng = random.Random(8)
    given = [(i, prose(rng, "en", rng.randint(60, 900)), "en", "src0") for i in range(200)]
    given += [(1000 + i, prose(rng, "en", 300).upper(), "en", "src0") for i in range(60)]
    rows_ = clean_rows(spark, given).cache()
    starts = quality.start_params(rows_).unionByName(quality.subset_params(rows_))
    assert {r.start for r in starts.collect()} == {0, 1, 2, 3}
    best = quality.estimates(rows_).collect()
    assert len(best) == 1
    upper = list(quality.STATISTICS).index("upper_share")
    assert best[0][f"m{upper}"] < 0.1
    kept = {r.doc_id for r in quality.judge(documents(spark, given)).where("kept").collect()}
    assert kept == set(range(200))


def test_determinants(spark):
    rng = np.random.default_rng(1)
    scatters = np.stack([np.cov(rng.standard_normal((quality.N, 50))) for _ in range(3)])
    found = quality._params(["a", "b", "c"], [0, 1, 2], np.zeros((3, quality.N)), scatters)
    least = np.diag(np.square(list(quality.STATISTICS.values())))
    assert np.allclose(found["logdet"], [np.log(np.linalg.det(s + least)) for s in scatters])
