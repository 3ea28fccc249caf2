import random

import numpy as np
import pytest
import xxhash
from samples import documents, rows

from quaywise.llm import simhash


def plain_fingerprint(text):
    for c in "\t\n\r\x0b\x0c":
        text = (text or "").replace(c, " ")
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in text.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    """Position -> least position reachable over links of three bits."""
    group = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= 3 and group[j] > group[i]:
                    group[j], changed = group[i], True
    return group


def test_fingerprints():
    for text in [t for _, t, _, _ in rows() if not t or len(t) < 20000] + ["A b", "é É A", "a b c d"]:
        assert simhash.fingerprint(text.encode() if text else None) == plain_fingerprint(text)


def near_set(seed, n=120, spread=400):
    """Fingerprints in chains and clouds, at distances around the limit, and far ones."""
    rng = random.Random(seed)
    out = [0, (1 << 64) - 1]
    for _ in range(n):
        base = rng.choice(out) if rng.random() < 0.7 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randint(1, 5)):
            base ^= 1 << b
        out.append(base)
    return list(dict.fromkeys(out + [rng.getrandbits(64) for _ in range(spread)]))


@pytest.mark.parametrize("segments", [2, 4, 8])
def test_all_links_and_no_others(spark, segments):
    fps = sorted(near_set(segments), key=lambda x: x - (1 << 64) if x >> 63 else x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    forest = simhash.cell_forest(simhash.grid_cells(nodes, segments), segments)
    root = {r.u: r.v for r in simhash.components(forest).collect()}
    assert [root.get(x, x) for x in signed] == [signed[g] for g in plain_groups(fps)]


def test_blocks_of_pairs(monkeypatch):
    """Pairs of one cell are compared in blocks of any size."""
    monkeypatch.setattr(simhash, "PAIRS", 7)
    fps = near_set(9, 200, 0)
    cell = max({x.bit_count() for x in fps}, key=lambda n: sum(x.bit_count() == n for x in fps))
    fps = np.sort(np.array([x for x in fps if x.bit_count() == cell], "u8"))
    linked = {(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 3}
    found = {(max(i, j), min(i, j)) for a, b in simhash.links(fps, fps[:0], 64) for i, j in zip(a.tolist(), b.tolist(), strict=True) if i != j}
    assert linked and found == linked


def test_documents(spark):
    given = rows()
    found = simhash.near_groups(documents(spark, given)).collect()
    assert len(found) == len(given)
    fps = [plain_fingerprint(t) for _, t, _, _ in given]
    group = plain_groups(fps)
    least = {}
    for (i, *_), g in zip(given, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    expected = sorted((str(i), f"{fp:016x}", least.get(g)) for (i, *_), fp, g in zip(given, fps, group, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found) == expected


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    groups = {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted({g for g in groups.values()})


def test_rows_without_id_and_empty(spark):
    nameless = [(None, "one two three four", "en", "s"), (None, "one two three four", "en", "s")]
    assert len(simhash.keep_first(documents(spark, nameless)).collect()) == 1
    assert [r.component_id for r in simhash.near_groups(documents(spark, nameless)).collect()] == [None, None]
    assert simhash.near_groups(documents(spark, [])).collect() == []
    assert simhash.keep_first(documents(spark, [])).collect() == []
