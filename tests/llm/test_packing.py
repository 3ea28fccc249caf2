import random
import zlib

import numpy as np
import pytest
from samples import documents, rows

from quaywise.llm import packing
from quaywise.llm.tokens import encoder, vocabulary_path


def first_fit(sizes, capacity):
    bins = []
    for size in sorted(sizes, reverse=True):
        at = next((k for k, b in enumerate(bins) if b + size <= capacity), None)
        if at is None:
            bins.append(size)
        else:
            bins[at] += size
    return bins


@pytest.mark.parametrize("seed", range(5))
def test_tree_places_like_a_scan(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 200))]
    found = packing.pack(sizes, 100, max_gap=100)
    assert sorted(sum(p[2] for p in b) for b in found) == sorted(first_fit(sizes, 100))


@pytest.mark.parametrize("lengths", [[], [0], [1], [2048], [2049], [1100] * 99, [5000, 0, 3, 2048, 2047] * 7])
def test_every_token_once_and_little_padding(lengths):
    found = packing.pack(lengths)
    got = {k: [] for k in range(len(lengths))}
    for pieces in found:
        assert 0 < sum(p[2] for p in pieces) <= 2048
        for doc, start, n in pieces:
            got[doc].append((start, n))
    for doc, length in enumerate(lengths):
        at = 0
        for start, n in sorted(got[doc]):
            assert start == at and n > 0
            at += n
        assert at == length
    short = [p for p in found if sum(x[2] for x in p) < 2048 - packing.MAX_GAP]
    assert len(short) <= 1


@pytest.mark.parametrize("group_tokens", [3000, packing.GROUP_TOKENS])
def test_documents(spark, group_tokens):
    given = rows()
    found = packing.packed_pieces(documents(spark, given), group_tokens=group_tokens, with_ids=True).collect()
    encode = encoder(vocabulary_path())
    expected = sorted(
        [*encode.tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t, _, _ in given
    )
    for r in found:
        own = np.array(r.ids, "<u4")
        assert r.length == len(own) and r.ids_crc32 == zlib.crc32(own.tobytes())
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
    # documents with one id are told apart by how their pieces follow each other
    whole = {}
    for r in sorted(found, key=lambda r: (str(r.doc_id), r.doc_tokens, r.start, r.ids)):
        whole.setdefault((r.doc_id, r.doc_tokens), {}).setdefault(r.start, []).append(r.ids)
    rebuilt = []
    for starts in whole.values():
        docs = [[]]
        for start in sorted(starts):
            if start == 0:
                docs = [list(x) for x in starts[0]]
            else:
                for ids in starts[start]:
                    next(d for d in docs if len(d) == start).extend(ids)
        rebuilt += docs
    assert sorted(rebuilt) == expected


def test_empty(spark):
    assert packing.packed_pieces(documents(spark, [])).collect() == []


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_the_query_fills_its_sequences(spark, sf):
    found = packing.op8_pack_ffd(spark, f"/root/testdata/sf{sf}").collect()
    filled = {}
    for r in found:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert len(filled) > 50
    assert sum(filled.values()) / (packing.SEQUENCE_TOKENS * len(filled)) > 0.97
