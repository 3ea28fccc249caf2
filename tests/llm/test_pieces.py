import random
import zlib

import numpy as np
import pytest
import sentencepiece
from samples import documents, rows

from quaywise.llm import pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary_path())


@pytest.fixture(scope="module")
def transducer():
    return pieces.transducer(pieces.vocabulary_path())


def test_random_texts_equal_the_library(library, transducer):
    rng = random.Random(1)
    for alphabet in ("ab  the ingon<>[]/s.,éñß\n\t日ﬀ▁1290́", "aàinger  ", "▁ a", "٣²½x_-' ​😀"):
        for _ in range(800):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
            ids = library.encode(text)
            assert list(transducer.encode(text)) == ids, repr(text)
            assert transducer.decode(ids) == text.replace("▁", " ")


def test_path_is_the_least_of_all_paths(transducer):
    """All ways to cut a short text, weighed by brute force, give the same path."""

    def paths(text, last=pieces.UNKNOWN):
        if not text:
            yield 0, []
        for n in range(1, len(text) + 1):
            piece = text[:n]
            if piece in transducer.ids and transducer.follows(last, piece):
                for w, rest in paths(text[n:], piece):
                    yield w, [transducer.ids[piece], *rest]
        if text and text[0] not in transducer.ids:
            for w, rest in paths(text[1:], pieces.UNKNOWN):
                yield w + 1, [*transducer.fallback(text[0]), *rest]

    for text in ("▁the", "▁reading", "▁▁a", "▁x\ny", "▁日本", "▁enstth"):
        found = sorted(paths(text))
        assert len(found) == 1 and found[0][1] == transducer.shortest(text)


def test_documents(spark, library):
    given = rows()
    found = pieces.encoded(documents(spark, given))
    expected = [(i, library.encode(t or "")) for i, t, _, _ in given]
    assert sorted((str(r.doc_id), list(r.ids)) for r in found.collect()) == sorted((str(i), x) for i, x in expected)
    back = sorted((str(r.doc_id), r.text) for r in pieces.decoded(found).collect())
    assert back == sorted((str(i), t or "") for i, t, _, _ in given)
    digests = pieces.round_trips(documents(spark, given)).collect()
    assert all(r.round_trip for r in digests)
    assert sorted((str(r.doc_id), r.n_pieces, r.ids_crc32) for r in digests) == sorted(
        (str(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in expected
    )


def test_bytes_that_are_no_text(transducer):
    assert transducer.decode([transducer.bytes[0xFF]]) == "�"
    assert transducer.decode([]) == ""


def test_empty(spark):
    assert pieces.round_trips(documents(spark, [])).collect() == []
    assert pieces.encoded(documents(spark, [])).collect() == []
