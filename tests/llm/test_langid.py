import random

import numpy as np
from samples import SYLLABLES, documents, prose, rows

from quaywise.llm import langid
from quaywise.llm.common import crc_remainder


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = langid.new_model(["a", "b", "c"], rng, hidden=3)
    for name in ("inputs", "states"):
        setattr(model, name, [x.astype("f8") for x in getattr(model, name)])
    model.out, model.bias = model.out.astype("f8"), model.bias.astype("f8")
    data, target = rng.integers(0, 256, (5, 4)), rng.integers(0, 3, 4)
    _, grads = langid.gradients(model, data, target)
    for array, grad in zip(model.arrays(), grads, strict=True):
        spots = [np.unravel_index(k, array.shape) for k in rng.choice(array.size, 6)]
        spots += [(data[0, 0], 1)] if array.shape[0] == 256 else []
        for at in spots:
            kept, step = array[at], 1e-3
            array[at] = kept + step
            up, _ = langid.gradients(model, data, target)
            array[at] = kept - step
            down, _ = langid.gradients(model, data, target)
            array[at] = kept
            assert abs((up - down) / (2 * step) - grad[at]) < 2e-3


def test_reader_equals_the_plain_network():
    """Windows, padding and pooling against one text and one step at a time."""
    rng = np.random.default_rng(1)
    model = langid.new_model(["a", "b"], rng)
    reader = langid.Reader(model)
    texts = [b"x", b"some text " * 9, rng.integers(0, 256, 300, dtype="u1").tobytes(), b"ab" * 64, b""]
    pooled = reader.documents(texts)
    for text, row in zip(texts, pooled, strict=True):
        total = np.zeros(2)
        for begin in range(0, len(text), langid.WINDOW):
            at = max(0, min(begin, len(text) - langid.WINDOW))
            part = np.frombuffer(text[at : at + langid.WINDOW].ljust(langid.WINDOW), "u1").astype("i8")[:, None]
            ahead = np.stack([s[-1] for s in langid.recur(model.inputs[0], model.states[0], part)])
            behind = np.stack([s[-1] for s in langid.recur(model.inputs[1], model.states[1], part[::-1])])[::-1]
            p = langid.softmax(np.concatenate([ahead, behind], axis=2) @ model.out + model.bias)[:, 0]
            counted = np.arange(at, at + langid.WINDOW)
            total += p[(counted >= begin) & (counted < len(text))].sum(axis=0)
        assert np.allclose(row, total / max(len(text), 1), atol=1e-4)


def test_held_out_accuracy(spark):
    rng = random.Random(7)
    given = [(i, prose(rng, lang, 80), lang, "s") for i, lang in enumerate(list(SYLLABLES) * 60)]
    found = langid.identify(documents(spark, given)).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 180 and len(held) > 20
    assert all(r.held_out == (crc_remainder(r.doc_id, 4) == 2) for r in found)
    assert all(r.lang_pred == given[r.doc_id][2] and 0.5 < r.score <= 1 for r in held)


def test_rare_ones_of_many_languages(spark):
    """Forty languages, the last eight of them with fewer rows than the others."""
    rng = random.Random(5)
    letters = ("abcdefghijklmnopqrstuvwxyzäöüéèçñåøßžščő", "абвгдежзийклмнопрстуфхцчшщыэюя")
    given = []
    for k in range(40):
        syllables = ["".join(rng.choice(letters[k % 2]) for _ in range(rng.randint(1, 3))) for _ in range(14)]
        for _ in range(24 if k < 32 else 16):
            words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(100)]
            given.append((len(given), " ".join(words), f"l{k:02d}", "s"))
    docs = documents(spark, given)
    held = [r for r in langid.identify(docs).collect() if r.held_out]
    rare = [r for r in held if given[r.doc_id][2] >= "l32"]
    assert len(rare) > 20 and all(r.lang_pred == given[r.doc_id][2] for r in rare)
    assert sum(r.lang_pred == given[r.doc_id][2] for r in held) >= 0.98 * len(held)
    assert langid.keep_known(docs).count() >= 0.98 * len(given)


def test_rows_of_many_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "FULL_LABELS", 2)
    monkeypatch.setattr(langid, "PER_LABEL", 6)
    given = [(i, f"text {i}", f"l{i % 4}", "s") for i in range(200)] + [(200, "text", "rare", "s"), (204, "text", "rare", "s")]
    found = [r.lang for r in langid.training_rows(documents(spark, given)).collect()]
    assert {x: found.count(x) for x in found} == {"l0": 2, "l1": 2, "l2": 2, "l3": 2, "rare": found.count("rare")}
    assert 1 <= found.count("rare") <= 2


def test_held_out_labels_are_not_read(spark):
    given = [(i, t, lang if crc_remainder(i, 4) != 2 else "xx", s) for i, t, lang, s in rows()[:60]]
    assert {r.lang for r in langid.training_rows(documents(spark, given)).collect()} == {"en", "de", "fr"}


def test_odd_rows(spark):
    docs = documents(spark)
    found = langid.identify(docs).collect()
    assert len(found) == len(rows())
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (300, 301, 302, 304))
    assert by_id[303].lang_pred != "und" and by_id[306].lang_pred == "fr"
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 3 and not {300, 301, 302, 304} & set(ids)


def test_nothing_to_learn_from(spark):
    assert langid.identify(documents(spark, [])).collect() == []
    found = langid.identify(documents(spark, [(1, "some text", None, "s")])).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
