import math
from collections import Counter

import pytest
from samples import documents, rows

from quaywise.llm import ngrams
from quaywise.llm.common import crc_remainder


def tokens(text):
    text = text or ""
    for c in "\t\n\r\x0b\x0c":
        text = text.replace(c, " ")
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [*(w for w in text.split(" ") if w), 0]  # 0: end


class Plain:
    """The model with dictionaries, from its formulas."""

    def __init__(self, texts):
        self.c, self.pairs = Counter(), Counter()
        for text in texts:
            before = 1  # begin
            for t in tokens(text):
                self.c[t] += 1
                self.pairs[before, t] += 1
                before = t
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.before = Counter(b for _, b in self.pairs)
        self.after, self.follow = Counter(), {}
        for (a, _), k in self.pairs.items():
            self.after[a] += k
            self.follow.setdefault(a, Counter())[min(k, 3)] += 1
        of = lambda counts: [sum(k == j for k in counts.values()) for j in (1, 2, 3, 4)]
        self.d2, self.d1 = ngrams.discounts(of(self.pairs)), ngrams.discounts(of(self.before))

    def lower(self, t):
        if not self.pairs:
            return 1.0
        kept = sum(self.d1[min(k, 3)] for k in self.before.values()) / len(self.pairs)
        k = self.before[t]
        return (k - self.d1[min(k, 3)]) / len(self.pairs) + kept / (self.v + 1)

    def p(self, a, t):
        if not self.after[a]:
            return self.lower(t)
        k = self.pairs[a, t]
        kept = sum(self.d2[j] * n for j, n in self.follow[a].items())
        return (k - self.d2[min(k, 3)] + kept * self.lower(t)) / self.after[a]

    def row(self, text):
        found = tokens(text)
        base = sum(math.log10((self.c[t] + 1) / (self.n + self.v + 1)) for t in found)
        score = sum(math.log10(self.p(a, t)) for a, t in zip([1, *found], found, strict=False))
        return len(found), sum(self.c[t] > 0 for t in found), self.n, base, score


@pytest.mark.parametrize("block, hot", [(3_000_000, 4), (500, 1000)])
def test_matches_plain_model(spark, monkeypatch, block, hot):
    monkeypatch.setattr(ngrams, "HOT", hot)
    given = rows() + [(700 + i, "the end of the line " * (i + 1), "en", "s") for i in range(20)]
    model = Plain([t for i, t, _, _ in given if i is None or crc_remainder(i, 7) != 2])
    found = ngrams.held_out_scores(documents(spark, given)).collect()
    assert len(found) == len(given)
    expected = sorted((str(i), *model.row(t)) for i, t, _, _ in given)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found)
    for a, b in zip(got, expected, strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)
    assert all(r.held_out == (crc_remainder(r.doc_id, 7) == 2) for r in found)


def test_probabilities_sum_to_one():
    model = Plain([t for _, t, _, _ in rows()[:12]])
    for a in [1, *list(model.after)[:5], "never seen"]:
        total = sum(model.p(a, t) for t in model.c) + model.p(a, "unseen")
        assert abs(total - 1) < 1e-9


def test_blocks_round_trip(spark):
    texts = documents(spark).select("doc_id", "text")
    hot = ngrams.hot_words(texts, 16)
    blocks = ngrams.pair_blocks(texts, hot, 16).collect()
    first, second, count = zip(*(ngrams.unpacked(r.block, *ngrams.PAIR_KINDS) for r in blocks), strict=True)
    pairs = Counter()
    for a, b, n in zip(first, second, count, strict=True):
        for x, y, k in zip(a.tolist(), b.tolist(), n.tolist(), strict=True):
            pairs[x, y] += k
    assert sorted(pairs.values()) == sorted(Plain([t for _, t, _, _ in rows()]).pairs.values())


def test_empty_and_untrained(spark):
    assert ngrams.held_out_scores(documents(spark, [])).collect() == []
    held = next(i for i in range(100) if crc_remainder(i, 7) == 2)
    r = ngrams.held_out_scores(documents(spark, [(held, "a b", "en", "s")])).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
