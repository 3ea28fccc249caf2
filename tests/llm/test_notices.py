import random
import re

import duckdb
import pytest
from samples import documents, rows

from quaywise.llm import notices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FIND = notices.search(notices.NOTICES)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def least_edits(notice, words):
    """Ends of parts of ``words`` -> least edits to ``notice`` (Sellers)."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(notice, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return row


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def spoilt(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        text = text[:at] + ("" if kind == 0 else rng.choice("abexyz é")) + text[at + (kind < 2) :]
    return text


def base_by_words(text):
    words = WORD.findall(lower(text))
    found = []
    for label, phrase in notices.BASE:
        p = phrase.split()
        found += [(label, i) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(found, key=lambda x: (x[1], x[0]))


def test_places_equal_brute_force():
    """Every notice that is within its bound is found with its least edits, and no other."""
    rng = random.Random(2)
    some = 0
    for _ in range(250):
        _, notice = rng.choice(notices.NOTICES)
        k = notices.edits_of(f" {notice} ")
        text = " ".join(["foo bar é", spoilt(rng, notice, rng.randint(0, k + 2)), rng.choice(["", "baz", notice[: len(notice) // 2]])])
        words = notices.plain_words(text.encode()).decode()
        found = {}
        for f in FIND.places(words):
            found.setdefault(f.notice, []).append(f)
            assert distance(f" {f.notice} ", words[f.start : f.stop]) == f.edits
        for _, other in set(notices.NOTICES):
            least = min(least_edits(f" {other} ", words))
            if least <= notices.edits_of(f" {other} "):
                some += 1
                assert min(f.edits for f in found[other]) == least, (other, words)
            else:
                assert other not in found, (other, words)
    assert some > 150


def test_all_places_of_a_long_text():
    rng = random.Random(3)
    _, notice = notices.NOTICES[0]
    parts = [spoilt(rng, notice, rng.randint(0, 2)) for _ in range(40)]
    words = notices.plain_words(" filler words ".join(parts).encode()).decode()
    found = [f for f in FIND.places(words) if f.notice == notice]
    good = sum(min(least_edits(f" {notice} ", f" {p} ")) <= 2 for p in parts)
    assert len(found) == good
    assert all(a.stop <= b.start for a, b in zip(found, found[1:], strict=False))
    ends = least_edits(f" {notice} ", words)
    for end, least in enumerate(ends):  # every place is one of those found, or overlaps one
        if least <= 2:
            assert any(f.start < end and end - len(notice) < f.stop for f in found)


CASES = [
    "Licensed under the Apache License, Version 2.0.", "GNU General\nPublic-License", "gnu general public licence v3",
    "MIT License mit license MIT  LICENSE", "cc by", "cc bye", "xcc by", "CC BY-NC 4.0 and CC BY 4.0", "", None, "é",
    "cc cc by by cc by", "gnu gnu general public license", "{cc} by ~cc|by", "apache license apache license",
    "Licenced undr the Apache Licence, Version 2.0", "permission is hereby granted, free of charge, to any person optaining a copy of this softwre",
    "This Source Code Form is subject to the terms of the Mozila Public License, v. 2.0",
]


@pytest.mark.parametrize("text", CASES)
def test_base_places(text):
    n, found = base_by_words(text or "")
    words = notices.plain_words((text or "").encode())
    assert words.count(b" ") - 1 == n
    assert notices.base_places(words) == found


def test_labels_and_spans(spark):
    given = [(1000 + i, t, "en", "s") for i, t in enumerate(CASES)] + rows() + [(900, "x " * 300000 + "MIT Licence. " + "MIT License " * 3, None, None)]
    found = notices.license_places(documents(spark, given)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in given)
    texts = {i: t for i, t, *_ in given}
    for r in found:
        if r.doc_id in (None, 4):
            continue
        n, base = base_by_words(texts[r.doc_id] or "")
        assert (r.n_words, [tuple(b) for b in r.base]) == (n, base)
        for x in r.notices:
            part = texts[r.doc_id][x.start : x.stop]
            words = f" {' '.join(WORD.findall(lower(part)))} "
            assert distance(f" {x.notice} ", words) <= x.edits + 2, (x, part)
            assert WORD.match(lower(part)) and WORD.fullmatch(lower(part[-1]))
    by_id = {r.doc_id - 1000: {x.label for x in r.notices} for r in found if r.doc_id}
    assert by_id[15] == {"apache"} and by_id[16] == {"mit"} and by_id[17] == {"mpl"} and by_id[2] == {"gpl"}
    assert not by_id[0] - {"apache"} and not by_id[5] and by_id[7] == {"cc-by-nc"}


def test_query_columns_equal_sql(spark, tmp_path):
    given = [(1000 + i, t, "en", "s") for i, t in enumerate(CASES)] + [r for r in rows() if r[0] not in (None, 4)]
    documents(spark, given).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    found = notices.op13_fuzzy_notices(spark, str(tmp_path)).collect()
    con = duckdb.connect()
    phrases = ", ".join(f"('{label}', string_split('{p}', ' '))" for label, p in notices.BASE)
    wanted = con.execute(f"""
        WITH w AS (SELECT doc_id,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
          FROM '{tmp_path}/documents.parquet/*.parquet'),
        place AS (
          SELECT doc_id, label, i - 1 AS word FROM w, (VALUES {phrases}) p(label, phrase), unnest(range(1, len(words) + 1)) u(i)
          WHERE words[i : i + len(phrase) - 1] = phrase)
        SELECT w.doc_id, len(any_value(words)), count(word), min(word), max(word),
          coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '')
        FROM w LEFT JOIN place ON w.doc_id = place.doc_id GROUP BY w.doc_id""").fetchall()
    assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found) == sorted(wanted)
    for r in found:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.n_base == 0 or r.score == 1) and (r.labels != "" or r.score == 0)
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


def test_empty_table(spark):
    assert notices.license_places(documents(spark, [])).collect() == []
