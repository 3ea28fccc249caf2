"""Fuzzy search of short license notices.

A text becomes its words, A-Z in lower case, with one space before, between
and after them. A notice of n characters may differ from a part of that string
by up to one edit in twelve characters, four at most. By the pigeonhole
principle one of k + 1 parts of a notice is untouched by k edits: an automaton
finds all parts of all notices at once, and only around these seeds does the
regex library match the whole notice with a bounded number of errors, with
fewer errors first.

Beside them the base phrases are found exactly, word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.llm.common import byte_texts, map_batches, slices, table

#: Phrases that count as places of their label, word by word. Fixed values.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
#: Notices that may be misspelt. Fixed values.
NOTICES = (
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "spdx license identifier apache 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors"),
    ("cc-by", "creative commons attribution license"),
    ("cc-by", "creative commons attribution 4 0 international"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "creative commons zero"),
    ("cc0", "cc0 1 0 universal"),
    ("epl", "eclipse public license"),
    ("gpl", "gnu general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("mit", "spdx license identifier mit"),
    ("mpl", "mozilla public license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

LETTERS_AN_EDIT = 12
MOST_EDITS = 4

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
_PLAIN = bytes.maketrans(_SEPARATORS + _UPPER, b" " * len(_SEPARATORS) + _UPPER.lower())
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

PLACES = (
    "doc_id long, n_words long, base array<struct<label: string, word: long>>, "
    "notices array<struct<label: string, notice: string, start: long, stop: long, edits: int>>"
)


class Notice(NamedTuple):
    label: str
    text: str
    #: Patterns for 0, 1, ... errors.
    patterns: tuple


class Found(NamedTuple):
    label: str
    notice: str
    start: int
    stop: int
    edits: int


def edits_of(notice: str) -> int:
    return min(MOST_EDITS, len(notice) // LETTERS_AN_EDIT)


class Search:
    """The automaton of all seeds, and the patterns behind them."""

    def __init__(self, notices: Sequence[tuple[str, str]]):
        import ahocorasick
        import regex

        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (label, text) in enumerate(notices):
            whole = f" {text} "
            k = edits_of(whole)
            patterns = [regex.compile(regex.escape(whole, literal_spaces=True))]
            patterns += [regex.compile(f"(?:{regex.escape(whole, literal_spaces=True)}){{e<={e}}}") for e in range(1, k + 1)]
            self.notices.append(Notice(label, whole, tuple(patterns)))
            cuts = [len(whole) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(whole[a:b], []).append((i, a))
        self.automaton = ahocorasick.Automaton()
        for seed, owners in seeds.items():
            self.automaton.add_word(seed, (len(seed), owners))
        self.automaton.make_automaton()

    def regions(self, words: str) -> dict[int, list[list[int]]]:
        """Notice -> parts of ``words`` that hold all its places; parts that meet are one."""
        found: dict[int, list[list[int]]] = {}
        for last, (length, owners) in self.automaton.iter(words):
            for i, offset in owners:
                text = self.notices[i].text
                k = len(self.notices[i].patterns) - 1
                start = last + 1 - length - offset
                found.setdefault(i, []).append([max(0, start - k), min(len(words), start + len(text) + k)])
        return {i: merged(x) for i, x in found.items()}

    def places(self, words: str) -> list[Found]:
        """Places of notices: those with fewer edits first, then those further left.

        A place that overlaps another one of its notice is not given beside it.
        """
        found = []
        for i, parts in self.regions(words).items():
            label, text, patterns = self.notices[i]
            for edits, pattern in enumerate(patterns):
                rest = []
                for start, stop in parts:
                    for m in pattern.finditer(words, start, stop):
                        if m.end() > m.start():
                            found.append(Found(label, text[1:-1], m.start(), m.end(), edits))
                            rest.append([start, m.start()])
                            start = m.end()
                    rest.append([start, stop])
                # a part that is too short for the notice holds no more places
                parts = [p for p in rest if p[1] - p[0] >= len(text) - len(patterns) + 1]
        return sorted(found, key=lambda x: (x.start, x.stop, x.notice))


def merged(parts: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted(parts):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


@lru_cache(maxsize=4)
def search(notices: tuple[tuple[str, str], ...]) -> Search:
    """One for each worker process."""
    return Search(notices)


def plain_words(text: bytes) -> bytes:
    """Lower-case words with one space around each."""
    words = text.translate(_PLAIN).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def base_places(words: bytes, phrases: Sequence[tuple[str, str]] = BASE) -> list[tuple[str, int]]:
    """Label and first word of every place where a phrase's words stand one after another."""
    out = []
    for label, phrase in phrases:
        wanted = f" {phrase} ".encode()
        at, counted, word = words.find(wanted), 0, 0
        while at >= 0:
            word += words.count(b" ", counted, at)
            counted = at
            out.append((label, word))
            at = words.find(wanted, at + 1)
    return sorted(out, key=lambda x: (x[1], x[0]))


def in_text(text: str, words: str, found: list[Found]) -> list[Found]:
    """The same places as positions in the given text, from its first to behind its last letter."""
    if not found:
        return found
    ends = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    starts = [0]
    for a, b in ends:
        starts.append(starts[-1] + b - a + 1)  # where words begin in ``words``, less one

    def original(at: int) -> int:
        import bisect

        w = bisect.bisect_right(starts, at - 1) - 1
        return ends[w][0] + at - 1 - starts[w]

    out = []
    for f in found:
        first = f.start + (words[f.start] == " ")
        last = f.stop - 1 - (words[f.stop - 1] == " ")
        out.append(f._replace(start=original(first), stop=original(last) + 1))
    return out


def license_places(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    phrases: Sequence[tuple[str, str]] = BASE,
) -> DataFrame:
    """Words, base places (first words) and notices (spans of the text, edits) of every document.

    A null text counts as empty and has none. A null id stays; repeated rows
    stay; an empty table gives no rows; other columns are not read. A text is
    read once from its beginning to its end, however long it is.
    """
    notices, phrases = tuple(map(tuple, notices)), tuple(map(tuple, phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = search(notices)
        schema = pa.schema(
            {
                "doc_id": pa.int64(), "n_words": pa.int64(),
                "base": pa.list_(pa.struct({"label": pa.string(), "word": pa.int64()})),
                "notices": pa.list_(pa.struct({
                    "label": pa.string(), "notice": pa.string(), "start": pa.int64(), "stop": pa.int64(),
                    "edits": pa.int32(),
                })),
            }
        )
        for batch in slices(batches, "text"):
            n_words, base, spans = [], [], []
            for text in byte_texts(batch.column("text")):
                text = text.as_py() or b""
                words = plain_words(text)
                n_words.append(words.count(b" ") - 1)
                base.append([{"label": x, "word": w} for x, w in base_places(words, phrases)])
                line = words.decode()
                places = find.places(line)
                spans.append([x._asdict() for x in in_text(text.decode(), line, places)] if places else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(base, schema.field("base").type),
                    pa.array(spans, schema.field("notices").type),
                ],
                schema=schema,
            )

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PLACES)


def op13_fuzzy_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all ``documents``; the score is that of the best place, 1 for exact ones."""
    found = license_places(table(spark, sf_dir, "documents"))
    words = F.transform("base", lambda x: x["word"])
    labels = F.transform("base", lambda x: x["label"])
    similar = F.transform(
        "notices", lambda x: F.lit(1.0) - x["edits"] / (F.length(x["notice"]) + F.lit(2))
    )
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union(labels, F.transform("notices", lambda x: x["label"]))), ","
        ).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max(similar), F.lit(0.0))).alias("score"),
        "notices",
    )
