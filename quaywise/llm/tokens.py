"""Byte-level BPE token ids, with the ids of space-separated chunks kept."""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache
from pathlib import Path

import numpy as np

#: Chunks whose ids a worker keeps; a chunk beyond that is encoded each time.
KEPT_CHUNKS = 400_000

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The split pattern of the vocabulary, and the first character beyond those whose
#: class in it is the same in every version of Unicode. Fixed values.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BELOW = "\u0250"


def ranked(path: str):
    """The same vocabulary for a library that encodes short chunks several times faster.

    Only for a byte-level vocabulary whose ids follow the order of its merges,
    so that ids are ranks; None for any other.
    """
    import tiktoken

    given = json.loads(Path(path).read_text(encoding="utf-8"))
    model = given["model"]
    kind = given.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space"):
        return None
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    byte = {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(rest)}
    special = {x["content"] for x in given.get("added_tokens", [])}
    ids = {x: i for x, i in model["vocab"].items() if x not in special}
    pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    order = [ids[a + b] for a, b in pairs]
    if order != sorted(order) or not all(c in byte for x in ids for c in x):
        return None
    ranks = {bytes(byte[c] for c in x): i for x, i in ids.items()}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Chunks(dict):
    """Chunk after a single space -> its ids as little-endian 16-bit numbers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(" " + chunk)
        if len(self) < KEPT_CHUNKS and len(chunk) <= 64:
            self[chunk] = ids
        return ids


class Encoder:
    """Ids of the given vocabulary file; its special strings in a text are ordinary text.

    A space between two other characters always begins a token of the
    vocabulary's split pattern, so a text may be encoded in chunks that begin
    there, and equal chunks have equal ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = ranked(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size()
        if self.size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.chunks = _Chunks(self._plain)

    def _plain(self, text: str) -> bytes:
        if self.ranked and (text.isascii() or max(text) < PLAIN_BELOW):
            found = self.ranked.encode_ordinary(text)
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        ids = array("H", found)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<u2")
        parts = text.split(" ") if "  " not in text else _SINGLE_SPACE.split(text)
        first = self._plain(parts[0]) if parts[0] else b""
        rest = map(self.chunks.__getitem__, parts[1:])
        return np.frombuffer(first + b"".join(rest), dtype="<u2")

    def text(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False) if ids else ""


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process; Rust threads of its own are not wanted there."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)
