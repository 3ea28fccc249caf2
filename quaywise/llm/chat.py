"""Chat formatting at the level of tokens.

A turn is formatted as

    <|turn|> role <|text|> text <|end|>

where the three markers are reserved ids beyond the vocabulary, spliced between
ids that were encoded separately for the role and the text, so no text can
produce a marker. In the formatted string the markers are strings; control
strings that occur in a role or a text get a backslash after their first
character, and one more if they have some already, which can be undone.

The loss mask is the running sum of +1 where an assistant's text begins and -1
after its end marker, which is learned with the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.llm.common import slices, table
from quaywise.llm.tokens import encoder, vocabulary_path

MARKERS = ("<|turn|>", "<|text|>", "<|end|>")
#: Control strings of common templates, escaped in texts as the markers are. Fixed values.
CONTROL = (
    *MARKERS, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>",
    "<|im_end|>", "<|endoftext|>",
)
LEARNED_ROLE = "assistant"
SAMPLE_ID = -7
SAMPLE_TEXT = "</s>[INST] ok [/INST]"

_REST = "|".join(re.escape(x[1:]) for x in sorted(CONTROL, key=len, reverse=True))
ESCAPE = rf"([<\[])(\\*)({_REST})"
_ESCAPE = re.compile(ESCAPE)
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_REST})")

TURNS = "conv_id long, turn long, formatted string, ids array<int>, loss_mask array<byte>"


def escaped(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def assemble(role: np.ndarray, text: np.ndarray, size: int, learned: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a turn and its loss mask, from the ids of its two segments."""
    turn, begin, end = ([size + k] for k in range(3))
    ids = np.concatenate([turn, role, begin, text, end]).astype("i4")
    change = np.zeros(len(ids) + 1, "i4")
    if learned:
        change[len(role) + 2] += 1
        change[-1] -= 1
    return ids, np.cumsum(change)[:-1].astype("i1")


def format_turns(conversations: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row for each turn: formatted string, token ids and loss mask.

    A null role or text counts as empty; a null ``conv_id`` or ``turn`` stays
    null; repeated rows stay; an empty table gives no rows; other columns are
    not read. Turns are independent here, so no conversation is ever gathered.
    """
    path = vocabulary_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in slices(batches, "text"):
            formatted, all_ids, masks = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                said = escaped(role), escaped(text)
                formatted.append(f"{MARKERS[0]}{said[0]}{MARKERS[1]}{said[1]}{MARKERS[2]}")
                ids, mask = assemble(*map(encode.ids, said), encode.size, role == LEARNED_ROLE)
                all_ids.append(ids)
                masks.append(mask)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("turn"), pa.array(formatted, pa.string()),
                    pa.array(all_ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8())),
                ],
                names=["conv_id", "turn", "formatted", "ids", "loss_mask"],
            )

    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    ).mapInArrow(run, TURNS)


def read_turn(ids: list[int], mask: list[int], encode) -> tuple[str, str, str | None]:
    """Role, text and learned text (None if there is none) behind the ids of a turn."""
    begin = ids.index(encode.size + 1)
    role, text = (unescaped(encode.text(x)) for x in (ids[1:begin], ids[begin + 1 : -1]))
    learned = [i for i, m in zip(ids, mask, strict=True) if m and i < encode.size]
    return role, text, unescaped(encode.text(learned)) if any(mask) else None


def conversation_digests(turns: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Digests of every conversation, read back from the ids of ``format_turns``.

    Turns with equal numbers are taken in the order of their formatted strings;
    a null turn comes first. All rows without ``conv_id`` are one conversation.
    A conversation streams through one task turn by turn, however many it has;
    only its running digests are held.
    """
    path = vocabulary_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        now: list | None = None

        def result(*rows) -> pa.RecordBatch:
            conv, n, turns_sha, chars, loss_sha, length = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(conv, pa.int64()), pa.array(n, pa.int64()),
                    pa.array([x.hexdigest() for x in turns_sha]), pa.array(chars, pa.int64()),
                    pa.array([x.hexdigest() for x in loss_sha]), pa.array(length, pa.int64()),
                ],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "ids", "loss_mask", "formatted"))
            for conv, ids, mask, formatted in zip(*columns, strict=True):
                if now is None or now[0] != conv:
                    if now:
                        done.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, learned = read_turn(ids, mask, encode)
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                if learned is not None:
                    now[3] += len(learned)
                    now[4].update(learned.encode())
                now[5] += len(formatted)
            if done:
                yield result(*done)
        if now:
            yield result(now)

    return (
        turns.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "formatted")
        .mapInArrow(
            run,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long",
        )
    )


def op2_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations and of the one with control strings."""
    sample = spark.sql(
        f"""SELECT {SAMPLE_ID}L conv_id, id turn, element_at(array('user', '{LEARNED_ROLE}'), cast(id + 1 AS int)) role,
        '{SAMPLE_TEXT}' text FROM range(2)"""
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(format_turns(given.unionByName(sample)))


_SQL_ESCAPED = "regexp_replace({}, '" + ESCAPE.replace("'", "''") + r"', '\1\\\2\3', 'g')"
ORACLE = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT {SAMPLE_ID}, 0, 'user', '{SAMPLE_TEXT}'
  UNION ALL SELECT {SAMPLE_ID}, 1, '{LEARNED_ROLE}', '{SAMPLE_TEXT}'),
formatted AS (
  SELECT *, '{MARKERS[0]}' || {_SQL_ESCAPED.format('r')} || '{MARKERS[1]}' || {_SQL_ESCAPED.format('t')}
    || '{MARKERS[2]}' AS f FROM given),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, f) AS said,
    coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, f) FILTER (r = '{LEARNED_ROLE}'), '') AS learned,
    sum(length(f)) AS chars
  FROM formatted GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, chars::BIGINT AS formatted_chars FROM joined
"""
