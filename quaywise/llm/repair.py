"""Repair of conversations as a lightest derivation.

A repaired conversation is empty or has an optional system turn and then
pairs of user and assistant. Its rows are read from left to right by a machine
of four states; what is derived are items

    [i, p -> q]   "the first i rows, edited, lead from state p to state q"

with hyperedges that keep, rerole or delete row i, insert a turn, or join the
item with one of a later part of the conversation. A value is (cost, audit),
the audit being the initials of the edits; every hyperedge adds costs and
appends audits, so no value is less than that of the item it continues and a
less value stays the less one. Knuth's algorithm therefore pops items from an
agenda in the order of their values and each is final when it is popped, until
the goal is.

Rows are sorted over all tasks, so one conversation may lie in many of them:
a task derives the items of its parts from every state, and parts of one
conversation are joined sixteen at a time by the same agenda. Texts are read
once more, with the edits in front of the rows they belong to.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.llm.common import map_batches, stored, table

SPACE = " \t\n\x0b\x0c\r"
#: Costs of edits; a truncated row that stays costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: State -> what may follow: begin, after system, after user, after assistant.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTED = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
#: Rows of a part that is derived at once, and parts that are joined at once.
PART = 1024
FAN = 16

FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: ``begun`` and ``ended``: the part is known to hold the first, the last row of its conversation.
PARTS = (
    "conv_id long, part long, no long, whole boolean, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, turns long, first_turn long, last_turn long, "
    "paths array<struct<p: int, q: int, cost: long, audit: string>>"
)
TURNS = "conv_id long, edit string, turn long, role string, text string"

Value = tuple[int, str]
Deductions = Callable[[int, int], Iterable[tuple[int, str, int, int]]]


def agenda(start: int, deductions: Deductions, goal: Callable[[int, int], bool] | None = None) -> dict:
    """Final values of all items that begin in a state, or of those up to the goal.

    ``deductions`` names what an item (position, state) leads to: weight, edits,
    position, state.
    """
    heap: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: dict[tuple[int, int], Value] = {}
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if (i, q) in final:
            continue
        final[i, q] = cost, audit
        if goal and goal(i, q):
            break
        for weight, edits, j, r in deductions(i, q):
            if (j, r) not in final:
                heapq.heappush(heap, (cost + weight, audit + edits, j, r))
    return final


def row_deductions(rows: list[tuple[str, str]]) -> Deductions:
    """Edits of rows, given as (role initial, fault initial)."""

    def deduce(i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
        for role, r in NEXT[q].items():
            if role in ROLES:
                yield INSERT, "I", i, r
        if i == len(rows):
            return
        initial, fault = rows[i]
        yield DELETE, "D", i + 1, q
        if fault in ("b", "d"):
            return
        more = TRUNCATED if fault == "t" else 0
        for role, r in NEXT[q].items():
            if role == initial:
                yield more, "K", i + 1, r
            elif role in ROLES:
                yield REROLE + more, "R", i + 1, r

    return deduce


def part_deductions(parts: list[list[dict]]) -> Deductions:
    """Joins with the items of the parts that follow."""
    paths = [{q: [x for x in part if x["p"] == q] for q in range(len(NEXT))} for part in parts]

    def deduce(i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
        if i < len(paths):
            for x in paths[i][q]:
                yield x["cost"], x["audit"], i + 1, x["q"]

    return deduce


def paths_between(n: int, deductions: Deductions, starts: Iterable[int]) -> list[dict]:
    """Items over all ``n`` positions, from each of the given states."""
    found = []
    for p in starts:
        final = agenda(p, deductions)
        found += [{"p": p, "q": q, "cost": c, "audit": a} for (i, q), (c, a) in final.items() if i == n]
    return found


def whole_path(rows: list[tuple[str, str]]) -> list[dict]:
    """The goal of a conversation whose rows are all here."""
    final = agenda(0, row_deductions(rows), lambda i, q: i == len(rows) and q in ACCEPTED)
    (_, q), (cost, audit) = list(final.items())[-1]
    return [{"p": 0, "q": q, "cost": cost, "audit": audit}]


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def summary(rows: list[tuple]) -> dict:
    """Figures of a part from its (initial, fault, turn)."""
    turns = [t for _, _, t in rows if t is not None]
    return {
        **{name: sum(f == name[0] for _, f, _ in rows) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(not legal(a[0], b[0]) for a, b in zip(rows, rows[1:], strict=False)),
        "first": rows[0][0], "last": rows[-1][0],
        "turns": len(set(turns)), "first_turn": min(turns, default=None), "last_turn": max(turns, default=None),
    }


def joined(parts: list[dict]) -> dict:
    """Parts that follow each other as one."""
    out = dict(parts[0])
    for b in parts[1:]:
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            out[name] += b[name]
        out["illegal"] += not legal(out["last"], b["first"])
        out["last"] = b["last"]
        if b["first_turn"] is not None:
            out["turns"] -= out["last_turn"] == b["first_turn"]
            out["first_turn"] = b["first_turn"] if out["first_turn"] is None else out["first_turn"]
            out["last_turn"] = b["last_turn"]
    if len(parts) > 1:
        deduce = part_deductions([x["paths"] for x in parts])
        out["paths"] = paths_between(len(parts), deduce, range(len(NEXT)))
    return out


def _order(turns: DataFrame) -> list[Column]:
    """The order of rows: turn (null first), role, text; long ones by their beginning and a hash."""
    return [F.col(c) for c in ("conv_id", "turn", "role_start", "text_start", "h1", "h2")]


def rows_of(turns: DataFrame) -> DataFrame:
    """Rows with what the order needs; a null role or text is one space."""
    given = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
    )
    return given.select(
        "*", F.left("role", F.lit(64)).alias("role_start"), F.left("text", F.lit(64)).alias("text_start"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("second"), "text", "role").alias("h2"),
    )


def marked(rows: DataFrame) -> DataFrame:
    """Rows without texts: initial, ``blank``, ``cut`` short, said ``before`` at an earlier turn.

    The first turn of every text is combined before it is shuffled, and only
    texts that occur again are joined back.
    """
    body = F.rtrim("text", F.lit(SPACE))
    facts = rows.select(
        "conv_id", "turn", "role_start", "text_start", "h1", "h2", F.left("role", F.lit(1)).alias("initial"),
        (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn"))
    again = (
        facts.where(~F.col("blank")).groupBy("conv_id", "h1", "h2")
        .agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("conv_id").alias("c"), F.col("h1").alias("a"), F.col("h2").alias("b"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))
    return facts.join(again, same, "left").select(
        *facts.columns, F.coalesce(F.col("first") < place, F.lit(False)).alias("before")
    )


def derived_parts(turns: DataFrame) -> DataFrame:
    """Parts of conversations with their figures and items, in the order of (``part``, ``no``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        key, no, opening, held, previous = None, 0, True, [], None
        ready: list[dict] = []

        def part(whole: bool) -> dict:
            rows = [(a, f) for a, f, _ in held]
            paths = whole_path(rows) if whole else paths_between(len(rows), row_deductions(rows), range(len(NEXT)))
            return {"conv_id": key, "part": task, "no": no, "whole": whole, **summary(held), "paths": paths}

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in _PASSED)
            for conv, turn, h1, h2, initial, blank, cut, before in zip(*columns, strict=True):
                if held and conv != key:
                    ready.append(part(whole=not opening and no == 0))
                    held, no, opening, previous = [], 0, False, None
                elif len(held) == PART:
                    ready.append(part(whole=False))
                    held, no = [], no + 1
                key = conv
                same = previous == (turn, h1, h2)
                previous = turn, h1, h2
                held.append((initial, "b" if blank else "d" if before or same else "t" if cut else "", turn))
            if ready:
                yield pa.RecordBatch.from_pylist(ready, _PARTS)
                ready = []
        if held:
            yield pa.RecordBatch.from_pylist([part(whole=False)], _PARTS)

    facts = marked(rows_of(turns))
    order = _order(facts)
    sorted_rows = facts.repartitionByRange(*order).sortWithinPartitions(*order)
    return map_batches(sorted_rows.select(*_PASSED), run, PARTS)


_PASSED = ("conv_id", "turn", "h1", "h2", "initial", "blank", "cut", "before")
_PARTS = pa.schema(
    {
        "conv_id": pa.int64(), "part": pa.int64(), "no": pa.int64(), "whole": pa.bool_(), "blank": pa.int64(),
        "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(), "first": pa.string(),
        "last": pa.string(), "turns": pa.int64(), "first_turn": pa.int64(), "last_turn": pa.int64(),
        "paths": pa.list_(pa.struct({"p": pa.int32(), "q": pa.int32(), "cost": pa.int64(), "audit": pa.string()})),
    }
)


def joined_parts(parts: DataFrame, by: str) -> DataFrame:
    """Up to sixteen parts that follow each other become one, in the order of ``by``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for _, group in groupby(rows, lambda x: (x["conv_id"], x["part"] // FAN if by == "part" else (x["part"], x["no"] // FAN))):
            one = joined(list(group))
            one[by] //= FAN
            yield pa.RecordBatch.from_pylist([one], _PARTS)

    keys = ["conv_id", "part", (F.col("no") / FAN).cast("long")] if by == "no" else ["conv_id", (F.col("part") / FAN).cast("long")]
    return parts.repartition(*keys).sortWithinPartitions("conv_id", "part", "no").mapInArrow(run, PARTS)


def figures(turns: DataFrame) -> DataFrame:
    """One row for each conversation: gaps, faults, illegal neighbours, cost and audit of its repair.

    Rows are taken by turn, null turns first, then by role and text. A null
    ``conv_id`` is a conversation of its own; repeated rows are duplicates; a
    role other than system, user or assistant can only be replaced or deleted.
    An empty table gives no rows; other columns are not read.
    """
    parts = stored(derived_parts(turns), "parts")
    last = parts.agg(F.max("no").alias("no"), F.max("part").alias("part")).first()
    open_parts = parts.where(~F.col("whole"))
    for by in ("no", "part"):
        most = last[by] or 0
        while most:
            open_parts = joined_parts(open_parts, by)
            most //= FAN
    goals = F.transform(
        F.filter("paths", lambda x: (x["p"] == 0) & x["q"].isin(*ACCEPTED)), lambda x: F.struct(x["cost"], x["audit"])
    )
    return (
        parts.where("whole").unionByName(open_parts)
        .withColumn("goal", F.array_min(goals))
        .select(
            "conv_id", F.coalesce(F.expr("last_turn - first_turn + 1 - turns"), F.lit(0)).alias("gaps"),
            "blank", "duplicate", "truncated", "illegal", F.col("goal.cost").alias("cost"),
            F.col("goal.audit").alias("audit"),
        )
    )


def edited(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """Conversations turn by turn: a row with the figures (``edit`` null), then its turns in order.

    ``edit`` is K, R, D or I; a deleted turn keeps its role and text. All rows of
    a conversation are in one partition, one after another, and stream through
    its task: only a place in the audit is held.
    """
    head = F.struct(*FIGURES, "audit")
    texts = rows_of(turns).withColumn("head", F.lit(None).cast(repairs.select(head).schema[0].dataType))
    heads = repairs.select(
        "conv_id", head.alias("head"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in texts.schema if f.name not in ("conv_id", "head"))
    )
    both = texts.unionByName(heads)
    order = [F.col("conv_id"), F.col("head").isNull(), *_order(texts)[1:]]
    one_by_one = both.repartition("conv_id").sortWithinPartitions(*order)
    schema = f"{TURNS}, {', '.join(f'{c} long' for c in FIGURES)}, audit string"
    return map_batches(one_by_one.select("conv_id", "turn", "role", "text", "head"), _edit, schema)


_EDITED = pa.schema(
    {
        "conv_id": pa.int64(), "edit": pa.string(), "turn": pa.int64(), "role": pa.string(), "text": pa.string(),
        **{c: pa.int64() for c in FIGURES}, "audit": pa.string(),
    }
)


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, audit, at, state = None, "", 0, 0
    out: list[dict] = []

    def turn(edit: str, number: int | None, role: str, text: str) -> None:
        nonlocal state
        if edit in ("I", "R"):
            role = ROLES["a" if state == 2 else "u"]
        if edit != "D":
            state = NEXT[state][role[0]]
        out.append({"conv_id": conv, "edit": edit, "turn": number, "role": role, "text": text})

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            turn("I", None, "", "")
            at += 1

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in batch.schema.names)
        for key, number, role, text, head in zip(*columns, strict=True):
            if head is not None:
                inserted()
                conv, audit, at, state = key, head["audit"], 0, 0
                out.append({"conv_id": key, **head})
                continue
            inserted()
            turn(audit[at], number, role, text)
            at += 1
        if out:
            yield pa.RecordBatch.from_pylist(out, _EDITED)
            out = []
    inserted()
    if out:
        yield pa.RecordBatch.from_pylist(out, _EDITED)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """All conversations repaired: ``conv_id``, place from 0, edit, turn (null for a new one), role and text.

    Deleted turns are left out; see :func:`figures` for what odd rows give.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            keep, places = [], []
            for i, edit in enumerate(batch.column("edit").to_pylist()):
                if edit is None:
                    place = 0
                elif edit != "D":
                    keep.append(i)
                    places.append(place)
                    place += 1
            kept = batch.take(pa.array(keep, pa.int64()))
            columns = [kept.column(c) for c in ("conv_id", "edit", "turn", "role", "text")]
            yield pa.RecordBatch.from_arrays(
                [columns[0], pa.array(places, pa.int64()), *columns[1:]],
                names=["conv_id", "place", "edit", "turn", "role", "text"],
            )

    return edited(turns, figures(turns)).mapInArrow(number, TURNS.replace("edit", "place long, edit"))


def digests(repaired: DataFrame) -> DataFrame:
    """Figures of each conversation and the digest of its repaired turns, from :func:`edited`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, some = None, hashlib.sha256(), False
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text", *FIGURES, "audit"))
            for conv, edit, role, text, *figures_ in zip(*columns, strict=True):
                if edit is None:
                    if now:
                        done.append((*now, sha.hexdigest()))
                    now, sha, some = (conv, *figures_), hashlib.sha256(), False
                elif edit != "D":
                    sha.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                    some = True
            if done:
                yield result(done)
        if now:
            yield result([(*now, sha.hexdigest())])

    names = ("conv_id", *FIGURES, "audit", "repaired_sha256")

    def result(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64()] * (len(FIGURES) + 1) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
        )

    return repaired.mapInArrow(
        run, f"conv_id long, {', '.join(f'{c} long' for c in FIGURES)}, audit string, repaired_sha256 string"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with one of five faults each, by a hash of conversation and turn; nulls are one space."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"])) % 20
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.when(kind == 4, "user").otherwise(text["role"]).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text["text"], "[.!?]", "")).otherwise(text["text"]).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def op11_repair_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, repairs and digests of all damaged ``conversations``."""
    given = table(spark, sf_dir, "conversations")
    turns = damaged(given)
    found = digests(edited(turns, figures(turns))).withColumnRenamed("conv_id", "found_id")
    all_ids = given.select(F.col("conv_id").cast("long")).distinct()
    joined_ids = all_ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    return joined_ids.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in FIGURES),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


#: Damage, faults, and the lightest edits row by row: each step keeps the least value of a state.
ORACLE = r"""
WITH RECURSIVE powers AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    [n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(place, ''), lambda c: ord(c)::BIGINT)),
      lambda a, c: xor(t[xor(a, c) % 256 + 1], a >> 8)), 4294967295) % 20 AS kind
  FROM given, powers),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
rows_ AS (
  SELECT conv_id, turn, role, text, k, left(role, 1) AS initial,
    CASE WHEN body = '' THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'd'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM numbered),
-- states: 0 begin, 1 after system, 2 after user, 3 after assistant
inserts(q, r, cost, audit) AS (
  VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
    (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')),
goes(q, initial, r) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
edits AS (
  SELECT conv_id, k, q, q AS r, 3 AS cost, 'D' AS audit FROM rows_, (VALUES (0), (1), (2), (3)) s(q)
  UNION ALL
  SELECT conv_id, k, q, r, CASE WHEN fault = 't' THEN 1 ELSE 0 END + CASE WHEN same THEN 0 ELSE 2 END,
    CASE WHEN same THEN 'K' ELSE 'R' END
  FROM (SELECT *, rows_.initial = goes.initial AS same, goes.initial AS wanted FROM rows_, goes WHERE fault IN ('', 't'))
  WHERE same OR wanted <> 's'),
ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, 0::BIGINT AS k, r AS q, cost::BIGINT AS cost, audit FROM ids, inserts WHERE inserts.q = 0
  UNION ALL
  SELECT conv_id, k, q, best.cost, best.audit FROM (
    SELECT w.conv_id, w.k + 1 AS k, i.r AS q,
      min({'cost': w.cost + e.cost + i.cost, 'audit': w.audit || e.audit || i.audit}) AS best
    FROM walk w JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.k = w.k + 1 AND e.q = w.q
    JOIN inserts i ON i.q = e.r GROUP BY ALL)),
figures AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (bad) AS illegal
  FROM (SELECT *, lag(initial) OVER w || initial NOT IN ('su', 'ua', 'au') AS bad
    FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY k)) GROUP BY conv_id),
best AS (
  SELECT ids.conv_id, f.* EXCLUDE (conv_id), min({'cost': w.cost, 'audit': w.audit}) AS goal
  FROM ids LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM ids.conv_id
  JOIN walk w ON w.conv_id IS NOT DISTINCT FROM ids.conv_id AND w.k = coalesce(n, 0) AND w.q IN (0, 3)
  GROUP BY ALL),
edited AS (
  SELECT conv_id, pos, audit[pos] AS edit, sum(CASE WHEN audit[pos] <> 'I' THEN 1 ELSE 0 END) OVER w AS k,
    sum(CASE WHEN audit[pos] <> 'D' THEN 1 ELSE 0 END) OVER w AS nth
  FROM (SELECT conv_id, goal.audit AS audit, unnest(range(1, length(goal.audit) + 1)) AS pos FROM best)
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
placed AS (
  SELECT e.*, role, text,
    max(CASE WHEN nth = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
  FROM edited e LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.k = e.k AND edit <> 'I'
  WHERE edit <> 'D'),
said AS (
  SELECT conv_id, string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (nth - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
    chr(10) ORDER BY pos) AS repaired FROM placed GROUP BY conv_id)
SELECT best.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, goal.cost AS cost, goal.audit AS audit,
  sha256(coalesce(repaired, '')) AS repaired_sha256
FROM best LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM best.conv_id
"""
