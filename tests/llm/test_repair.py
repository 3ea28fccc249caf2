import hashlib
import itertools
import random
import zlib

import duckdb
import pytest

from quaywise.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, edit string, audit string, part string, no string, head string"
SPACE = " \t\n\x0b\x0c\r"


def conversations(spark, given):
    return spark.createDataFrame([(*r, *["clash"] * 5) for r in given], SCHEMA)


def lightest(rows):
    """Least (cost, audit) of rows (initial, fault) by all edits of every row, in layers."""
    closure = {q: {q: (0, "")} for q in range(4)}
    for q in range(4):  # turns inserted one after another
        state, n = q, 0
        for _ in range(4):
            step = {0: 2, 1: 2, 2: 3, 3: 2}[state]
            state, n = step, n + 1
            closure[q].setdefault(state, (2 * n, "I" * n))
    now = {0: (0, "")}

    def spread(layer):
        out = {}
        for q, (c, a) in layer.items():
            for r, (d, b) in closure[q].items():
                out.setdefault(r, []).append((c + d, a + b))
        return {r: min(x) for r, x in out.items()}

    now = spread(now)
    for initial, fault in rows:
        after = {}
        for q, (c, a) in now.items():
            after.setdefault(q, []).append((c + 3, a + "D"))
            if fault in ("b", "d"):
                continue
            for x, r in (("s", 1), ("u", 2)) if q == 0 else (("u", 2),) if q in (1, 3) else (("a", 3),):
                more = fault == "t"
                if x == initial:
                    after.setdefault(r, []).append((c + more, a + "K"))
                elif x != "s":
                    after.setdefault(r, []).append((c + more + 2, a + "R"))
        now = spread({r: min(x) for r, x in after.items()})
    return min(now[q] for q in (0, 3) if q in now)


def expected(given):
    """Figures of conversations with rows, by plain loops."""
    out = {}
    for conv in {r[0] for r in given}:
        rows = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in given if c == conv]
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            body = text.strip(SPACE)
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append((role[:1], fault))
        cost, audit = lightest(faults)
        turns = [t for t, *_ in rows if t is not None]
        said, state, at = [], 0, 0
        for e in audit:
            role, text = (None, "") if e == "I" else rows[at][1:]
            at += e != "I"
            if e == "D":
                continue
            if e in "IR":
                role = "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            said.append(f"{role}:{text}")
        assert state in (0, 3)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(sum(f == x for _, f in faults) for x in "bdt"),
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(faults)),
            cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest(),
        )
    return out


def digests(spark, given):
    turns = conversations(spark, given)
    found = repair.digests(repair.edited(turns, repair.figures(turns))).collect()
    return {r[0]: tuple(r[1:]) for r in found}


def chats(seed, n=80, longest=14):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system"] + ["user", "assistant"] * 4 + ["tool", "", None, "u", "assistants"])
            text = rng.choice(["Yes.", "No!", "why", "", " \t", "a long text?", None, "é", ". ", "x.y", "same."])
            out.append((conv, rng.choice([turn, turn, turn, None, turn // 2]), role, text))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    given = chats(seed) + [(None, 0, "user", "no id."), (None, 1, "user", "no id.")]
    assert digests(spark, given) == expected(given)


def test_agenda_on_all_short_conversations():
    """Every sequence of three rows, against trying all audits."""
    kinds = [(i, f) for i in "suax" for f in ("", "b", "t")]
    for rows in itertools.product(kinds, repeat=3):
        path = repair.whole_path(list(rows))[0]
        assert (path["cost"], path["audit"]) == lightest(rows)


@pytest.mark.parametrize("part", [1, 3, 64])
def test_parts_do_not_matter(part):
    """Any cut of a conversation into parts, joined in any grouping, gives one result."""
    rng = random.Random(part)
    for _ in range(40):
        rows = [(rng.choice("suaux"), rng.choice(["", "", "", "t", "d"]), rng.choice([None, k])) for k in range(rng.randint(1, 70))]
        rows.sort(key=lambda x: (x[2] is not None, x[2] or 0))
        parts = []
        for k in range(0, len(rows), part):
            held = rows[k : k + part]
            edges = repair.row_deductions([(a, f) for a, f, _ in held])
            parts.append({**repair.summary(held), "paths": repair.paths_between(len(held), edges, range(4))})
        while len(parts) > 1:
            width = rng.choice([2, 3, 16])
            parts = [repair.joined(parts[k : k + width]) for k in range(0, len(parts), width)]
        best = min((x["cost"], x["audit"]) for x in parts[0]["paths"] if x["p"] == 0 and x["q"] in (0, 3))
        assert best == lightest([(a, f) for a, f, _ in rows])
        whole = repair.summary(rows)
        assert {k: parts[0][k] for k in whole} == whole


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    given = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {t % 900}." if t % 7 else f"cut {t}") for c, n in ((1, 9000), (2, 5), (3, 5000)) for t in range(n)]
    given += [(1, None, "system", "Be kind."), (2, None, "user", None)]
    turns = conversations(spark, given).repartition(13)
    with_many = repair.derived_parts(turns)
    assert with_many.where("conv_id = 1").count() > 8
    assert digests(spark, given) == expected(given)


def test_turns(spark):
    given = [
        (1, 0, "user", "Hi."), (1, 1, "user", "And?"), (1, 2, "assistant", "Yes."), (1, 3, "assistant", "Yes."),
        (2, 0, "assistant", ""), (3, 1, "tool", "Log."), (3, 2, "assistant", "Ok."), (4, 0, "system", "Be kind."),
        (4, 1, "assistant", "I am"),
    ]
    found = sorted(map(tuple, repair.repaired_turns(conversations(spark, given)).collect()), key=lambda x: x[:2])
    assert found == [
        (1, 0, "K", 0, "user", "Hi."), (1, 1, "I", None, "assistant", ""), (1, 2, "K", 1, "user", "And?"),
        (1, 3, "K", 2, "assistant", "Yes."), (3, 0, "R", 1, "user", "Log."), (3, 1, "K", 2, "assistant", "Ok."),
        (4, 0, "K", 0, "system", "Be kind."), (4, 1, "I", None, "user", ""), (4, 2, "K", 1, "assistant", "I am"),
    ]


def test_query(spark, tmp_path):
    """Damage, and conversations of which nothing is left."""
    given = [r for r in chats(5, n=200, longest=4)] + [(None, None, None, None), (None, 3, "user", "x.")]
    conversations(spark, given).write.parquet(f"{tmp_path}/conversations.parquet")
    damaged = []
    for conv, turn, role, text in given:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        damaged += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    wanted = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in given} | expected(damaged)
    found = repair.op11_repair_agenda(spark, str(tmp_path)).collect()
    assert len(found) == len(wanted)
    assert {r[0]: tuple(r[1:]) for r in found} == wanted
    assert any(len(v[6]) == 0 for v in wanted.values())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert {r[0]: r[1:] for r in con.execute(repair.ORACLE).fetchall()} == wanted


def test_empty(spark):
    assert digests(spark, []) == {}
