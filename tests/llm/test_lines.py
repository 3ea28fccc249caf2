import duckdb
import pytest
from samples import documents, rows

from quaywise.llm import lines


def brute(given):
    """Places in order of id; a window's later places are removed line by line."""
    real = {}
    for i, t in given:
        found = [] if t is None else [(k, x.strip(lines.SPACE)) for k, x in enumerate(t.split("\n"))]
        real[i] = [(k, x) for k, x in found if x]
    seen, dead = set(), {i: set() for i, _ in given}
    for i in sorted(real):
        for k in range(len(real[i]) - 2):
            window = tuple(x for _, x in real[i][k : k + 3])
            if window in seen:
                dead[i] |= {p for p, _ in real[i][k : k + 3]}
            seen.add(window)
    return {
        i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in dead[i]) for i, t in given
    }


def unique_rows():
    out, ids = [], set()
    for i, t, lang, s in rows():
        if i is not None and i not in ids:
            ids.add(i)
            out.append((i, t, lang, s))
    passage = "\n".join(f"shared line {k} of the passage" for k in range(5))
    out += [(400 + k, f"own {k}\n{passage}\nmore {k}\n \n{passage.upper()}", "en", "s") for k in range(30)]
    out += [(500, "a\na\na\na\na", "en", "s"), (501, "a\n\na\n\n a \nb", "en", "s"), (502, "a\nb", "en", "s")]
    return out


def test_matches_brute_force(spark):
    given = unique_rows()
    found = {r.doc_id: r.text for r in lines.without_repeats(documents(spark, given)).collect()}
    assert found == brute([(i, t) for i, t, _, _ in given])


def test_sql_states_the_same(spark):
    given = unique_rows()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t, _, _ in given])
    assert dict(con.execute(lines.ORACLE).fetchall()) == brute([(i, t) for i, t, _, _ in given])


def test_repeated_rows_and_null_ids(spark):
    docs = documents(spark)
    found = lines.without_repeats(docs)
    assert found.columns == docs.columns
    got = found.collect()
    assert len(got) == len(rows())
    same = [r.text for r in got if r.doc_id == 4 and r.source == "src1"]
    assert len(same) == 3 and len(set(same)) == 1
    nameless = [r.text for r in got if r.doc_id is None]
    assert sorted(nameless, key=str) == ["", None]  # its lines all stand in documents with an id
    cut = next(r for r in got if r.doc_id == 100)
    assert cut.n_chars == len(cut.text)


def test_empty(spark):
    assert lines.without_repeats(documents(spark, [])).collect() == []


@pytest.mark.parametrize("text, places, out", [(None, [0], None), ("a\nb\nc", None, "a\nb\nc"), ("a\n\nb\nc\nd", [0], "\nd")])
def test_cut(text, places, out):
    assert lines.without(text, places) == out
