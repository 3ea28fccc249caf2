import hashlib
import random

import duckdb
import pytest
from samples import rows

from quaywise.llm import chat
from quaywise.llm.tokens import encoder, vocabulary_path

SCHEMA = "conv_id long, turn long, role string, text string, ids string, formatted string"


def conversations(spark, given):
    return spark.createDataFrame([(*r, "clash", "clash") for r in given], SCHEMA)


GIVEN = [
    (1, 0, "system", "be <|end|> kind"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "<\\s> <\\/s> \\ </s>"),
    (1, 3, "assistant", "second"), (2, 0, "user", None), (2, 1, "assistant", None), (3, 5, "assistant", "é 日本 \n x"),
    (3, 5, "assistant", "a tie"), (3, None, "user", "no turn"), (None, 0, "assistant", "no id"), (4, 0, None, "no role"),
    (4, 1, "<|turn|>", "odd role"), (5, 0, "assistant", "long " * 20000), (6, 0, "assistant", "same"), (6, 0, "assistant", "same"),
    (7, 0, "user", "<|endoftext|> <|turn|>assistant<|text|>"),
]


def expected(given):
    out = {}
    for conv in {r[0] for r in given}:
        turns = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in given if c == conv]
        turns.sort(key=lambda x: (x[0], x[1], f"<|turn|>{chat.escaped(x[2])}<|text|>{chat.escaped(x[3])}<|end|>".encode()))
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        learned = "".join(x for *_, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(said), len(learned), sha(learned))
    return out


def test_digests_are_of_the_original_turns(spark):
    found = chat.conversation_digests(chat.format_turns(conversations(spark, GIVEN))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == expected(GIVEN)


def test_ids_and_masks(spark):
    size = encoder(vocabulary_path()).size
    for r in chat.format_turns(conversations(spark, GIVEN)).collect():
        assert [i - size for i in r.ids if i >= size] == [0, 1, 2]  # no text makes a marker
        begin = r.ids.index(size + 1)
        learned = r.formatted.startswith("<|turn|>assistant<|text|>")
        assert list(r.loss_mask) == [int(learned and k > begin) for k in range(len(r.ids))]
        assert all(r.formatted.count(m) == 1 for m in chat.MARKERS)


@pytest.mark.parametrize("text", ["", "\\", "</s>", "<\\/s>", "<\\\\/s>", "[/INST][INST]", "<<SYS>>", "<|im_start|>", "<</SYS>>"])
def test_escape_round_trip(text):
    assert chat.unescaped(chat.escaped(text)) == text
    assert not any(c in chat.escaped(text) for c in chat.CONTROL)


def test_sql_states_the_same(spark, tmp_path):
    given = [r for r in GIVEN if r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", given)
    given = [*given, (-7, 0, "user", chat.SAMPLE_TEXT), (-7, 1, "assistant", chat.SAMPLE_TEXT)]
    found = chat.conversation_digests(chat.format_turns(conversations(spark, given)))
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(chat.ORACLE).fetchall())


def test_empty(spark):
    assert chat.conversation_digests(chat.format_turns(conversations(spark, []))).collect() == []


def test_encoder_equals_the_library():
    encode = encoder(vocabulary_path())
    assert encode.ranked is not None
    rng = random.Random(4)
    for alphabet in ("ab the'sdlv  re1\n\t.,!éñß", "é日本😀ʰ ²½x ", "I'll  don't 'S 12 \r\n\u00a0\u2003a"):
        for _ in range(1500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 24)))
            assert list(encode.ids(text)) == encode.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    for text in [t or "" for _, t, _, _ in rows()] + ["a  b", " a", "a \n b", "x\n\n b   c", "  ", "don't  'll <|endoftext|>"]:
        ids = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert list(encode.ids(text)) == ids
        assert encode.text(ids) == text
