"""Small tables with the cases that every operator has to bear."""

import random

#: Names that operators use for columns of their own.
CLASHING = (
    "fp", "kept", "lang_pred", "score", "ks", "a", "k", "spread", "component", "row", "n", "grp", "list", "key",
    "found", "own", "given", "bad", "held", "row_hash", "text_hash", "__key", "__ks", "__bad",
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHING
)
SYLLABLES = {
    "en": "th he an in er on re nd at ing ou ea".split(),
    "de": "sch ein ich ung ä ü ß keit ver zu".split(),
    "fr": "é eau ou que è ê ment ç ai eux".split(),
}


def words(rng, lang, n):
    return ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(rng, lang="en", n=120, line=12):
    found = words(rng, lang, n)
    return ".\n".join(" ".join(found[k : k + line]).capitalize() for k in range(0, n, line)) + "."


def rows(seed=1, n=60):
    """Prose in three languages, copies, near copies, junk, empty, null and long texts."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = ("en", "en", "de", "fr")[i % 4]
        out.append((i, prose(rng, lang, rng.randint(60, 300)), lang, f"src{i % 3}"))
    base = out[4][1]
    out += [(100 + i, base, "en", "src0") for i in range(5)]
    out += [(200 + i, base.replace(" ", "  ", 1) + f" more{i}", "en", "src0") for i in range(3)]
    out += [
        (300, None, "en", "src1"), (301, "", "en", None), (302, " \t\n ", None, "src1"), (303, "one", None, None),
        (304, "!!! ??? 123", "en", "src2"), (None, base, "de", "src0"), (None, None, None, None),
        (305, "a b c a b c a b c " * 40, "en", "src0"), (306, prose(rng, "fr", 6000), "fr", "src1"),
        (307, "x" * 30000, "en", "src1"), (308, "\n".join(["same line of text here"] * 20), "en", "src2"),
        (309, "  two   spaces \n\n\n and a\ttab ", "en", "src2"), (4, base, "en", "src1"), (4, base, "en", "src1"),
    ]
    return out


def documents(spark, given=None):
    given = rows() if given is None else given
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), *["clash"] * len(CLASHING)) for i, t, lang, s in given], SCHEMA
    )
