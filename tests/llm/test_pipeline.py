import random

import corpus_pipeline
from samples import SYLLABLES, documents, prose
from test_lines import brute

from quaywise.llm import simhash
from quaywise.llm.tokens import encoder, vocabulary_path


def corpus():
    rng = random.Random(21)
    out = [(i, prose(rng, lang, rng.randint(80, 300)), lang, "s") for i, lang in enumerate(list(SYLLABLES) * 110)]
    passage = prose(rng, "en", 70)
    out += [(1000 + i, prose(rng, "en", 120) + "\n" + passage, "en", "s") for i in range(12)]
    out += [(2000 + i, out[0][1], out[0][2], "s") for i in range(20)]
    out += [(3000 + i, out[1][1] + f" tail{i}", out[1][2], "s") for i in range(20)]
    bad = [(4000, None, "en", "s"), (4001, "", "en", "s"), (4002, "123 " * 90, "en", "s"), (4003, "too short", "en", "s")]
    bad += [(4004, "again and again " * 80, "en", "s"), (4005, " ".join(f"{w}###$$$" for w in passage.split() * 3), "en", "s")]
    return out, bad


def test_stages(spark):
    good, bad = corpus()
    docs = documents(spark, good + bad)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "quality", "line_dedup", "near_dedup", "pack"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == documents(spark, []).columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert not {4000, 4001, 4002} & set(kept["language"]) and {i for i, *_ in good} <= set(kept["language"])
    assert set(kept["quality"]) == {i for i, *_ in good}
    assert kept["line_dedup"] == brute(list(kept["quality"].items()))
    fps = {i: simhash.fingerprint(t.encode()) for i, t in kept["line_dedup"].items()}
    # every document dropped is linked, over others, to a smaller one that stays
    groups = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if groups[i] < groups[j] and (fps[i] ^ fps[j]).bit_count() <= 3:
                    groups[j], changed = groups[i], True
    assert set(kept["near_dedup"]) == set(groups.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    encode = encoder(vocabulary_path())
    assert sum(r.length for r in pieces) == sum(len(encode.ids(t)) + 1 for t in kept["near_dedup"].values())


def test_run_reads_and_writes_each_stage(spark, tmp_path):
    good, bad = corpus()
    documents(spark, (good + bad)[::7]).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() > 0 and "sequence_id" in found.columns


def test_empty(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
