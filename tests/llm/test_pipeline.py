"""The pipeline on a small folder of tables."""

import random

import corpus_pipeline
from encore.llm import decontamination, language, ngram_join
from encore.llm.shared import table

WORDS = {"en": "the of and to house water thing with which that".split(),
         "de": "der die und zu haus wasser ding mit welche dass".split()}


def test_stages_in_order(spark, folder):
    rng = random.Random(6)
    item = " ".join(f"i{k}" for k in range(30))
    rows = []
    for i in range(120):
        lang = rng.choice(list(WORDS))
        text = " ".join(rng.choice(WORDS[lang]) + str(rng.randrange(3)) * (rng.random() < 0.3)
                        for _ in range(rng.randint(40, 90)))
        rows.append((i, text, lang, f"s{i % 3}"))
    rows += [(200 + i, rows[i][1], rows[i][2], "copies") for i in range(10)]
    rows += [(300, rows[40][1] + " extra", "en", "copies"), (301, item, "en", "s0"),
             (302, "1234 5678", "en", "s0"), (303, None, None, None)]
    rows = [(*r, len(r[1] or "")) for r in rows]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    docs = table(spark, folder, "documents")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        seen.append((name, docs))
    assert [n for n, _ in seen] == ["language_id", "ngram_jaccard_join", "decontamination",
                                    "source_mix", "sharding"]
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for _, d in seen]
    assert ids[0].isdisjoint({302, 303})
    assert ids[1].isdisjoint({*range(200, 210), 300}) and ids[1] <= ids[0]
    assert ids[2] == ids[1] - {301}
    for _, d in seen[:-1]:
        assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.shard for r in seen[-1][1].collect()} <= set(range(16))
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, seen[-1][1].collect()))
    for f in (language.keep_identified, ngram_join.one_per_component):
        assert f(docs_empty := table(spark, folder, "documents").limit(0)).count() == 0
    assert decontamination.drop_contaminated(docs_empty, table(spark, folder, "benchmark")).count() == 0
