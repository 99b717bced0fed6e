"""The pipeline's stages on planted cases."""

import random

import corpus_pipeline as P
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCAB = {
    "en": "the of and to in is was that for it with as his on be at by had not are but from or have an they which one you were".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass".split(),
}


def corpus():
    rng = random.Random(8)
    item = " ".join("bench%d" % i for i in range(25))
    docs, kinds = [], {}

    def add(text, lang, source, kind):
        docs.append((len(docs), text, lang, source, len(text) if text is not None else 0))
        kinds.setdefault(kind, []).append(len(docs) - 1)

    def prose(lang, n=120):
        return " ".join(rng.choice(VOCAB[lang]) + ("" if rng.random() < 0.5 else "%x" % rng.getrandbits(16)) for _ in range(n))

    for i in range(240):
        lang = rng.choice(["en", "de"])
        text = prose(lang) + ("\nAll rights reserved by the site." if i % 4 == 0 else "")
        add(text, lang if i % 7 else None, rng.choice(["a", "b", None]), "clean")
    for i in range(20):
        text = docs[i][1]
        words = text.split(" ")
        words[40] = "changed%d" % i
        add(" ".join(words), docs[i][2], docs[i][3], "near")
        add(text, docs[i][2], "b", "copy")
    for _ in range(10):
        w = prose("en").split(" ")
        w[30:30] = item.split(" ")[:12]
        add(" ".join(w), "en", "a", "leak")
    for text in (None, "", "12 34 !!", "\n\n"):
        add(text, "en", "a", "no language")
    return docs, kinds, [(1, item), (2, None)]


def test_each_stage_does_its_work(spark, tmp_path):
    docs, kinds, items = corpus()
    clashing = ["bad", "host", "lines", "kept", "found_lang", "found_score", "rep", "fp", "id", "node", "state_lang", "keep_0"]
    spark.createDataFrame(docs, SCHEMA).withColumns({c: F.lit(c) for c in clashing}).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = now.columns
    for name, stage in P.STAGES:
        now = stage(spark, now, str(tmp_path))
        assert name == "mixing_sources" or now.columns == columns
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r for r in now.collect()}
    ids = {k: set(v) for k, v in kinds.items()}
    assert set(kept["language_id"]) == {d[0] for d in docs} - ids["no language"]
    assert set(kept["line_dedup"]) == set(kept["language_id"])
    assert not any("All rights" in r.text for r in kept["line_dedup"].values())
    assert all(r.n_chars == len(r.text) for r in kept["line_dedup"].values())
    assert set(kept["near_duplicates"]) == ids["clean"] | ids["leak"]
    assert set(kept["decontamination"]) == ids["clean"]
    mixed = kept["mixing_sources"]
    assert set(mixed) <= ids["clean"] and all(r.taken > 0 for r in mixed.values())
    total = sum(r["size"] * 1 for r in kept["mixing_sources"].values())
    assert total > 0 and abs(sum(r.taken for r in mixed.values()) - sum({r.source: r.target for r in mixed.values()}.values())) < 200
    assert sorted(map(str, P.run(spark, str(tmp_path)).collect())) == sorted(map(str, mixed.values()))


def test_an_empty_table_passes_through(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
