import math
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import langid as L

SCHEMA = "doc_id bigint, text string, lang string, score string"
TEXTS = {
    "en": ["the quick brown fox jumps over the lazy dog", "what is that thing over there", "this is the way that they went with the others"],
    "de": ["der schnelle braune fuchs springt über den faulen hund", "was ist das ding da drüben", "das ist der weg den sie mit den anderen gingen"],
    "fr": ["le renard brun rapide saute par dessus le chien paresseux", "qu'est ce que cette chose là bas", "c'est le chemin qu'ils ont pris avec les autres"],
}


def rows():
    return [(i * 3 + k, t, lang) for k, (lang, texts) in enumerate(TEXTS.items()) for i, t in enumerate(texts)]


def frame(spark, data):
    return spark.createDataFrame([(*r, "x") for r in data], SCHEMA)


def grams(text):
    chars = []
    for c in text:
        x = c.lower()[0] if c.isalpha() else " "
        if not (x == " " and chars and chars[-1] == " "):
            chars.append(x)
    points = np.array([ord(c) for c in chars], np.uint32)
    for n in L.ORDERS:
        for i in range(len(points) - n + 1):
            yield int(L._buckets(points[i : i + n], n)[0])


def test_scores_are_naive_bayes(spark):
    df = frame(spark, rows())
    model = L.train(df)
    size = L.DIM * len(L.ORDERS)
    want = np.zeros((size, 3))
    for _, t, lang in rows():
        for g in grams(t):
            want[g, model.langs.index(lang)] += 1
    assert model.langs == ["de", "en", "fr"]
    for k in range(3):
        part = want[k * L.DIM : (k + 1) * L.DIM] + L.SMOOTHING
        np.testing.assert_allclose(model.logs[k * L.DIM : (k + 1) * L.DIM], np.log(part / part.sum(axis=0)), rtol=1e-5)
    for text in ["That  WAY, the other!", "x", "Über den Weg", "漢字 \U0001f600 é"]:
        raw = np.frombuffer(text.encode(), np.uint8)
        totals, letters = L.score_texts(model, raw, np.array([0, len(raw)]))
        np.testing.assert_allclose(totals[0], sum(model.logs[g].astype(float) for g in grams(text)), rtol=1e-5)
        assert letters[0] == sum(c.isalpha() for c in text)


def test_long_texts_are_scored_whole(spark, monkeypatch):
    model = L.train(frame(spark, rows()))
    raw = np.frombuffer(("the way " * 300 + "der weg ").encode(), np.uint8)
    whole, n = L.score_texts(model, raw, np.array([0, len(raw)]))
    monkeypatch.setattr(L, "_PIECE", 100)
    pieces, m = L.score_texts(model, raw, np.array([0, len(raw)]))
    assert n == m
    np.testing.assert_allclose(whole, pieces, rtol=1e-9)
    monkeypatch.setattr(L, "_ENTRIES", 50)
    np.testing.assert_allclose(whole, L.score_texts(model, raw, np.array([0, len(raw)]))[0], rtol=1e-9)


@pytest.mark.parametrize("block", [200, 2, 1])
def test_the_query_against_plain_naive_bayes(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK_LANGS", block)
    base = rows()
    data = [(i, t + extra, lang) for i, (_, t, lang) in enumerate([r for r in base for _ in range(4)]) for extra in [["", " x", " 1!", " THE"][i % 4]]]
    data += [(200, None, "en"), (201, "??", "de"), (202, "ding", None), (None, "the way", "fr"), (203, "e", "en"), (5, data[5][1], "en")]
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    learned = [(t, lang) for i, t, lang in data if i is not None and zlib.crc32(str(i).encode()) % 3 != 1 and t is not None and lang is not None]
    langs = sorted({x for _, x in learned})
    counts = {x: np.zeros(L.DIM * len(L.ORDERS)) for x in langs}
    for t, x in learned:
        for g in grams(t):
            counts[x][g] += 1
    logs = {x: np.concatenate([np.log((c[k * L.DIM : (k + 1) * L.DIM] + 0.5) / (c[k * L.DIM : (k + 1) * L.DIM] + 0.5).sum()) for k in range(3)]) for x, c in counts.items()}
    prior = {x: math.log(sum(y == x for _, y in learned) / len(learned)) for x in langs}
    got = sorted(map(tuple, L.op2_language_id(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t, _ in data:
        letters = sum(c.isalpha() for c in t or "")
        if not letters:
            want.append((i, i is not None and zlib.crc32(str(i).encode()) % 3 == 1, "und", 0.0))
            continue
        sums = {x: sum(logs[x][g] for g in grams(t)) for x in langs}
        best = max(langs, key=lambda x: sums[x] + prior[x])
        soft = {x: (sums[x] + prior[x]) * min(letters, L.SHARPNESS) / letters for x in langs}
        want.append((i, i is not None and zlib.crc32(str(i).encode()) % 3 == 1, best, 1 / sum(math.exp(s - soft[best]) for s in soft.values())))
    want.sort(key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    np.testing.assert_allclose([g[3] for g in got], [w[3] for w in want], atol=1e-4)


def test_columns_of_clashing_names(spark):
    data = frame(spark, rows()).selectExpr("*", "1 found_lang", "2 as FOUND_SCORE", "3 keep_0", "4 state_lang")
    kept = L.accept(data, L.train(data))
    assert kept.columns == data.columns and kept.count() == 9


def test_edge_cases(spark):
    data = [*rows(), (100, None, "en"), (101, "", None), (102, "12 !? \n", "de"), (103, "the way", None), (None, "the thing", "fr"), (103, "the way", None)]
    df = frame(spark, data)
    found = L.predict(df, L.train(df), ["doc_id", "lang"]).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(data) and all(0 <= r.score <= 1 for r in found)
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert by_id[103].lang_pred == by_id[None].lang_pred == "en"
    assert {r.doc_id for r in L.accept(df, L.train(df)).collect()} == {r[0] for r in data} - {100, 101, 102}
    assert L.predict(df.limit(0), L.train(df.limit(0)), ["doc_id"]).collect() == []
    none = L.train(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in L.predict(df, none, ["doc_id"]).collect()} == {"und"}


def test_fold(spark):
    got = spark.range(50).select("id", L.fold(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in got)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_held_out_accuracy(spark):
    found = L.op2_language_id(spark, "/root/testdata/sf0.01").where("held_out")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").where("lang is not null")
    right, n = found.join(docs, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.97 and not math.isnan(right)
