import os
import random

import pytest
from pyspark.sql import functions as F

from sievewright.llm import tokencount as C

pytestmark = pytest.mark.skipif(not os.path.exists(C.RANKS), reason="no vocabulary file")

SCHEMA = "doc_id bigint, text string, edits array<struct<pos:bigint,del:bigint,ins:string>>, n_tokens string"
BITS = ["word", " word", " ", "  ", "\n", "\n\n", "\t", "it's", "'ll", "123", " 45", "...", " !?", "é", "漢字", "\U0001f600", " ", "\x1c", "x" * 40]


def random_text(rng, n):
    return "".join(rng.choice(BITS) for _ in range(n))


def whole(text):
    return len(C.encoder().encode_ordinary(text))


@pytest.mark.parametrize("seed", range(12))
def test_trees_count_as_whole_texts(seed, monkeypatch):
    monkeypatch.setattr(C, "_MOST", 60)
    rng = random.Random(seed)
    text = random_text(rng, rng.choice([0, 1, 5, 60, 400]))
    monkeypatch.setattr(C.runs, "__defaults__", (rng.choice([1, 8, 30]),))
    tree = C.TokenTree.of(text, C.encoder())
    assert tree.count == whole(text) and tree.text() == text
    for _ in range(60):
        pos, delete = rng.randint(-2, len(text) + 2), rng.choice([0, 0, 1, 3, 20, len(text)] if rng.random() < 0.2 else [0, 1, 2, 5])
        insert = random_text(rng, rng.choice([0, 1, 3])) if rng.random() < 0.9 else random_text(rng, 80)
        tree.edit(pos, delete, insert)
        at = min(max(pos, 0), len(text))
        text = text[:at] + insert + text[at + delete :]
        assert tree.text() == text
        assert tree.count == whole(text) and tree.length == len(text)


def test_only_the_region_is_encoded():
    text = " ".join("word%d" % i for i in range(20_000))
    tree = C.TokenTree.of(text, C.encoder())
    tree.edit(70_000, 10, "edited")
    assert tree.encoded < 4 * C.RUN_CHARS
    assert tree.count == whole(text[:70_000] + "edited" + text[70_010:])


def test_rows_and_kept_trees(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        text = random_text(rng, 300)
        rows.append((i, text, [(rng.randint(0, 500), rng.randint(0, 9), rng.choice(BITS)) for _ in range(rng.randint(0, 4))], "x"))
    rows += [(60, None, [(0, 3, "from nothing")], "x"), (61, "", None, "x"), (None, "null id", [None, (3, None, None), (None, 1, "z")], "x"), (0, rows[0][1], [], "x"), (62, "w" * 9000, [(5, 1, " ")], "x")]
    df = spark.createDataFrame(rows, SCHEMA)

    def want(text, edits):
        text = text or ""
        for e in edits or []:
            if e and e[0] is not None:
                text = text[: min(e[0], len(text))] + (e[2] or "") + text[min(e[0], len(text)) + (e[1] or 0) :]
        return text

    expected = sorted((str(i), len(t or ""), whole(t or ""), len(want(t, e)), whole(want(t, e))) for i, t, e, _ in rows)
    got = C.count_edited(df, F.col("edits")).collect()
    assert sorted((str(r[0]), *r[1:5]) for r in got) == expected
    named = df.where("doc_id is not null").dropDuplicates(["doc_id"])
    kept = named.drop("n_tokens").join(C.trees(named), "doc_id")
    again = C.count_edited(kept, F.col("edits"), kept=("leaf_chars", "leaf_tokens")).collect()
    by_id = {str(r[0]): tuple(r[1:5]) for r in again}
    assert all(by_id[i] in {tuple(x[1:]) for x in expected if x[0] == i} for i in by_id) and len(by_id) == 63
    assert C.count_edited(df.limit(0), F.col("edits")).collect() == []


def test_the_query_against_whole_recounts(spark, tmp_path):
    rng = random.Random(3)
    texts = [random_text(rng, n) for n in (0, 1, 40, 900)] + [None, "one run " + "w" * 5000]
    spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] + [(0, texts[3], "x", "y"), (None, "a b", "x", "y")], "doc_id bigint, text string, leaf_chars string, edits string").write.parquet(f"{tmp_path}/documents.parquet")

    def edited(text):
        n = len(text)
        for pos, delete, insert in ((n // 3, 0, " a new passage, as an editor adds it "), (n // 2, 20, ""), (int(n * 2 / 3), 12, "changed")):
            at = min(pos, len(text))
            text = text[:at] + insert + text[at + delete :]
        return text

    rows = [(i, t or "") for i, t in enumerate(texts)] + [(0, texts[3]), (None, "a b")]
    want = [(str(i), len(t), whole(t), len(edited(t)), whole(edited(t))) for i, t in rows]
    got = [(str(r.doc_id), *r[1:5]) for r in C.op5_token_counts(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_query_edits_match_plain_slicing(spark):
    text = "The quick brown fox, as it's known, jumps over the lazy dog. " * 30
    df = spark.createDataFrame([(1, text, None, "x")], SCHEMA)
    row = C.count_edited(df, C.sample_edits(F.col("text"))).first()
    n = len(text)
    for pos, delete, insert in ((n // 3, 0, " a new passage, as an editor adds it "), (n // 2, 20, ""), (n * 2 // 3, 12, "changed")):
        text = text[:pos] + insert + text[pos + delete :]
    assert (row.edited_n_chars, row.edited_n_tokens) == (len(text), whole(text))
