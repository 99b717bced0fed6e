"""Phrases against counts of all n-grams, and the query against its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from sievewright.llm import phrases

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def expected(docs: list, least: int, most: int) -> set:
    counts: dict = defaultdict(Counter)
    for lang, text in docs:
        lowered = "".join(c.lower() if c < "\x80" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = tuple(re.findall("[^ \t]+", piece))
            for m in range(1, 6):
                counts[lang or "und"].update(words[i : i + m] for i in range(len(words) - m + 1))
    out = set()
    for lang, f in counts.items():
        n = sum(c for w, c in f.items() if len(w) == 1)
        found = {w: c for w, c in f.items() if len(w) > 1 and c >= least}
        rows = []
        for w, a in found.items():
            if any(len(x) > len(w) and 100 * c >= 100 * a and any(x[i : i + len(w)] == w for i in range(len(x))) for x, c in found.items()):
                continue
            score, k = min((1000 * a * n // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w)))
            rows.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        out |= {(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:most])}
    return out


def texts(n: int, seed: int) -> list:
    rng = random.Random(seed)
    words = ["a", "A", "of", "the", "été", "Été", "x-y", "\x00", "日本", "b'c", "'"] + [f"w{i}" for i in range(12)]
    weights = [1 / (1 + i) for i in range(len(words))]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", "\x85", "\x1c"]
    return [(rng.choice(["en", "en", "en", "de", None, "und"]), "".join(rng.choices(words, weights)[0] + rng.choice(joins) for _ in range(rng.randint(0, 80)))) for _ in range(n)]


def rows(found) -> list:
    return [tuple(r) for r in found.select(*COLUMNS).collect()]


@pytest.mark.parametrize("hot", [100_000, 3])
def test_all_phrases(spark, hot, monkeypatch):
    """Pivots that are dealt over several partitions give the same counts."""
    monkeypatch.setattr(phrases.phrase_counts, "__defaults__", (phrases.LEAST, phrases.LONGEST, hot, "lang", "text"))
    docs = texts(120, 1) + [("en", None), ("en", ""), (None, "the of " * 3000), ("en", " . , ")] + texts(10, 2) * 2
    table = spark.createDataFrame([(a, b, 1, "p") for a, b in docs], "lang string, text string, a int, phrase string").repartition(5)
    found = rows(phrases.collocations(table, least=6, most=40))
    want = expected(docs, 6, 40)
    assert len(found) == len(want) and set(found) == want


def test_slices_don_t_matter(spark, monkeypatch):
    docs = texts(60, 4)
    table = spark.createDataFrame(docs, "lang string, text string").coalesce(1)
    words = phrases.word_counts(table)
    counts = {tuple(r) for r in phrases.phrase_counts(table, words, least=5).collect()}
    assert counts and counts == {tuple(r) for r in phrases.phrase_counts(table.repartition(13), words, least=5).collect()}


def test_buckets_that_all_words_share(spark, monkeypatch):
    """Tables of buckets that tell nothing apart make more fragments and the same phrases."""
    monkeypatch.setattr(phrases, "_totals", lambda words: __import__("numpy").full(phrases.WORD_BUCKETS, 9))
    monkeypatch.setattr(phrases, "_frequent_pairs", lambda *a: __import__("numpy").full(phrases.PAIR_BITS // 64, -1))
    docs = texts(60, 7)
    assert set(rows(phrases.collocations(spark.createDataFrame(docs, "lang string, text string"), least=6, most=30))) == expected(docs, 6, 30)


def test_empty(spark):
    table = spark.createDataFrame([], "lang string, text string")
    assert rows(phrases.collocations(table)) == []


def test_exact_beyond_64_bits(spark):
    a, n = 10**12, 10**16
    row = spark.createDataFrame([(a, n, 10**12 + 1, 10**12 + 7)], "a bigint, n bigint, l bigint, r bigint")
    assert row.selectExpr(phrases._SCORE).first()[0] == 1000 * a * n // ((10**12 + 1) * (10**12 + 7))


def test_query_and_its_sql(spark, tmp_path):
    docs = [("en" if i % 3 else None, t) for i, (_, t) in enumerate(texts(2500, 8))]
    spark.createDataFrame(docs, "lang string, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(phrases.ORACLE).fetchall()
    found = rows(phrases.op11_phrase_mining(spark, str(tmp_path)))
    assert len(found) > 15 and sorted(found) == sorted(want) and set(found) == expected(docs, 100, 2000)
