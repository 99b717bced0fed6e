"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from sievewright.llm import spelling


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts: dict[str, int], ratio: int = 10) -> set:
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        if xs:
            best = min(xs, key=lambda x: (-counts[x], x))
            if counts[best] >= ratio * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def rows(found) -> list:
    return [tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def vocabulary(n: int, seed: int, letters: str = "abcdeé") -> dict[str, int]:
    rng, words = random.Random(seed), {}
    while len(words) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))
        words[word] = rng.choice([1, 2, 3, 10, 30, 31, 400, 5000])
        if word:
            at = rng.randrange(len(word))
            words.setdefault(word[:at] + word[at + 1 :], rng.choice([1, 300]))
            words.setdefault(word[:at] + rng.choice(letters) + word[at + 1 :], 1)
    return words


@pytest.mark.parametrize("split", [4096, 7])
def test_all_pairs(spark, split, monkeypatch):
    """With blocks of few words each group is cut, and no pair is lost or taken twice."""
    monkeypatch.setattr(spelling.near_words, "__defaults__", (split,))
    words = vocabulary(500, 3)
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    found = rows(spelling.roots(spelling.forms(table)))
    assert len(found) == len(words) and set(found) == expected(words)


def test_any_alphabet(spark):
    words = {"привет": 50, "превет": 2, "приветы": 5, "日本語": 1, "日本": 10, "😀😀": 1, "😀": 10, "a" * 5000: 20, "a" * 4999 + "b": 2, "a" * 5001: 1}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert set(rows(spelling.roots(spelling.forms(table)))) == expected(words)


def test_chain_of_forms_and_ties(spark):
    words = {"aaaaaaaa": 1, "aaaaaaab": 10, "aaaaaabb": 100, "aaaaabbb": 1000, "aaaabbbb": 10000, "zzzzzzz": 1, "zzzzzzy": 10, "zzzzzzx": 10}
    found = {r[0]: r for r in rows(spelling.roots(spelling.forms(spark.createDataFrame(list(words.items()), "word string, n bigint"))))}
    assert found["aaaaaaaa"][1:3] == ("aaaaaaab", "aaaabbbb")
    assert found["zzzzzzz"][1] == "zzzzzzx"
    assert set(found.values()) == expected(words)


def test_nulls_repeats_and_clashing_columns(spark):
    table = spark.createDataFrame([("abc", 1, 9, "x"), ("abc", 2, 9, "x"), (None, 5, 9, "x"), ("abd", 30, 9, "x")], "word string, n bigint, near_n int, key string")
    assert set(rows(spelling.roots(spelling.forms(table)))) == expected({"abc": 3, "abd": 30})
    assert rows(spelling.roots(spelling.forms(table.limit(0)))) == []


def counted(docs: list) -> dict[str, int]:
    total: Counter = Counter()
    for number, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if number is None else number}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 7}


def test_counts_of_texts(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcÄéÿ×÷ZQ") for _ in range(rng.randint(5, 10))) for _ in range(60)]
    docs = [(i, rng.choice([" ", "-", "Ā", "1"]).join(rng.choice(words) for _ in range(80))) for i in range(80)]
    docs += [(80, None), (81, ""), (None, "Anything Anything nothing"), (82, "ÉCOLIERS écoliers " * 20_000), (3, docs[3][1])]
    table = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id bigint, text string, n int, word string")
    assert {r.word: r.n for r in spelling.misspelt_counts(table).collect()} == counted(docs)
    assert spelling.misspelt_counts(table.limit(0)).collect() == []


def test_query(spark, tmp_path):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(7, 8))) for _ in range(50)]
    docs = [(i, " ".join(rng.choices(words, [1.0 / (1 + k) ** 2 for k in range(50)], k=300))) for i in range(40)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = expected({w: n for w, n in counted(docs).items() if n >= 2})
    found = rows(spelling.op13_spelling_variants(spark, str(tmp_path)))
    assert set(found) == want and len(found) == len(want)
    assert any(r[1] for r in want)
