"""Frequent grams: brute force at every size of the summary, bounds of the summary, texts of all kinds, and the plan."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewright.operators import frequent


def brute(texts, size=5):
    return Counter(t[i : i + size] for t in texts if t for i in range(len(t) - size + 1))


def top(texts, k, size=5):
    return [(i + 1, g, n) for i, (g, n) in enumerate(sorted(brute(texts, size).items(), key=lambda x: (-x[1], x[0].encode()))[:k])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abé日😀"), max_size=30), max_size=8), st.integers(1, 6), st.integers(1, 40))
def test_table_of_grams(texts, size, most):
    got = Counter()
    for grams, counts in frequent.gram_table(texts, size, most):
        got.update(dict(zip(grams, counts.tolist(), strict=True)))
    assert got == brute(texts, size)


def test_many_letters_do_not_overflow():
    text = "".join(chr(0x4E00 + i) for i in range(20_000)) * 2
    got = Counter()
    for grams, counts in frequent.gram_table([text], 7):
        got.update(dict(zip(grams, counts.tolist(), strict=True)))
    assert got == brute([text], 7)


@given(st.dictionaries(st.integers(), st.integers(1, 50), max_size=40), st.integers(1, 20))
def test_a_cut_summary_keeps_its_bounds(summary, counters):
    cut, off = frequent.reduced(summary, counters)
    assert len(cut) <= counters
    assert all(cut.get(g, 0) <= n <= cut.get(g, 0) + off for g, n in summary.items())
    # what is taken off is taken off more than ``counters`` grams
    assert off * (counters + 1) <= sum(summary.values())


TEXTS = [None, "", "abcd", "the cat and the dog and the end 😀😀😀😀😀😀", "aaaaaaaaaaaa", *(f"{i * 7919 % 1000:03d} the cat" for i in range(300)), *["the cat and the dog"] * 40]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(t, i, 0) for i, t in enumerate(TEXTS)], "text string, n bigint, gram int").repartition(5).persist()


# of 200 counters the bounds tell the candidates apart, of 20 they can't
@pytest.mark.parametrize("counters", [20, 200, 1 << 16])
def test_equal_to_brute_force(rows, counters):
    got = sorted(tuple(r) for r in frequent.top_grams(rows, "text", 12, counters=counters).collect())
    assert got == top(TEXTS, 12)


def test_bounds_leave_few_candidates(rows):
    assert frequent.candidates(frequent.summaries(rows, "text", 5, 20), 12) is None
    found = frequent.candidates(frequent.summaries(rows, "text", 5, 200), 12)
    assert found is not None
    wanted = {r.gram for r in found.collect()}
    assert {g for _, g, _ in top(TEXTS, 12)} <= wanted and len(wanted) < len(brute(TEXTS)) / 4


def test_beyond_the_broadcast(rows, monkeypatch):
    monkeypatch.setattr(frequent, "FEW", 1)
    assert sorted(tuple(r) for r in frequent.top_grams(rows, "text", 12).collect()) == top(TEXTS, 12)


def test_fewer_grams_than_asked_for(spark, rows):
    few = rows.where("text = 'aaaaaaaaaaaa'")
    assert [tuple(r) for r in frequent.top_grams(few, "text", 5).collect()] == [(1, "aaaaa", 8)]
    assert frequent.top_grams(rows.limit(0), "text", 5).count() == 0
    assert frequent.top_grams(rows.where("text is null or length(text) < 5"), "text", 5).count() == 0


def test_only_candidates_are_shuffled(rows):
    found = frequent.top_grams(rows, "text", 12)
    found.collect()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # the semi join lies below the aggregate
    assert plan.index("Aggregate [gram") < plan.index("LeftSemi") and "broadcast" in plan
