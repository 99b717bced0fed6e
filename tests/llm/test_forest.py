"""The forest's recall against brute force, and what takes no part."""

import numpy as np
import pytest

from sievewright.llm import forest

SCHEMA = "vec_id bigint, embedding array<float>, score string, rank int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(None if i is None else int(i), None if v is None else [None if x is None else float(x) for x in v], "s", 7) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def nearest(vectors: np.ndarray, ids: np.ndarray, at: int, k: int = 5) -> list:
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    scores = unit @ unit[at]
    mine = np.flatnonzero(ids != ids[at])
    return ids[mine[np.lexsort((ids[mine], -scores[mine].round(12)))][:k]].tolist()


def found_of(spark, vectors, every=10, **given) -> dict:
    rows = table(spark, vectors)
    found = forest.search(forest.build_index(rows.repartition(3)), rows.where(f"vec_id % {every} = 0"), **given).collect()
    out: dict = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r)
    return out


@pytest.mark.parametrize("spread", [0.2, 1.0, 50.0])
def test_recall(spark, spread):
    """Near copies, clusters and noise without structure: at least 0.95 of the neighbours are found."""
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((40, 32))[rng.integers(0, 40, 1500)] + spread * rng.standard_normal((1500, 32))).astype(np.float32)
    found, ids = found_of(spark, vectors), np.arange(1500)
    assert len(found) == 150
    hits = sum(len({r.vec_id for r in rows} & set(nearest(vectors, ids, q))) for q, rows in found.items())
    assert hits / (5 * len(found)) >= 0.95
    for q, rows in found.items():
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
        exact = [vectors[q].astype(float) @ vectors[r.vec_id].astype(float) / np.linalg.norm(vectors[q].astype(float)) / np.linalg.norm(vectors[r.vec_id].astype(float)) for r in rows]
        assert np.allclose([r.score for r in rows], exact, atol=1e-12) and sorted(exact, reverse=True) == pytest.approx(exact)


def test_structure_saves_work(spark):
    """Where neighbours are far nearer than others, a query looks at a small share of the rows."""
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((50, 32))[rng.integers(0, 50, 4000)] + 0.05 * rng.standard_normal((4000, 32))
    planes = forest._planes(32, forest.TREES, 42)
    codes = forest._codes(forest._unit(vectors), planes, forest.TREES)
    places = np.argsort(codes, axis=1, kind="stable")
    block = forest.Block(32, np.arange(4000), vectors.ravel(), np.take_along_axis(codes, places, 1).view(np.int32).ravel(), places.ravel())
    looked = []
    score = block._score
    block._score = lambda marks, *rest: (looked.append(marks.sum()), score(marks, *rest))[1]
    best = np.full((20, 5), -np.inf), np.full((20, 5), np.iinfo(np.int64).max)
    block.search(np.arange(20), vectors[:20], np.linalg.norm(vectors[:20], axis=1), codes[:, :20], best, forest.MISS)
    assert sum(looked) < 20 * 4000 * 0.25


def test_copies_and_ties(spark):
    """A third of all rows are one vector: its smallest ids come first."""
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((600, 16)).astype(np.float32)
    vectors[::3] = vectors[0]
    found = found_of(spark, vectors, every=30)
    assert [r.vec_id for r in found[30]] == [0, 3, 6, 9, 12]
    assert [r.vec_id for r in found[0]] == [3, 6, 9, 12, 15]


def test_packs_and_few_rows(spark):
    vectors = np.random.default_rng(4).standard_normal((40, 8)).astype(np.float32)
    whole, packed = found_of(spark, vectors), found_of(spark, vectors, pack=1)
    assert whole == packed
    few = found_of(spark, vectors[:3])
    assert [len(few[0]), {r.vec_id for r in few[0]}] == [2, {1, 2}]


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [1, 1], None, [], [0, 0], [nan, 1], [inf, 1], [None, 1], [1, 0, 0], [0, 1], [3, 0]]
    rows = table(spark, vectors, [0, 1, 2, 3, 4, 5, 6, 7, 8, None, 0])
    found = forest.search(forest.build_index(rows), rows).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in found) == [(0, 1, 1, 0.707107), (1, 1, 0, 0.707107), (1, 2, 0, 0.707107)]
    empty = rows.limit(0)
    assert forest.search(forest.build_index(empty), rows).collect() == []
    assert forest.search(forest.build_index(rows), empty).collect() == []


def test_large_values(spark):
    vectors = np.array([[1e30, 1e30], [1e-30, 1e-30], [1e30, -1e30], [1.0, 0.5]], np.float32)
    found = found_of(spark, vectors, every=4)
    assert [r.vec_id for r in found[0]] == [1, 3, 2]


def test_query(spark, tmp_path):
    vectors = np.random.default_rng(6).standard_normal((400, 24)).astype(np.float32)
    table(spark, vectors).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = forest.op12_hash_forest(spark, str(tmp_path)).collect()
    assert {r.query_id for r in found} == set(range(0, 400, 50)) and len(found) == 40
    hits = sum(r.vec_id in nearest(vectors, np.arange(400), r.query_id) for r in found)
    assert hits >= 36
