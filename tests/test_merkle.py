"""The tree of hashes: one root for any order of work, paths alone are hashed anew, proofs, lost appends, bad places."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sievewright.operators import merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_root(lines):
    """Root of {place: line}, by plain Python."""
    level = {p: sha("0:" + v) if v is not None else sha("-") for p, v in lines.items()}
    depth = max(1, -(-max(lines).bit_length() // 6))
    for _ in range(depth):
        above = {}
        for p in sorted(level):
            above.setdefault(p >> 6, []).append(f"{p & 63}:{level[p]}")
        level = {p: sha("1:" + ",".join(c)) for p, c in above.items()}
    return level[0]


def frame(spark, lines):
    return spark.createDataFrame(sorted(lines.items()), "seq bigint, value string")


@pytest.fixture
def tree(spark, tmp_path):
    return merkle.MerkleTree(spark, str(tmp_path / "tree"))


LINES = {i: f"line {i}" for i in range(300)} | {5: None, 6: ""}


def test_one_root_however_it_is_built(spark, tree, tmp_path):
    want = plain_root(LINES)
    assert tree.append(frame(spark, LINES).repartition(7)) == want
    other = merkle.MerkleTree(spark, str(tmp_path / "other"))
    for low, high in [(0, 10), (10, 64), (64, 65), (65, 300)]:
        part = {p: v for p, v in LINES.items() if low <= p < high}
        assert other.append(frame(spark, part)) == plain_root({p: v for p, v in LINES.items() if p < high})
    assert other.root() == want


def test_growth_past_a_gap_and_replaced_lines(spark, tree):
    lines = {0: "a", 3: "b"}
    assert tree.append(frame(spark, lines)) == plain_root(lines)
    # two levels more at once: the old root has new nodes above it that no new line touches
    lines[70_000] = "c"
    assert tree.append(frame(spark, {70_000: "c"})) == plain_root(lines)
    lines[3] = "changed"
    assert tree.append(frame(spark, {3: "changed"})) == plain_root(lines)
    assert tree.roots().orderBy(F.desc("append")).first().n == 3


def test_an_append_hashes_its_paths_only(spark, tree):
    tree.append(frame(spark, {i: str(i) for i in range(64 * 64)}))
    tree.append(frame(spark, {64 * 63 + 5: "new"}))
    written = spark.read.parquet(f"{tree.path}/nodes/append=1").groupBy("level").count().collect()
    assert {r.level: r["count"] for r in written} == {0: 1, 1: 1, 2: 1}


def test_proofs_hold_for_the_line_alone(spark, tree):
    tree.append(frame(spark, {p: v for p, v in LINES.items() if p < 200}))
    root = tree.append(frame(spark, {p: v for p, v in LINES.items() if p >= 200}))
    proofs = tree.proofs(spark.createDataFrame([(5,), (6,), (130,), (299,), (299,), (300,)], "at bigint"))
    got = proofs.join(frame(spark, LINES), F.col("at") == F.col("seq")).select(
        "at", merkle.climbed(merkle.leaf_hash(F.col("value")), F.col("at"), F.col("path")).alias("right"), merkle.climbed(merkle.leaf_hash(F.lit("x")), F.col("at"), F.col("path")).alias("wrong"),
        merkle.climbed(merkle.leaf_hash(F.col("value")), F.col("at") + 1, F.col("path")).alias("elsewhere"),
    ).collect()
    assert sorted(r.at for r in got) == [5, 6, 130, 299]
    assert all(r.right == root and r.wrong is None and r.elsewhere is None for r in got)


def test_an_append_that_was_lost_is_written_again(spark, tree):
    tree.append(frame(spark, {0: "a"}))
    # leaves of an append without a root
    for level in (0, 1, 2):
        frame(spark, {0: "lost"}).select(F.col("seq").alias("node"), F.lit(1).cast("bigint").alias("n"), F.col("value").alias("hash")).write.parquet(f"{tree.path}/nodes/append=1/level={level}")
    assert tree.root() == plain_root({0: "a"}) and tree.nodes(0).count() == 1
    assert tree.append(frame(spark, {2: "b"})) == plain_root({0: "a", 2: "b"})
    assert tree.nodes(2).count() == 0


def test_empty_repeated_and_bad_rows(spark, tree):
    assert tree.root() is None and tree.nodes(1).count() == 0
    none = spark.createDataFrame([], "seq bigint, value string, hash string, node string")
    assert tree.append(none) is None
    twice = spark.createDataFrame([(1, "a", "h", 5), (1, "a", "g", 6)], "seq bigint, value string, hash string, node int")
    assert tree.append(twice) == plain_root({1: "a"})
    assert tree.append(none) == plain_root({1: "a"})
    for bad in ([(None, "a")], [(-1, "a")], [(2, "a"), (2, "b")]):
        with pytest.raises(Exception, match="place"):
            tree.append(spark.createDataFrame(bad, "seq bigint, value string"))
    assert tree.root() == plain_root({1: "a"})
