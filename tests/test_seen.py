"""The filter ahead of the anti join: equal results, few rows let through, merging, nulls, and plans."""

import pytest
from pyspark.sql import functions as F

from sievewright.operators import seen


@pytest.fixture(scope="module")
def tables(spark):
    known = spark.range(0, 20_000, 2).select(F.col("id").alias("k"))
    rows = spark.range(0, 30_000).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("text"))
    return rows, known


def test_equal_to_the_anti_join(spark, tables):
    rows, known = tables
    want = set(range(1, 20_000, 2)) | set(range(20_000, 30_000))
    got = [r.k for r in seen.unseen_filtered(rows, known, "k").collect()]
    assert len(got) == len(want) and set(got) == want
    assert seen.unseen_filtered(rows.limit(0), known, "k").count() == 0
    assert seen.unseen_filtered(rows, known.limit(0), "k").count() == 30_000


def test_few_pass_that_were_never_seen(spark, tables):
    rows, known = tables
    blocks = seen.blocks_for(10_000)
    met = seen.marked(rows, seen.seen_filter(known, "k", blocks), "k", blocks)
    is_known = (F.col("k") % 2 == 0) & (F.col("k") < 20_000)
    n = met.agg(F.count_if(is_known & ~F.col("possible")).alias("lost"), F.count_if(~is_known & F.col("possible")).alias("through")).first()
    assert n.lost == 0 and 0 < n.through < 0.05 * 20_000


def test_merged_filters_are_the_filter_of_all(spark, tables):
    _, known = tables
    blocks = seen.blocks_for(10_000)
    halves = [seen.seen_filter(known.where(c), "k", blocks) for c in ("k < 9000", "k >= 9000")]
    assert sorted(seen.merged(*halves).collect()) == sorted(seen.seen_filter(known, "k", blocks).collect())
    got = seen.unseen_filtered(tables[0], known, "k", seen.merged(*halves), blocks)
    assert got.count() == 20_000


def test_nulls_repeats_and_clashes(spark):
    rows = spark.createDataFrame([(None, "a"), ("x", "b"), ("x", "c"), ("y", "d"), ("y", "d")], "hash string, block string")
    known = spark.createDataFrame([("x",), ("x",), (None,)], "hash string")
    assert sorted((r.hash or "", r.block) for r in seen.unseen_filtered(rows, known).collect()) == [("", "a"), ("y", "d"), ("y", "d")]
    with pytest.raises(ValueError):
        seen.unseen_filtered(rows, known.select(F.lit(1).alias("hash")))
    with pytest.raises(ValueError):
        seen.unseen_filtered(rows, known, found=seen.seen_filter(known, "hash", 1024))


def test_beyond_the_bound_a_plain_anti_join(spark, tables, monkeypatch):
    monkeypatch.setattr(seen, "MOST_BLOCKS", 512)
    assert seen.unseen_filtered(*tables, "k").count() == 20_000


def test_texts_of_new_rows_are_not_shuffled(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = seen.unseen_filtered(*tables, "k")
        found.write.format("noop").mode("overwrite").save()
        plan = found._jdf.queryExecution().optimizedPlan()
        assert plan.nodeName() == "Union"
        new, doubtful = (plan.children().apply(i).toString() for i in range(2))
        # rows that are new for sure meet the filter alone, which is broadcast
        assert "LeftAnti" not in new and "broadcast" in new and new.count("Join ") == 1
        assert doubtful.count("LeftAnti") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
