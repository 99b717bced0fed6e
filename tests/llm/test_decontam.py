import hashlib
import random
import re
from collections import Counter

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sievewright.llm import decontam as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    wins = []
    for item, text in items:
        w = words(text)
        wins += [(None if item is None else str(item), tuple(w[i : i + window])) for i in range(max(len(w) - window + 1, 1)) if w]
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, x in wins:
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i : i + len(x)]) == x:
                    hit.update(range(i, i + len(x)))
                    found.add(item)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found - {None})).encode()).hexdigest(), bool(hit), near(w, wins, found)))
    return out


def near(w, wins, found, slop=2):
    close = set()
    for item, x in wins:
        if item not in found and item not in close:
            need, n = Counter(x), len(x) + slop
            if any(not need - Counter(w[i : i + n]) for i in range(len(w)) if w[i] in need):
                close.add(item)
    return len(close)


def make():
    rng = random.Random(11)
    vocab = ["the", "of", "a", "Été", "x1", "ab", "CD", "eins", "zwei", "drei"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([2, 5, 10, 14, 30])))) for i in range(30)] + [(30, None), (31, "..."), (3, "a of a of the"), (None, "x1 ab eins zwei"), (None, "drei drei Été")]
    docs = []
    for d in range(150):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 90))]
        if d % 3 == 0:
            w[10:10] = words(items[d % 30][1])
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(w)))
    return [*docs, (150, None), (151, ""), (0, docs[0][1]), (None, docs[3][1])], items


def key(row):
    return tuple((x is not None, x) for x in row)


def frames(spark, docs, items):
    return spark.createDataFrame([(d, t, "i") for d, t in docs], "doc_id bigint, text string, items string"), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")


def test_against_brute_force(spark):
    docs, items = make()
    d, i = frames(spark, docs, items)
    for pack in (D.PACK_WORDS, 60):
        got = [tuple(r) for r in D.report(D.search(D.build_index(d), i, slop=D.SLOP, pack_words=pack)).collect()]
        assert sorted(got, key=key) == sorted(brute(docs, items), key=key)


def test_hits_do_not_cross_documents_or_blocks(spark, monkeypatch):
    docs = [(1, "a b c d e"), (2, "f g h i j"), (3, "a b c d e f g h i j")]
    d, i = frames(spark, docs, [(7, "a b c d e f g h i j")])
    got = {r.doc_id: r for r in D.search(D.build_index(d.coalesce(1)), i).collect()}
    assert [got[k]["items"] for k in (1, 2, 3)] == [[], [], ["7"]]
    assert [tuple(s) for s in got[3]["spans"]] == [(0, 10)]


def test_proximity(spark):
    docs = [(1, "x a b q c y"), (2, "c b a"), (3, "a b c"), (4, "a b q q q c"), (5, "a b")]
    d, i = frames(spark, docs, [(1, "a b c")])
    got = {r.doc_id: r for r in D.search(D.build_index(d.coalesce(1)), i, window=3, slop=1).collect()}
    assert {k for k, r in got.items() if r["items"]} == {3}
    near = {r.doc_id for r in D.search(D.build_index(d.where("doc_id <> 3").coalesce(1)), i, window=3, slop=1).collect() if r["near"]}
    assert near == {1, 2}


def test_empty_tables_and_removal(spark):
    docs, items = make()
    d, i = frames(spark, docs, items)
    assert D.report(D.search(D.build_index(d.limit(0)), i)).collect() == []
    clean = D.search(D.build_index(d), i.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r["items"] for r in clean)
    bad = {r[0] for r in brute(docs, items) if r[5]}
    kept = D.decontaminate(d, i)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {x for x, _ in docs} - bad


def test_rows_that_share_an_id_are_judged_each(spark):
    leak = " ".join(f"w{i}" for i in range(12))
    rows = [(None, leak), (None, "clean text"), (1, "before " + leak), (1, "another text"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("row_key", F.lit("x"))
    kept = D.decontaminate(docs, spark.createDataFrame([(1, leak)], "item_id bigint, text string"))
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("1", "another text"), ("2", "None"), ("None", "clean text")]


def test_the_index_has_small_row_groups_and_batches_are_set_back(spark, tmp_path):
    rng = random.Random(5)
    docs = [(d, " ".join("%x" % rng.getrandbits(30) for _ in range(250_000))) for d in range(8)]
    held = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    index = D.build_index(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1), f"{tmp_path}/index")
    (file,) = (pq.ParquetFile(x) for x in tmp_path.glob("index/*.parquet"))
    assert max(file.metadata.row_group(i).total_byte_size for i in range(file.num_row_groups)) < 16 << 20
    items = [(d, " ".join(text.split(" ")[100:110])) for d, text in docs]
    got = D.search(index, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert [(r.doc_id, r["items"], [tuple(x) for x in r.spans]) for r in sorted(got)] == [(d, [str(d)], [(100, 110)]) for d, _ in docs]
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == held


def test_decontaminate_stores_no_index_and_moves_few_texts(spark, monkeypatch):
    docs, items = make()
    many = [(d + 1000 * k, text) for k in range(20) for d, text in docs if d is not None]
    monkeypatch.setattr(D, "build_index", None)
    monkeypatch.setattr(D, "PACK_WORDS", 20)
    got = D.decontaminate(spark.createDataFrame(many, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    bad = {(d, x) for (d, x), hit in zip(many, [b[5] for b in brute(docs, items) if b[0] is not None] * 20, strict=True) if hit}
    assert 0 < len(bad) < len(many)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((x for x in many if x not in bad), key=key)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "_words" in plan[plan.index("Join LeftOuter") :]  # texts pass the filter ahead of the join
