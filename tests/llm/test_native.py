"""Mixing, line dedup and fingerprints against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from sievewright.llm import fingerprint as P
from sievewright.llm import linededup as L
from sievewright.llm import mixing as M

SCHEMA = "doc_id bigint, text string, source string, s string, size string, key int"


def docs_of(rows):
    return [(i, t, s, "x", "y", 1) for i, t, s in rows]


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(w[s] for s in open_) if open_ else 0
        over = {s for s in open_ if w[s] * level >= 2 * sizes[s]}
        if not over:
            return out | {s: w[s] * level for s in open_}
        for s in over:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= over


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(0, 60))) + rng.choice(["", " \n", " 12 34"]), rng.choice(["a", "a", "a", "b", "é", "Z", None])) for i in range(900)]
    rows += [(900, None, "a"), (None, "no id", "b"), (None, "no id", "b"), (3, "again three", "a"), (901, "", "empty")]
    df = spark.createDataFrame(docs_of(rows), SCHEMA)
    for bucket in (M.BUCKET_ROWS, 20):
        got = M.mix(df, bucket_rows=bucket).collect()
        assert len(got) == len(rows)
        assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(re.findall("[^\x20\x09-\x0d]+", t or ""))) for i, t, _ in rows)
        sizes, taken, target, most = defaultdict(int), defaultdict(int), {}, defaultdict(int)
        for r in got:
            sizes[r.source] += r["size"]
            taken[r.source] += r.taken
            target[r.source] = r.target
            most[r.source] = max(most[r.source], r["size"])
            assert r.taken <= 2 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        assert target == pytest.approx(brute_targets(dict(sizes)))
        assert {r.source: r.source_size for r in got} == dict(sizes)
        for s in sizes:
            assert abs(taken[s] - target[s]) <= most[s] / 2 + 1e-6
        if bucket == 20:
            assert sorted(map(str, got)) == before
        before = sorted(map(str, got))


@pytest.mark.parametrize("worth", ["1.0", "0.2", "0.2 + 0.8 * (id % 7) / 6", "if(id % 3 = 0, 50.0, 0.01)"])
def test_buckets_are_of_one_size_for_any_quality(spark, monkeypatch, worth):
    monkeypatch.setattr(M, "BUCKETS_AT_ONCE", 7)
    docs = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"), F.expr(worth).alias("w"))
    sizes = sorted(r["count"] for r in M.bucketed(docs, weight=F.col("w"), bucket_rows=200).groupBy("bucket").count().collect())
    assert sum(sizes) == 20_000 and len(sizes) > 80 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    rows = M.mix(docs, weight=F.col("w"), bucket_rows=200).collect()
    assert len(rows) == 20_000 and abs(sum(r.taken for r in rows) - rows[0].target) <= 1


def test_mix_follows_quality_and_order_of_keys(spark):
    rows = [(i, "a b c", "s") for i in range(400)]
    df = spark.createDataFrame(docs_of(rows), SCHEMA)
    got = M.mix(df, weight=F.when(F.col("doc_id") < 200, 5.0).otherwise(0.5)).collect()
    extra = [r for r in got if r.taken > r["size"]]
    assert sum(r.doc_id < 200 for r in extra) > 3 * sum(r.doc_id >= 200 for r in extra) and all(r.taken >= 3 for r in got)
    assert M.mix(df.limit(0)).collect() == []
    assert [(r.target, r.taken) for r in M.mix(spark.createDataFrame(docs_of([(1, "", "s"), (2, None, None)]), SCHEMA)).collect()] == [(0.0, 0), (0.0, 0)]


def test_uniform_keys_match_their_definition(spark):
    row = spark.createDataFrame([(12,)], "i bigint").select(M.uniform(F.col("i"), F.lit("x"))).first()
    assert row[0] == (int(hashlib.md5(b"12").hexdigest()[:12], 16) + 1) / 2**48


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        lines = ["line %d" % rng.randint(0, 4000) for _ in range(rng.randint(0, 5))]
        source = rng.choice(["a", "b", None])
        if rng.random() < {"a": 0.3, "b": 0.05, None: 0.2}[source]:
            lines.insert(rng.randint(0, len(lines)), rng.choice(["  cookie notice ", "cookie notice"]))
        rows.append((i, "\n".join(lines), source))
    rows += [(400, None, "a"), (401, "", "a"), (402, "cookie notice\ncookie notice\n\n", "a"), (402, "cookie notice\ncookie notice\n\n", "a")]
    df = spark.createDataFrame(docs_of(rows), SCHEMA)
    hosts, count = Counter(s for _, _, s in rows), Counter()
    for _, t, s in rows:
        count.update({(s, x.strip(" ")) for x in (t or "").split("\n") if x.strip(" ")})
    want = []
    for i, t, s in rows:
        kept = None if t is None else [x for x in t.split("\n") if not x.strip(" ") or not (count[s, x.strip(" ")] >= 10 and count[s, x.strip(" ")] > 0.1 * hosts[s])]
        want.append((i, t if t is None else "\n".join(kept), s, 0 if t is None else len(t.split("\n")) - len(kept)))
    out = L.drop_boilerplate(df)
    assert out.columns == [*df.columns, "n_dropped"]
    assert sorted(map(str, ((r.doc_id, r.text, r.source, r.n_dropped) for r in out.collect()))) == sorted(map(str, want))
    assert any(w[3] for w in want) and L.drop_boilerplate(df.limit(0)).collect() == []


def brute_lanes(text):
    lanes = [0] * P.LANES
    for p in re.split("(?<=[.!?])[ \t]+|\n", text):
        if not p:
            continue
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for i in range(64):
            lanes[i] += len(p) if h >> i & 1 else -len(p)
        for i in range(P.CHECK // 2):
            wide = xxhash.xxh64_intdigest(p.encode(), xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 42))
            lanes[64 + 2 * i] += wide & 0xFFFFFFFF
            lanes[65 + 2 * i] += wide >> 32
    return [x & 0xFFFFFFFF for x in lanes]


def brute_likeness(a, b):
    if a == b:
        return 1.0
    x, y = ([v - (1 << 32) if v > 1 << 31 else v for v in z[:64]] for z in (a, b))
    n = math.sqrt(sum(v * v for v in x) * sum(v * v for v in y))
    return max(0.0, sum(p * q for p, q in zip(x, y)) / n) if n else 0.0


def brute_compare(rows):
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64)
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1]), r[1].encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        a, b, c = brute_lanes(t), brute_lanes(e), brute_lanes(nxt)
        text = lambda z: "".join("%08x" % v for v in z)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), text(a), text(b), brute_likeness(a, b), brute_likeness(a, c)))
    return out


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_fingerprints_against_brute_force(spark, ranges):
    rng = random.Random(4)
    words = ["a", "Été", "x.", "y!", "\n", "\U0001f600", "long-word"]
    rows = [(rng.choice([i, i * i, -i]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    rows += [(None, "null id. Two"), (500, None), (501, ""), (7, "same id"), (7, "same id"), (7, "other")]
    rows += [(rng.choice([None, 44]), "hot %d. %d" % (i % 50, i % 7)) for i in range(80)]
    got = P.compare_edited(spark.createDataFrame(docs_of([(i, t, "s") for i, t in rows]), SCHEMA), ranges=ranges).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:5])
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(brute_compare(rows), key=order), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:])


def test_insert_delete_and_order(spark):
    df = spark.createDataFrame([("a.\nb.\nc.", "c.\na.\nb.", "a.\nc.", "b.")], "x string, y string, z string, b string")
    lanes = {}
    for c in df.columns:
        lanes[c] = P.summed(df.select(F.lit(1).alias("k"), F.explode(P.paragraphs(F.col(c))).alias("paragraph")), ["k"]).first().lanes
    assert lanes["x"] == lanes["y"] != lanes["z"]
    two = spark.createDataFrame([(lanes["z"], lanes["b"], lanes["x"])], "z array<bigint>, b array<bigint>, x array<bigint>")
    assert two.select(P.insert("z", "b"), P.delete("x", "b")).first()[:] == (lanes["x"], lanes["z"])


def test_one_row_and_no_row(spark):
    df = spark.createDataFrame(docs_of([(1, "abcd", "s")]), SCHEMA)
    row = P.compare_edited(df).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert P.compare_edited(df.limit(0)).collect() == []
