import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from sievewright.llm import simhash as S
from sievewright.llm.components import components

SCHEMA = "doc_id bigint, text string, component_id string"


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, budget):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def texts():
    rng = random.Random(3)
    words = ["w%d" % i for i in range(60)] + ["É", "ABC", "x\tx"]
    out = [None, "", "  \n", "one", "One", "one two", "ONE  two"]
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(3, 200))]
        out.append(" ".join(base))
        out.append("\n".join(base))
        out.append(" ".join([*base, "tail"]))
    return list(enumerate(out))


def test_fingerprints_and_components(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(None, "one", "y"), (5, "one two", "again")], SCHEMA)
    got = S.near_duplicates(df).collect()
    fps = {i: brute_fingerprint(t) for i, t in rows}
    want = brute_components(fps, 2)
    assert {r.id: int(bytes(r.fp).hex(), 16) for r in got if r.id is not None} == fps
    assert {r.id: r.component_id for r in got if r.id is not None} == want
    assert [r.component_id for r in got if r.id is None] == [None]
    assert len(got) == len(rows) + 2


def test_empty_table(spark):
    assert S.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("limit", [50_000, 12])
def test_links_against_all_pairs(spark, limit):
    rng = random.Random(limit)
    base = [rng.getrandbits(64) for _ in range(25)]
    keys = set(base)
    for b in base[:8]:
        for _ in range(25):
            keys.add(b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = dict(enumerate(sorted(keys)))
    classes = spark.createDataFrame([(i, bytearray(k.to_bytes(8, "big"))) for i, k in fps.items()], "rep bigint, fp binary")
    found = components(S.links(classes, group_limit=limit)).collect()
    want = brute_components(fps, 2)
    assert {r.id: r.component for r in found} == {i: c for i, c in want.items() if list(want.values()).count(c) > 1}


def wide(keys):
    return [(i, bytearray(k.to_bytes(16, "big"))) for i, k in enumerate(keys)]


def lane_components(keys, far, lane_budget):
    """Components of 128-bit keys under links of at most ``far`` bits that have a 32-bit lane within its budget."""
    keys = np.array([[k >> s & 0xFFFFFFFF for s in (96, 64, 32, 0)] for k in keys], np.uint64)
    root = np.arange(len(keys))
    for i in range(len(keys)):
        bits = np.bitwise_count(keys ^ keys[i])
        for j in np.flatnonzero((bits.sum(axis=1) <= far) & (bits.min(axis=1) <= lane_budget)):
            root[root == max(root[i], root[j])] = min(root[i], root[j])
    return {i: c for i, c in enumerate(root.tolist()) if (root == c).sum() > 1}


@pytest.mark.parametrize("limit", [50_000, 10])
@pytest.mark.parametrize("groups", [1, 40])
def test_groups_that_share_a_lane_lose_no_link(spark, limit, groups):
    rng = random.Random(5)
    lane, keys = rng.getrandbits(32), set()
    for _ in range(groups):  # all keys share the first lane; members of a group are near each other, groups are far apart
        base = lane << 96 | rng.getrandbits(96)
        keys |= {base ^ (1 << rng.randrange(96)) ^ (1 << rng.randrange(96)) for _ in range(90 // groups + 2)}
    keys = sorted(keys)
    classes = spark.createDataFrame(wide(keys), "rep bigint, fp binary")
    found = components(S.links(classes, 128, 6, 32, 2, 3, group_limit=limit)).collect()
    assert {r.id: r.component for r in found} == lane_components(keys, 6, 2)


@pytest.mark.parametrize("limit", [50_000, 20])
def test_a_few_strangers_in_a_large_group(spark, limit):
    """A chain that only its far end ties to the group's rest is found, whatever the tree of the group holds."""
    rng = random.Random(6)
    base = rng.getrandbits(128)
    keys = {base ^ (1 << rng.randrange(32, 128)) for _ in range(80)}
    step = base
    for b in range(0, 24, 4):
        step ^= 0b1111 << b + 32
        keys.add(step)
    keys = sorted(keys)
    found = components(S.links(spark.createDataFrame(wide(keys), "rep bigint, fp binary"), 128, 5, 32, 2, 3, group_limit=limit)).collect()
    assert {r.id: r.component for r in found} == lane_components(keys, 5, 2)


def test_a_group_read_again_hands_on_rows_not_pairs():
    """Of members that are all unsure of each other, rows grow with the members, and sets decide in the task."""
    rng = random.Random(8)
    lane = rng.getrandbits(32)
    n = 60
    keys = [lane << 96 | rng.getrandbits(96) for _ in range(n)]
    rows = pd.DataFrame({"node": "0.0.1", "side": 0, "rest": 7, "errors": 0, "rep": range(n), "fp": [k.to_bytes(16, "big") for k in keys], "label": range(n)})
    again = S._Groups(rows, 22, 2).crossing(0, 128, 2, 32)
    assert again["src"].isna().all() and sorted(again["rep"]) == list(range(n))
    big = 1 << 62
    sets = [np.arange(10, dtype=np.int64) + big + 100 * (i // 20) for i in range(n)]
    done = S._Groups(again.drop(columns=["src", "dst"]).astype({c: "int64" for c in ("rest", "rep", "label")}).assign(shingles=sets), 22, 2).crossing(0, 128, 2, 32, 0.8)
    assert len(done) == n - 3 and done["node"].isna().all()
    label = S.forest(n, done["src"].to_numpy(np.int64), done["dst"].to_numpy(np.int64))
    assert label.tolist() == [i // 20 * 20 for i in range(n)]


def test_marked_rows_go_or_stay_once(spark):
    """Rows of marked keys go, or stay once; all others stay, and columns of any name do no harm."""
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit(1).alias("row"))
    marked = rows.where("doc_id % 40 = 0").select(S.row_key().alias("row_key"), (F.col("doc_id") % 80 == 0).alias("again"))
    twice = rows.unionByName(rows.where("doc_id = 80"))
    kept = S._without(twice, "row_key", marked)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(4000) if i % 40 or i % 80 == 0] and kept.columns == rows.columns


def test_walk_finds_each_pair_once():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 10, 300, dtype=np.uint64))
    n = len(keys)
    zero = np.array([0])
    pairs = [(a, b) for x, y in S.walk(keys, (zero, np.array([n]), zero, np.array([n]), zero), 10, 2) for a, b in zip(x.tolist(), y.tolist())]
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if bin(int(keys[i] ^ keys[j])).count("1") <= 2}
    assert len(pairs) == len(want) and {tuple(sorted(p)) for p in pairs} == want


def jaccard(a, b, k=5):
    one, two = ({tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} for w in (a, b))
    return len(one & two) / len(one | two)


def test_similar_texts_at_five_words(spark):
    """Groups of two on both sides of the similarity: nothing below it goes, and over 0.9 of those at and above it are found."""
    rng = random.Random(7)
    rows, similar = [], {}
    for d in range(400):
        words = ["%x" % rng.getrandbits(24) for _ in range(rng.choice([60, 150, 400]))]
        rows.append((2 * d, " ".join(words)))
        changed, least = list(words), rng.uniform(0.72, 0.9)
        while jaccard(words, changed) > least:
            changed[rng.randrange(len(words))] = "%x" % rng.getrandbits(24)
        rows.append((2 * d + 1, " ".join(changed)))
        similar[2 * d + 1] = jaccard(words, changed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit(1)).withColumn("rep", F.lit("x"))
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    gone = {r[0] for r in rows} - {r.doc_id for r in kept.collect()}
    assert not [d for d in gone if similar.get(d, 0) < 0.8]
    near = [d for d, s in similar.items() if 0.8 <= s < 0.83]
    assert len(near) > 50 and len([d for d in near if d in gone]) >= 0.9 * len(near)
    assert len([d for d, s in similar.items() if s >= 0.83 and d not in gone]) <= 0.05 * len(similar)


def test_repeated_lines_count_once(spark):
    rng = random.Random(9)
    words = ["%x" % rng.getrandbits(24) for _ in range(80)]
    text = " ".join(words)
    more = " ".join(words + words[:40] * 6)
    rows = [(1, text), (2, more), (2, more), (3, text.upper()), (4, None), (5, None), (None, text)]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.doc_id or 0) for r in kept)) == [0, 1, 4]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 180)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 180)}


def test_texts_of_one_id_stay_each(spark):
    """Unlike texts that share an id stay, and so do rows without one; repeats and near copies go."""
    rng = random.Random(31)
    text = lambda: " ".join("%x" % rng.getrandbits(20) for _ in range(60))
    a, b, c, d, e = (text() for _ in range(5))
    near = " ".join(a.split()[:-1] + ["changed"])
    rows = [(1, a, "x"), (1, b, "x"), (2, c, "x"), (2, c, "y"), (None, d, "x"), (None, e, "x"), (None, d, "x"), (7, near, "x"), (0, e, "x"), (9, None, "x"), (8, "", "x")]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, row_key string")).collect()
    found = sorted((str(r.doc_id), r.text or "") for r in kept)
    assert found == sorted([("1", a), ("1", b), ("2", c), ("None", d), ("None", d), ("None", e), ("0", e), ("8", "")])
