import json

import pytest
from pyspark.sql import functions as F

from sievewright import schemas as S
from sievewright.sources import readers as R
from sievewright.sources import writers as W


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


SIMPLE = S.struct(id="string", text="string")


def test_json_lines_skip_blank_and_broken(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"id": "1", "text": "é"}', "", "   ", "{invalid}", '{"id": "2", "text": "b"}')
    rows = R.json_lines(spark, path, SIMPLE).orderBy("line_no").collect()
    assert [(r.line_no, r.id, r.text) for r in rows] == [(0, "1", "é"), (4, "2", "b")]
    assert [(r.line_no, r.raw) for r in R.json_lines(spark, path, SIMPLE, broken=True).collect()] == [(3, "{invalid}")]


def test_line_numbers_hold_over_splits(spark, tmp_path):
    path = write(tmp_path / "big.txt", *(f"line {i} " + "x" * 200 for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = R.lines(spark, path)
        assert got.rdd.getNumPartitions() >= 1
        assert all(r.value.startswith(f"line {r.line_no} ") for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_recursive_pattern_and_counts(spark, tmp_path):
    write(tmp_path / "r1/data/clean_round_1.jsonl", '{"id": "1"}')
    write(tmp_path / "r2/data/clean_round_2.jsonl", '{"id": "2"}', "")
    write(tmp_path / "r2/data/raw_round_2.jsonl", '{"id": "3"}')
    rows = R.json_lines(spark, str(tmp_path), SIMPLE, "clean_round_*.jsonl").collect()
    assert sorted(r.id for r in rows) == ["1", "2"]
    assert sorted(r.n for r in R.line_counts(spark, str(tmp_path), "clean_round_*.jsonl").collect()) == [1, 2]


def event(**changes):
    return json.dumps({k: "x" for k in S.JOURNAL_KEYS} | {"event_version": "1.0", "ts": "2024-01-02T03:04:05Z", "round": 1, "counters_delta": {"a": 1}, "usage_delta": {}, "artifact_paths": []} | changes)


def test_journals_fail_closed(spark, tmp_path):
    good = R.journal(spark, write(tmp_path / "good", event(), event(round=2))).orderBy("seq").collect()
    assert [(r.seq, r["round"], r.counters_delta) for r in good] == [(0, 1, {"a": 1.0}), (1, 2, {"a": 1.0})] and good[0].event_time is not None
    for bad in ("not a json", event(event_version="2.0"), json.dumps({"ts": "x"})):
        path = write(tmp_path / "bad", event(), bad)
        with pytest.raises(Exception, match="journal line 1"):
            R.journal(spark, path).collect()
        assert R.journal(spark, path, fail=False).where("violation is not null").count() == 1


def test_training_samples(spark, tmp_path):
    ok = {"instruction": "i", "input": "", "output": "o"}
    assert R.training_samples(spark, write(tmp_path / "t", json.dumps(ok), json.dumps(ok | {"id": "1"}))).count() == 2
    with pytest.raises(Exception, match="unknown: test_result"):
        R.training_samples(spark, write(tmp_path / "u", json.dumps(ok | {"test_result": {}}))).select("raw").collect()
    with pytest.raises(Exception, match="signature"):
        R.training_samples(spark, write(tmp_path / "v", json.dumps(ok)), key="k").select("raw").collect()


def test_eval_cap_counts_physical_lines(spark, tmp_path):
    path = write(tmp_path / "e", "", "broken", *(json.dumps({"id": str(i)}) for i in range(5)))
    assert [r.id for r in R.eval_samples(spark, path, 4).orderBy("line_no").collect()] == ["0", "1"]


def test_small_readers(spark, tmp_path):
    path = write(tmp_path / "p", " a ", "", "b")
    assert [tuple(r) for r in R.prompts(spark, path).orderBy("id").collect()] == [("prompt_000000", "a"), ("prompt_000001", "b")]
    assert sorted(r.name for r in R.names(spark, path).collect()) == ["a", "b"]
    (tmp_path / "src").mkdir()
    (tmp_path / "src/a.py").write_text("x" * 200)
    (tmp_path / "src/b.py").write_text("x")
    (tmp_path / "src/c.txt").write_text("x" * 200)
    assert [r.path.rsplit("/", 1)[1] for r in R.source_files(spark, str(tmp_path / "src")).collect()] == ["a.py"]
    write(tmp_path / "runs/r1/state.json", json.dumps({"run_id": "r1", "counters": {"a": 1}}))
    write(tmp_path / "runs/r2/state.json", "{broken")
    assert [r.run_id for r in R.run_states(spark, f"{tmp_path}/runs/*/state.json", S.RUN_STATE).collect()] == ["r1"]
    own = spark.createDataFrame([("gpt-4o", 9.0, 9.0), ("mine", 1.0, 2.0)], "model string, input_price double, output_price double")
    table = {r.model: r.input_price for r in R.prices(spark, own).collect()}
    assert table["gpt-4o"] == 9.0 and table["mine"] == 1.0 and len(table) == len(S.PRICES) + 1
    assert R.settings({"a": 1, "b": 2}, {"b": 3, "a": None}) == {"a": 1, "b": 3}
    assert R.path_contained(f"{tmp_path}/x/../y", str(tmp_path)) and not R.path_contained(f"{tmp_path}/../y", str(tmp_path))


def test_path_containment_follows_links(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/link").symlink_to("/etc")
    assert not R.path_contained(str(tmp_path / "in/link/passwd"), str(tmp_path / "in"))


def test_event_frames(spark):
    text = ["data: {\"a\":", "data: 1}", "", ": comment", "event: x", "data: broken", "", "data:[2]\r", "\r", "id: 3", ""]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(text)], "stream string, line_no int, value string")
    assert [r.data for r in R.frames(df).orderBy("frame").collect()] == ['{"a":\n1}', "[2]"]


def test_json_of_lines(spark):
    df = spark.createDataFrame([('{"a": 1}\n\n{"a": 2}',)], "t string")
    assert df.select(F.size(R.json_array_of(F.col("t"))).alias("n")).first().n == 2
    with pytest.raises(Exception, match="(?i)malformed|parse|invalid"):
        spark.createDataFrame([("{}\nno",)], "t string").select(R.json_array_of(F.col("t")).cast("array<string>")).collect()


def test_json_writer_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("2", "é\U0001f600\"\n", 1), ("1", None, 0)], "id string, text string, seq int")
    W.json_lines(df, str(tmp_path / "a"), "seq")
    lines = [r.value for r in spark.read.text(str(tmp_path / "a")).collect()]
    assert [json.loads(x) for x in lines] == [{"id": "1", "text": None}, {"id": "2", "text": "é\U0001f600\"\n"}]
    W.json_lines(df, str(tmp_path / "b"), "seq", ascii_only=True)
    ascii_lines = [r.value for r in spark.read.text(str(tmp_path / "b")).orderBy("value").collect()]
    assert all(x.isascii() for x in ascii_lines) and sorted(map(json.loads, ascii_lines), key=str) == sorted(map(json.loads, lines), key=str)
    assert json.dumps("é\U0001f600") in ascii_lines[1].replace('\\"', "") or "\\u00e9\\ud83d\\ude00" in ascii_lines[1]


def test_sealed_dataset(spark, tmp_path):
    import hashlib
    import hmac

    df = spark.createDataFrame([(i, json.dumps({"i": i})) for i in range(5)], "seq int, value string")
    W.seal(df, str(tmp_path), "run1", "key", "2024-01-01T00:00:00Z")
    row = spark.read.json(f"{tmp_path}/run1/manifest").first()
    assert row.signature == hmac.new(b"key", row.manifest.encode(), hashlib.sha256).hexdigest()
    m = json.loads(row.manifest)
    assert sorted(m) == list(m) == sorted(S.MANIFEST_KEYS) and m["record_count"] == 5 and m["guardrail_snapshot"] == {}
    assert [r.value for r in spark.read.text(f"{tmp_path}/run1/dataset").collect()] == [json.dumps({"i": i}) for i in range(5)]
    with pytest.raises(Exception, match="(?i)already exists"):
        W.seal(df, str(tmp_path), "run1", "key", "2024-01-01T00:00:00Z")
    other = W.manifest(df.withColumn("value", F.lit("x")), "run1", "key", "2024-01-01T00:00:00Z").first()
    assert other.signature != row.signature


def test_scans_fail_whatever_is_selected(spark, tmp_path):
    bad = write(tmp_path / "journal.jsonl", json.dumps(event()), "not a json")
    null = write(tmp_path / "null.jsonl", json.dumps(event(event_version=None)))
    train = write(tmp_path / "train.jsonl", '{"instruction": "i", "input": "x", "output": "o"}', '{"instruction": "i"}')
    for frame in (R.journal(spark, bad), R.journal(spark, null), R.training_samples(spark, train)):
        for act in (lambda f: f.count(), lambda f: f.select(f.columns[-1]).collect(), lambda f: f.agg(F.lit(1)).collect(), lambda f: f.limit(5).collect()):
            with pytest.raises(Exception):
                act(frame)
    assert R.training_samples(spark, write(tmp_path / "good.jsonl", '{"instruction": "i", "input": "x", "output": "o"}')).count() == 1


def test_the_newest_file_is_read_as_it_is(spark, tmp_path):
    import os

    write(tmp_path / "clean_round_1.jsonl", "a", "b")
    path = write(tmp_path / "clean_round_2.jsonl", *map(str, range(10)))
    os.utime(tmp_path / "clean_round_1.jsonl", (1, 1))
    last = lambda: sorted((r.line_no, r.value) for r in R.newest_lines(spark, str(tmp_path), "clean_round_*.jsonl", 3).collect())
    assert last() == [(7, "7"), (8, "8"), (9, "9")]
    write(tmp_path / "clean_round_2.jsonl", "fresh")  # cut and written anew
    assert path.endswith("2.jsonl") and last() == [(0, "fresh")]


def test_a_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    W.replace_table(spark.range(3), path)
    W.replace_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception):
        W.replace_table(spark.range(2).select(F.raise_error(F.lit("x")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5


def test_prompts_of_several_files_are_numbered_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "PROMPTS", 2)
    write(tmp_path / "p/a.txt", "one", "", " two ", "three")
    write(tmp_path / "p/b.txt", "four", "five")
    found = sorted((r.id, r.prompt) for r in R.prompts(spark, str(tmp_path / "p")).collect())
    assert found == [(f"prompt_{i:06d}", x) for i, x in enumerate(["one", "two", "three", "four", "five"])]


@pytest.mark.parametrize("few", [0, 100_000])
def test_no_line_is_shuffled(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(R, "FEW_SPLITS", few)
    for name in "abc":
        write(tmp_path / f"n/{name}.txt", *(f"{name} {i}" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        found = R.lines(spark, str(tmp_path / "n"))
        assert all(r.value == f"{r.path[-5]} {r.line_no}" for r in found.collect())
        if few:
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
