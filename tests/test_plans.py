import hashlib
import json

from sievewright.operators.validate import Gate
from sievewright.plans import curate


def sample(i, output, **more):
    return json.dumps({"id": str(i), "instruction": "do it", "input": "", "output": output, "metadata": {"task_type": "other", "teacher_model": "m"}} | more)


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_a_round(spark, tmp_path):
    lines = [sample(i, f"answer {i}: " + hashlib.md5(str(i).encode()).hexdigest()) for i in range(20)]
    lines += [lines[3], sample(30, "short"), sample(31, "class Handler: in a long answer"), sample(32, "fine and long enough", extra=1), "broken", ""]
    out = curate.run_round(spark, write(tmp_path / "raw.jsonl", lines), str(tmp_path / "out"), curate.Plan(val_ratio=0.2, test_code=True))
    assert out["clean"].count() == 20 and {(r.reason, r.n) for r in out["reasons"].collect()} == {("length", 1), ("schema", 1), ("semantic", 1)}
    assert [r.seq for r in out["split"].where("split = 'val'").orderBy("seq").collect()] == [16, 17, 18, 19]
    assert out["clean"].where("validation.passed and test_result.passed").count() == 20
    (tmp_path / "raw.jsonl").unlink()  # what is there isn't made again
    write(tmp_path / "raw.jsonl", [])
    assert curate.run_round(spark, str(tmp_path / "raw.jsonl"), str(tmp_path / "out"))["clean"].count() == 20


def test_a_round_over_two_files(spark, tmp_path):
    texts = [f"answer {i}: " + hashlib.md5(str(i).encode()).hexdigest() for i in range(10)]
    write(tmp_path / "raw/a.jsonl", [sample(i, t) for i, t in enumerate(texts[:6])])
    write(tmp_path / "raw/b.jsonl", [sample(100 + i, t) for i, t in enumerate(texts[3:])])
    out = curate.run_round(spark, str(tmp_path / "raw"), str(tmp_path / "out"), curate.Plan(val_ratio=0.2))
    kept = out["split"].orderBy("seq").collect()
    assert [r.id for r in kept] == ["0", "1", "2", "3", "4", "5", "103", "104", "105", "106"]
    assert [r.id for r in kept if r.split == "val"] == ["105", "106"]


def test_a_build_over_repositories(spark, tmp_path):
    one = [sample(i, f"answer {i}") for i in range(30)]
    write(tmp_path / "data/a/clean_round_1.jsonl", one)
    write(tmp_path / "data/b/clean_round_1.jsonl", [*one[10:20], *(sample(i, f"other {i}") for i in range(10))])
    out = curate.build(spark, str(tmp_path / "data"), str(tmp_path / "out"), curate.Plan(gate=Gate(), seed=42))
    row = out["summary"].first()
    assert (row.dataset_lines, row.total_lines_before_dedupe, row.unique_lines, row.train_lines, row.val_lines, row.dedupe_ratio) == (40, 50, 40, 36, 4, 0.8)
    assert [r.seq for r in out["merged"].orderBy("seq").collect()] == list(range(40))
    assert [json.loads(r.raw)["id"] for r in out["merged"].orderBy("seq").limit(30).collect()] == [str(i) for i in range(30)]
    curate.seal(spark, str(tmp_path / "out"), "run", "key", "2024-01-01T00:00:00Z")
    assert spark.read.text(f"{tmp_path}/out/verified/run/dataset").count() == 40


def test_evaluation(spark):
    df = spark.createDataFrame([("a", True, "fine")], "sample_id string, success boolean, output string")
    assert curate.evaluation(df).first().success_rate == 1.0
