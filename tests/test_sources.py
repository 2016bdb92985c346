import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dialogue_engine import schemas
from dialogue_engine.scratch import clear_written, scratch_dir, written
from dialogue_engine.sources import cases as cases_source
from dialogue_engine.sources import evaluations as ev
from dialogue_engine.sources import run_stats

TWO = {
    "results": [
        {"prompt": "p0", "base_output": "b0", "fine_tuned_output": "f0", "commentary": "c"},
        {"prompt": "p1", "base_output": None, "fine_tuned_output": "f1"},
    ],
    "metrics": {"num_prompts": 2, "avg_length_base": 1, "avg_length_ollama": None, "keyword_count_avg": 0.5},
    "evaluation_config": {"base_model": "m", "adapter_path": "a", "adapter_loaded": False},
}
ONE = {"results": [{"prompt": "p0", "ollama_output": "o0 \U0001f600"}], "metrics": {}}
LIST = [{"prompt": f"p{i}", "base_output": "b", "fine_tuned_output": "f"} for i in range(30)]


@pytest.fixture
def folder(tmp_path):
    for name, content in {"two": TWO, "one": ONE, "list": LIST, "empty": []}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content, indent=2))
    (tmp_path / "broken.json").write_text('{"results": [{"prompt": ')
    return tmp_path


def by_file(rows):
    return {r.run_id.rsplit("/", 1)[1].removesuffix(".json"): r for r in rows}


def test_results_of_every_shape(spark, folder):
    files = ev.read_evaluations(spark, str(folder))
    rows = ev.load_eval_results(files).collect()
    found = {}
    for r in rows:
        found.setdefault(r.run_id.rsplit("/", 1)[1], []).append((r.prompt_id, r.prompt))
    assert {k: sorted(v) for k, v in found.items()} == {
        "two.json": [(0, "p0"), (1, "p1")],
        "one.json": [(0, "p0")],
        "list.json": [(i, f"p{i}") for i in range(30)],
    }
    assert {r.ollama_output for r in rows if "one.json" in r.run_id} == {"o0 \U0001f600"}


def test_odd_entries_are_no_results(spark, tmp_path):
    contents = {
        "nothing": {}, "note": {"note": 1}, "empty": [],
        "mixed": {"results": [{"note": 1}, {"prompt": "p", "fine_tuned_output": None}, {}]},
        "list": [{"prompt": None, "base_output": "b"}, {"prompt": "q", "fine_tuned_output": "f"}],
    }
    for name, content in contents.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content))
    files = ev.read_evaluations(spark, str(tmp_path))
    rows = ev.load_eval_results(files).collect()
    found = {(r.run_id.rsplit("/", 1)[1], r.prompt_id): (r.prompt, r.has_two) for r in rows}
    assert found == {("mixed.json", 1): ("p", True), ("list.json", 0): (None, False), ("list.json", 1): ("q", True)}
    assert set(by_file(ev.evaluation_runs(spark, str(tmp_path)).collect())) == set(contents)


def test_case_ids_do_not_depend_on_the_tasks(spark, tmp_path):
    rows = [(f"q{i}", f"a{i}", "c", "i", None) for i in range(500)]
    cases = spark.createDataFrame(rows, schemas.CASES).repartition(3)
    cases.write.parquet(str(tmp_path / "cases"))
    cases.write.option("header", True).csv(str(tmp_path / "csv"))

    def ids(size, fmt, folder):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        loaded = cases_source.load_cases(spark, str(tmp_path / folder), fmt)
        found = {r.case_id: r.instruction for r in loaded.collect()}
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        return found

    for fmt, folder in (("parquet", "cases"), ("csv", "csv")):
        first = ids("128m", fmt, folder)
        assert len(first) == 500 and first == ids("2k", fmt, folder)


def test_metrics_config_and_broken_files(spark, folder):
    files = ev.read_evaluations(spark, str(folder))
    metrics = by_file(ev.load_eval_metrics(files).collect())
    assert set(metrics) == {"two", "one"}
    assert (metrics["two"].avg_length_base, metrics["two"].avg_length_ollama) == (1.0, None)
    configs = by_file(ev.load_eval_config(files).collect())
    assert configs["two"].adapter_loaded is False and configs["one"].adapter_loaded is None
    assert set(configs) == {"two", "one", "list"}
    assert set(by_file(ev.unreadable_files(files).collect())) == {"broken"}


def test_missing_path_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        ev.read_evaluations(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_write_results_replaces_only_its_runs(spark, tmp_path, fmt):
    path = str(tmp_path / "out")

    def save(rows):
        ev.write_results(spark.createDataFrame(rows, "run_id string, prompt_id long, output string"), path, fmt)

    save([("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")])
    save([("a", 0, "new")])
    rows = spark.read.format(fmt).load(path).select("run_id", "prompt_id", "output").collect()
    assert {tuple(r) for r in rows} == {("a", 0, "new"), ("b", 0, "z")}


def test_cases_round_trip(spark, tmp_path):
    text = 'instruction,response,category,intent,flags\n"say ""hi"", now","line one\nline two",ORDER,cancel,B\nq,a,,,\n'
    (tmp_path / "cases.csv").write_text(text)
    cases = cases_source.load_cases(spark, str(tmp_path / "cases.csv"), "csv")
    rows = cases.orderBy("case_id").collect()
    assert (rows[0].instruction, rows[0].response) == ('say "hi", now', "line one\nline two")
    assert rows[1].category is None and rows[0].case_id != rows[1].case_id
    cases_source.write_cases(cases, str(tmp_path / "cases"))
    again = cases_source.load_cases(spark, str(tmp_path / "cases"))
    assert again.columns == ["case_id", *schemas.CASE_COLUMNS]
    assert sorted(again.collect()) == sorted(rows)


def test_run_stats(spark, tmp_path):
    stats = {
        "model_name": "m", "trainable_params": 24_313_856, "total_params": 3_237_063_680, "trainable_pct": 0.75,
        "config": {"batch_size": 1, "learning_rate": 0.0002, "used_4bit": False}, "duration_seconds": 4028.0,
        "log_history": [{"loss": 2.0, "step": 10}, {"eval_loss": 1.0}, {"loss": 1.5}],
    }
    (tmp_path / "stats.json").write_text(json.dumps(stats))
    (tmp_path / "broken.json").write_text("{")
    runs = run_stats.load_run_stats(spark, str(tmp_path))
    assert set(by_file(run_stats.unreadable_run_stats(spark, str(tmp_path)).collect())) == {"broken"}
    row = runs.first()
    assert runs.count() == 1 and row.total_params == 3_237_063_680
    assert row.config["batch_size"] == "1" and row.config["used_4bit"] == "false"
    log = [tuple(r)[1:] for r in run_stats.run_log(runs).orderBy("seq").collect()]
    assert log == [(0, 10, 2.0), (1, None, None), (2, None, 1.5)]
    run_stats.write_run_stats(runs, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).first() == row


def test_scratch_table(spark):
    table = written(spark.range(5).withColumn("x", F.lit(None).cast("string")))
    assert table.count() == 5 and scratch_dir(spark) in table.inputFiles()[0]


def test_clear_written():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    table = written(spark.range(3))
    (file,) = {f.rsplit("/", 2)[0] for f in table.inputFiles()}
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert system.exists(path)
    clear_written(spark)
    assert not system.exists(path)


@pytest.mark.parametrize(
    "folder, master",
    [("/shared", "yarn"), (None, "local[2]"), (None, "yarn"), (None, "local-cluster[2,1,1024]")],
)
def test_scratch_folder(folder, master):
    class Session:
        class conf:
            get = staticmethod(lambda key, default: folder)

        class sparkContext:
            pass

    Session.sparkContext.master = master
    if folder:
        assert scratch_dir(Session) == folder
    elif master != "local[2]":
        with pytest.raises(ValueError):
            scratch_dir(Session)
    else:
        assert scratch_dir(Session) == scratch_dir(Session) != ""


def test_csv_keeps_every_text(spark, tmp_path):
    """Line breaks, quotes, backslashes, outer blanks; an empty text is a missing one."""
    texts = ['say "hi", now', "a\nb\r\nc", " outer ", "\\", '\\"', '"', "", None, "x,y", "\t", "#no comment", "é\U0001f600"]
    rows = [(f"q{i}", t, "c", t, None) for i, t in enumerate(texts)]
    cases = spark.createDataFrame(rows, schemas.CASES).repartition(3)
    cases_source.write_cases(cases, str(tmp_path / "csv"), "csv")
    loaded = cases_source.load_cases(spark, str(tmp_path / "csv"), "csv").collect()
    assert {r.instruction: (r.response, r.intent) for r in loaded} == {q: (t or None, i or None) for q, t, _, i, _ in rows}
    assert len({r.case_id for r in loaded}) == len(rows)
