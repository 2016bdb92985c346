import pytest
from pyspark.sql import functions as F

from dialogue_engine.operators import generate
from dialogue_engine.operators.profile import truncation_monitor


def prompts(spark, n=20):
    return spark.range(n).select(
        F.col("id").alias("prompt_id"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt")
    )


@pytest.fixture
def load():
    """Loaders by name. Nested functions are shipped to the workers as they are."""

    def echo():
        return lambda conversations: [c[-1]["content"].upper() for c in conversations]

    def failing():
        def run(conversations):
            if any(c[-1]["content"] == "p3" for c in conversations):
                raise RuntimeError("no p3")
            return [c[0]["role"] for c in conversations]

        return run

    def short():
        return lambda conversations: ["one"]

    return {"echo": echo, "failing": failing, "short": short}


def test_fan_out_and_generate(spark, load):
    models = {"base": load["echo"], "fine_tuned": load["failing"]}
    asked = generate.prompt_messages(generate.fan_out(prompts(spark), list(models)))
    rows = generate.batch_generate(asked, models, partitions=3).collect()
    assert len(rows) == 40
    assert all(r.output == r.prompt.upper() and r.error is None for r in rows if r.model == "base")
    tuned = {r.prompt: (r.output, r.error) for r in rows if r.model == "fine_tuned"}
    assert tuned.pop("p3") == (None, "RuntimeError: no p3")
    assert set(tuned.values()) == {("system", None)}


def test_wrong_number_of_replies_falls_back_to_single_calls(spark, load):
    asked = generate.prompt_messages(generate.fan_out(prompts(spark, 3), ["single"]))
    rows = generate.batch_generate(asked, {"single": load["short"]}).collect()
    assert [r.output for r in rows] == ["one"] * 3


def test_a_model_is_loaded_once_per_task(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return lambda conversations: ["x"] * len(conversations)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    asked = generate.prompt_messages(generate.fan_out(prompts(spark, 100).coalesce(1), ["single"]))
    assert generate.batch_generate(asked, {"single": load}).count() == 100
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert loads.value == 1


def test_token_count_and_monitor(spark):
    df = spark.createDataFrame([("a b c", "x"), (None, "x"), ("a", "y")], "response string, intent string")
    native = truncation_monitor(df, F.col("response"), 2)
    counted = truncation_monitor(
        df, F.col("response"), 2, tokens=generate.token_count(lambda texts: [len(t.split()) for t in texts])
    )
    expected = {("x", 2, 3, 1, 0.5), ("y", 1, 1, 0, 0.0)}
    assert {tuple(r) for r in native.collect()} == {tuple(r) for r in counted.collect()} == expected


def test_map_rows(spark):
    mapped = generate.map_rows(
        prompts(spark, 3), lambda batch: batch.assign(n=batch["prompt"].str.len())[["n"]], "n long"
    )
    assert [r.n for r in mapped.collect()] == [2, 2, 2]


def test_large_numbers_next_to_nulls(spark, load):
    df = spark.range(40).select(
        F.when(F.col("id") % 3 > 0, F.col("id") + 9_007_199_254_740_993).alias("n"),
        F.lit("echo").alias("model"),
        F.array(F.struct(F.lit("user").alias("role"), F.col("id").cast("string").alias("content"))).alias("messages"),
    )
    out = generate.batch_generate(df, {"echo": load["echo"]}, batch_size=7).collect()
    assert sorted((r.n is None, r.n) for r in out) == sorted((r.n is None, r.n) for r in df.collect())
    assert all(r.output == r.messages[0].content and r.error is None for r in out)


def requests(spark, n=40):
    return generate.prompt_messages(generate.fan_out(prompts(spark, n), ["a", "b"]))


def counted(spark, fail=()):
    """Models that note what they were asked, and fail for some prompts."""
    seen = spark.sparkContext.accumulator(0)

    def load(name):
        def loaded():
            def run(conversations):
                texts = [c[-1]["content"] for c in conversations]
                if any(t in fail for t in texts):
                    raise ValueError("no")
                seen.add(len(texts))
                return [f"{name}:{t}" for t in texts]

            return run

        return loaded

    return seen, {name: load(name) for name in "ab"}


def test_resume_asks_only_what_is_open(spark, tmp_path):
    store = str(tmp_path / "answers")
    some = requests(spark).where("prompt_id % 3 = 0")
    seen, load = counted(spark)
    assert generate.resume_generate(some, load, store).count() == some.count()
    assert seen.value == some.count()
    rows = generate.resume_generate(requests(spark), load, store, steps=3).collect()
    assert seen.value == 80 and len(rows) == 80
    assert all(r.output == f"{r.model}:{r.prompt}" and r.error is None for r in rows)
    assert generate.resume_generate(requests(spark), load, store).count() == 80 and seen.value == 80


def test_resume_after_a_crash(spark, tmp_path):
    """The writer of the third part fails: two parts stay, and what they hold is not asked again."""
    store = str(tmp_path / "answers")
    seen, load = counted(spark)
    keep, calls = generate.batch_generate, []

    def crash(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        return keep(*args)

    generate.batch_generate = crash
    try:
        with pytest.raises(RuntimeError):
            generate.resume_generate(requests(spark), load, store, steps=4)
    finally:
        generate.batch_generate = keep
    stored = spark.read.parquet(store).count()
    assert seen.value == stored and 0 < stored < 80
    rows = generate.resume_generate(requests(spark), load, store, steps=4).collect()
    assert seen.value == 80 and {r.output for r in rows} == {f"{m}:p{i}" for m in "ab" for i in range(40)}


def test_resume_retries_errors_and_changed_prompts(spark, tmp_path):
    store = str(tmp_path / "answers")
    seen, load = counted(spark, fail={"p1", "p2"})
    first = generate.resume_generate(requests(spark, 5), load, store).collect()
    assert {(r.prompt, r.error) for r in first if r.error} == {("p1", "ValueError: no"), ("p2", "ValueError: no")}
    again, works = counted(spark)
    kept = generate.resume_generate(requests(spark, 5), works, store, retry_errors=False).collect()
    assert again.value == 0 and sum(r.error is not None for r in kept) == 4
    changed = requests(spark, 5).withColumn("prompt", F.concat("prompt", F.when(F.col("prompt_id") == 3, "!").otherwise("")))
    rows = generate.resume_generate(generate.prompt_messages(changed), works, store).collect()
    # two prompts that failed and one that is another now, through two models
    assert again.value == 6 and all(r.error is None and r.output == f"{r.model}:{r.prompt}" for r in rows)


def test_resume_asks_equal_requests_once(spark, tmp_path):
    seen, load = counted(spark)
    twice = requests(spark, 4).unionByName(requests(spark, 4))
    twice = twice.withColumn("prompt_id", F.when(F.col("prompt_id") > 0, F.col("prompt_id")))
    rows = generate.resume_generate(twice, load, str(tmp_path / "answers")).collect()
    assert len(rows) == 16 and seen.value == 8
    assert {(r.prompt_id, r.output) for r in rows if r.model == "a"} == {(None, "a:p0"), (1, "a:p1"), (2, "a:p2"), (3, "a:p3")}
    empty = generate.resume_generate(requests(spark, 0), load, str(tmp_path / "none"))
    assert empty.collect() == [] and empty.columns == [*requests(spark, 0).columns, "output", "error"]
