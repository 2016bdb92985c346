"""What the physical plans must and must not contain."""

import os
import re

import pytest
from helpers import plan
from pyspark.sql import functions as F

from dialogue_engine.operators import context, prepare
from dialogue_engine.registry import views
from dialogue_engine.registry.queries import QUERIES
from dialogue_engine.sources.cases import load_cases, write_cases

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PYTHON = re.compile(r"MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture
def as_planned(spark):
    """Plans without run-time changes and without broadcasts, as for large tables."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: plan(QUERIES[name](spark, SF_DIR))
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_python_only_for_models(spark, as_planned, name):
    text = as_planned(name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    with_python = ("fan_out_generate", "token_counts", "mapped_rows")
    assert bool(PYTHON.search(text)) == (name in with_python)


def test_scores_take_one_scan_and_one_shuffle(as_planned):
    text = as_planned("evaluation_metrics_documents")
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "partial_stddev_samp" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["evaluation_metrics", "ab_summary", "report_cards", "result_mode"])
def test_scores_move_no_text(as_planned, name):
    text = as_planned(name)
    assert "SortAggregate" not in text
    for line in text.splitlines():
        if "Aggregate" in line and "partial_" in line:
            assert "max(output" not in line and "struct(chars" not in line


def test_held_out_writes_nothing_and_hashes_once(as_planned):
    text = as_planned("held_out")
    assert "/tables/" not in text and text.count("md5(") <= 5


def test_random_split_moves_no_rows(as_planned):
    text = as_planned("random_split")
    assert "Exchange" not in text and "Sort" not in text
    assert "ReadSchema: struct<doc_id:bigint>" in text


def test_filter_reaches_the_scan(as_planned):
    assert re.search(r"PushedFilters: \[[^\]]*In\(lang", as_planned("in_scope"))


def test_dedupe_limits_rows_before_the_shuffle(as_planned):
    text = as_planned("dedupe")
    assert text.index("Exchange hashpartitioning(flags") < text.index(", Partial")


def test_positions_shuffle_the_rows_once(as_planned):
    text = as_planned("loss_series")
    joined = text[text.index("SortMergeJoin"):]
    left = joined[: joined.index("FileScan")]
    assert left.count("Exchange") == 1


def test_pairs_are_joined_on_conversation_and_turn(as_planned):
    text = as_planned("pair_turns")
    assert re.search(r"Exchange hashpartitioning\(__key#\d+", text)
    assert not re.search(r"Exchange hashpartitioning\(conv_id#\d+L?, \d+\)", text.split("__bucket")[0])


def test_context_is_partitioned_by_block(as_planned):
    assert re.search(r"Exchange hashpartitioning\(__key#\d+", as_planned("chat_context"))


def test_requests_pass_on_only_the_last_turns(spark, as_planned):
    turns = views.table(spark, SF_DIR, "conversations")
    asked = turns.select("conv_id").distinct().withColumn("message", F.lit("q"))
    text = plan(context.request_context(turns, asked, last_k=3))
    assert re.search(r"Exchange hashpartitioning\(conv_id#\d+L, __part", text)
    assert re.search(r"Exchange hashpartitioning\(conv_id#\d+L, turn", text)


def test_cases_read_only_needed_columns(spark):
    text = plan(views.cases(spark, SF_DIR).select("case_id"))
    assert "ReadSchema: struct<doc_id:bigint>" in text


def test_selection_prunes_folders(spark, tmp_path):
    """Only the folders of chosen categories are read."""
    cases = views.cases(spark, SF_DIR)
    cases.write.partitionBy("category").parquet(str(tmp_path / "cases"))
    stored = spark.read.parquet(str(tmp_path / "cases"))
    categories = stored.select("category").distinct().withColumn("wanted", F.col("category").isin("de", "fr").cast("int"))
    categories.write.parquet(str(tmp_path / "chosen"))
    chosen = spark.read.parquet(str(tmp_path / "chosen")).where("wanted = 1")
    kept = prepare.in_scope_of(stored, chosen, "category")
    assert "dynamicpruning" in plan(kept)
    assert {r.category for r in kept.select("category").distinct().collect()} == {"de", "fr"}
    assert kept.count() == cases.where("category in ('de', 'fr')").count()
    twice = chosen.unionByName(chosen).select("category").unionByName(spark.sql("select cast(null as string) category"))
    assert prepare.in_scope_of(stored, twice, "category").count() == kept.count()


def test_csv_ids_move_no_text(spark, tmp_path):
    write_cases(views.flagged_cases(spark, SF_DIR).drop("case_id"), str(tmp_path / "csv"), "csv")
    text = plan(load_cases(spark, str(tmp_path / "csv"), "csv"))
    assert "Window" not in text
    counted = text[text.index("HashAggregate") :]
    assert "response" not in counted.split("FileScan")[0]


def test_few_prompts_are_looked_up_where_the_data_is(as_planned):
    text = as_planned("held_out_overlap_items")
    assert "getbit" in text and "array_join" not in text
    assert "getbit" not in as_planned("held_out_overlap") or os.path.basename(SF_DIR) == "sf0.001"
