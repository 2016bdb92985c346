"""Registered queries against their SQL, and the pipeline stage by stage."""

import os

import public_tokenizers
import pytest
from compare import connect, difference
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from dialogue_engine.llm import decontaminate, line_chunks, ngram_join, toxicity
from dialogue_engine.llm.oracles import ORACLES
from dialogue_engine.llm.queries import QUERIES
from dialogue_engine.scratch import written

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, db, name):
    assert difference(spark, db, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    for number in range(1, 14):
        assert sum(n.startswith(f"op{number}_") for n in QUERIES) == 1
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op2_benchmark_decontamination", "op10_suffix_dedup", "op12_embedding_whitening"}))
def test_a_row_for_each_row(spark, name):
    table = "pages" if name.startswith("op9") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    source = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    got = QUERIES[name](spark, SF_DIR)
    if name.startswith("op7"):
        got = got.where("start = 0")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in source.select(key).collect())


def test_whitened_rows(spark):
    """Every usable vector has a row per component; the values are tested against numpy."""
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    got = QUERIES["op12_embedding_whitening"](spark, SF_DIR)
    assert dict(got.dtypes)["deviation"] == "bigint"
    rows = got.collect()
    assert sorted((r.vec_id, r.component) for r in rows) == sorted(
        (r.vec_id, c) for r in vectors.collect() for c in range(1, 9)
    )
    assert max(r.identity_error for r in rows) < 1e-10 and all(r.deviation > 0 for r in rows)


def test_pipeline(spark):
    """Each stage on what the stage before it kept, against the operators' own reports."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    assert len(stages) == 5
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    clean = written(stages[0](spark, docs, SF_DIR))
    scores = toxicity.toxicity(docs, labels).where("predicted = 0")
    assert clean.columns == columns and ids(clean) == ids(scores)

    lines = written(stages[1](spark, clean, SF_DIR))
    assert lines.columns == columns and ids(lines) == ids(clean)
    assert {r.doc_id: r.text for r in lines.collect()} == {
        r.doc_id: r.text for r in line_chunks.drop_repeated_lines(clean).collect()
    }

    single = written(stages[2](spark, lines, SF_DIR))
    found = ngram_join.near_duplicates(lines).where("doc_id = component_id")
    assert single.columns == columns and ids(single) == ids(found)

    free = written(stages[3](spark, single, SF_DIR))
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    hit = {r.doc_id for r in decontaminate.contaminations(single, items).collect()}
    assert free.columns == columns and ids(free) == [i for i in ids(single) if i not in hit]

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stages[4](spark, free, SF_DIR).collect()
    sizes = {}
    for r in pieces:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    texts = {r.doc_id: r.text for r in free.collect()}
    assert sizes == {
        i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts.items()
    }
    assert sorted(sizes) == sorted({r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()})
