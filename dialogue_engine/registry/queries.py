"""One query per operator, each over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.functions import chat, text
from dialogue_engine.functions.placeholders import (
    generic_placeholders,
    handle_placeholders,
    strip_placeholders,
)
from dialogue_engine.operators import (
    context,
    evaluate,
    fill,
    generate,
    heldout,
    prepare,
    profile,
    runs,
    split,
)
from dialogue_engine.registry import views
from dialogue_engine.registry.views import KEYWORDS, table
from dialogue_engine.scratch import new_folder, written
from dialogue_engine.sources.cases import load_cases, write_cases
from dialogue_engine.sources.evaluations import (
    load_eval_config,
    load_eval_metrics,
    load_eval_results,
    read_evaluations,
    write_results,
)
from dialogue_engine.sources.run_stats import load_run_stats, run_log, write_run_stats

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


def _pairs(spark, sf_dir):
    """Question and answer pairs; the case id names the turn that asked."""
    return prepare.pair_turns(_conversations(spark, sf_dir)).withColumn(
        "case_id", F.concat_ws(":", "conv_id", "turn")
    )


def _scores(spark, sf_dir):
    return evaluate.paired_scores(views.responses(spark, sf_dir), keywords=KEYWORDS)


def _wide(spark, sf_dir):
    return evaluate.side_by_side(views.responses(spark, sf_dir))


def _digest(df, *keys):
    return df.select(*keys, F.md5("text").alias("digest"), F.length("text").cast("long").alias("chars"))


# --- scoring ------------------------------------------------------------------------------


@query
def evaluation_metrics(spark, sf_dir):
    return evaluate.metrics_of_scores(_scores(spark, sf_dir))


@query
def evaluation_metrics_documents(spark, sf_dir):
    return evaluate.evaluation_metrics(views.document_responses(spark, sf_dir), keywords=KEYWORDS)


@query
def evaluation_record(spark, sf_dir):
    """Stored layout, from results of two modes: every second run has one model only. Each run is
    there again without any output, and once more with the fine-tuned ones failed."""
    wide = _wide(spark, sf_dir)
    single = F.col("run_id") % 2 == 1
    results = wide.select(
        "run_id",
        "prompt_id",
        F.when(~single, F.col("base_output")).alias("base_output"),
        F.when(~single, F.col("fine_tuned_output")).alias("fine_tuned_output"),
        F.when(single, F.col("base_output")).alias("ollama_output"),
        F.lit(False).alias("has_two"),
    )
    none = F.lit(None).cast("string")
    silent = results.select(
        (F.col("run_id") + 10).alias("run_id"), "prompt_id", none.alias("base_output"),
        none.alias("fine_tuned_output"), none.alias("ollama_output"), "has_two",
    )
    failed = wide.select(
        (F.col("run_id") + 20).alias("run_id"), "prompt_id", "base_output",
        none.alias("fine_tuned_output"), none.alias("ollama_output"), F.lit(True).alias("has_two"),
    )
    results = results.unionByName(silent).unionByName(failed)
    record = evaluate.metrics_record(evaluate.evaluate_results(results, KEYWORDS))
    stats = [c for c in record.columns if c.startswith("length_stats")]
    return record.select(
        *(c for c in record.columns if c not in stats),
        *(F.col(f"{s}.{p}").alias(f"{s}_{p}") for s in stats for p in ("min", "max", "avg", "std")),
    )


@query
def reply_scores(spark, sf_dir):
    return evaluate.score_replies(views.document_responses(spark, sf_dir), KEYWORDS).drop("run_id")


@query
def result_mode(spark, sf_dir):
    """Each prompt as a run of its own."""
    return evaluate.result_mode(views.result_rows(spark, sf_dir))


@query
def side_by_side(spark, sf_dir):
    return _wide(spark, sf_dir)


@query
def ab_delta(spark, sf_dir):
    return evaluate.ab_delta(_wide(spark, sf_dir), keywords=KEYWORDS)


@query
def ab_summary(spark, sf_dir):
    return evaluate.ab_summary(evaluate.ab_delta_of_scores(_scores(spark, sf_dir)))


@query
def comparison_table(spark, sf_dir):
    cells = views.responses(spark, sf_dir).withColumn(
        "output", text.excerpt(F.col("output"), C.OUTPUT_CELL_CHARS)
    )
    return evaluate.comparison_table(evaluate.side_by_side(cells))


@query
def metrics_by_test_type(spark, sf_dir):
    return evaluate.metrics_by_test_type(
        views.responses(spark, sf_dir), views.catalog(spark, sf_dir), KEYWORDS
    )


@query
def weak_intents(spark, sf_dir):
    return evaluate.weak_intents(
        views.document_responses(spark, sf_dir), views.cases(spark, sf_dir), 10, KEYWORDS
    )


@query
def metrics_by_lang(spark, sf_dir):
    replies = table(spark, sf_dir, "documents").select(
        "lang", "source", F.col("text").alias("output")
    )
    return evaluate.evaluation_metrics(replies, ("lang", "source"), KEYWORDS)


def _records(spark, sf_dir):
    """Computed records of all runs; two runs also have a stored one, partly filled."""
    computed = evaluate.metrics_record(evaluate.metrics_of_scores(_scores(spark, sf_dir)))
    stored = computed.where(F.col("run_id") >= 2).select(
        "run_id",
        *(
            (F.col(c) + 1000 if c == "num_prompts" else F.lit(0.0) if c == "relevance_score_base"
             else F.lit(0.5) if c == "relevance_score_ollama"
             else F.lit(None).cast(computed.schema[c].dataType)).alias(c)
            for c in computed.columns
            if c != "run_id"
        ),
    )
    return evaluate.metrics_or_recompute(stored, computed)


@query
def metrics_or_recompute(spark, sf_dir):
    return _records(spark, sf_dir).select(
        "run_id", "num_prompts", "avg_length_base", "relevance_score_base", "short_responses", "source"
    )


@query
def report_cards(spark, sf_dir):
    return evaluate.report_cards(_records(spark, sf_dir))


@query
def invalid_comparison(spark, sf_dir):
    """Each prompt as a run of its own; adapter state by the parity of the conversation."""
    modes = evaluate.result_mode(views.result_rows(spark, sf_dir))
    state = F.when(F.col("conv_id") % 3 == 0, F.lit(True)).when(F.col("conv_id") % 3 == 1, F.lit(False))
    configs = (
        _conversations(spark, sf_dir)
        .select(
            F.concat_ws(":", "conv_id", F.expr("turn div 4")).alias("run_id"),
            state.alias("adapter_loaded"),
        )
        .distinct()
    )
    return evaluate.invalid_comparison(modes, configs)


# --- text ---------------------------------------------------------------------------------


@query
def excerpts(spark, sf_dir):
    return _conversations(spark, sf_dir).select(
        "conv_id",
        "turn",
        text.excerpt(F.col("text"), 50, mark=True).alias("progress"),
        text.excerpt(F.col("text"), C.PROMPT_CELL_CHARS).alias("cell"),
    )


@query
def extract_reply(spark, sf_dir):
    """Model texts put together from a turn and the roles around it, with and without the word."""
    full = F.when(
        F.col("turn") % 3 == 0,
        F.concat(F.lit("system x user "), F.col("text"), F.lit(" assistant\n\n "), F.col("text"), F.lit(" <|end|> y")),
    ).otherwise(F.concat(F.lit(" "), F.col("text")))
    return _conversations(spark, sf_dir).select(
        "conv_id", "turn", text.extract_reply(full).alias("reply")
    )


@query
def reply_json(spark, sf_dir):
    """Event properties as reply bodies: wrapped ones, bare ones and cut ones."""
    props = F.col("props")
    quoted = F.regexp_replace(props, '"', "'")
    body = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"message":{"role":"assistant","content":"'), quoted, F.lit('"}}')))
        .when(F.col("event_id") % 3 == 1, props)
        .otherwise(F.concat(F.lit('{"message":{"content":"'), quoted))
    )
    return table(spark, sf_dir, "events").select("event_id", text.parse_reply_json(body).alias("r")).select(
        "event_id", "r.content", "r.bad_json"
    )


# --- preparation --------------------------------------------------------------------------


@query
def pair_turns(spark, sf_dir):
    return prepare.pair_turns(_conversations(spark, sf_dir))


@query
def pair_turns_with_gaps(spark, sf_dir):
    """Turn numbers with gaps, below 0 and far apart."""
    spread = (F.col("turn") - 2) * 1_000_003
    return prepare.pair_turns(_conversations(spark, sf_dir).withColumn("turn", spread))


@query
def number_turns(spark, sf_dir):
    """All turns, after their numbers were spread out."""
    spread = F.col("turn") * F.col("turn") * 70_001 - 5
    return prepare.number_turns(_conversations(spark, sf_dir).withColumn("turn", spread))


@query
def chat_rendered(spark, sf_dir):
    examples = prepare.to_messages(_pairs(spark, sf_dir))
    return _digest(
        examples.select("case_id", chat.render_chat(F.col("messages")).alias("text")), "case_id"
    )


@query
def messages_exploded(spark, sf_dir):
    return prepare.explode_messages(prepare.to_messages(_pairs(spark, sf_dir)))


@query
def length_band(spark, sf_dir):
    return prepare.length_band(views.cases(spark, sf_dir), "response", 57, 2470).select(
        "case_id", "category", "intent"
    )


@query
def in_scope(spark, sf_dir):
    wanted = prepare.in_scope(views.cases(spark, sf_dir), "category", ["de", "fr"])
    return wanted.select("case_id", "category", "intent")


@query
def dedupe(spark, sf_dir):
    kept = prepare.dedupe(views.flagged_cases(spark, sf_dir), ["flags", "category"])
    return kept.select("case_id", "flags", "category", "intent")


@query
def cap_per_template(spark, sf_dir):
    kept = prepare.cap_per_template(views.cases(spark, sf_dir), 2)
    return kept.select("case_id", F.md5("response").alias("response"), "intent")


@query
def fallback_union(spark, sf_dir):
    """Cases with out-of-scope examples made from the benchmark texts."""
    extra = table(spark, sf_dir, "benchmark").select(
        (-1 - F.col("item_id")).alias("case_id"), F.col("text").alias("instruction")
    )
    return prepare.add_fallback_examples(views.flagged_cases(spark, sf_dir), extra).select(
        "case_id",
        "instruction",
        F.md5("response").alias("response"),
        "category",
        "intent",
        "flags",
    )


# --- splits -------------------------------------------------------------------------------


@query
def random_split(spark, sf_dir):
    return split.random_split(views.cases(spark, sf_dir)).select("case_id", "is_eval")


@query
def random_split_approx(spark, sf_dir):
    return split.random_split(views.cases(spark, sf_dir), approx=True).select("case_id", "is_eval")


@query
def stratified_split(spark, sf_dir):
    return split.stratified_split(views.cases(spark, sf_dir), ["intent"]).select(
        "case_id", "intent", "is_eval"
    )


@query
def subset(spark, sf_dir):
    parts = split.split_parts(split.random_split(views.cases(spark, sf_dir)))
    train, evaluation = split.subset(*parts, 100)
    return train.select("case_id", F.lit("train").alias("part")).unionByName(
        evaluation.select("case_id", F.lit("eval").alias("part"))
    )


@query
def split_examples(spark, sf_dir):
    """Both parts as rendered training text."""
    train, evaluation = split.split_parts(split.random_split(_pairs(spark, sf_dir)))

    def rendered(part, name):
        texts = prepare.to_messages(part).select(
            "case_id", chat.render_chat(F.col("messages")).alias("text")
        )
        return _digest(texts, "case_id").withColumn("part", F.lit(name))

    return rendered(train, "train").unionByName(rendered(evaluation, "eval"))


@query
def eval_coverage(spark, sf_dir):
    """Combinations of language and source without an eval example in a plain split."""
    labelled = views.cases(spark, sf_dir).withColumn("intent", F.concat_ws("/", "category", "intent"))
    return split.eval_coverage(*split.split_parts(split.random_split(labelled)))


@query
def review_sample(spark, sf_dir):
    return split.review_sample(views.cases(spark, sf_dir)).select(
        "case_id", F.md5("response").alias("response")
    )


# --- context and generation ---------------------------------------------------------------


def _context_digest(contexts):
    rendered = chat.render_chat(F.col("messages"), add_generation_prompt=True)
    return _digest(contexts.withColumn("text", rendered), "conv_id", "turn")


@query
def chat_context(spark, sf_dir):
    return _context_digest(context.chat_context(_conversations(spark, sf_dir)))


@query
def chat_context_shifted(spark, sf_dir):
    """Turns from below 0 to beyond the first block."""
    shifted = F.col("turn") * 101 - 150
    return _context_digest(
        context.chat_context(_conversations(spark, sf_dir).withColumn("turn", shifted))
    )


@query
def chat_context_last4(spark, sf_dir):
    return _context_digest(context.chat_context(_conversations(spark, sf_dir), last_k=4))


def _open_messages(spark, sf_dir):
    """History, and the last message of each conversation that ends with the user."""
    turns = _conversations(spark, sf_dir)
    ends = turns.groupBy("conv_id").agg(
        F.max("turn").alias("turn"), F.max(F.when(F.col("role") == "user", F.col("turn"))).alias("asked")
    )
    ends = ends.where("turn = asked").select("conv_id", "turn")
    history = turns.join(ends, ["conv_id", "turn"], "left_anti")
    messages = turns.join(ends, ["conv_id", "turn"]).select("conv_id", F.col("text").alias("message"))
    return history, messages


@query
def append_reply(spark, sf_dir):
    """Two exchanges for each open conversation."""
    history, messages = _open_messages(spark, sf_dir)
    reply = F.concat(F.lit("Re: "), F.col("message"))
    first = messages.withColumn("reply", reply).withColumn("seq", F.lit(1))
    second = first.withColumn("message", F.lit("And?")).withColumn("seq", F.lit(2))
    return context.append_reply(history, first.unionByName(second), ["seq"])


@query
def request_context(spark, sf_dir):
    history, messages = _open_messages(spark, sf_dir)
    asked = context.request_context(history, messages)
    rendered = chat.render_chat(F.col("messages"), add_generation_prompt=True)
    return _digest(asked.withColumn("text", rendered), "conv_id")


@query
def request_gate(spark, sf_dir):
    """Every message once as it is and once blank."""
    asked = views.requests(spark, sf_dir)
    blank = asked.withColumn("message", F.lit(" \t　")).withColumn("turn", -F.col("turn") - 1)
    gated = context.request_gate(asked.unionByName(blank))
    return gated.select("conv_id", "turn", F.md5("message").alias("message"), "max_tokens")


@query
def request_json(spark, sf_dir):
    """Request bodies of all user turns, read back field by field."""
    asked = context.request_gate(views.requests(spark, sf_dir))
    limit = F.when(F.col("conv_id") % 2 == 0, F.col("max_tokens"))
    asked = generate.prompt_messages(asked.withColumn("prompt", F.col("message")))
    body = F.col("request")
    return context.build_requests(asked.withColumn("max_tokens", limit), "m1").select(
        "conv_id",
        "turn",
        F.get_json_object(body, "$.model").alias("model"),
        F.get_json_object(body, "$.stream").alias("stream"),
        F.md5(F.get_json_object(body, "$.messages[1].content")).alias("content"),
        F.get_json_object(body, "$.options.num_predict").cast("long").alias("num_predict"),
        F.contains(body, F.lit('"options"')).alias("has_options"),
    )


def _stub(prefix):
    """A model for tests: says how many messages it saw and repeats the last one."""

    def load():
        def run(conversations):
            if any(len(c[-1]["content"]) % 7 == 0 for c in conversations):
                raise ValueError("seven")
            return [f"{prefix} {len(c)}: {c[-1]['content']}" for c in conversations]

        return run

    return load


@query
def fan_out_generate(spark, sf_dir):
    prompts = views.requests(spark, sf_dir).withColumn("prompt", F.col("message"))
    models = {"base": _stub("b"), "fine_tuned": _stub("f")}
    asked = generate.prompt_messages(generate.fan_out(prompts, list(models)))
    # a number that a double cannot hold, next to nulls
    large = F.when(F.col("turn") % 3 > 0, F.lit(9_007_199_254_740_993) + F.col("conv_id"))
    asked = asked.withColumn("large", large).select("conv_id", "turn", "large", "model", "messages")
    answered = generate.batch_generate(asked, models)
    return answered.select("conv_id", "turn", "large", "model", "output", "error")


# --- placeholders -------------------------------------------------------------------------


@query
def placeholder_inventory(spark, sf_dir):
    return fill.placeholder_inventory(views.order_texts(spark, sf_dir))


@query
def placeholder_generic(spark, sf_dir):
    return views.order_texts(spark, sf_dir).select(
        "o_orderkey", generic_placeholders(F.col("text")).alias("text")
    )


@query
def placeholder_strip(spark, sf_dir):
    return views.order_texts(spark, sf_dir).select(
        "o_orderkey", strip_placeholders(F.col("text")).alias("text")
    )


@query
def placeholder_fill(spark, sf_dir):
    """Order texts with the customer's name from its table; number and state of the order come
    from a second pass over the row's own table."""
    texts = views.order_texts(spark, sf_dir)
    named = fill.fill_placeholders(
        texts, table(spark, sf_dir, "customer"), "c_custkey", {"Customer": "c_name"}
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    values = orders.withColumn("number", F.col("o_orderkey"))
    filled = fill.fill_placeholders(
        named, values, "o_orderkey", {"Order Number": "number", "Status": "status"}
    )
    return filled.select("o_orderkey", "text")


@query
def placeholder_keep(spark, sf_dir):
    return views.order_texts(spark, sf_dir).select(
        "o_orderkey", handle_placeholders(F.col("text"), "keep").alias("text")
    )


# --- Python functions and sources ---------------------------------------------------------


@query
def token_counts(spark, sf_dir):
    """Lengths from a Python function, as a tokenizer would give them."""
    tokens = generate.token_count(lambda texts: [len(t.split()) for t in texts])
    return table(spark, sf_dir, "documents").select("doc_id", tokens(F.col("text")).alias("tokens"))


@query
def mapped_rows(spark, sf_dir):
    turns = _conversations(spark, sf_dir)
    return generate.map_rows(
        turns,
        lambda batch: batch.assign(chars=batch["text"].str.len())[["conv_id", "turn", "chars"]],
        "conv_id bigint, turn bigint, chars bigint",
    )


@query
def cases_with_ids(spark, sf_dir):
    """Cases stored without ids and loaded again: the ids are unique and the rest is as it was."""
    stored = written(views.flagged_cases(spark, sf_dir).drop("case_id"))
    loaded = load_cases(spark, stored.inputFiles()[0].rsplit("/", 1)[0])
    ids = loaded.groupBy("case_id").agg(F.count(F.lit(1)).alias("uses"))
    return loaded.join(ids, "case_id").select(
        "instruction", F.md5("response").alias("response"), "category", "intent", "flags", "uses"
    )


# --- held-out prompts ---------------------------------------------------------------------


@query
def held_out(spark, sf_dir):
    """Benchmark items, and every document with other blanks or another ending, against the
    documents."""
    documents = table(spark, sf_dir, "documents")
    varied = F.when(
        F.col("doc_id") % 2 == 0,
        F.concat(F.lit(" "), F.replace("text", F.lit(" "), F.lit("\n ")), F.lit("\t")),
    ).otherwise(F.concat("text", F.lit(" new")))
    prompts = (
        table(spark, sf_dir, "benchmark")
        .select((-1 - F.col("item_id")).alias("prompt_id"), F.col("text").alias("prompt"))
        .unionByName(documents.select(F.col("doc_id").alias("prompt_id"), varied.alias("prompt")))
    )
    kept = heldout.held_out(prompts, documents, instruction="text")
    return kept.select("prompt_id", F.md5("prompt").alias("prompt"))


@query
def held_out_overlap(spark, sf_dir):
    """Benchmark items and all documents, two thirds of them changed, against all documents."""
    documents = table(spark, sf_dir, "documents")
    changed = (
        F.when(F.col("doc_id") % 3 == 0, F.replace("text", F.lit("an"), F.lit("on")))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("New "), F.replace("text", F.lit(" "), F.lit("  ")), F.lit("\tnew")))
        .otherwise(F.col("text"))
    )
    prompts = (
        table(spark, sf_dir, "benchmark")
        .select((-1 - F.col("item_id")).alias("prompt_id"), F.col("text").alias("prompt"))
        .unionByName(documents.select(F.col("doc_id").alias("prompt_id"), changed.alias("prompt")))
    )
    return heldout.held_out_overlap(prompts, documents, instruction="text")


@query
def held_out_overlap_items(spark, sf_dir):
    """Benchmark items alone, which are few enough for the pre-filter, in runs of 13 words."""
    prompts = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("prompt_id"), F.col("text").alias("prompt")
    )
    return heldout.held_out_overlap(
        prompts, table(spark, sf_dir, "documents"), n=13, instruction="text"
    )


# --- training runs ------------------------------------------------------------------------


@query
def loss_series(spark, sf_dir):
    return runs.loss_series(views.run_log(spark, sf_dir))


@query
def loss_scaled(spark, sf_dir):
    return runs.loss_scaled(views.run_log(spark, sf_dir))


@query
def loss_summary(spark, sf_dir):
    return runs.loss_summary(views.run_log(spark, sf_dir))


@query
def trainable_share(spark, sf_dir):
    parameters = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("model_name"),
        F.col("p_size").alias("size"),
        (F.col("p_partkey") % 7 == 0).alias("trainable"),
    )
    return runs.trainable_share(parameters)


@query
def cost_proxy(spark, sf_dir):
    """Seconds between first and last event of a user as the run's duration."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp"))
    trained = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("run_id")).agg(
        ((F.max(seconds) - F.min(seconds)) / 1e6).alias("duration_seconds"),
        F.count_if(F.col("event_type") == "view").alias("views"),
    )
    known = trained.withColumn("trainable_params", (F.col("views") * (F.col("run_id") % 3) * 1_000_000).cast("long"))
    return runs.cost_proxy(known).select("run_id", "trainable_params", "cost_proxy")


# --- profiles -----------------------------------------------------------------------------


@query
def distribution(spark, sf_dir):
    return profile.distribution(views.flagged_cases(spark, sf_dir))


@query
def length_profile(spark, sf_dir):
    return profile.length_profile(views.cases(spark, sf_dir))


@query
def longest_cases(spark, sf_dir):
    return profile.longest_cases(views.cases(spark, sf_dir), 20).select("case_id", "intent", "chars")


@query
def truncation_monitor(spark, sf_dir):
    """Lengths of the rendered examples, which is what the limit holds for."""
    examples = prepare.to_messages(views.cases(spark, sf_dir), keys=("case_id", "intent"))
    return profile.truncation_monitor(examples, chat.render_chat(F.col("messages")))


@query
def table_profile(spark, sf_dir):
    return profile.table_profile(views.flagged_cases(spark, sf_dir))


@query
def preview(spark, sf_dir):
    return profile.preview(table(spark, sf_dir, "documents"), 3, ["doc_id"], offset=5)


@query
def preview_far(spark, sf_dir):
    rows = profile.preview(table(spark, sf_dir, "orders"), 25, ["o_orderkey"], offset=12_000)
    return rows.select("o_orderkey", "o_custkey", "o_orderpriority")


@query
def distribution_totals(spark, sf_dir):
    return profile.distribution(views.flagged_cases(spark, sf_dir), totals=True)


@query
def in_scope_table(spark, sf_dir):
    """Cases stored by category, and a selection table computed from them."""
    folder = new_folder(spark)
    views.cases(spark, sf_dir).write.partitionBy("category").parquet(f"{folder}/cases")
    cases = spark.read.parquet(f"{folder}/cases")
    selection = written(cases.groupBy("category").count()).where(F.col("count") % 2 == 0)
    kept = prepare.in_scope_of(cases, selection, "category")
    return kept.select("case_id", "category", F.md5("response").alias("response"))


# --- stored runs --------------------------------------------------------------------------


@query
def cases_from_csv(spark, sf_dir):
    """Cases stored as CSV, whole texts with their line breaks, and loaded again."""
    folder = new_folder(spark)
    write_cases(views.flagged_cases(spark, sf_dir).drop("case_id"), folder, "csv")
    loaded = load_cases(spark, folder, "csv")
    ids = loaded.groupBy("case_id").agg(F.count(F.lit(1)).alias("uses"))
    response = F.md5(text.text_or_empty(F.col("response")))
    return loaded.join(ids, "case_id").select(
        "instruction", response.alias("response"), "category", "intent", "flags", "uses"
    )


@query
def resumed_answers(spark, sf_dir):
    """A third of the prompts is answered by a first start, the rest by the next one."""
    prompts = views.requests(spark, sf_dir).select(
        F.concat_ws(":", "conv_id", "turn").alias("prompt_id"), "conv_id", F.col("message").alias("prompt")
    )
    asked = generate.prompt_messages(generate.fan_out(prompts, ["single"]))
    store = f"{new_folder(spark)}/answers"

    def model(name):
        return lambda: lambda talks: [f"{name} {len(t)}: {t[-1]['content']}" for t in talks]

    first = asked.where(F.col("conv_id") % 3 == 0)
    generate.resume_generate(first, {"single": model("first")}, store, steps=2)
    answered = generate.resume_generate(asked, {"single": model("again")}, store, steps=2)
    return answered.select("prompt_id", "output", "error")


@query
def results_written(spark, sf_dir):
    """All runs are written, then half of them again with other outputs."""
    path = f"{new_folder(spark)}/responses"
    replies = views.responses(spark, sf_dir).withColumn("run_id", F.col("run_id").cast("string"))
    write_results(replies, path)
    again = replies.where(F.col("run_id") % 2 == 0)
    write_results(again.withColumn("output", F.concat(F.lit("new "), "output")), path)
    found = spark.read.schema(replies.schema).parquet(path)
    return found.select("run_id", "prompt_id", "model", F.md5("output").alias("output"))


def _run_of(path):
    """The number in the name of a run's folder."""
    return F.regexp_extract(path, "run=([0-9]+)", 1).cast("long").alias("run")


def _evaluations(spark, sf_dir):
    """Assistant turns as evaluation files of 40 conversations: two models with a configuration, one
    model without, or a bare list of results, in turn. A third of the entries lacks an output."""
    entry = F.struct(
        "conv_id",
        "turn",
        F.concat_ws(":", "conv_id", "turn").alias("prompt"),
        F.when(F.col("shape") != 1, F.col("text")).alias("base_output"),
        F.when((F.col("shape") != 1) & (F.col("turn") % 3 != 0), F.concat("text", F.lit("!"))).alias(
            "fine_tuned_output"
        ),
        F.when(F.col("shape") == 1, F.col("text")).alias("ollama_output"),
    )
    kept = ("prompt", "base_output", "fine_tuned_output", "ollama_output")
    longest = F.max(F.length("text")).cast("double")
    files = (
        _conversations(spark, sf_dir)
        .where("role = 'assistant'")
        .withColumn("run", F.expr("conv_id div 40"))
        .withColumn("shape", F.col("run") % 3)
        .groupBy("run", "shape")
        .agg(
            F.array_sort(F.collect_list(entry)).alias("entries"),
            F.struct(
                F.count(F.lit(1)).alias("num_prompts"),
                F.when(F.col("shape") == 0, longest).alias("avg_length_base"),
                F.when(F.col("shape") == 1, longest).alias("avg_length_ollama"),
                F.struct(F.min(F.length("text")).alias("min")).alias("length_stats_base"),
            ).alias("metrics"),
        )
    )
    results = F.transform("entries", lambda e: F.struct(*(e[c].alias(c) for c in kept)))
    even = F.col("run") % 2 == 0
    config = F.struct(
        F.concat(F.lit("m"), F.col("run").cast("string")).alias("base_model"),
        F.when(even, F.concat(F.lit("a"), F.col("run").cast("string"))).alias("adapter_path"),
        even.alias("adapter_loaded"),
    )
    whole = F.struct(
        results.alias("results"),
        "metrics",
        F.when(F.col("shape") == 0, config).alias("evaluation_config"),
    )
    folder = new_folder(spark)
    text = F.when(F.col("shape") == 2, F.to_json(results)).otherwise(F.to_json(whole))
    files.select("run", text.alias("value")).write.partitionBy("run").text(folder)
    return written(read_evaluations(spark, f"{folder}/*"))


@query
def evaluation_files(spark, sf_dir):
    run = _run_of("run_id")
    return load_eval_results(_evaluations(spark, sf_dir)).select(
        run,
        (run % 3).alias("shape"),
        "prompt_id",
        "prompt",
        *(F.md5(c).alias(c) for c in ("base_output", "fine_tuned_output", "ollama_output")),
        "has_two",
    )


@query
def evaluation_file_metrics(spark, sf_dir):
    return load_eval_metrics(_evaluations(spark, sf_dir)).select(
        _run_of("run_id"),
        "num_prompts",
        "avg_length_base",
        "avg_length_ollama",
        F.col("length_stats_base.min").alias("shortest"),
    )


@query
def evaluation_file_configs(spark, sf_dir):
    configs = load_eval_config(_evaluations(spark, sf_dir))
    return configs.select(_run_of("run_id"), "base_model", "adapter_path", "adapter_loaded")


def _run_stats(spark, sf_dir):
    """Events of 25 users as a training run with its log, one file each."""
    even = F.col("run") % 2 == 0
    size = F.col("event_id") % 1000 + 4294967296
    entry = F.struct(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("step"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("loss"),
    )
    stats = (
        table(spark, sf_dir, "events")
        .withColumn("run", F.expr("user_id div 25"))
        .groupBy("run")
        .agg(
            F.array_sort(F.collect_list(entry)).alias("entries"),
            F.sum(F.when(F.col("event_type") == "click", size).otherwise(0)).alias("trainable_params"),
            F.sum(size).alias("total_params"),
            F.max("event_id").cast("double").alias("duration_seconds"),
            F.max("user_id").alias("batch_size"),
        )
    )
    whole = F.struct(
        F.concat(F.lit("m"), F.col("run").cast("string")).alias("model_name"),
        "trainable_params",
        "total_params",
        F.struct("batch_size", even.alias("used_4bit")).alias("config"),
        "duration_seconds",
        F.transform("entries", lambda e: F.struct(e["step"].alias("step"), e["loss"].alias("loss"))).alias(
            "log_history"
        ),
    )
    folder = new_folder(spark)
    stats.select("run", F.to_json(whole).alias("value")).write.partitionBy("run").text(f"{folder}/files")
    # stored once more as the library stores them
    write_run_stats(load_run_stats(spark, f"{folder}/files/*"), f"{folder}/stored")
    return spark.read.parquet(f"{folder}/stored")


@query
def run_stats_files(spark, sf_dir):
    return _run_stats(spark, sf_dir).select(
        _run_of("run_id"),
        "model_name",
        "trainable_params",
        "total_params",
        "duration_seconds",
        *(F.col("config")[c].alias(c) for c in ("batch_size", "used_4bit")),
    )


@query
def run_stats_log(spark, sf_dir):
    return run_log(_run_stats(spark, sf_dir)).select(_run_of("run_id"), "seq", "step", "loss")
