"""Secrets in texts, found through an inverted index of trigrams. DataFrame functions only.

From each rule's pattern a Boolean query is derived: alternatives of which one must hold, each a
set of trigrams that every match contains. The index lists, for the trigrams of all queries, the
documents whose lower-cased text has them. A query is answered by intersecting lists: the
postings of a document are counted per alternative, where a document's postings meet in the
task that made them, so a trigram that a third of all documents have is never gathered.
Documents that answer a rule's query are verified with its pattern. A rule without mandatory
trigrams, such as runs of hex digits, is verified on every text.

Positions are counted in code points and come from Spark's own functions: the pieces between
matches and the matches themselves, in turn, add up to where each match begins.
"""

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogue_engine.llm.tables import dealt, document_key, unused
from dialogue_engine.scratch import written

# Alternatives a query may have before it is given up for a weaker one.
MOST_ALTERNATIVES = 64
# Numbers summed up in one array.
PART = 256


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are found leftmost and without overlap, and those of which the
    given group has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, in the order of their listing, and the kinds added to them.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
ADDED_RULES = (
    Rule("private", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,255}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + ADDED_RULES


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each the lower-case trigrams that a match has. Empty: nothing is mandatory.

    Literals next to each other form strings; an alternation or a small character set
    multiplies them; anything that may be absent or is open-ended ends them.
    """
    runs = _literal_runs(list(re._parser.parse(pattern)))
    query: list[frozenset[str]] = [frozenset()]
    for strings in runs:
        options = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() in options or len(query) * len(options) > MOST_ALTERNATIVES:
            continue
        query = [known | option for known in query for option in options]
    return [] if query == [frozenset()] else query


def _literal_runs(items: Sequence) -> list[set[str]]:
    """The strings that stand at each stretch of a pattern with a known text."""
    runs: list[set[str]] = []
    now = {""}

    def close() -> None:
        nonlocal now
        runs.append(now)
        now = {""}

    def follow(strings: set[str]) -> None:
        nonlocal now
        if len(now) * len(strings) > MOST_ALTERNATIVES:
            close()
        now = {a + b for a, b in product(now, strings)}

    for op, value in items:
        strings = _strings(op, value)
        if strings is not None and len(strings) <= MOST_ALTERNATIVES:
            follow(strings)
            continue
        close()
        name = str(op)
        if name == "MAX_REPEAT" and value[0] > 0:
            runs += _literal_runs(list(value[2]))
        elif name == "SUBPATTERN":
            runs += _literal_runs(list(value[3]))
    close()
    return runs


def _strings(op, value) -> set[str] | None:
    """All strings an item of a pattern matches, in lower case; None when they are many."""
    name = str(op)
    if name == "LITERAL":
        return {chr(value).lower()}
    if name == "IN":
        if all(str(o) == "LITERAL" for o, _ in value):
            return {chr(v).lower() for _, v in value}
        return None
    if name == "SUBPATTERN":
        return _joined(list(value[3]))
    if name == "BRANCH":
        parts = [_joined(list(branch)) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if name == "MAX_REPEAT" and value[0] == value[1] and value[1] <= 8:
        part = _joined(list(value[2]))
        return None if part is None else {"".join(p) for p in product(part, repeat=value[0])}
    if name == "MAX_REPEAT" and (value[0], value[1]) == (0, 1):
        part = _joined(list(value[2]))
        return None if part is None else part | {""}
    return None


def _joined(items: Sequence) -> set[str] | None:
    out = {""}
    for op, value in items:
        strings = _strings(op, value)
        if strings is None or len(out) * len(strings) > MOST_ALTERNATIVES:
            return None
        out = {a + b for a, b in product(out, strings)}
    return out


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def postings(documents: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """The inverted index: (trigram number, key) for every listed trigram a document has."""

    def present(text: Column) -> Column:
        marks = [F.when(F.contains(text, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]
        return F.array_compact(F.array(*marks))

    found = _let(F.lower(_text()), present)
    return documents.select(document_key().alias("key"), F.explode(found).alias("trigram"))


def candidates(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(key, rules): which of the rules with mandatory trigrams a document may match, by number."""
    queries = {i: trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    clauses = [(i, clause) for i, query in queries.items() for clause in query]
    trigrams = sorted(set().union(*(clause for _, clause in clauses)))
    asked = F.array(
        *(
            F.array(*(F.lit(c) for c, (_, clause) in enumerate(clauses) if t in clause))
            for t in trigrams
        )
    )
    wanted = F.array(*(F.lit(len(clause)) for _, clause in clauses))
    rule_of = F.array(*(F.lit(i) for i, _ in clauses))
    return (
        postings(documents, trigrams)
        .distinct()
        .select("key", F.explode(F.element_at(asked, F.col("trigram") + 1)).alias("clause"))
        .groupBy("key", "clause")
        .agg(F.count(F.lit(1)).alias("lists"))
        .where(F.col("lists") == F.element_at(wanted, F.col("clause") + 1))
        .groupBy("key")
        .agg(F.collect_set(F.element_at(rule_of, F.col("clause") + 1)).alias("rules"))
    )


def running_sums(values: Column, part: int = PART) -> Column:
    """The sum of each number and those before it. Appending to an array copies it, so sums are made
    in parts of a few numbers, and what lies before each part is added to them after."""

    def added(numbers: Column) -> Column:
        nothing = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("sums"))

        def add(state: Column, number: Column) -> Column:
            total = state["sum"] + number
            return F.struct(total.alias("sum"), F.concat(state["sums"], F.array(total)).alias("sums"))

        return F.aggregate(numbers, nothing, add)

    def shifted(parts: Column) -> Column:
        ends = added(F.transform(parts, lambda p: p["sum"]))["sums"]
        before = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
        return F.flatten(
            F.zip_with(parts, before, lambda p, b: F.transform(p["sums"], lambda n: n + b))
        )

    def cut(numbers: Column) -> Column:
        last = F.floor(F.greatest(F.size(numbers) - 1, F.lit(0)) / part).cast("int")
        parts = F.transform(
            F.sequence(F.lit(0), last), lambda i: added(F.slice(numbers, i * part + 1, part))
        )
        return _let(parts, shifted)

    return _let(values, cut)


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, order, end, kind>> of the matches of a rule in a text. The work grows with
    the length of the text, whatever the number of matches."""
    pattern = F.lit(rule.pattern)
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")

    def placed(found: Column) -> Column:
        # the lengths of what stands before each match, and of the match
        sizes = F.transform(found["whole"], lambda w: F.length(w))
        gaps = F.transform(
            F.slice(F.split(text, rule.pattern, -1), 1, F.size(found["whole"])), lambda g: F.length(g)
        )

        def spans(sized: Column) -> Column:
            ends = running_sums(F.zip_with(sized["gaps"], sized["sizes"], lambda g, n: g + n))
            placed = F.zip_with(
                F.zip_with(ends, sized["sizes"], lambda e, n: F.struct((e - n).alias("start"), e.alias("end"))),
                found["part"],
                lambda at, p: F.struct(
                    at["start"].alias("start"),
                    F.lit(order).alias("order"),
                    at["end"].alias("end"),
                    F.lit(rule.kind).alias("kind"),
                    F.length(p).alias("size"),
                ),
            )
            kept = F.filter(placed, lambda m: m["size"] >= rule.least)
            return F.transform(
                kept, lambda m: F.struct(*(m[c].alias(c) for c in ("start", "order", "end", "kind")))
            )

        return _let(F.struct(gaps.alias("gaps"), sizes.alias("sizes")), spans)

    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    # most texts have no match, and then nothing else is done
    return F.when(
        F.rlike(text, pattern),
        _let(F.struct(whole.alias("whole"), part.alias("part")), placed),
    ).otherwise(none)


def _listing(spans: Column) -> Column:
    texts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(texts, ",")


def with_spans(
    documents: DataFrame, rules: Sequence[Rule] = RULES, name: str = "found"
) -> DataFrame:
    """Add array<struct<start, order, end, kind>> of all matches, in order of start and rule.

    A null text is an empty one. Rows that agree in doc_id and text come out alike; null ids are
    ids like others.
    """
    key, chosen = unused(documents, "__key"), unused(documents, "__rules")
    listed = candidates(documents, rules).select(
        F.col("key").alias(key), F.col("rules").alias(chosen)
    )
    joined = documents.withColumn(key, document_key()).join(dealt(written(listed)), key, "left")
    scanned_fully = {i for i, rule in enumerate(rules) if not trigram_query(rule.pattern)}
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    parts = []
    for i, rule in enumerate(rules):
        spans = rule_spans(_text(), rule, i)
        if i not in scanned_fully:
            spans = F.when(F.array_contains(chosen, i), spans).otherwise(none)
        parts.append(spans)
    return joined.withColumn(name, F.array_sort(F.concat(*parts))).drop(key, chosen)


def secrets(documents: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): the base kinds counted and digested,
    and the listing of all spans."""
    found = with_spans(documents.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["order"] < len(BASE_RULES))
    return found.select("doc_id", "found").select(
        "doc_id",
        *(count(rule.kind) for rule in BASE_RULES),
        F.sha2(_listing(base), 256).alias("base_sha256"),
        _listing(F.col("found")).alias("spans"),
    )
