"""Removal of repeated passages of lines, with DataFrame functions only.

A rolling hash over the hashes of two neighbouring lines decides where a boundary lies. The two
lines around a boundary are a chunk. What makes a chunk lies inside it, so the same two lines
give the same chunk in every document, whatever stands before, between or after, and lines put
in or left out shift no other chunk. Boundaries are dense: half of the passages that repeat have
two lines only, and would be missed by longer chunks, whose ends depend on lines outside. Chunks of
a longer passage overlap and add up to it.

Chunks that occur again, anywhere in the corpus, are removed except for the first occurrence,
once their bytes have been compared with it. Single lines stay, and so do two lines with few words,
since these may repeat for good reasons.

Where the data goes:

1. Hashes of chunks are counted by partial aggregates, so a chunk that a third of all documents
   have is one row per task. Those with two places or more meet their places again, without text,
   in a join that Spark can split.
2. The documents meet the list of their repeated chunks and give out the texts of these alone,
   which are compared with the text of the first place, in a join that Spark can split.
3. The documents meet the list of what to leave out.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogue_engine.llm.tables import dealt, document_key, unused
from dialogue_engine.scratch import written

# A boundary lies where the rolled hash starts with a hex digit below this one: at 15 of 16 places.
CUT_BELOW = "f"
# Words of a chunk, at least.
LEAST_WORDS = 10


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _chunks(text: Column) -> Column:
    """array<struct<at, hash>>: number of the first line, from 0, and hash of every chunk."""

    def cut(lines: Column) -> Column:
        def chunks(hashes: Column) -> Column:
            count = F.greatest(F.size(lines) - 1, F.lit(0))
            words = F.transform(lines, lambda line: F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")))
            rolled = F.zip_with(
                F.slice(hashes, 1, count), F.slice(hashes, 2, count), lambda a, b: F.concat(a, b)
            )
            both = F.zip_with(F.slice(words, 1, count), F.slice(words, 2, count), lambda a, b: a + b)
            marked = F.zip_with(
                F.transform(rolled, lambda pair: F.struct(F.md5(pair).alias("cut"), F.xxhash64(pair).alias("hash"))),
                both,
                lambda c, n: F.when(
                    (F.substring(c["cut"], 1, 1) < CUT_BELOW) & (n >= LEAST_WORDS), c["hash"]
                ),
            )
            placed = F.transform(marked, lambda h, i: F.struct(i.alias("at"), h.alias("hash")))
            return F.filter(placed, lambda c: c["hash"].isNotNull())

        return _let(F.transform(lines, lambda line: F.md5(line)), chunks)

    return _let(_lines(text), cut)


def repeated_chunks(documents: DataFrame) -> DataFrame:
    """(key, at) of every chunk to remove: its bytes are those of an earlier chunk.

    Earlier is by (doc_id, hash of the text, line). Two chunks with the same hash and other bytes
    are not the same; of such the first one counts, and the others stay. Rows that agree in
    doc_id and text are one document.
    """
    keyed = documents.select(document_key().alias("key"), "text")
    # used twice, and cutting costs more than storing three numbers a line
    places = written(
        keyed.select("key", F.explode(_chunks(F.col("text"))).alias("c")).select(
            "key", "c.at", "c.hash"
        )
    )
    place = F.struct("key", "at")
    counted = (
        places.groupBy("hash")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last")
        .select("hash", "first")
    )
    listed = (
        places.join(dealt(written(counted)), "hash")
        .groupBy("key")
        .agg(F.collect_set(F.struct("at", "hash", (place == F.col("first")).alias("is_first"))).alias("chunks"))
    )
    lines = _lines(F.col("text"))
    with_text = F.transform(
        "chunks",
        lambda c: c.withField("text", F.array_join(F.slice(F.col("lines"), c["at"] + 1, F.lit(2)), "\n")),
    )
    found = written(
        keyed.join(dealt(written(listed)), "key")
        .select("key", "chunks", lines.alias("lines"))
        .select("key", F.inline(with_text))
    )
    firsts = found.where("is_first").select("hash", F.col("text").alias("first_text"))
    same = (
        found.where("not is_first")
        # the same document, repeated, has the first chunk more than once
        .join(dealt(firsts.dropDuplicates(["hash"])), "hash")
        .where(F.col("text").cast("binary") == F.col("first_text").cast("binary"))
    )
    return same.select("key", "at")


def drop_repeated_lines(documents: DataFrame, counts: bool = False) -> DataFrame:
    """The documents without repeated chunks; ``n_chars``, where there is one, is that of the new
    text. With ``counts`` also ``n_lines`` before, and ``n_removed`` lines.

    Every row stays. A null text stays null; a text of which nothing is left is empty. Rows that
    agree in doc_id and text are one document and come out alike. Null ids are ids like others.
    """
    key, gone, left, kept = (unused(documents, n) for n in ("__key", "__gone", "__left", "__kept"))
    listed = (
        repeated_chunks(documents)
        .groupBy(F.col("key").alias(key))
        .agg(F.collect_set("at").alias(gone))
    )
    joined = documents.withColumn(key, document_key()).join(dealt(written(listed)), key, "left")
    # both lines of each chunk go
    every = F.sequence(F.lit(0), F.size(_lines(F.col("text"))) - 1)
    lines_left = F.array_except(every, F.array_union(gone, F.transform(gone, lambda at: at + 1)))
    joined = joined.withColumn(left, F.when(F.col(gone).isNotNull(), lines_left))
    cleaned = _let(
        _lines(F.col("text")),
        lambda lines: F.array_join(F.transform(F.col(left), lambda i: F.get(lines, i)), "\n"),
    )
    cleaned = joined.withColumn(kept, F.when(F.col(gone).isNotNull(), cleaned).otherwise(F.col("text")))
    columns = []
    for field in documents.schema.fields:
        name = field.name
        if name == "text":
            columns.append(F.col(kept).alias("text"))
        elif name == "n_chars":
            size = F.when(F.col(gone).isNotNull(), F.length(kept)).otherwise(F.col(name))
            columns.append(size.cast(field.dataType).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    if counts:
        n_lines = F.size(_lines(F.col("text"))).cast("long")
        removed = F.coalesce(n_lines - F.size(left), F.lit(0).cast("long"))
        columns += [n_lines.alias("n_lines"), removed.alias("n_removed")]
    return cleaned.select(*columns)
