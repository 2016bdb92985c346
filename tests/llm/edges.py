"""Documents every operator must take: nulls, empty and long texts, ties, repeats, odd columns."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "`__key` int, `Score` int, `text_hash` string, `hits` string"
)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "__key", "Score", "text_hash", "hits"]

LONG = " ".join(f"w{i}" for i in range(30_000))


def edge_rows():
    rows = [
        (1, None),
        (2, ""),
        (None, "alone without an id"),
        (None, None),
        (3, " \t\n\x0b "),
        (4, LONG),
        (5, "same words here\nand there\nand over there"),
        (5, "same words here\nand there\nand over there"),
        (6, "same words here\nand there\nand over there"),
        (7, "one"),
    ]
    return [(i, t, None, "s", None if t is None else len(t), 1, 2, "x", "y") for i, t in rows]


def edge_documents(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, texts, first=0):
    rows = [(i, t) for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, "doc_id long, text string")
