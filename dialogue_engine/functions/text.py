"""Text columns: blanks, lengths, excerpts, keywords, replies."""

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine import schemas


def text_or_empty(col: Column) -> Column:
    """A missing text counts as an empty one."""
    return F.coalesce(col, F.lit(""))


def char_length(col: Column) -> Column:
    return F.length(text_or_empty(col)).cast("long")


def strip_unicode(col: Column) -> Column:
    """Python's ``str.strip``: Spark's ``trim`` only knows U+0020."""
    return F.btrim(col, F.lit(C.BLANK_CHARS))


def _single_spaced(col: Column) -> Column:
    """Every run of blanks one space, no blanks at the ends. Mapping the blanks to spaces first
    leaves a pattern that is cheap to search for."""
    spaces = F.translate(text_or_empty(col), C.BLANK_CHARS, " " * len(C.BLANK_CHARS))
    return F.btrim(F.regexp_replace(spaces, "  +", " "))


def word_count(col: Column) -> Column:
    """Number of words between blanks, as ``len(s.split())``."""
    words = _single_spaced(col)
    gaps = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
    return (gaps + (words != "").cast("int")).cast("long")


def normalised(col: Column) -> Column:
    """Lower case, every run of blanks one space, no blanks at the ends."""
    return _single_spaced(F.lower(col))


def excerpt(col: Column, chars: int, mark: bool = False) -> Column:
    """The first characters of a text; with ``mark``, dots show that something was cut."""
    text = text_or_empty(col)
    head = F.substring(text, 1, chars)
    if not mark:
        return head
    return F.when(F.length(text) > chars, F.concat(head, F.lit("..."))).otherwise(head)


def length_commentary(base: Column, fine_tuned: Column) -> Column:
    return F.concat(
        F.lit("Base: "),
        char_length(base).cast("string"),
        F.lit(" chars. Fine-tuned: "),
        char_length(fine_tuned).cast("string"),
        F.lit(f" chars. {C.COMMENTARY_REMARK}"),
    )


def keyword_count(col: Column, keywords: Sequence[str] = C.SUPPORT_KEYWORDS) -> Column:
    """How many of the keywords occur; each counts once, and inside longer words too."""
    text = F.lower(text_or_empty(col))
    return reduce(add, (F.contains(text, F.lit(k)).cast("long") for k in keywords))


def any_keyword(col: Column, keywords: Sequence[str] = C.SUPPORT_KEYWORDS) -> Column:
    text = F.lower(text_or_empty(col))
    return reduce(or_, (F.contains(text, F.lit(k)) for k in keywords))


def reply_class(col: Column, short_chars: int = C.SHORT_REPLY_CHARS) -> Column:
    """``empty``, ``short`` or ``ok`` by the length between the outer blanks."""
    size = F.length(strip_unicode(text_or_empty(col)))
    return F.when(size == 0, "empty").when(size < short_chars, "short").otherwise("ok")


def extract_reply(col: Column, mode: str = "last") -> Column:
    """The reply inside a decoded model text.

    ``last`` takes what follows the last "assistant" and so cuts a reply that has the word in
    it; ``template`` takes what follows the last assistant header of the chat template. The
    reply ends at the next special token. A text without the word or header is returned as
    it is, blanks included.
    """
    start = {
        "last": C.REPLY_WORD,
        "template": f"{C.HEADER_OPEN}{C.REPLY_WORD}{C.HEADER_CLOSE}",
    }[mode]
    reply = strip_unicode(F.substring_index(col, start, -1))
    reply = strip_unicode(F.substring_index(reply, C.SPECIAL_TOKEN_OPEN, 1))
    return F.when(F.contains(col, F.lit(start)), reply).otherwise(col)


def parse_reply_json(body: Column) -> Column:
    """``content``: the text at message.content, "" when absent; ``bad_json``: not readable,
    so that a broken reply is not mistaken for an empty one."""
    parsed = F.from_json(
        body, schemas.REPLY_BODY, {"columnNameOfCorruptRecord": "_corrupt_record"}
    )

    def checked(reply: Column) -> Column:
        return F.struct(
            text_or_empty(reply["message"]["content"]).alias("content"),
            (reply.isNull() | reply["_corrupt_record"].isNotNull()).alias("bad_json"),
        )

    # both fields come from one variable, so the text is parsed once
    return F.element_at(F.transform(F.array(parsed), checked), 1)
