"""``{{Name}}`` tokens inside text."""

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine.functions.text import text_or_empty

# A code point that Unicode sets aside and never assigns to a character.
MARK = "\ufdd0"
TOKEN = r"\{\{([^{}]+)\}\}"


def placeholder_names(col: Column) -> Column:
    """Names of the complete tokens in order, repeats kept."""
    return F.regexp_extract_all(text_or_empty(col), F.lit(TOKEN), F.lit(1))


def strip_placeholders(col: Column) -> Column:
    return F.regexp_replace(col, TOKEN, "")


def _replace_tokens(col: Column, value_of) -> Column:
    """Replace tokens in one pass, so that a value holding ``{{..}}`` is not replaced again.

    The text is split at opening braces that belong to a complete token, so every piece but the
    first starts with a name and its closing braces. ``value_of`` gives null to keep a token.
    """

    def named(part: Column) -> Column:
        return F.struct(part.alias("part"), F.substring_index(part, "}}", 1).alias("name"))

    def replaced(piece: Column, position: Column) -> Column:
        rest = F.substr(piece["part"], F.length(piece["name"]) + F.lit(3))
        value = value_of(piece["name"])
        return F.when(position == 0, piece["part"]).otherwise(
            F.coalesce(F.concat(value, rest), F.concat(F.lit("{{"), piece["part"]))
        )

    pieces = F.transform(F.split(col, r"\{\{(?=[^{}]+\}\})", -1), named)
    return F.when(
        F.contains(col, F.lit("{{")), F.array_join(F.transform(pieces, replaced), "")
    ).otherwise(col)


def _choose(name: Column, values: Mapping[str, Column]) -> Column:
    """The value listed for a name, else null. A chain of comparisons: a map of row values would
    be built anew for every token."""
    chosen = F.lit(None).cast("string")
    for listed, value in values.items():
        chosen = F.when(name == listed, value).otherwise(chosen)
    return chosen


def _replace_marked(col: Column, values: Mapping[str, Column]) -> Column:
    """One ``replace`` per name. A mark around every value, and after each brace in it, keeps
    later replacements from seeing a token that the text did not have."""
    mark, brace = F.lit(MARK), F.lit("{")
    text = col
    for name, value in values.items():
        token = F.lit("{{" + name + "}}")
        marked = F.concat(mark, F.replace(value, brace, F.lit("{" + MARK)), mark)
        text = F.replace(text, token, F.coalesce(marked, token))
    return F.replace(text, mark, F.lit(""))


def fill_tokens(col: Column, values: Mapping[str, Column]) -> Column:
    """Replace known tokens by the value columns of the row; unknown ones, and those whose
    value is null, stay. Values are not searched for tokens.

    Plain replacements are many times faster than taking the text to pieces, which is left for
    rows that hold the mark character themselves.
    """
    if not values:
        return col
    strings = {name: value.cast("string") for name, value in values.items()}
    has_mark = reduce(
        or_,
        (F.coalesce(F.contains(c, F.lit(MARK)), F.lit(False)) for c in (col, *strings.values())),
    )
    in_pieces = _replace_tokens(col, lambda name: _choose(name, strings))
    return F.when(has_mark, in_pieces).otherwise(_replace_marked(col, strings))


def generic_placeholders(
    col: Column, phrases: Mapping[str, str] = C.PLACEHOLDER_PHRASES
) -> Column:
    """Replace tokens by plain words: the listed phrase, else the name in lower case."""
    listed = {name: F.lit(phrase) for name, phrase in phrases.items()}
    return _replace_tokens(
        col, lambda name: F.coalesce(_choose(name, listed), F.lower(name))
    )


def handle_placeholders(col: Column, how: str = "keep") -> Column:
    """The three ways to prepare training text: ``keep``, ``generic`` or ``strip``."""
    return {"keep": lambda c: c, "generic": generic_placeholders, "strip": strip_placeholders}[
        how
    ](col)
