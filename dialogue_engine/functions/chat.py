"""Message arrays: building them, rendering them to text, packing them into requests."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialogue_engine import constants as C
from dialogue_engine import schemas
from dialogue_engine.functions.text import text_or_empty


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def messages(instruction: Column, response: Column, system_prompt: str = C.SYSTEM_PROMPT) -> Column:
    """One support case as system, user and assistant message."""
    return F.array(
        message("system", F.lit(system_prompt)),
        message("user", instruction),
        message("assistant", response),
    ).cast(schemas.MESSAGES)


def _header(role: str) -> str:
    begin = C.BEGIN_MARK if role == "system" else ""
    return f"{begin}{C.HEADER_OPEN}{role}{C.HEADER_CLOSE}"


def _render_one(entry: Column) -> Column:
    body = F.concat(text_or_empty(entry["content"]), F.lit(C.MESSAGE_END))
    out = F.lit("")
    for role in C.CHAT_ROLES:
        out = F.when(entry["role"] == role, F.concat(F.lit(_header(role)), body)).otherwise(out)
    return out


def render_chat(entries: Column, add_generation_prompt: bool = False) -> Column:
    """Message array to training or prompt text. Other roles print nothing."""
    text = F.array_join(F.transform(entries, _render_one), "")
    return F.concat(text, F.lit(_header("assistant"))) if add_generation_prompt else text


def request_json(model: Column, entries: Column, max_tokens: Column) -> Column:
    """Body of a chat request; ``options`` only appears when there is a token limit."""
    options = F.when(
        max_tokens.isNotNull(), F.struct(max_tokens.cast("long").alias("num_predict"))
    )
    return F.to_json(
        F.struct(
            model.alias("model"),
            entries.alias("messages"),
            F.lit(False).alias("stream"),
            options.alias("options"),
        )
    )
