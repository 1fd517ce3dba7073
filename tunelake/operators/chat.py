"""Turning every example format into one list of messages, and rendering it.

A message is ``struct<role, content, tool_calls array<variant>>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.functions.chattemplate import compile_template
from tunelake.functions.ordered import running_sum
from tunelake.functions.pytext import text_or_empty, truthy

# Role names of the two conversation styles.
ROLE_MAP = {"system": "system", "human": "user", "gpt": "assistant"}
# The fallback template writes only these roles, under these names.
TEMPLATE_ROLES = {"user": "user", "assistant": "model", "system": "system"}
TURN_START, TURN_END = "<start_of_turn>", "<end_of_turn>\n"
GENERATION_PROMPT = "<start_of_turn>model\n"


def detect_format() -> Column:
    """Name of the example's format; the first that fits wins, null counts as absent."""
    def both(a: str, b: str) -> Column:
        return F.col(a).isNotNull() & F.col(b).isNotNull()

    return (
        F.when(F.col("messages").isNotNull(), "messages")
        .when(F.col("conversations").isNotNull(), "conversations")
        .when(both("question", "answer"), "qa")
        .when(both("instruction", "output"), "instruct")
        .otherwise("unknown")
    )


def _message(role: Column, content: Column, tool_calls: Column | None = None) -> Column:
    if tool_calls is None:
        tool_calls = F.lit(None).cast("array<variant>")
    return F.struct(
        role.alias("role"), content.alias("content"), tool_calls.alias("tool_calls"))


def map_role(role: Column) -> Column:
    """human/gpt/system to user/assistant/system; others pass, a missing one is ''."""
    out = text_or_empty(role)
    for name, mapped in ROLE_MAP.items():
        out = F.when(role == name, mapped).otherwise(out)
    return out


def messages_from_conversations(conversations: Column) -> Column:
    """A turn naming ``from`` uses from/value, any other role/content."""
    def turn(t: Column) -> Column:
        named = t["from"].isNotNull()
        return _message(
            map_role(F.when(named, t["from"]).otherwise(t["role"])),
            F.when(named, t["value"]).otherwise(t["content"]))

    return F.transform(conversations, turn)


def _prompt(main: Column, extra: Column, extra_first: bool) -> Column:
    parts = [extra, main] if extra_first else [main, extra]
    return F.when(truthy(extra), F.concat_ws("\n\n", *parts)).otherwise(main)


def messages_from_qa(question: Column, answer: Column, context: Column) -> Column:
    return F.array(
        _message(F.lit("user"), _prompt(question, context, extra_first=True)),
        _message(F.lit("assistant"), answer))


def messages_from_instruct(instruction: Column, output: Column, extra: Column) -> Column:
    return F.array(
        _message(F.lit("user"), _prompt(instruction, extra, extra_first=False)),
        _message(F.lit("assistant"), output))


def _is_text(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def _parsed_arguments(v: Column) -> Column:
    """Text that parses to any JSON value is kept as that; blank or malformed is {}."""
    return F.coalesce(
        F.try_parse_json(F.try_variant_get(v, "$", "string")), F.parse_json(F.lit("{}")))


def _with_parsed_arguments(obj: Column) -> Column:
    fields = F.try_variant_get(obj, "$", "map<string,variant>")
    return F.to_variant_object(F.transform_values(
        fields, lambda k, v: F.when(k == "arguments", _parsed_arguments(v)).otherwise(v)))


def normalize_tool_call(call: Column) -> Column:
    """Parse a call's ``arguments`` text, nested under ``function`` or flat; all
    other keys, and arguments already parsed, stay as they are."""
    function = F.try_variant_get(call, "$.function", "variant")
    nested_text = _is_text(F.try_variant_get(call, "$.function.arguments", "variant"))
    flat_text = function.isNull() & _is_text(F.try_variant_get(call, "$.arguments", "variant"))
    fields = F.try_variant_get(call, "$", "map<string,variant>")
    nested = F.to_variant_object(F.transform_values(
        fields, lambda k, v: F.when(k == "function", _with_parsed_arguments(v)).otherwise(v)))
    return (
        F.when(nested_text, nested)
        .when(flat_text, _with_parsed_arguments(call))
        .otherwise(call)
    )


def messages_from_variants(messages: Column) -> Column:
    """Chat-completion messages; a missing content is '', a JSON null stays null."""
    def one(m: Column) -> Column:
        content = F.try_variant_get(m, "$.content", "variant")
        calls = F.try_variant_get(m, "$.tool_calls", "array<variant>")
        return _message(
            F.try_variant_get(m, "$.role", "string"),
            F.when(content.isNull(), "").otherwise(F.try_variant_get(m, "$.content", "string")),
            F.transform(calls, normalize_tool_call))

    return F.transform(messages, one)


def reject_reason() -> Column:
    """Why accepted fields make no example: unknown_format, bad_turn for a turn that is
    no object, or null. Reads the fields as they were before :func:`to_messages`."""
    bad_turn = (
        F.when(F.col("messages").isNotNull(), F.exists("messages", lambda m: ~F.schema_of_variant(m).startswith("OBJECT")))
        .when(F.col("conversations").isNotNull(), F.exists("conversations", lambda t: t.isNull() | (
            t["from"].isNull() & t["role"].isNull() & t["value"].isNull() & t["content"].isNull()))))
    return F.when(detect_format() == "unknown", "unknown_format").when(bad_turn, "bad_turn")


def to_messages(examples: DataFrame) -> DataFrame:
    """Add ``format`` and replace ``messages`` by the uniform list.

    Rows of unknown format keep null messages. ``tools`` applies to the
    chat-completion format only; an empty list still counts.
    """
    fmt = F.col("format")
    c = F.col
    return (
        examples.withColumn("format", detect_format())
        .withColumn(
            "messages",
            F.when(fmt == "messages", messages_from_variants(c("messages")))
            .when(fmt == "conversations", messages_from_conversations(c("conversations")))
            .when(fmt == "qa", messages_from_qa(c("question"), c("answer"), c("context")))
            .when(
                fmt == "instruct",
                messages_from_instruct(c("instruction"), c("output"), c("input"))))
        .withColumn("tools", F.when(fmt == "messages", c("tools")))
    )


def render_turn(role: Column, content: Column) -> Column:
    """One turn in the fallback template. Other roles give ''; a null content
    is written as the template language writes it, ``None``."""
    body = F.coalesce(content, F.lit("None"))
    out = F.lit("")
    for name, shown in TEMPLATE_ROLES.items():
        out = F.when(
            role == name,
            F.concat(F.lit(f"{TURN_START}{shown}\n"), body, F.lit(TURN_END)),
        ).otherwise(out)
    return out


def render(messages: Column, *, add_generation_prompt: bool = False) -> Column:
    """The whole conversation as text in the fallback template."""
    text = F.array_join(
        F.transform(messages, lambda m: render_turn(m["role"], m["content"])), "")
    return F.concat(text, F.lit(GENERATION_PROMPT)) if add_generation_prompt else text


def render_with(
    df: DataFrame, template: Callable[[Column, Column], Column] | str | None = None, *, out: str = "text"
) -> DataFrame:
    """Render ``messages`` (and ``tools``) by a caller's template, the text of a chat
    template or a function of the two columns such as a pandas UDF, or by the fallback."""
    if isinstance(template, str):
        template = compile_template(template)
    text = template(F.col("messages"), F.col("tools")) if template else render(F.col("messages"))
    return df.withColumn(out, text)


def render_turns(
    turns: DataFrame, *, key: str = "conv_id", order: str = "turn",
    role: str = "role", content: str = "text",
) -> DataFrame:
    """Render conversations stored one turn per row, and leave them in rows.

    Each row gets its ``segment`` and ``start_char``, the segment's place in the
    conversation's text, so a conversation of any length is never put together
    in one task.
    """
    shown = turns.withColumn("segment", render_turn(map_role(F.col(role)), F.col(content)))
    return running_sum(
        shown, [key], order, F.length("segment"), "start_char", inclusive=False)


def first_messages(messages: Column) -> Column:
    """Struct (system, user): the first non-empty system text before the first
    user turn, and that turn's text; '' where absent. Later turns never count."""
    first_user = F.array_position(F.transform(messages, lambda m: m["role"]), "user")
    head = F.when(first_user > 0, F.slice(messages, F.lit(1), (first_user - 1).cast("int"))
                  ).otherwise(messages)
    system = F.try_element_at(
        F.filter(head, lambda m: (m["role"] == "system") & truthy(m["content"])), F.lit(1))
    user = F.when(first_user > 0, F.try_element_at(messages, first_user.cast("int")))
    return F.struct(
        text_or_empty(system["content"]).alias("system"),
        text_or_empty(user["content"]).alias("user"))


def first_by_role(
    turns: DataFrame, *, key: str = "conv_id", order: str = "turn",
    role: str = "from_role", content: str = "text",
) -> DataFrame:
    """First system, human and answer text of conversations stored as turns."""
    def first(name: str) -> Column:
        at = F.when(F.col(role) == name, F.col(order))
        return text_or_empty(F.min_by(content, at))

    return turns.groupBy(key).agg(
        first("system").alias("system"), first("human").alias("human"),
        first("gpt").alias("gpt"))


def first_messages_of_turns(
    turns: DataFrame, *, key: str = "conv_id", order: str = "turn",
    role: str = "role", content: str = "text",
) -> DataFrame:
    """:func:`first_messages` for conversations stored as turns: two partial
    minima per conversation, no conversation gathered."""
    user_at = F.when(F.col(role) == "user", F.col(order))
    system_at = F.when((F.col(role) == "system") & truthy(F.col(content)), F.col(order))
    return (
        turns.groupBy(key).agg(
            F.min(user_at).alias("__u"), F.min(system_at).alias("__s"),
            F.min_by(content, user_at).alias("__ut"), F.min_by(content, system_at).alias("__st"))
        .select(
            key,
            F.when(F.col("__u").isNull() | (F.col("__s") < F.col("__u")),
                   text_or_empty(F.col("__st"))).otherwise("").alias("system"),
            text_or_empty(F.col("__ut")).alias("user"))
        .withColumn("system", text_or_empty(F.col("system")))
    )


def sql_prompt(context: Column, question: Column) -> Column:
    return F.array(_message(F.lit("user"), F.concat_ws("\n\n", context, question)))


def code_prompt(system: Column, human: Column) -> Column:
    """Both turns are always present, even with an empty system text."""
    return F.array(_message(F.lit("system"), system), _message(F.lit("user"), human))
