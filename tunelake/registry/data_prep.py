"""Queries: JSON lines to uniform messages to rendered text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tunelake.functions.chattemplate import compile_template
from tunelake.functions.pytext import text_or_empty
from tunelake.operators import chat
from tunelake.registry.core import register
from tunelake.registry.inputs import derive, table
from tunelake.registry.sql_text import strip
from tunelake.sinks.shared import shared_dir
from tunelake.sources import jsonl

FX = ("fx_jsonl_lines",)
KNOWN = "['" + "','".join(jsonl.TRAINING_FIELDS) + "']"

PARSED = f"""WITH parsed AS (SELECT line_no, value, {strip('value')} AS s,
  CASE WHEN json_valid({strip('value')}) THEN {strip('value')}::JSON END AS j FROM fx_jsonl_lines),
classed AS (SELECT *, CASE WHEN s = '' THEN 'blank' WHEN j IS NULL THEN 'bad_json'
  WHEN json_type(j) <> 'OBJECT' THEN 'not_object'
  WHEN list_has_any(json_keys(j), {KNOWN}) THEN 'ok' ELSE 'unrecognized' END AS status FROM parsed),
fields AS (SELECT line_no, j,
  CASE WHEN json_type(j, '$.conversations') = 'ARRAY' THEN json_array_length(j, '$.conversations') END AS n_conv,
  CASE WHEN json_type(j, '$.messages') = 'ARRAY' THEN json_array_length(j, '$.messages') END AS n_msg,
  CASE WHEN json_type(j, '$.tools') <> 'NULL' THEN CAST(json_extract(j, '$.tools') AS VARCHAR) END AS tools,
  json_extract_string(j, '$.system') AS system, json_extract_string(j, '$.question') AS question,
  json_extract_string(j, '$.answer') AS answer, json_extract_string(j, '$.context') AS context,
  json_extract_string(j, '$.instruction') AS instruction, json_extract_string(j, '$.input') AS input,
  json_extract_string(j, '$.output') AS output FROM classed WHERE status = 'ok'),
formats AS (SELECT *, CASE WHEN n_msg IS NOT NULL THEN 'messages' WHEN n_conv IS NOT NULL THEN 'conversations'
  WHEN question IS NOT NULL AND answer IS NOT NULL THEN 'qa'
  WHEN instruction IS NOT NULL AND output IS NOT NULL THEN 'instruct' ELSE 'unknown' END AS format FROM fields)
"""

# One row per message of every example, in SQL.
MESSAGES = PARSED + """,
conv AS (SELECT line_no, format, tools, k, json_extract(j, concat('$.conversations[', k, ']')) AS t
  FROM (SELECT *, unnest(range(CAST(n_conv AS BIGINT))) AS k FROM formats WHERE format = 'conversations')),
msg AS (SELECT line_no, format, tools, k, json_extract(j, concat('$.messages[', k, ']')) AS t
  FROM (SELECT *, unnest(range(CAST(n_msg AS BIGINT))) AS k FROM formats WHERE format = 'messages')),
turns AS (
  SELECT line_no, format, CAST(NULL AS VARCHAR) AS tools, CAST(k AS INTEGER) AS pos,
    CASE WHEN json_extract_string(t, '$.from') IS NOT NULL THEN json_extract_string(t, '$.from') ELSE coalesce(json_extract_string(t, '$.role'), '') END AS raw_role,
    CASE WHEN json_extract_string(t, '$.from') IS NOT NULL THEN json_extract_string(t, '$.value') ELSE json_extract_string(t, '$.content') END AS content FROM conv
  UNION ALL SELECT line_no, format, tools, CAST(k AS INTEGER), json_extract_string(t, '$.role'),
    CASE WHEN json_type(t, '$.content') IS NULL THEN '' ELSE json_extract_string(t, '$.content') END FROM msg
  UNION ALL SELECT line_no, format, NULL, 0, 'user', CASE WHEN context <> '' THEN concat(context, chr(10), chr(10), question) ELSE question END FROM formats WHERE format = 'qa'
  UNION ALL SELECT line_no, format, NULL, 1, 'assistant', answer FROM formats WHERE format = 'qa'
  UNION ALL SELECT line_no, format, NULL, 0, 'user', CASE WHEN input <> '' THEN concat(instruction, chr(10), chr(10), input) ELSE instruction END FROM formats WHERE format = 'instruct'
  UNION ALL SELECT line_no, format, NULL, 1, 'assistant', output FROM formats WHERE format = 'instruct'),
messages AS (SELECT line_no, format, tools, pos, content,
  CASE WHEN format <> 'conversations' THEN raw_role WHEN raw_role = 'human' THEN 'user' WHEN raw_role = 'gpt' THEN 'assistant' ELSE raw_role END AS role FROM turns)
"""

SEGMENT = """CASE role WHEN 'user' THEN concat('<start_of_turn>user', chr(10), coalesce(content, 'None'), '<end_of_turn>', chr(10))
  WHEN 'assistant' THEN concat('<start_of_turn>model', chr(10), coalesce(content, 'None'), '<end_of_turn>', chr(10))
  WHEN 'system' THEN concat('<start_of_turn>system', chr(10), coalesce(content, 'None'), '<end_of_turn>', chr(10)) ELSE '' END"""
RENDERED = MESSAGES + f""",
rendered AS (SELECT line_no, any_value(format) AS format, string_agg({SEGMENT}, '' ORDER BY pos) AS text FROM messages GROUP BY line_no)
"""


def classified(spark, sf_dir):
    return jsonl.classify_lines(derive(spark, sf_dir, "fx_jsonl_lines"))


def examples(spark, sf_dir):
    return jsonl.training_fields(classified(spark, sf_dir), "line_no")


def messages(spark, sf_dir):
    return chat.to_messages(examples(spark, sf_dir))


def message_rows(df, fmt):
    """One row per message of the examples in one format."""
    return df.filter(F.col("format") == fmt).select(
        "line_no", F.posexplode("messages").alias("pos", "m")
    ).select("line_no", "pos", "m.role", "m.content")


@register("src_jsonl_tolerant", PARSED + """
SELECT line_no, CAST(length(value) AS INTEGER) AS n_chars, status FROM classed""", FX)
def src_jsonl_tolerant(spark, sf_dir):
    return classified(spark, sf_dir).select(
        "line_no", F.length("value").alias("n_chars"), "status")


@register("src_dispatch", PARSED + """
SELECT format, count(*) AS n FROM formats GROUP BY format
UNION ALL SELECT 'parquet', count(*) FROM documents
UNION ALL SELECT 'table', count(*) FROM labels""", FX)
def src_dispatch(spark, sf_dir):
    """The derived lines written as JSON lines and loaded back, next to a
    parquet path and a named table."""
    path = f"{shared_dir(spark)}/dispatch-{uuid.uuid4().hex}.jsonl"
    derive(spark, sf_dir, "fx_jsonl_lines").select("value").write.text(path)
    view = f"labels_{uuid.uuid4().hex}"
    table(spark, sf_dir, "labels").createOrReplaceTempView(view)
    count = F.count(F.lit(1)).alias("n")
    lines = chat.to_messages(jsonl.load_training_table(spark, path).accepted).groupBy("format").agg(count)
    files = jsonl.load_training_table(spark, f"{sf_dir}/documents.parquet").accepted
    named = jsonl.load_training_table(spark, view).accepted
    return (
        lines.unionByName(files.agg(count).select(F.lit("parquet").alias("format"), "n"))
        .unionByName(named.agg(count).select(F.lit("table").alias("format"), "n"))
    )


@register("src_sharegpt_eval", PARSED + """
SELECT line_no, coalesce(json_extract_string(j, '$.conversations[0].value'), '') AS system,
  coalesce(json_extract_string(j, '$.conversations[1].value'), '') AS human,
  coalesce(json_extract_string(j, '$.conversations[2].value'), '') AS gpt_full,
  regexp_extract(json_extract_string(j, '$.conversations[2].value'), '(?is)```python\\s*\\n(.*?)\\n```', 1) AS reference_code
FROM classed WHERE json_extract_string(j, '$.conversations[0].from') IS NOT NULL""", FX)
def src_sharegpt_eval(spark, sf_dir):
    return jsonl.sharegpt_eval_rows(classified(spark, sf_dir), "line_no")


@register("src_eval_window", f"""
WITH n AS (SELECT line_no, length(value) AS n_chars, row_number() OVER (ORDER BY line_no) - 1 AS idx
  FROM fx_jsonl_lines WHERE {strip('value')} <> '')
SELECT line_no, CAST(n_chars AS INTEGER) AS n_chars, idx FROM n WHERE idx >= 40 AND idx < 640""", FX)
def src_eval_window(spark, sf_dir):
    lines = derive(spark, sf_dir, "fx_jsonl_lines")
    return jsonl.eval_window(lines, limit=640, start_from=40, block_rows=512).select(
        "line_no", F.length("value").alias("n_chars"), "idx")


@register("prj_training_fields", PARSED + """
SELECT line_no, CAST(n_conv AS INTEGER) AS n_conv, CAST(n_msg AS INTEGER) AS n_msg, tools, system, question, answer,
  context, instruction, input, output FROM fields""", FX)
def prj_training_fields(spark, sf_dir):
    def size(c):
        return F.when(F.col(c).isNotNull(), F.size(c))

    return examples(spark, sf_dir).select(
        "line_no", size("conversations").alias("n_conv"), size("messages").alias("n_msg"),
        F.to_json("tools").alias("tools"), *jsonl.TEXT_FIELDS)


@register("flt_unrecognized", PARSED + """
SELECT line_no, array_to_string(list_sort(json_keys(j)), ',') AS keys FROM classed WHERE status = 'unrecognized'""", FX)
def flt_unrecognized(spark, sf_dir):
    rejects = jsonl.rejected_lines(classified(spark, sf_dir), "line_no")
    return rejects.filter(F.col("reason") == "unrecognized").select(
        "line_no", F.array_join("keys", ",").alias("keys"))


@register("flt_bad_lines", PARSED + """
SELECT line_no, status AS reason FROM classed WHERE status IN ('bad_json', 'not_object', 'unrecognized')""", FX)
def flt_bad_lines(spark, sf_dir):
    return jsonl.rejected_lines(classified(spark, sf_dir), "line_no").select("line_no", "reason")


@register("chat_detect_format", PARSED + "SELECT line_no, format FROM formats", FX)
def chat_detect_format(spark, sf_dir):
    return examples(spark, sf_dir).select("line_no", chat.detect_format().alias("format"))


@register("chat_sharegpt_to_messages", MESSAGES + """
SELECT line_no, pos, role, content FROM messages WHERE format = 'conversations'""", FX)
def chat_sharegpt_to_messages(spark, sf_dir):
    return message_rows(messages(spark, sf_dir), "conversations")


@register("chat_qa_to_messages", MESSAGES + """
SELECT line_no, pos, role, content FROM messages WHERE format = 'qa'""", FX)
def chat_qa_to_messages(spark, sf_dir):
    return message_rows(messages(spark, sf_dir), "qa")


@register("chat_instruct_to_messages", MESSAGES + """
SELECT line_no, pos, role, content FROM messages WHERE format = 'instruct'""", FX)
def chat_instruct_to_messages(spark, sf_dir):
    return message_rows(messages(spark, sf_dir), "instruct")


@register("chat_tool_args", PARSED + """,
calls AS (SELECT line_no, c, json_extract(j, concat('$.messages[2].tool_calls[', c, ']')) AS t
  FROM (SELECT *, unnest(range(CAST(json_array_length(j, '$.messages[2].tool_calls') AS BIGINT))) AS c FROM formats WHERE format = 'messages')),
args AS (SELECT line_no, c, json_extract_string(t, '$.function.name') AS fn, json_extract_string(t, '$.name') AS flat,
  coalesce(json_extract(t, '$.function.arguments'), json_extract(t, '$.arguments')) AS a FROM calls)
SELECT line_no, CAST(c AS INTEGER) AS call_pos, coalesce(fn, flat) AS name, fn IS NOT NULL AS nested,
  CASE WHEN json_type(a) <> 'VARCHAR' THEN CAST(a AS VARCHAR)
    WHEN json_valid(json_extract_string(a, '$')) THEN json_extract_string(a, '$') ELSE '{}' END AS arguments
FROM args""", FX)
def chat_tool_args(spark, sf_dir):
    calls = messages(spark, sf_dir).filter(F.col("format") == "messages").select(
        "line_no", F.explode("messages").alias("m")
    ).select("line_no", F.posexplode("m.tool_calls").alias("call_pos", "t"))
    fn = F.try_variant_get("t", "$.function.name", "string")
    return calls.select(
        "line_no", "call_pos",
        F.coalesce(fn, F.try_variant_get("t", "$.name", "string")).alias("name"),
        fn.isNotNull().alias("nested"),
        F.to_json(F.coalesce(
            F.try_variant_get("t", "$.function.arguments", "variant"),
            F.try_variant_get("t", "$.arguments", "variant"))).alias("arguments"))


@register("chat_first_messages", """
WITH u AS (SELECT conv_id, min(turn) AS at FROM fx_chat_turns WHERE role = 'user' GROUP BY conv_id),
s AS (SELECT conv_id, min(turn) AS at FROM fx_chat_turns WHERE role = 'system' AND text <> '' GROUP BY conv_id),
c AS (SELECT DISTINCT conv_id FROM fx_chat_turns)
SELECT c.conv_id, CASE WHEN u.at IS NULL OR s.at < u.at THEN coalesce(st.text, '') ELSE '' END AS system,
  coalesce(ut.text, '') AS "user"
FROM c LEFT JOIN u USING (conv_id) LEFT JOIN s USING (conv_id)
LEFT JOIN fx_chat_turns st ON st.conv_id = c.conv_id AND st.turn = s.at
LEFT JOIN fx_chat_turns ut ON ut.conv_id = c.conv_id AND ut.turn = u.at""", ("fx_chat_turns",))
def chat_first_messages(spark, sf_dir):
    return chat.first_messages_of_turns(derive(spark, sf_dir, "fx_chat_turns"))


@register("chat_first_by_role", """
SELECT conv_id, coalesce(arg_min(text, turn) FILTER (WHERE from_role = 'system'), '') AS system,
  coalesce(arg_min(text, turn) FILTER (WHERE from_role = 'human'), '') AS human,
  coalesce(arg_min(text, turn) FILTER (WHERE from_role = 'gpt'), '') AS gpt
FROM fx_chat_turns GROUP BY conv_id""", ("fx_chat_turns",))
def chat_first_by_role(spark, sf_dir):
    return chat.first_by_role(derive(spark, sf_dir, "fx_chat_turns"))


@register("chat_render", RENDERED + """
SELECT line_no, format, text, concat(text, '<start_of_turn>model', chr(10)) AS prompt FROM rendered""", FX)
def chat_render(spark, sf_dir):
    return chat.render_with(messages(spark, sf_dir)).select(
        "line_no", "format", "text",
        F.concat("text", F.lit(chat.GENERATION_PROMPT)).alias("prompt"))


TEMPLATE = """
{%- set known = ['system', 'user', 'assistant'] %}
{% for m in messages %}
    {% if m.role == 'assistant' and loop.first %}{{ raise_exception('an answer before any question') }}{% endif %}
    {% if loop.first and m.role != 'system' %}
<|system|>You are helpful.
    {% endif %}
    {% if m.role in known %}
        {%- set body = m.content | trim if m.content is not none else '-' %}
<|{{ m.role | upper }}|>{{ body ~ (eos_token if m.role == 'assistant' else '') }}
        {%- if m.role == 'user' and m.content | length > 40 %} (long){% endif %}

    {% else %}
        {%- set body = 'unknown' %}
[{{ loop.index }} of {{ loop.length }}: {{ body }}]
    {% endif %}
{% endfor %}
{% if add_generation_prompt %}<|ASSISTANT|>{% endif %}
"""


@register("chat_render_template", MESSAGES + f""",
told AS (SELECT *, count(*) OVER (PARTITION BY line_no) AS n FROM messages),
segments AS (SELECT line_no, pos, pos = 0 AND role IS NOT DISTINCT FROM 'assistant' AS refused, concat(
  CASE WHEN pos = 0 AND role IS DISTINCT FROM 'system' THEN concat('<|system|>You are helpful.', chr(10)) ELSE '' END,
  CASE WHEN role IN ('system', 'user', 'assistant') THEN concat('<|', upper(role), '|>', coalesce({strip('content')}, '-'),
      CASE WHEN role = 'assistant' THEN '</s>' ELSE '' END, CASE WHEN role = 'user' AND length(content) > 40 THEN ' (long)' ELSE '' END, chr(10))
    ELSE concat('[', pos + 1, ' of ', n, ': unknown]', chr(10)) END) AS segment FROM told)
SELECT line_no, bool_or(refused) AS refused,
  CASE WHEN NOT bool_or(refused) THEN concat(string_agg(segment, '' ORDER BY pos), '<|ASSISTANT|>') END AS text FROM segments GROUP BY line_no""", FX)
def chat_render_template(spark, sf_dir):
    """A tokenizer's own template: white-space control, variables, branches, filters, loop places and refusal."""
    template = compile_template(TEMPLATE, add_generation_prompt=True, eos_token="</s>")
    out = chat.render_with(messages(spark, sf_dir), template)
    return out.select("line_no", (F.col("messages").isNotNull() & F.col("text").isNull()).alias("refused"), "text")


@register("chat_render_turns", f"""
WITH s AS (SELECT conv_id, turn, {SEGMENT.replace('coalesce(content', 'coalesce(text').replace('CASE role', 'CASE role')} AS segment FROM fx_chat_turns)
SELECT conv_id, turn, segment,
  CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char
FROM s""", ("fx_chat_turns",))
def chat_render_turns(spark, sf_dir):
    return chat.render_turns(
        derive(spark, sf_dir, "fx_chat_turns"), role="from_role"
    ).select("conv_id", "turn", "segment", "start_char")


@register("chat_prompt_build", """
SELECT example_id, concat(context, chr(10), chr(10), question) AS sql_user,
  '<start_of_turn>system' || chr(10) || '<end_of_turn>' || chr(10) || '<start_of_turn>user' || chr(10) || question || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10) AS code_prompt
FROM fx_sql_pairs""", ("fx_sql_pairs",))
def chat_prompt_build(spark, sf_dir):
    pairs = derive(spark, sf_dir, "fx_sql_pairs")
    sql = chat.sql_prompt(F.col("context"), F.col("question"))
    code = chat.code_prompt(F.lit(""), F.col("question"))
    return pairs.select(
        "example_id", sql[0]["content"].alias("sql_user"),
        chat.render(code, add_generation_prompt=True).alias("code_prompt"))


@register("chat_tools_passthrough", PARSED + """
SELECT line_no, format, CASE WHEN format = 'messages' THEN tools END AS tools FROM formats""", FX)
def chat_tools_passthrough(spark, sf_dir):
    return messages(spark, sf_dir).select("line_no", "format", F.to_json("tools").alias("tools"))


@register("prj_record_header", PARSED + """
SELECT line_no, coalesce(nullif(source, ''), lang) AS example_id, left(coalesce(text, ''), 300) AS user_msg_preview,
  left(coalesce(lang, ''), 200) AS system_msg_preview
FROM (SELECT doc_id + 1 AS line_no, text, lang, CASE WHEN doc_id % 4 = 0 THEN '' ELSE source END AS source FROM documents)""", FX)
def prj_record_header(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") + 1).alias("line_no"), "text", "lang",
        F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("source")).alias("source"))
    return docs.select(
        "line_no",
        F.coalesce(F.nullif("source", F.lit("")), F.col("lang")).alias("example_id"),
        F.left(text_or_empty(F.col("text")), F.lit(300)).alias("user_msg_preview"),
        F.left(text_or_empty(F.col("lang")), F.lit(200)).alias("system_msg_preview"))
