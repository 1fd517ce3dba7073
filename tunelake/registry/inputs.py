"""Inputs derived from the driver's tables, in SQL that Spark and DuckDB share.

The tables hold no code fences, SQL text, JSON lines, logs or tensors, so each
input below writes such values over every row of a table. Dialect notes:
``chr(10)`` newline, ``chr(92)`` backslash, ``repeat('`',3)`` a code fence.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_FENCE = "repeat('`',3)"
_NL = "chr(10)"
_BOTH_SIDES = """(
SELECT *, 'base' AS side, 0 AS salt
FROM part
UNION ALL SELECT *, 'tuned' AS side, 1 AS salt
FROM part
) p"""
_BOTH_FACTORS = """(
SELECT *, 'A' AS f
FROM part
UNION ALL SELECT *, 'B' AS f
FROM part
) p"""


def _escaped(col: str) -> str:
    """A JSON string body: backslash, quote, newline, tab and return escaped."""
    out = f"replace({col}, chr(92), concat(chr(92), chr(92)))"
    for ch, esc in (("chr(34)", "chr(34)"), (_NL, "'n'"), ("chr(9)", "'t'"), ("chr(13)", "'r'")):
        out = f"replace({out}, {ch}, concat(chr(92), {esc}))"
    return out


_TEXT = _escaped("text")
_BS = "chr(92)"

INPUTS: dict[str, str] = {}

INPUTS["fx_sql_pairs"] = f"""
SELECT p_partkey AS example_id,
  concat('CREATE TABLE part (', p_type, ' int)') AS context,
  concat('How many ', p_name, '?') AS question,
  concat('SELECT p_name FROM part WHERE p_size = ', cast(p_size AS string)) AS truth,
  CASE p_partkey % 8
    WHEN 0 THEN concat('SELECT p_name FROM part WHERE p_size = ', cast(p_size AS string), ';')
    WHEN 1 THEN concat('Sure:', {_NL}, {_FENCE}, 'sql', {_NL}, 'select P_NAME from part', {_NL}, 'where p_size = ', cast(p_size AS string), {_NL}, {_FENCE})
    WHEN 2 THEN concat('Thinking. SQL: `SELECT p_name FROM part WHERE p_size = ', cast(p_size AS string), ';` done')
    WHEN 3 THEN concat('SELECT p_brand FROM part WHERE p_name = ', chr(39), p_name, chr(39))
    WHEN 4 THEN ''
    WHEN 5 THEN NULL
    WHEN 6 THEN concat('SELECT x FROM (SELECT p_name FROM part WHERE p_size = ', cast(p_size AS string), {_NL}, {_NL}, 'Note: y')
    ELSE concat('I cannot answer ', p_name) END AS base_prediction,
  CASE WHEN p_partkey % 5 = 0 THEN 'SELECT user_id FROM part'
    ELSE concat('SELECT  p_name', chr(9), 'FROM part WHERE p_size = ', cast(p_size AS string), '<|im_end|>') END AS tuned_prediction,
  CASE WHEN p_partkey % 8 = 4 THEN 'URLError: timed out' END AS base_error
FROM part
"""

INPUTS["fx_sql_sides"] = f"""
SELECT p_partkey AS example_id, side,
  CASE WHEN side = 'base' AND p_partkey % 8 = 4 THEN NULL
    WHEN side = 'base' AND p_partkey % 8 = 0 THEN concat('SELECT p_name FROM part WHERE p_size = ', cast(p_size AS string), ';')
    WHEN side = 'base' THEN concat('Sure:', {_NL}, {_FENCE}, {_NL}, 'select ', p_name, {_FENCE})
    ELSE concat('SELECT  p_name FROM part WHERE p_size = ', cast(p_size AS string)) END AS prediction,
  CASE WHEN side = 'base' AND p_partkey % 8 = 4 THEN 'URLError: timed out' END AS error,
  CASE WHEN side = 'base' AND p_partkey % 8 = 4 THEN 0 ELSE p_partkey % 900 + 1 END AS latency_ms
FROM {_BOTH_SIDES}
"""

INPUTS["fx_code_pairs"] = f"""
SELECT p_partkey AS example_id, side,
  concat('with BuildPart() as p:', {_NL}, '    Box(', cast(p_size AS string), ', 2, 3)', {_NL},
    CASE WHEN p_partkey % 3 = 0 THEN concat('    Cylinder(1, 2)', {_NL}) ELSE '' END, 'root_part = p.part') AS reference_code,
  CASE (p_partkey + 2 * salt) % 7
    WHEN 0 THEN concat({_FENCE}, 'python', {_NL}, 'with BuildPart() as p:', {_NL}, '    Box(1, 2, 3)', {_NL}, 'root_part = p.part', {_NL}, {_FENCE})
    WHEN 1 THEN concat({_FENCE}, 'py', {_NL}, 'root_part = Sphere(2)', {_NL}, {_FENCE})
    WHEN 2 THEN concat({_FENCE}, 'python', {_NL}, 'import os.path', {_NL}, 'root_part = MagicGear', cast(p_size AS string), '(2)', {_NL}, {_FENCE})
    WHEN 3 THEN concat({_FENCE}, 'python', {_NL}, 'root_part = = Box(1)', {_NL}, {_FENCE})
    WHEN 4 THEN 'root_part = Box(1)'
    WHEN 5 THEN concat('Sorry, no ', p_name, '.')
    ELSE concat({_FENCE}, 'python', {_NL}, 'x = Box(1)', {_FENCE}) END AS prediction,
  CASE WHEN (p_partkey + 2 * salt) % 7 = 5 THEN 0 ELSE (p_partkey * 31 + salt) % 900 + 1 END AS latency_ms
FROM {_BOTH_SIDES}
"""

INPUTS["fx_jsonl_lines"] = f"""
SELECT doc_id + 1 AS line_no,
  CASE doc_id % 10
    WHEN 0 THEN concat('{{"question":"q', cast(doc_id AS string), '","answer":"', lang, '","context":"', {_TEXT}, '"}}')
    WHEN 1 THEN concat('{{"question":"q","answer":"', {_TEXT}, '","context":"","metadata":{{"n":', cast(n_chars AS string), '}}}}')
    WHEN 2 THEN concat('{{"instruction":"i', cast(doc_id AS string), '","output":"', lang, '","input":"', {_TEXT}, '","metadata":"s"}}')
    WHEN 3 THEN concat('{{"conversations":[{{"from":"system","value":"s"}},{{"from":"human","value":"', source, '"}},{{"from":"gpt","value":"', {_FENCE}, 'python', {_BS}, 'n', {_TEXT}, {_BS}, 'n', {_FENCE}, '"}}]}}')
    WHEN 4 THEN concat('{{"conversations":[{{"role":"human","content":"', {_TEXT}, '"}},{{"role":"tool","content":"x"}},{{"content":"', lang, '"}}]}}')
    WHEN 5 THEN concat('{{"messages":[{{"role":"system","content":""}},{{"role":"user","content":"', {_TEXT}, '"}},{{"role":"assistant","content":null,"tool_calls":[',
      CASE doc_id % 3
        WHEN 0 THEN concat('{{"function":{{"name":"f","arguments":"{{', {_BS}, '"a', {_BS}, '":', cast(n_chars AS string), '}}"}}}}')
        WHEN 1 THEN '{{"name":"g","arguments":"not json"}},{{"name":"h","arguments":" "}}'
        ELSE concat('{{"function":{{"name":"f","arguments":{{"b":', cast(doc_id AS string), '}}}}}},{{"name":"k","arguments":"[1,2]"}}') END,
      ']}}],"tools":', CASE WHEN doc_id % 4 = 1 THEN '[]' ELSE 'null' END, '}}')
    WHEN 6 THEN concat('{{"messages":null,"instruction":"i","output":"', {_TEXT}, '","system":"', lang, '"}}')
    WHEN 7 THEN concat('{{"score":', cast(n_chars AS string), ',"id":"', source, '"}}')
    WHEN 8 THEN '  '
    ELSE concat('{{"question": bad', {_TEXT}) END AS value
FROM documents
"""

INPUTS["fx_chat_turns"] = """
SELECT conv_id, turn,
  CASE WHEN role = 'user' THEN 'human' WHEN role = 'assistant' THEN 'gpt' ELSE role END AS from_role,
  role, text
FROM conversations
"""

INPUTS["fx_exec_results"] = f"""
SELECT p_partkey AS idx, side,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE concat('ex', cast(p_partkey % 50 AS string)) END AS example_id,
  CASE WHEN (p_partkey + salt) % 13 = 12 THEN 'HTTP 500: busy' END AS query_error,
  side = 'tuned' AND p_partkey % 17 = 3 AS skipped,
  CASE WHEN (p_partkey + salt) % 7 = 6 THEN '' ELSE concat('root_part = Box(', cast(p_size AS string), ')') END AS code,
  (p_partkey + salt) % 11 <> 10 AS syntax_ok,
  (p_partkey + salt) % 6 = 5 AS timed_out,
  CASE WHEN (p_partkey + salt) % 6 IN (0, 1, 2) THEN 0 ELSE 1 END AS returncode,
  CASE (p_partkey + salt) % 6
    WHEN 0 THEN concat('warn ', p_name, {_NL}, '__EVAL_RESULT__{{"root_part_ok": true, "volume": ', cast(p_size AS string), '.5, "bbox": [[0,0,0],[1,2,', cast(p_size AS string), ']], "face_count": ', cast(p_size % 7 AS string), ', "step_export_ok": true, "step_size_bytes": 10}}', {_NL})
    WHEN 1 THEN '__EVAL_RESULT__{{"root_part_ok": true, "volume": null, "bbox": null, "face_count": 6, "step_export_ok": false, "step_size_bytes": 0}}'
    WHEN 2 THEN concat('nothing here ', p_name)
    WHEN 3 THEN concat('Traceback (most recent call last):', {_NL}, '  File "<string>", line 3', {_NL}, 'NameError: name ', p_name, {_NL})
    WHEN 4 THEN concat('Traceback (most recent call last):', {_NL}, CASE WHEN p_partkey % 4 = 0 THEN '  File "<string>", SyntaxError' ELSE 'ValueError: bad ' END, repeat('x', 400))
    ELSE '' END AS stderr
FROM {_BOTH_SIDES}
"""

INPUTS["fx_reference_invariants"] = """
SELECT concat('ex', cast(p_partkey % 45 AS string)) AS example_id,
  cast(max(p_size) AS double) AS volume, max(p_size) % 7 AS face_count, cast(max(p_size) AS double) AS dz
FROM part GROUP BY concat('ex', cast(p_partkey % 45 AS string))
"""

INPUTS["fx_requests"] = """
SELECT event_id AS request_id,
  CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 8 ELSE 32 END AS concurrency,
  event_type <> 'error' AS ok,
  event_id * 1000 AS start_us,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 50 = 7 THEN 0 ELSE cast(round(value * 100) AS bigint) END AS total_us,
  CASE WHEN event_type = 'view' THEN NULL ELSE event_id % 257 END AS completion_tokens,
  CASE WHEN user_id % 3 = 0 AND event_type = 'click' THEN event_id % 500 END AS ttft_us
FROM events
"""

INPUTS["fx_frames"] = """
SELECT user_id AS request_id, event_id AS seq, event_id AS recv_us,
  CASE event_type
    WHEN 'click' THEN concat('data: {"choices":[{"delta":{"content":"c', cast(event_id AS string), '"}}]}')
    WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'data: {"choices":[{"delta":{"role":"assistant"}}]}' ELSE 'data: {"choices":[{"delta":{"content":""}}]}' END
    WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN ': keep-alive' ELSE '' END
    WHEN 'purchase' THEN concat('data: {"choices":[],"usage":{"completion_tokens":', cast(event_id % 90 AS string), '}}')
    ELSE CASE WHEN event_id % 13 = 0 THEN 'data: [DONE]' ELSE 'data: {bad' END END AS line
FROM events
"""

INPUTS["fx_request_starts"] = """
SELECT user_id AS request_id, min(event_id) - 5000 - user_id % 1000 AS start_us
FROM events
GROUP BY user_id
"""

INPUTS["fx_log_lines"] = """
SELECT CASE WHEN user_id % 4 = 0 THEN 'train.log' ELSE concat('train-rank', cast(user_id % 4 AS string), '.log') END AS file,
  event_id AS line_no,
  CASE event_type
    WHEN 'signup' THEN CASE WHEN event_id % 3 = 0 THEN concat('=== Rank ', cast(user_id % 4 AS string), ': logging session started (local) ===') ELSE props END
    WHEN 'error' THEN '[EVAL] Running evaluation...'
    WHEN 'purchase' THEN concat('[EVAL] eval_loss=0.', cast(event_id % 1000 AS string))
    WHEN 'view' THEN concat('[TRAIN] step=', cast(event_id AS string), '/? loss=nan lr=0.0002')
    ELSE concat('[TRAIN] step=', cast(event_id AS string), '/10000 loss=2.', cast(event_id % 100 AS string), ' lr=2e-04') END AS value
FROM events
"""

INPUTS["fx_base_tensors"] = """
SELECT concat('model.language_model.layers.', cast(p_partkey AS string),
    CASE p_partkey % 6 WHEN 0 THEN '.self_attn.q_proj.weight' WHEN 1 THEN '.mlp.experts.gate_up_proj' WHEN 2 THEN '.self_attn.o_proj.linear.weight'
      WHEN 3 THEN '.self_attn.k_proj.weight' WHEN 4 THEN '.mlp.experts.down_proj' ELSE '.mlp.gate.weight' END) AS name,
  concat('model-0000', cast(p_partkey % 3 AS string), '.safetensors') AS shard,
  CASE WHEN p_partkey % 6 IN (1, 4) THEN 8 END AS experts,
  p_size + 16 AS out_dim,
  64 AS in_dim
FROM part
"""

INPUTS["fx_adapter_keys"] = f"""
SELECT concat('base_model.model.model.layers.', cast(p_partkey AS string),
    CASE p_partkey % 6 WHEN 0 THEN '.self_attn.q_proj' WHEN 1 THEN '.mlp.experts.base_layer' WHEN 2 THEN '.self_attn.v_proj'
      WHEN 3 THEN '.self_attn.k_proj' WHEN 4 THEN '.mlp.experts' ELSE '.mlp.gate' END,
    CASE WHEN f = 'B' AND p_partkey % 10 = 9 THEN '.lora_embedding_B' ELSE concat('.lora_', f, '.weight') END) AS key,
  CASE WHEN f = 'A' THEN CASE WHEN p_partkey % 6 IN (1, 4) THEN 32 ELSE 4 END ELSE p_size + 16 END AS dim0,
  CASE WHEN f = 'A' THEN CASE WHEN p_partkey % 14 = 0 THEN 63 ELSE 64 END
    ELSE CASE WHEN p_partkey % 6 IN (1, 4) THEN CASE WHEN p_partkey % 16 = 4 THEN 31 ELSE 32 END ELSE 4 END END AS dim1
FROM {_BOTH_FACTORS}
"""

INPUTS["fx_saved_names"] = """
SELECT CASE WHEN p_partkey % 7 = 0 THEN concat('extra.', cast(p_partkey AS string), '.bias')
    ELSE concat('model.language_model.layers.', cast(p_partkey AS string),
      CASE p_partkey % 6 WHEN 0 THEN '.self_attn.q_proj.weight' WHEN 1 THEN '.mlp.experts.gate_up_proj' WHEN 2 THEN '.self_attn.o_proj.weight'
        WHEN 3 THEN '.self_attn.k_proj.weight' WHEN 4 THEN '.mlp.experts.down_proj' ELSE '.mlp.gate.weight' END) END AS name
FROM part
"""

INPUTS["fx_file_listing"] = """
SELECT page_id % 4 AS model,
  concat('snap', cast(page_id % 20 AS string)) AS snapshot,
  concat('snap', cast(page_id % 20 AS string), '/', cast(page_id AS string), CASE page_id % 3 WHEN 0 THEN '.safetensors' ELSE '.json' END) AS path,
  page_id * 7919 % 1000 AS mtime
FROM pages
"""


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Run one derived input over the parquet tables under ``sf_dir``."""
    text = INPUTS[name]
    used = {
        t: table(spark, sf_dir, t)
        for t in TABLES if re.search(rf"^FROM {t}\b", text, re.MULTILINE)
    }
    text = text.replace("{", "{{").replace("}", "}}")
    for t in used:
        text = re.sub(rf"^FROM {t}\b", f"FROM {{{t}}}", text, flags=re.MULTILINE)
    return spark.sql(text, **used)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read as it lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
