"""Queries: recorded executions of generated code."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tunelake.functions.codetext import extract_code_block
from tunelake.functions.exectext import categorize, error_line, parse_result, stderr_tail
from tunelake.operators import execeval
from tunelake.registry.core import register
from tunelake.registry.inputs import derive, table
from tunelake.sinks.records import append_new, commit_records, committed_records, read_records, write_records
from tunelake.sinks.shared import shared_dir

FX = ("fx_exec_results",)
FX2 = ("fx_exec_results", "fx_reference_invariants")

LINES = """WITH lines AS (SELECT *, right(stderr, 3000) AS tail,
  list_filter(string_split(stderr, chr(10)), lambda x: starts_with(x, '__EVAL_RESULT__'))[1] AS marked FROM fx_exec_results),
cat AS (SELECT *, substr(marked, 16) AS result,
  CASE WHEN trim(code) = '' THEN 'no_code' WHEN timed_out THEN 'timeout' WHEN returncode = 0 AND marked IS NOT NULL THEN 'ok'
    WHEN returncode = 0 THEN 'no_result' WHEN regexp_matches(tail, 'NameError|ImportError|ModuleNotFoundError|AttributeError') THEN 'api_error'
    WHEN contains(tail, 'SyntaxError') AND contains(tail, '<string>') THEN 'syntax_error' ELSE 'runtime' END AS category,
  left(coalesce(list_filter(list_transform(string_split(tail, chr(10)), lambda x: trim(x)),
    lambda x: x <> '' AND NOT starts_with(x, 'File ') AND NOT starts_with(x, 'Traceback'))[-1], ''), 300) AS error_line FROM lines)
"""
LAYERS = LINES + """,
l1 AS (SELECT *, NOT skipped AND query_error IS NULL AND trim(code) <> '' AS has_code_block,
  NOT skipped AND query_error IS NULL AND trim(code) <> '' AND syntax_ok AS L1_syntax_ok FROM cat),
l2 AS (SELECT *, CASE WHEN L1_syntax_ok THEN category END AS exec_category,
  CASE WHEN L1_syntax_ok AND category = 'ok' THEN result::JSON END AS res FROM l1),
layers AS (SELECT *, coalesce(exec_category <> 'api_error', false) AS L2_api_ok,
  coalesce(json_extract_string(res, '$.root_part_ok') = 'true', false) AS L3_exec_ok,
  coalesce(json_extract_string(res, '$.step_export_ok') = 'true', false) AS L4_step_ok,
  CASE WHEN exec_category IN ('api_error', 'syntax_error', 'runtime') THEN error_line END AS exec_error,
  CAST(json_extract_string(res, '$.volume') AS DOUBLE) AS volume,
  CAST(json_extract_string(res, '$.face_count') AS BIGINT) AS face_count,
  CAST(json_extract_string(res, '$.bbox[1][2]') AS DOUBLE) - CAST(json_extract_string(res, '$.bbox[0][2]') AS DOUBLE) AS dz FROM l2)
"""
L5 = LAYERS + """,
ref AS (SELECT l.*, r.example_id IS NOT NULL AS has_ref, r.volume AS rv, r.face_count AS rf, r.dz AS rz
  FROM layers l LEFT JOIN fx_reference_invariants r USING (example_id)),
l5 AS (SELECT *, L3_exec_ok AND example_id IS NOT NULL AS due,
  coalesce(abs(volume - rv) <= 0.1::DOUBLE * greatest(abs(rv), 1e-9::DOUBLE), false) AS volume_ok,
  coalesce(face_count = rf, false) AS faces_ok,
  coalesce(abs(dz - rz) <= 0.1::DOUBLE * greatest(abs(rz), 1e-9::DOUBLE), false) AS bbox_ok FROM ref),
scored AS (SELECT *, CASE WHEN due THEN has_ref AND volume_ok AND faces_ok AND bbox_ok END AS L5_invariants_ok,
  CASE WHEN due AND NOT has_ref THEN 'no_reference' END AS L5_reason FROM l5)
"""


def _n(cond: str) -> str:
    return f"CAST(sum(coalesce(({cond})::int, 0)) AS BIGINT)"


_Q = "NOT skipped AND query_error IS NULL"
COUNTS = L5 + f""",
counts AS (SELECT side, {_n(_Q)} AS queried, {_n('NOT skipped AND query_error IS NOT NULL')} AS query_error,
  {_n(f'{_Q} AND has_code_block')} AS has_code_block, {_n(f'{_Q} AND L1_syntax_ok')} AS L1, {_n(f'{_Q} AND L2_api_ok')} AS L2,
  {_n(f'{_Q} AND L3_exec_ok')} AS L3, {_n(f'{_Q} AND L4_step_ok')} AS L4, {_n(f'{_Q} AND L5_invariants_ok')} AS L5
  FROM scored GROUP BY side)
"""



def runs(spark, sf_dir):
    return derive(spark, sf_dir, "fx_exec_results")


def references(spark, sf_dir):
    return derive(spark, sf_dir, "fx_reference_invariants").withColumn(
        "bbox", F.array(
            F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)),
            F.array(F.lit(1.0), F.lit(2.0), F.col("dz"))))


def layered(spark, sf_dir):
    return execeval.score_layers(runs(spark, sf_dir))


def referenced(spark, sf_dir):
    return execeval.attach_references(
        layered(spark, sf_dir), references(spark, sf_dir))


def scored(spark, sf_dir):
    return execeval.score_invariants(referenced(spark, sf_dir))


@register("code_extract_exec", """
SELECT example_id, side, CASE WHEN regexp_matches(prediction, '(?s)```(?:python)?\\s*\\n(.*?)```')
  THEN regexp_extract(prediction, '(?s)```(?:python)?\\s*\\n(.*?)```', 1)
  WHEN regexp_matches(prediction, 'build123d|BuildPart|root_part') THEN prediction ELSE '' END AS code
FROM fx_code_pairs""", ("fx_code_pairs",))
def code_extract_exec(spark, sf_dir):
    return derive(spark, sf_dir, "fx_code_pairs").select(
        "example_id", "side", extract_code_block(F.col("prediction")).alias("code"))


@register("exec_categorize", LINES + "SELECT idx, side, category FROM cat", FX)
def exec_categorize(spark, sf_dir):
    return runs(spark, sf_dir).select("idx", "side", categorize(
        F.col("code"), F.col("timed_out"), F.col("returncode"), F.col("stderr")).alias("category"))


@register("exec_error_line", LINES + """
SELECT idx, side, error_line, CASE WHEN returncode = 0 THEN right(stderr, 500) ELSE right(tail, 600) END AS stderr_tail FROM cat""", FX)
def exec_error_line(spark, sf_dir):
    return runs(spark, sf_dir).select(
        "idx", "side", error_line(F.col("stderr")).alias("error_line"),
        stderr_tail(F.col("stderr"), F.col("returncode")).alias("stderr_tail"))


@register("exec_result_parse", LINES + """
SELECT idx, side, json_extract_string(result, '$.root_part_ok') = 'true' AS root_part_ok,
  CAST(json_extract_string(result, '$.volume') AS DOUBLE) AS volume, CAST(json_extract_string(result, '$.face_count') AS BIGINT) AS face_count,
  CAST(json_extract_string(result, '$.bbox[1][2]') AS DOUBLE) AS top, json_extract_string(result, '$.step_export_ok') = 'true' AS step_export_ok,
  CAST(json_extract_string(result, '$.step_size_bytes') AS BIGINT) AS step_size_bytes FROM cat""", FX)
def exec_result_parse(spark, sf_dir):
    return runs(spark, sf_dir).withColumn("r", parse_result(F.col("stderr"))).select(
        "idx", "side", "r.root_part_ok", "r.volume", "r.face_count",
        F.col("r.bbox")[1][2].alias("top"), "r.step_export_ok", "r.step_size_bytes")


@register("exec_layers", LAYERS + """
SELECT idx, side, has_code_block, L1_syntax_ok, L2_api_ok, L3_exec_ok, L4_step_ok, exec_category, exec_error FROM layers""", FX)
def exec_layers(spark, sf_dir):
    return layered(spark, sf_dir).select(
        "idx", "side", "has_code_block", *execeval.LAYERS[:4], "exec_category", "exec_error")


@register("exec_signature", LAYERS + """
SELECT idx, side, CASE WHEN skipped THEN '----' WHEN query_error IS NOT NULL THEN 'QERR' ELSE
  concat(CASE WHEN L1_syntax_ok THEN 'Y' ELSE '.' END, CASE WHEN L2_api_ok THEN 'Y' ELSE '.' END,
    CASE WHEN L3_exec_ok THEN 'Y' ELSE '.' END, CASE WHEN L4_step_ok THEN 'Y' ELSE '.' END) END AS signature FROM layers""", FX)
def exec_signature(spark, sf_dir):
    return layered(spark, sf_dir).select("idx", "side", execeval.signature().alias("signature"))


@register("join_reference_invariants", L5 + """
SELECT idx, side, example_id, has_ref, rv AS ref_volume, rf AS ref_faces FROM ref""", FX2)
def join_reference_invariants(spark, sf_dir):
    return referenced(spark, sf_dir).select(
        "idx", "side", "example_id", F.col("reference").isNotNull().alias("has_ref"),
        F.col("reference.volume").alias("ref_volume"), F.col("reference.face_count").alias("ref_faces"))


@register("exec_invariants", L5 + """
SELECT idx, side, volume_ok, faces_ok, bbox_ok, volume_ok AND faces_ok AND bbox_ok AS ok FROM l5 WHERE has_ref""", FX2)
def exec_invariants(spark, sf_dir):
    both = referenced(spark, sf_dir).filter(F.col("reference").isNotNull())
    return both.select("idx", "side", F.inline(F.array(
        execeval.compare_invariants(F.col("result"), F.col("reference")))))


@register("exec_l5", L5 + "SELECT idx, side, L5_invariants_ok, L5_reason FROM scored", FX2)
def exec_l5(spark, sf_dir):
    return scored(spark, sf_dir).select("idx", "side", "L5_invariants_ok", "L5_reason")


@register("exec_layer_counts", COUNTS + "SELECT * FROM counts", FX2)
def exec_layer_counts(spark, sf_dir):
    return execeval.layer_counts(scored(spark, sf_dir))


@register("report_exec_summary", COUNTS + """,
long AS (UNPIVOT counts ON has_code_block, L1, L2, L3, L4, L5, query_error INTO NAME metric VALUE n),
total AS (SELECT greatest(max(queried), 1) AS total FROM counts)
SELECT b.metric, b.n AS base_n, t.n AS tuned_n, total, b.n * 100 / total::DOUBLE AS base_pct, t.n * 100 / total::DOUBLE AS tuned_pct, t.n - b.n AS delta
FROM long b JOIN long t ON b.metric = t.metric AND b.side = 'base' AND t.side = 'tuned', total""", FX2)
def report_exec_summary(spark, sf_dir):
    return execeval.summary_table(execeval.layer_counts(scored(spark, sf_dir)))


@register("exec_summary_doc", COUNTS + """,
docs AS (SELECT side, concat('"', side, '":{"queried":', queried, ',"query_error":', query_error, ',"has_code_block":', has_code_block,
  ',"L1":', L1, ',"L2":', L2, ',"L3":', L3, ',"L4":', L4, ',"L5":', L5, '}') AS d FROM counts)
SELECT concat('{"n_total":', (SELECT count(*) FROM part), ',"sides":{', string_agg(d, ',' ORDER BY side), '}}') AS document FROM docs""", FX2)
def exec_summary_doc(spark, sf_dir):
    n_total = table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    return execeval.summary_document(execeval.layer_counts(scored(spark, sf_dir)), n_total)


# Records of an earlier session: a third is complete, a third is broken JSON, a third has none.
_RECORD = """CASE p_partkey % 3 WHEN 0 THEN concat('{"idx": ', cast(p_partkey AS string), '}') WHEN 1 THEN '{"idx": 1' END"""


@register("resume_pending", f"""
SELECT p_partkey AS idx, p_name FROM part
  WHERE NOT coalesce(json_valid({_RECORD}), false)""")
def resume_pending(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    rows = part.select(F.col("p_partkey").alias("idx"), "p_name")
    records = part.select(F.col("p_partkey").alias("idx"), F.expr(_RECORD).alias("record"))
    return execeval.pending(rows, records)


@register("sink_records", """
SELECT idx, side, example_id, CASE WHEN side = 'base' THEN 'first' ELSE 'second' END AS run_id FROM fx_exec_results""", FX)
def sink_records(spark, sf_dir):
    """One side written twice as one run, then both sides offered as another."""
    path = f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    both = runs(spark, sf_dir).select("idx", "side", "example_id")
    for _ in range(2):
        write_records(both.filter(F.col("side") == "base"), path, "first")
    append_new(both, path, "second", ["idx", "side"])
    return read_records(spark, path)


@register("sink_committed", """
SELECT idx, side, CASE WHEN side = 'base' THEN example_id ELSE upper(example_id) END AS example_id,
  CASE WHEN side = 'base' THEN 'first' ELSE 'second' END AS run_id FROM fx_exec_results""", FX)
def sink_committed(spark, sf_dir):
    """All results as one run, one side again with other values as a later run, and a run that never commits."""
    path = f"{shared_dir(spark)}/committed-{uuid.uuid4().hex}"
    both = runs(spark, sf_dir).select("idx", "side", "example_id")
    later = both.filter(F.col("side") != "base").withColumn("example_id", F.upper("example_id"))
    commit_records(both.filter(F.col("side") == "base"), path, "first")
    commit_records(both, path, "first")
    commit_records(later, path, "second")
    both.withColumn("example_id", F.lit("lost")).write.parquet(f"{path}/data/{uuid.uuid4().hex}")
    return committed_records(spark, path, ["idx", "side"])
