"""Golden rows for the text rules, one per branch."""

import pytest
from pyspark.sql import functions as F

from tunelake.functions import codetext, exectext, loranames, pytext
from tunelake.functions.sqltext import with_normal_sql
from tunelake.operators.codeeval import code_checks


def column_of(spark, values, expr, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.select("i", expr.alias("y")).orderBy("i").select("y").collect()]


SPACES = [chr(c) for c in range(0x3100) if chr(c).isspace()]


def test_space_class_is_pythons():
    assert sorted(pytext.SPACE_CHARS) == sorted(SPACES)


def test_strip_and_squeeze_follow_python(spark):
    texts = [f"{s}a{s}{s}b{s}" for s in SPACES] + ["", " ", "a", "​x​"]
    assert column_of(spark, texts, pytext.strip(F.col("x"))) == [t.strip() for t in texts]
    assert column_of(spark, texts, pytext.squeeze(F.col("x"))) == [" ".join(t.split()) for t in texts]


def test_splitlines_follows_python(spark):
    texts = ["a\nb", "a\r\nb\r", "\n", "a\n\nb\n", "x\x0by\x85z w", "one"]
    assert column_of(spark, texts, pytext.splitlines(F.col("x"))) == [t.splitlines() for t in texts]


SQL_CASES = [
    (None, ""), ("", ""), ("SELECT 1", "select 1"),
    ("Sure:\n```sql\nSELECT a\nFROM t\n```\nmore", "select a from t"),
    ("```SELECT a```", "select a"),
    ("```python\nSELECT a```", "python select a"),
    ("SQL: `SELECT a FROM t;` done", "select a from t"),
    ("SELECT x FROM (SELECT y FROM t)", "select y from t)"),
    ("SELECT a\n\nNote: b", "select a"), ("SELECT a\n\nThis is b", "select a"),
    ("SELECT a\n\nThese are b", "select a these are b"),
    ("SELECT a\n\nExplanation", "select a"), ("SELECT a\n`b", "select a"),
    ("SELECT a <|im_end|> b", "select a"), ("x<end_of_turn>y", "x"),
    ("SELECT user_id FROM t", "select"), ("SELECT m FROM model", "select m from"),
    ("SELECT 'a'", 'select "a"'), ("```sql\nSELECT a;;\n```", "select a"),
    ("SELECT　a", "select a"), ("```sql\nSELECT a", "select a"),
    ("selection of things", "selection of things"), ("use SELECT", "select"),
    ("```\nfoo``` SELECT b", "foo"), ("; SELECT a", "select a"),
]


@pytest.mark.parametrize("compat", [True, False])
def test_sql_normal_form(spark, compat):
    cases = SQL_CASES if compat else [
        ("SELECT user_id FROM t", "select user_id from t"), ("SELECT m FROM model", "select m from model")]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, x string")
    rows = with_normal_sql(df, "x", "y", compat=compat).orderBy("i").collect()
    assert [r.y for r in rows] == [want for _, want in cases]
    assert rows[0].asDict().keys() == {"i", "x", "y"}


# text, (code, has_python), code for execution
FENCES = [
    ("```python\nx = 1\n```", ("x = 1", True), "x = 1\n"),
    ("```PYTHON\nx\n```", ("x", True), ""),
    ("```js\nx\n```", ("x", False), ""),
    ("```\nx\n```", ("x", False), "x\n"),
    ("```python\nx```", (None, False), "x"),
    ("root_part = 1", (None, False), "root_part = 1"),
    ("Sorry.", (None, False), ""),
    ("```python\r\nx\r\n```", ("x\r", True), "x\r\n"),
    ("```python \nx\n```", ("x", True), "x\n"),
    ("```js\na\n```\nprose\n```\nb\n```", ("a", False), "prose\n"),
    (None, (None, False), ""), ("", (None, False), ""),
]


def test_code_extraction(spark):
    texts = [t for t, _, _ in FENCES]
    found = column_of(spark, texts, codetext.extract_code(F.col("x")))
    assert [tuple(r) for r in found] == [w for _, w, _ in FENCES]
    assert column_of(spark, texts, codetext.extract_code_block(F.col("x"))) == [w for _, _, w in FENCES]


def test_called_names(spark):
    code = ["Box(1) + Box (2); foo(Bar(3)).Baz()", "xBox(1)", None, "Box\n(1)", "A_1("]
    assert column_of(spark, code, codetext.called_names(F.col("x"))) == [
        ["Bar", "Baz", "Box"], [], [], ["Box"], ["A_1"]]


def test_length_sanity(spark):
    df = spark.createDataFrame(
        [("ab", "abcd", True), ("a", "abcd", False), ("a" * 8, "abcd", True), ("a" * 9, "abcd", False),
         ("a", "", False), (None, "a", False)], "g string, r string, want boolean")
    rows = df.select(codetext.length_sanity(F.col("g"), F.col("r")).alias("got"), "want").collect()
    assert [r.got for r in rows] == [r.want for r in rows]


# code, (parses, defines_target, forbidden)
PYTHON = [
    ("root_part = 1", (True, True, False)), ("def f():\n    root_part = 1", (True, True, False)),
    ("root_part: int = 1", (True, True, False)), ("root_part, b = 1, 2", (True, False, False)),
    ("root_part += 1", (True, False, False)), ("x = root_part = 1", (True, True, False)),
    ("(root_part := 1)", (True, False, False)), ("a.root_part = 1", (True, False, False)),
    ("import os.path", (True, False, True)), ("import numpy, sys as s", (True, False, True)),
    ("from os import x", (True, False, True)), ("from . import os", (True, False, False)),
    ("import osmium", (True, False, False)), ("root_part = = 1", (False, False, False)),
    ("import os; x = = 1", (False, False, False)), ("x = 1\0", (False, False, False)),
    ("", (True, False, False)), (None, (False, False, False)),
]


def test_code_checks(spark):
    got = column_of(spark, [c for c, _ in PYTHON], code_checks(F.col("x")))
    assert [(r.parses, r.defines_target, r.forbidden) for r in got] == [w for _, w in PYTHON]
    assert got[13].syntax_error.startswith("SyntaxError at line 1: ")


# code, timed_out, returncode, stderr, category
RUNS = [
    (" ", False, 0, "", "no_code"), ("x", True, None, None, "timeout"),
    ("x", False, 0, "w\n__EVAL_RESULT__{}", "ok"), ("x", False, 0, "w __EVAL_RESULT__{}", "no_result"),
    ("x", False, 0, None, "no_result"), ("x", False, 1, "NameError: a", "api_error"),
    ("x", False, 1, "ModuleNotFoundError", "api_error"),
    ("x", False, 1, 'File "<string>"\nSyntaxError', "syntax_error"), ("x", False, 1, "SyntaxError", "runtime"),
    ("x", False, 1, "NameError" + "y" * 3000, "runtime"), ("x", False, 1, "", "runtime"),
    ("x", False, 1, "ValueError: NameError", "api_error"),
]


def test_exec_categories(spark):
    df = spark.createDataFrame(RUNS, "code string, t boolean, rc int, err string, want string")
    got = df.select(exectext.categorize(
        F.col("code"), F.col("t"), F.col("rc"), F.col("err")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_exec_error_line(spark):
    errs = ["Traceback (most recent call last):\n  File \"x\"\nValueError: a\n\n", "  File \"x\"", "",
            None, "E: " + "z" * 400]
    assert column_of(spark, errs, exectext.error_line(F.col("x"))) == [
        "ValueError: a", "", "", "", ("E: " + "z" * 400)[:300]]


def test_exec_result(spark):
    err = ['w\n__EVAL_RESULT__{"volume": 2.5, "bbox": [[0,0,0],[1,2,3]], "root_part_ok": true}\n'
           '__EVAL_RESULT__{"volume": 9}', "none"]
    first, second = column_of(spark, err, exectext.parse_result(F.col("x")))
    assert (first.volume, first.bbox, first.root_part_ok, first.face_count) == (
        2.5, [[0, 0, 0], [1, 2, 3]], True, None)
    assert second is None


def test_adapter_names(spark):
    keys = [
        "base_model.model.model.layers.3.self_attn.q_proj.lora_A.weight",
        "base_model.model.model.layers.3.mlp.experts.base_layer.lora_B.weight",
        "base_model.model.model.layers.3.mlp.experts.lora_A.weight",
        "other.root.lora_B.weight", "base_model.model.x.lora_C.weight",
    ]
    got = column_of(spark, keys, loranames.parse_adapter_key(F.col("x")))
    assert [tuple(g) if g else None for g in got] == [
        ("model.layers.3.self_attn.q_proj", "bare", "A"),
        ("model.layers.3.mlp.experts", "base_layer", "B"),
        ("model.layers.3.mlp.experts", "bare", "A"), ("other.root", "bare", "B"), None]
    roots = [(g.root, g.slot) for g in got if g]
    df = spark.createDataFrame(roots, "r string, s string")
    assert [r[0] for r in df.select(loranames.resolve_target(F.col("r"), F.col("s"))).collect()] == [
        "model.language_model.layers.3.self_attn.q_proj.weight",
        "model.language_model.layers.3.mlp.experts.gate_up_proj",
        "model.language_model.layers.3.mlp.experts.down_proj", "other.root.weight"]


def test_trainable_names(spark):
    names = ["a.q_proj.weight", "a.q_proj", "a.xq_proj.weight", "mtp.q_proj.weight", "a.gate.weight", "a.q_proj.bias"]
    assert column_of(spark, names, loranames.is_trainable(F.col("x"))) == [
        True, True, False, False, False, False]
