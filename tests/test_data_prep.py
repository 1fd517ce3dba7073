"""Reading JSON lines, the message forms, and the prepared table."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tunelake.operators import chat
from tunelake.plans.prepare import prepare_training_table, write_training_table
from tunelake.sources import jsonl

LINES = [
    ("", "blank"), (" \t ", "blank"), ("{oops", "bad_json"), ("[1]", "not_object"), ('"text"', "not_object"),
    ('{"score": 1, "b": 2}', "unrecognized"), ('{"messages": null}', "ok"),
    ('{"question": "q", "answer": "a", "context": ""}', "ok"),
    ('{"question": 5, "answer": "a", "metadata": {"k": 1}}', "ok"),
    ('{"question": "q", "answer": "a", "metadata": "text"}', "ok"),
    ('{"instruction": "i", "output": "o", "input": " "}', "ok"), ("{}", "unrecognized"),
    ('　{"system": "s"}　', "ok"),
]


@pytest.fixture(scope="module")
def classified(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LINES)], "line_no long, value string")
    return jsonl.classify_lines(df)


def test_line_status(classified):
    got = {r.line_no: r.status for r in classified.collect()}
    assert [got[i] for i in range(len(LINES))] == [s for _, s in LINES]


def test_rejects_name_sorted_keys(classified):
    rows = {r.line_no: r for r in jsonl.rejected_lines(classified, "line_no").collect()}
    assert {i for i, (_, s) in enumerate(LINES) if s not in ("ok", "blank")} == set(rows)
    assert rows[5]["keys"] == ["b", "score"] and rows[11]["keys"] == [] and rows[2]["keys"] is None


def test_fields_and_formats(classified):
    df = chat.to_messages(jsonl.training_fields(classified, "line_no"))
    rows = {r.line_no: r for r in df.select("line_no", "format", "messages.content", "question").collect()}
    assert {i: r.format for i, r in rows.items()} == {
        6: "unknown", 7: "qa", 8: "qa", 9: "qa", 10: "instruct", 12: "unknown"}
    assert rows[7].content == ["q", "a"] and rows[8].question == "5"
    assert rows[10].content == ["i\n\n ", "o"]


def test_lines_are_parsed_once_per_row(classified):
    plan = jsonl.training_fields(classified, "line_no")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1


def write_jsonl(path, texts):
    path.write_text("\n".join(texts) + "\n", encoding="utf8")


def test_line_numbers_across_splits(spark, tmp_path):
    for name, n in (("a", 5000), ("b", 37)):
        write_jsonl(tmp_path / f"{name}.jsonl", [
            "bad" if i % 97 == 5 else "" if i % 11 == 0 else json.dumps({"question": f"{name}{i}", "answer": "x" * 50})
            for i in range(1, n + 1)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = jsonl.read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        bad = jsonl.rejected_lines(jsonl.classify_lines(lines), "file", "block", "pos", "value")
        got = {(r.file[-7], r.line_no) for r in jsonl.number_lines(bad, lines).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {(name, i) for name, n in (("a", 5000), ("b", 37)) for i in range(1, n + 1) if i % 97 == 5}


def test_strict_load_fails_on_a_bad_line(spark, tmp_path):
    write_jsonl(tmp_path / "x.jsonl", ['{"question": "q", "answer": "a"}', "", "{oops"])
    path = str(tmp_path / "x.jsonl")
    loaded = jsonl.load_training_table(spark, path)
    assert loaded.accepted.count() == 1 and [r.reason for r in loaded.rejected.collect()] == ["bad_json"]
    with pytest.raises(PySparkException, match="line refused: bad_json"):
        jsonl.load_training_table(spark, path, strict=True).accepted.collect()


@pytest.mark.parametrize("block_rows", [3, 1000])
def test_eval_window(spark, block_rows):
    texts = ["a", " ", "b", "", "c", "d", "e"]
    df = spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "line_no long, value string")
    got = jsonl.eval_window(df, limit=4, start_from=1, block_rows=block_rows).collect()
    assert sorted((r.idx, r.value) for r in got) == [(1, "b"), (2, "c"), (3, "d")]


def test_eval_window_over_many_blocks(spark, tmp_path):
    """No window over a constant key, and the scan is bound by the order column itself."""
    lines = spark.range(1, 20_001).select(F.col("id").alias("line_no"), F.lit("x").alias("value"))
    lines.repartitionByRange(20, "line_no").write.parquet(str(tmp_path / "lines"))
    got = jsonl.eval_window(spark.read.parquet(str(tmp_path / "lines")), limit=5_020, start_from=5_000, block_rows=100)
    assert sorted(r.line_no for r in got.collect()) == list(range(5_001, 5_021))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(0" not in plan and "(line_no" in plan and ">= scalar-subquery" in plan


def messages_of(spark, *docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "line_no long, value string")
    return chat.to_messages(jsonl.training_fields(jsonl.classify_lines(df), "line_no"))


CALLS = [
    ({"id": "1", "function": {"name": "f", "arguments": '{"a": [1, {"b": null}]}', "z": 1}},
     {"id": "1", "function": {"name": "f", "arguments": {"a": [1, {"b": None}]}, "z": 1}}),
    ({"name": "f", "arguments": ""}, {"name": "f", "arguments": {}}),
    ({"name": "f", "arguments": "  "}, {"name": "f", "arguments": {}}),
    ({"name": "f", "arguments": "{oops"}, {"name": "f", "arguments": {}}),
    ({"name": "f", "arguments": "[1, 2]"}, {"name": "f", "arguments": [1, 2]}),
    ({"name": "f", "arguments": {"a": "1"}}, {"name": "f", "arguments": {"a": "1"}}),
    ({"function": None, "arguments": "{}"}, {"function": None, "arguments": "{}"}),
    ({"function": {"name": "f", "arguments": None}}, {"function": {"name": "f", "arguments": None}}),
    ("text", "text"),
]


def test_tool_call_arguments(spark):
    df = messages_of(spark, {"messages": [{"role": "assistant", "content": "", "tool_calls": [c for c, _ in CALLS]},
                                          {"role": "assistant", "content": "", "tool_calls": []}]})
    row = df.select(F.to_json("messages")).first()[0]
    first, second = json.loads(row)
    assert first["tool_calls"] == [w for _, w in CALLS] and second["tool_calls"] == []


def test_roles_and_rendering(spark):
    df = messages_of(
        spark,
        {"conversations": [{"from": "human", "value": "a"}, {"role": "gpt", "content": "b"}, {"content": "c"},
                           {"from": None, "role": "human", "content": "d"}, {"from": "tool", "value": "e"}]},
        {"messages": [{"role": "system", "content": "s"}, {"role": "assistant", "content": None}, {"role": "user"}]})
    first, second = df.orderBy("line_no").select("messages", chat.render(F.col("messages")).alias("t")).collect()
    assert [(m.role, m.content) for m in first.messages] == [
        ("user", "a"), ("assistant", "b"), ("", "c"), ("user", "d"), ("tool", "e")]
    assert first.t == ("<start_of_turn>user\na<end_of_turn>\n<start_of_turn>model\nb<end_of_turn>\n"
                       "<start_of_turn>user\nd<end_of_turn>\n")
    assert second.t == ("<start_of_turn>system\ns<end_of_turn>\n<start_of_turn>model\nNone<end_of_turn>\n"
                        "<start_of_turn>user\n<end_of_turn>\n")


FIRSTS = [
    ([("system", ""), ("system", "s"), ("user", "u"), ("user", "v")], ("s", "u")),
    ([("user", None), ("system", "s"), ("user", "u")], ("", "")),
    ([("assistant", "a"), ("system", "s")], ("s", "")), ([("user", "u")], ("", "u")), ([], ("", "")),
]


def test_first_messages_both_forms(spark):
    arrays = spark.createDataFrame(
        [(i, [dict(role=r, content=c) for r, c in m]) for i, (m, _) in enumerate(FIRSTS)],
        "i int, m array<struct<role string, content string>>")
    got = arrays.orderBy("i").select(chat.first_messages(F.col("m"))).collect()
    assert [tuple(r[0]) for r in got] == [w for _, w in FIRSTS]
    turns = spark.createDataFrame(
        [(i, t, r, c) for i, (m, _) in enumerate(FIRSTS) for t, (r, c) in enumerate(m)],
        "conv_id int, turn int, role string, text string")
    rows = {r.conv_id: (r.system, r.user) for r in chat.first_messages_of_turns(turns).collect()}
    assert rows == {i: w for i, (m, w) in enumerate(FIRSTS) if m}


def test_render_takes_a_template(spark):
    df = messages_of(spark, {"question": "q", "answer": "a"})
    shout = chat.render_with(df, lambda messages, tools: F.upper(messages[0]["content"]))
    assert shout.first().text == "Q"


def test_prepared_table(spark, tmp_path):
    docs = [json.dumps({"question": f"q {i}", "answer": "a b c"}) for i in range(200)] + ["", "{oops"]
    lines = spark.createDataFrame(list(enumerate(docs)), "line_no long, value string")
    table = prepare_training_table(lines, "line_no", 8).table
    rows = table.collect()
    assert len(rows) == 200 and sum(r.split == "eval" for r in rows) == 20
    assert all(len(r.input_ids) == 8 == len(r.token_type_ids) and r.n_tokens > 8 for r in rows)
    write_training_table(table, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("split").count().count() == 2


def test_every_line_is_accounted_for(spark):
    docs = ['{"question": "q", "answer": "a"}', "", "{oops", "[1]", '{"x": 1}', '{"system": "x", "messages": null}', '{"messages": "abc"}',
            '{"conversations": ["hello"]}', '{"messages": ["hi"]}', '{"conversations": [{"from": "human", "value": "v"}]}']
    lines = spark.createDataFrame(list(enumerate(docs)), "line_no long, value string")
    made = prepare_training_table(lines, "line_no", 8)
    assert sorted(r.line_no for r in made.table.collect()) == [0, 9]
    assert {r.line_no: r.reason for r in made.rejected.collect()} == {
        2: "bad_json", 3: "not_object", 4: "unrecognized", 5: "unknown_format", 6: "unknown_format", 7: "bad_turn", 8: "bad_turn"}
