"""Queries: token sequences and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunelake.functions.pytext import is_blank
from tunelake.operators import chat, splits, tokens
from tunelake.plans.prepare import prepare_training_table
from tunelake.registry.core import register
from tunelake.registry.data_prep import FX, PARSED, RENDERED
from tunelake.registry.inputs import derive, table
from tunelake.registry.sql_text import WS
from tunelake.sinks.shared import shared_dir
from tunelake.sources import jsonl

MAX_LEN = 256
NUM_BUCKETS = 8
PIECE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_" + WS[1:]


def _h32(e: str) -> str:
    return f"CAST(concat('0x', substr(md5({e}), 1, 8)) AS BIGINT)"


def _order(e: str, seed: str = "42") -> str:
    return f"md5(concat_ws(':', {e}, '{seed}'))"


TOKENS = RENDERED + f""",
words AS (SELECT line_no, format, regexp_extract_all(text, '{PIECE}') AS w FROM rendered),
toks AS (SELECT line_no, format, CAST(len(w) AS INTEGER) AS n_tokens,
  list_transform(w, lambda t: {_h32('t')} % {tokens.VOCAB_SIZE - 1} + 1) AS all_ids, all_ids[1:{MAX_LEN}] AS ids FROM words)
"""
def _buckets(ids: str) -> str:
    return TOKENS + f""",
placed AS (SELECT line_no, {ids} AS ids, CAST(len({ids}) AS BIGINT) AS size, greatest(CAST(n_tokens AS INTEGER) - {MAX_LEN}, 0) AS tokens_cut,
  CAST({_h32('CAST(line_no AS VARCHAR)')} % {NUM_BUCKETS} AS BIGINT) AS bucket, {_order('line_no')} AS h FROM toks),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY h, line_no) AS rn,
  CAST(coalesce(sum(size) OVER (PARTITION BY bucket ORDER BY h, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM placed)
"""


CUT, UNCUT = _buckets("ids"), _buckets("all_ids")


def _joined(col):
    return F.array_join(F.col(col).cast("array<string>"), " ").alias(col)


def dealt_lines(spark, sf_dir):
    """Lines dealt over tasks before they are parsed: a file of one row group would be one task's work."""
    return derive(spark, sf_dir, "fx_jsonl_lines").repartition("line_no")


def rendered(spark, sf_dir):
    parsed = jsonl.training_fields(jsonl.classify_lines(dealt_lines(spark, sf_dir)), "line_no")
    return chat.render_with(chat.to_messages(parsed))


def tokenized(spark, sf_dir):
    return tokens.tokenize(rendered(spark, sf_dir), MAX_LEN)


def stored_tokens(spark, sf_dir):
    """Uncut token rows written once, as batching and packing read a prepared table."""
    shared_dir(spark)
    whole = tokens.tokenize(rendered(spark, sf_dir), None)
    return whole.select("line_no", "input_ids").checkpoint()


@register("tok_truncate", TOKENS + """
SELECT line_no, n_tokens, array_to_string(ids, ' ') AS input_ids FROM toks""", FX)
def tok_truncate(spark, sf_dir):
    return tokenized(spark, sf_dir).select("line_no", "n_tokens", _joined("input_ids"))


@register("tok_aux_zeros", TOKENS + """
SELECT line_no, trim(repeat('1 ', len(ids))) AS attention_mask, trim(repeat('0 ', len(ids))) AS token_type_ids,
  trim(repeat('0 ', len(ids))) AS mm_token_type_ids FROM toks""", FX)
def tok_aux_zeros(spark, sf_dir):
    return tokens.add_aux(tokenized(spark, sf_dir)).select(
        "line_no", _joined("attention_mask"), *[_joined(f) for f in tokens.AUX_FIELDS])


@register("prj_drop_aux", TOKENS + """
SELECT line_no, n_tokens, array_to_string(ids, ' ') AS input_ids, trim(repeat('1 ', len(ids))) AS attention_mask FROM toks""", FX)
def prj_drop_aux(spark, sf_dir):
    kept = tokens.drop_aux(tokens.add_aux(tokenized(spark, sf_dir)))
    return kept.drop(
        "messages", "tools", "conversations", "text", "format",
        "system", "question", "answer", "context", "instruction", "input", "output",
    ).withColumns({c: _joined(c) for c in ("input_ids", "attention_mask")})


@register("tok_collate", CUT + """,
batched AS (SELECT *, CAST(floor((rn - 1) / 8.0) AS BIGINT) AS batch, CAST((rn - 1) % 8 AS INTEGER) AS row_in_batch FROM ranked),
widths AS (SELECT bucket, batch, max(size) AS width FROM batched GROUP BY bucket, batch),
wide AS (SELECT b.*, w.width, w.width - b.size AS gap FROM batched b JOIN widths w USING (bucket, batch))
SELECT line_no, bucket, batch, row_in_batch, tokens_cut, CAST(width AS INTEGER) AS width,
  array_to_string(ids || list_transform(range(gap), lambda g: 0), ' ') AS input_ids,
  array_to_string(ids || list_transform(range(gap), lambda g: -100), ' ') AS labels,
  trim(concat(repeat('1 ', size), repeat('0 ', gap))) AS attention_mask,
  trim(repeat('0 ', width)) AS token_type_ids FROM wide""", FX)
def tok_collate(spark, sf_dir):
    ready = tokens.add_aux(stored_tokens(spark, sf_dir))
    return tokens.collate(ready, "line_no", 8, num_buckets=NUM_BUCKETS, max_len=MAX_LEN).select(
        "line_no", "bucket", "batch", "row_in_batch", "tokens_cut", "width", _joined("input_ids"),
        _joined("labels"), _joined("attention_mask"), _joined("token_type_ids"))


@register("tok_collate_global", TOKENS + f""",
numbered AS (SELECT *, len(ids) AS size, greatest(CAST(n_tokens AS INTEGER) - {MAX_LEN}, 0) AS tokens_cut, row_number() OVER (ORDER BY {_order('line_no')}, line_no) - 1 AS place FROM toks),
batched AS (SELECT *, CAST(floor(place / 8.0) AS BIGINT) AS batch, CAST(place % 8 AS INTEGER) AS row_in_batch FROM numbered),
wide AS (SELECT *, max(size) OVER (PARTITION BY batch) AS width FROM batched)
SELECT line_no, batch, row_in_batch, CAST(tokens_cut AS INTEGER) AS tokens_cut, CAST(width AS INTEGER) AS width,
  array_to_string(ids || list_transform(range(width - size), lambda g: 0), ' ') AS input_ids,
  array_to_string(ids || list_transform(range(width - size), lambda g: -100), ' ') AS labels FROM wide""", FX)
def tok_collate_global(spark, sf_dir):
    """Batches over all rows: every one but the last is full."""
    return tokens.collate(stored_tokens(spark, sf_dir), "line_no", 8, max_len=MAX_LEN).select(
        "line_no", "batch", "row_in_batch", "tokens_cut", "width", _joined("input_ids"), _joined("labels"))


@register("tok_pack_wrapped", UNCUT + f""",
stream AS (SELECT bucket, start + k AS place, ids[k + 1] AS tok FROM (SELECT *, unnest(range(size)) AS k FROM ranked))
SELECT bucket, CAST(floor(place / {MAX_LEN}.0) AS BIGINT) AS block, array_to_string(list(tok ORDER BY place), ' ') AS input_ids
FROM stream GROUP BY ALL""", FX)
def tok_pack_wrapped(spark, sf_dir):
    return tokens.pack_wrapped(
        stored_tokens(spark, sf_dir), "line_no", MAX_LEN, num_buckets=NUM_BUCKETS
    ).select("bucket", "block", _joined("input_ids"))


@register("tok_pack_examples", CUT.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
filled(bucket, rn, line_no, size, ids, tokens_cut, pack, pos) AS (
  SELECT bucket, rn, line_no, size, ids, tokens_cut, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.bucket, r.rn, r.line_no, r.size, r.ids, r.tokens_cut,
    CASE WHEN f.pos + f.size + r.size > {MAX_LEN} THEN f.pack + 1 ELSE f.pack END,
    CASE WHEN f.pos + f.size + r.size > {MAX_LEN} THEN 0 ELSE f.pos + f.size END
  FROM filled f JOIN ranked r ON r.bucket = f.bucket AND r.rn = f.rn + 1)
SELECT bucket, pack, CAST(sum(tokens_cut) AS INTEGER) AS tokens_cut, array_to_string(list(line_no ORDER BY rn), ' ') AS example_ids,
  array_to_string(list(pos ORDER BY rn), ' ') AS starts,
  array_to_string(flatten(list(ids ORDER BY rn)), ' ') AS input_ids FROM filled GROUP BY bucket, pack""", FX)
def tok_pack_examples(spark, sf_dir):
    return tokens.pack_examples(
        stored_tokens(spark, sf_dir), "line_no", MAX_LEN, num_buckets=NUM_BUCKETS, cut_long=True
    ).select("bucket", "pack", "tokens_cut", _joined("example_ids"), _joined("starts"), _joined("input_ids"))


@register("tok_profile", TOKENS + f""",
shown AS (SELECT line_no, CAST(sum((role NOT IN ('user', 'assistant', 'system'))::int) AS BIGINT) AS unseen FROM messages GROUP BY line_no),
ordered AS (SELECT *, row_number() OVER (ORDER BY {_order('line_no')}, line_no) AS rn, count(*) OVER () AS n FROM toks JOIN shown USING (line_no)),
split AS (SELECT *, CASE WHEN rn <= ceil(n * 0.1::DOUBLE) THEN 'eval' ELSE 'train' END AS split FROM ordered)
SELECT format, split, count(*) AS examples, CAST(sum(n_tokens) AS BIGINT) AS tokens, min(n_tokens) AS min_tokens,
  max(n_tokens) AS max_tokens, avg(n_tokens) AS mean_tokens, CAST(sum(unseen) AS BIGINT) AS turns_left_out
FROM split GROUP BY format, split""", FX)
def tok_profile(spark, sf_dir):
    lines = dealt_lines(spark, sf_dir)
    return tokens.profile(
        prepare_training_table(lines, "line_no", MAX_LEN, aux=False).table, "format", "split")


@register("prepare_accounting", PARSED + """,
outcomes AS (
  SELECT CASE WHEN status <> 'ok' THEN status WHEN format = 'unknown' THEN 'unknown_format'
    WHEN format = 'messages' AND len(list_filter(json_extract(c.j, '$.messages[*]'), lambda x: json_type(x) <> 'OBJECT')) > 0
      OR format = 'conversations' AND len(list_filter(json_extract(c.j, '$.conversations[*]'), lambda x: json_type(x) <> 'OBJECT')) > 0
    THEN 'bad_turn' ELSE 'accepted' END AS outcome FROM classed c LEFT JOIN formats USING (line_no))
SELECT outcome, count(*) AS lines FROM outcomes GROUP BY outcome""", FX)
def prepare_accounting(spark, sf_dir):
    """Where every line goes: accepted, rejected by reason, or blank."""
    lines = derive(spark, sf_dir, "fx_jsonl_lines")
    made = prepare_training_table(lines, "line_no", MAX_LEN, aux=False)
    blank = lines.filter(is_blank(F.col("value"))).select(F.lit("blank").alias("outcome"))
    outcomes = made.table.select(F.lit("accepted").alias("outcome")).unionAll(
        made.rejected.select("reason")).unionAll(blank)
    return outcomes.groupBy("outcome").agg(F.count("*").alias("lines"))


@register("split_train_eval", f"""
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY {_order('doc_id')}, doc_id) AS rn, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN rn <= ceil(n * 0.1::DOUBLE) THEN 'eval' ELSE 'train' END AS split FROM o""")
def split_train_eval(spark, sf_dir):
    return splits.split_exact(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@register("split_holdout_min1", f"""
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY {_order('doc_id')}, doc_id) AS rn, count(*) OVER () AS n FROM documents)
SELECT doc_id FROM o WHERE rn <= greatest(1, floor(n * 0.05::DOUBLE))""")
def split_holdout_min1(spark, sf_dir):
    return splits.holdout(
        table(spark, sf_dir, "documents").select("doc_id"), "doc_id",
        fraction=0.05, count=splits.floor_count_min1(0.05))


@register("split_threshold", f"""
SELECT doc_id, CASE WHEN {_h32(_order('doc_id').removeprefix('md5(').removesuffix(')'))} < {int(0.1 * 2**32)} THEN 'eval' ELSE 'train' END AS split
FROM documents""")
def split_threshold(spark, sf_dir):
    return splits.split_by_threshold(
        table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@register("split_holdout_head", f"""
WITH o AS (SELECT *, row_number() OVER (ORDER BY {_order('example_id')}, example_id) AS rn, count(*) OVER () AS n FROM fx_sql_pairs)
SELECT example_id, context, question, truth AS answer FROM o WHERE rn <= ceil(n * 0.05::DOUBLE) AND rn <= 50""", ("fx_sql_pairs",))
def split_holdout_head(spark, sf_dir):
    qa = derive(spark, sf_dir, "fx_sql_pairs").select(
        "example_id", "context", "question", F.col("truth").alias("answer"))
    return splits.head_of_order(splits.holdout(qa, "example_id", fraction=0.05), "example_id", 50)


@register("split_pick_subset", f"""
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY {_order('doc_id')}, doc_id) AS rn, count(*) OVER () AS n FROM documents),
e AS (SELECT doc_id, row_number() OVER (ORDER BY {_order('doc_id', '42:pick')}, doc_id) AS pick FROM o WHERE rn <= ceil(n * 0.1::DOUBLE))
SELECT doc_id AS orig_index FROM e WHERE pick <= 100""")
def split_pick_subset(spark, sf_dir):
    return splits.pick_subset(
        table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100
    ).withColumnRenamed("doc_id", "orig_index")
