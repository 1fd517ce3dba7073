"""Queries: adapter and base tensors."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tunelake.functions.loranames import ATTENTION, is_trainable, parse_adapter_key, resolve_target
from tunelake.operators import weights
from tunelake.plans.merge import merge_adapter
from tunelake.registry.core import register
from tunelake.registry.inputs import derive, table
from tunelake.sinks.shared import shared_dir
from tunelake.sinks.tensors import write_shards
from tunelake.sources import tensors

EXPERTS = 8
FX = ("fx_base_tensors", "fx_adapter_keys")

FACTORS = """WITH f AS (SELECT *, regexp_replace(key, '\\Abase_model\\.model\\.', '') AS bare, regexp_extract(key, '\\.lora_(A|B)\\.weight\\z', 1) AS factor
  FROM fx_adapter_keys WHERE regexp_matches(key, '\\.lora_(A|B)\\.weight\\z')),
r AS (SELECT *, regexp_replace(bare, '\\.lora_(A|B)\\.weight\\z', '') AS raw FROM f),
s AS (SELECT *, regexp_replace(raw, '\\.base_layer\\z', '') AS root, CASE WHEN ends_with(raw, '.base_layer') THEN 'base_layer' ELSE 'bare' END AS slot FROM r),
factors AS (SELECT key, dim0, dim1, root, slot, factor,
  concat(regexp_replace(root, '\\Amodel\\.layers\\.', 'model.language_model.layers.'),
    CASE WHEN NOT ends_with(root, '.mlp.experts') THEN '.weight' WHEN slot = 'base_layer' THEN '.gate_up_proj' ELSE '.down_proj' END) AS target FROM s),
pairs AS (SELECT root, slot, target, max(CASE WHEN factor = 'A' THEN dim0 END) AS a_rows, max(CASE WHEN factor = 'A' THEN dim1 END) AS a_cols,
  max(CASE WHEN factor = 'B' THEN dim0 END) AS b_rows, max(CASE WHEN factor = 'B' THEN dim1 END) AS b_cols FROM factors GROUP BY ALL)
"""
MATCHED = FACTORS + f""",
matched AS (SELECT p.*, b.shard, b.experts, b.out_dim, b.in_dim, CASE WHEN a_rows IS NULL OR b_rows IS NULL THEN 'incomplete'
  WHEN b.name IS NULL THEN 'target_missing'
  WHEN a_cols = in_dim AND b_rows = out_dim AND a_rows = b_cols AND (experts IS NULL OR (experts = {EXPERTS} AND a_rows % experts = 0)) THEN 'merged'
  ELSE 'shape_mismatch' END AS status FROM pairs p LEFT JOIN fx_base_tensors b ON b.name = p.target)
"""


def base(spark, sf_dir):
    return derive(spark, sf_dir, "fx_base_tensors")


def factors(spark, sf_dir):
    return weights.adapter_factors(derive(spark, sf_dir, "fx_adapter_keys"))


def pairs(spark, sf_dir):
    return weights.lora_pairs(factors(spark, sf_dir))


def matched(spark, sf_dir):
    return weights.match_pairs(pairs(spark, sf_dir), base(spark, sf_dir), EXPERTS)


_INDEX = """concat('{"metadata":{"total_size":', cast(p_size AS string), '},"weight_map":{"layers.', cast(p_partkey AS string),
  '.a":"model-', cast(p_partkey % 3 AS string), '.safetensors","layers.', cast(p_partkey AS string), '.b":"', p_type, '.safetensors"}}')"""


@register("tensor_index", """
SELECT p_partkey AS model, concat('layers.', p_partkey, '.a') AS name, concat('model-', p_partkey % 3, '.safetensors') AS shard FROM part
UNION ALL SELECT p_partkey, concat('layers.', p_partkey, '.b'), concat(p_type, '.safetensors') FROM part""")
def tensor_index(spark, sf_dir):
    docs = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("model"), F.expr(_INDEX).alias("value"))
    return tensors.tensor_index(docs, "model")


@register("adapter_scaling", """
SELECT p_partkey AS model, p_size + 1 AS r, 2 * p_size AS lora_alpha, 2 * p_size / (p_size + 1) AS scaling FROM part""")
def adapter_scaling(spark, sf_dir):
    config = F.concat(
        F.lit('{"peft_type":"LORA","r":'), (F.col("p_size") + 1).cast("string"),
        F.lit(',"lora_alpha":'), (2 * F.col("p_size")).cast("string"), F.lit("}"))
    docs = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("model"), config.alias("value"))
    return tensors.adapter_scaling(docs, "model")


@register("latest_valid_snapshot", """
WITH s AS (SELECT model, snapshot, max(mtime) AS mtime, bool_or(ends_with(path, '.safetensors')) AS usable FROM fx_file_listing GROUP BY model, snapshot),
r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mtime DESC, snapshot DESC) AS rn FROM s WHERE usable)
SELECT model, snapshot, mtime FROM r WHERE rn = 1""", ("fx_file_listing",))
def latest_valid_snapshot(spark, sf_dir):
    return tensors.latest_valid_snapshot(derive(spark, sf_dir, "fx_file_listing"))


_TRAINABLE = """(regexp_matches(name, '(\\A|\\.)(q_proj|k_proj|v_proj|o_proj)(\\.weight)?\\z') OR ends_with(name, 'experts.gate_up_proj') OR ends_with(name, 'experts.down_proj'))
  AND NOT contains(name, '.gate.weight') AND NOT contains(name, 'router') AND NOT contains(name, 'mtp.')"""
_FUSED = ("experts.gate_up_proj", "experts.down_proj")


@register("flt_trainable_names", f"SELECT name, {_TRAINABLE} AS trainable FROM fx_base_tensors", ("fx_base_tensors",))
def flt_trainable_names(spark, sf_dir):
    return base(spark, sf_dir).select(
        "name", is_trainable(F.col("name"), ATTENTION, _FUSED).alias("trainable"))


@register("trainable_share", f"""
WITH n AS (SELECT CAST(out_dim * in_dim * coalesce(experts, 1) AS BIGINT) AS numel, {_TRAINABLE} AS hit FROM fx_base_tensors),
a AS (SELECT CAST(sum(CASE WHEN hit THEN numel ELSE 0 END) AS BIGINT) AS trainable, CAST(sum(numel) AS BIGINT) AS total FROM n)
SELECT trainable, total, trainable / total * 100 AS pct, CASE WHEN trainable / total * 100 < 0.5 THEN 'fail' ELSE 'ok' END AS verdict FROM a""", ("fx_base_tensors",))
def trainable_share(spark, sf_dir):
    return weights.trainable_share(base(spark, sf_dir), 0.5, modules=ATTENTION, parameters=_FUSED)


@register("lora_resolve_target", FACTORS + "SELECT key, root, slot, factor, target FROM factors", FX)
def lora_resolve_target(spark, sf_dir):
    keys = derive(spark, sf_dir, "fx_adapter_keys").withColumn("p", parse_adapter_key(F.col("key")))
    return keys.filter(F.col("p").isNotNull()).select("key", "p.*").withColumn(
        "target", resolve_target(F.col("root"), F.col("slot")))


@register("lora_pairs", FACTORS + "SELECT * FROM pairs WHERE a_rows IS NOT NULL AND b_rows IS NOT NULL", FX)
def lora_pairs(spark, sf_dir):
    return pairs(spark, sf_dir).filter(weights.is_complete())


@register("join_pair_target", MATCHED + """
SELECT target, root, slot, shard, experts, out_dim, in_dim FROM matched WHERE a_rows IS NOT NULL AND b_rows IS NOT NULL AND shard IS NOT NULL""", FX)
def join_pair_target(spark, sf_dir):
    found = matched(spark, sf_dir).filter(weights.is_complete() & F.col("shard").isNotNull())
    return found.select("target", "root", "slot", "shard", "experts", "out_dim", "in_dim")


@register("lora_shape_check", MATCHED + f"""
SELECT target, slot, status, CASE WHEN status = 'merged' THEN CAST(a_rows / coalesce(experts, 1) AS BIGINT) END AS block_rank FROM matched""", FX)
def lora_shape_check(spark, sf_dir):
    return matched(spark, sf_dir).select("target", "slot", "status", "block_rank")


@register("merge_outcomes", MATCHED + "SELECT status, count(*) AS pairs FROM matched GROUP BY status", FX)
def merge_outcomes(spark, sf_dir):
    return weights.outcomes(matched(spark, sf_dir))


@register("pairs_unapplied", MATCHED + """,
m AS (SELECT target, root, slot, count(*) OVER () AS total FROM matched WHERE status = 'target_missing')
SELECT * FROM m ORDER BY target, slot LIMIT 10""", FX)
def pairs_unapplied(spark, sf_dir):
    return weights.unapplied(pairs(spark, sf_dir), base(spark, sf_dir))


@register("shard_counts", MATCHED + """,
a AS (SELECT shard, count(*) AS n FROM matched WHERE status = 'merged' GROUP BY shard),
t AS (SELECT shard, count(*) AS tensors FROM fx_base_tensors GROUP BY shard)
SELECT t.shard, t.tensors, CAST(coalesce(a.n, 0) AS BIGINT) AS pairs_applied FROM t LEFT JOIN a USING (shard)""", FX)
def shard_counts(spark, sf_dir):
    return weights.shard_counts(base(spark, sf_dir), matched(spark, sf_dir))


RECONCILED = """WITH l AS (SELECT name, replace(replace(name, '.weight', '.linear.weight'), '.bias', '.linear.bias') AS nested FROM fx_saved_names),
fixed AS (SELECT name AS saved_name, CASE WHEN name NOT IN (SELECT name FROM fx_base_tensors) AND nested IN (SELECT name FROM fx_base_tensors) THEN nested ELSE name END AS name FROM l),
rec AS (SELECT saved_name, name, CASE WHEN saved_name <> name THEN 'renamed' ELSE 'kept' END AS action FROM fixed
  UNION ALL SELECT NULL, name, 'copied' FROM fx_base_tensors WHERE name NOT IN (SELECT name FROM fixed))
"""
FX3 = ("fx_base_tensors", "fx_saved_names")


def reconciled(spark, sf_dir):
    return weights.reconcile_names(
        derive(spark, sf_dir, "fx_saved_names"), base(spark, sf_dir))


@register("reconcile_tensor_keys", RECONCILED + "SELECT * FROM rec", FX3)
def reconcile_tensor_keys(spark, sf_dir):
    return reconciled(spark, sf_dir)


@register("reconcile_counts", RECONCILED + "SELECT action, count(*) AS n FROM rec GROUP BY action", FX3)
def reconcile_counts(spark, sf_dir):
    return weights.reconcile_counts(reconciled(spark, sf_dir))


# Matrices from the embeddings, in whole twentieths so that sums are exact. Three base
# tensors by label; the adapter's factors sum over all rows and columns of a tensor, and
# those of the third tensor name a target that the base lacks.
RANK, SCALING, EMB_EXPERTS = 4, 2.0, 2
_NAME = "concat('t', label % 3)"
_TARGET = "CASE WHEN label % 3 = 2 THEN 'missing' ELSE concat('t', label % 3) END"


def _values_sql(rank: int) -> str:
    return f"""WITH v AS (SELECT {_NAME} AS name, {_TARGET} AS target, vec_id AS row, c AS col,
  CAST(round(CAST(embedding[c + 1] AS DOUBLE) * 20) AS BIGINT) AS x FROM (SELECT *, unnest(range(len(embedding))) AS c FROM embeddings)),
a AS (SELECT target, row % {rank} AS k, col, sum(x) AS x FROM v GROUP BY ALL),
b AS (SELECT target, row, col % {rank} AS k, sum(x) AS x FROM v GROUP BY ALL)
"""


DENSE = _values_sql(RANK) + f""",
d AS (SELECT b.target AS name, b.row, a.col, CAST(sum(b.x * a.x) AS DOUBLE) * {SCALING} AS value
  FROM b JOIN a ON a.target = b.target AND a.k = b.k GROUP BY ALL)
"""


def matrices(spark, sf_dir, rank):
    """Base rows, factor rows A and B, and row counts of the three tensors."""
    emb = table(spark, sf_dir, "embeddings").withColumn(
        "x", F.transform("embedding", lambda e: F.round(e.cast("double") * 20)))
    base_rows = emb.select(
        F.expr(_NAME).alias("name"), F.lit(0).alias("expert"), F.col("vec_id").alias("row"),
        F.col("x").alias("values"))
    target = F.expr(_TARGET).alias("name")
    column_sums = (
        emb.select(target, F.pmod("vec_id", F.lit(rank)).alias("k"), F.posexplode("x").alias("c", "v"))
        .groupBy("name", "k", "c").agg(F.sum("v").alias("v"))
        .groupBy("name", "k").agg(F.array_sort(F.collect_list(F.struct("c", "v"))).alias("s")))
    a = column_sums.select(
        "name", F.lit(0).alias("expert"), "k",
        F.transform("s", lambda s: s["v"]).alias("values"))
    coeffs = F.transform(
        F.sequence(F.lit(0), F.lit(rank - 1)),
        lambda k: F.aggregate(
            F.filter("x", lambda v, i: i % rank == k), F.lit(0.0), lambda s, v: s + v))
    b = emb.select(
        target, F.lit(0).alias("expert"), F.col("vec_id").alias("row"), coeffs.alias("coeffs"))
    shapes = b.groupBy("name").agg((F.max("row") + 1).alias("out_dim"))
    return base_rows, a, b, shapes


def dense_delta(spark, sf_dir):
    base_rows, a, b, shapes = matrices(spark, sf_dir, RANK)
    return base_rows, weights.lora_delta(a, b, shapes, SCALING, col_block=16)


@register("lora_delta_dense", DENSE + "SELECT * FROM d")
def lora_delta_dense(spark, sf_dir):
    return weights.tile_values(dense_delta(spark, sf_dir)[1], 16).drop("expert")


@register("lora_delta_experts", _values_sql(RANK * EMB_EXPERTS) + f"""
SELECT b.target AS name, CAST(b.k // {RANK} AS INTEGER) AS expert, b.row, a.col, CAST(sum(b.x * a.x) AS DOUBLE) * {SCALING} AS value
FROM b JOIN a ON a.target = b.target AND a.k = b.k GROUP BY b.target, b.k // {RANK}, b.row, a.col""")
def lora_delta_experts(spark, sf_dir):
    _, a, b, shapes = matrices(spark, sf_dir, RANK * EMB_EXPERTS)
    a, b = weights.split_expert_factors(a, b, EMB_EXPERTS)
    return weights.tile_values(weights.lora_delta(a, b, shapes, SCALING))


@register("delta_norm", DENSE + "SELECT name, sqrt(CAST(sum(CAST(value AS HUGEINT) * CAST(value AS HUGEINT)) AS DOUBLE)) AS norm FROM d GROUP BY name")
def delta_norm(spark, sf_dir):
    return weights.delta_norm(dense_delta(spark, sf_dir)[1])


@register("lora_apply", DENSE + """
SELECT v.name, v.row, v.col, v.x + coalesce(d.value, 0) AS value FROM v LEFT JOIN d ON d.name = v.name AND d.row = v.row AND d.col = v.col""")
def lora_apply(spark, sf_dir):
    base_rows, delta = dense_delta(spark, sf_dir)
    return weights.tile_values(
        weights.apply_delta(base_rows, delta, dtype="double", col_block=16), 16).drop("expert")


@register("tensor_shard_layout", f"""
SELECT concat('shard-', label % 2) AS shard, {_NAME} AS name, count(*) AS n_rows, CAST(sum(len(embedding)) AS BIGINT) AS n_values
FROM embeddings GROUP BY ALL""")
def tensor_shard_layout(spark, sf_dir):
    """Rows written in the base's layout and read back; here a tensor name is
    split by shard so that every shard holds several tensors."""
    emb = table(spark, sf_dir, "embeddings")
    name = F.concat_ws("/", F.concat(F.lit("shard-"), (F.col("label") % 2).cast("string")), F.expr(_NAME))
    tiles = emb.select(
        name.alias("name"), F.lit(0).alias("expert"), F.col("vec_id").alias("row"),
        F.col("embedding").cast("array<double>").alias("values"))
    manifest = tiles.select("name", F.substring_index("name", "/", 1).alias("shard")).distinct()
    path = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    write_shards(tiles, manifest, path)
    return spark.read.parquet(path).groupBy(
        "shard", F.substring_index("name", "/", -1).alias("name")
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("values")).alias("n_values"))


# One pair over all embeddings for the tensor u; v has none, and w is not in the base. The
# base is in twentieths, which neither double nor single precision holds exactly.
@register("merge_adapter_values", f"""
WITH v AS (SELECT vec_id AS row, c AS col, CAST(round(CAST(embedding[c + 1] AS DOUBLE) * 20) AS BIGINT) AS x
  FROM (SELECT *, unnest(range(len(embedding))) AS c FROM embeddings)),
a AS (SELECT row % {RANK} AS k, col, sum(x) AS x FROM v GROUP BY ALL),
b AS (SELECT row, col % {RANK} AS k, sum(x) AS x FROM v GROUP BY ALL),
d AS (SELECT b.row, a.col, CAST(sum(b.x * a.x) AS DOUBLE) * {SCALING} AS value FROM b JOIN a ON a.k = b.k GROUP BY ALL),
merged AS (
  SELECT 's0' AS shard, 'u.weight' AS name, v.row, v.col, CAST(v.x AS DOUBLE) / 20 + d.value AS value FROM v JOIN d ON d.row = v.row AND d.col = v.col
  UNION ALL SELECT 's1', 'v.weight', row, col, CAST(x AS DOUBLE) / 20 FROM v)
SELECT shard, name, row, col, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM merged""")
def merge_adapter_values(spark, sf_dir):
    """The values that a merge writes in single precision, read back by shard."""
    emb = table(spark, sf_dir, "embeddings").withColumn("x", F.transform("embedding", lambda e: F.round(e.cast("double") * 20)))
    size = emb.agg(F.count(F.lit(1)).cast("int").alias("n"), F.max(F.size("x")).alias("width"))

    def rows_of(fields: str, *values: tuple):
        names = fields.split()
        return size.select(F.inline(F.array(*[F.struct(*[F.expr(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in values])))

    keys = rows_of("key dim0 dim1", *[
        (f"'base_model.model.{t}.lora_{f}.weight'", *shape)
        for t in ("u", "w") for f, shape in (("A", (f"{RANK}", "width")), ("B", ("n", f"{RANK}")))])
    manifest = rows_of(
        "name shard experts out_dim in_dim", ("'u.weight'", "'s0'", "cast(null as int)", "n", "width"), ("'v.weight'", "'s1'", "cast(null as int)", "n", "width"))
    base_rows = emb.select(
        F.explode(F.array(F.lit("u.weight"), F.lit("v.weight"))).alias("name"), F.lit(0).alias("expert"), F.col("vec_id").alias("row"),
        F.transform("x", lambda v: v / 20).alias("values"))
    both = F.explode(F.array(F.lit("u"), F.lit("w"))).alias("root")
    a_rows = (
        emb.select(F.pmod("vec_id", F.lit(RANK)).cast("int").alias("k"), F.posexplode("x").alias("c", "v"))
        .groupBy("k", "c").agg(F.sum("v").alias("v")).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("c", "v"))).alias("s"))
        .select(both, F.lit("bare").alias("slot"), "k", F.col("s.v").alias("values")))
    coeffs = F.transform(F.sequence(F.lit(0), F.lit(RANK - 1)), lambda k: F.aggregate(F.filter("x", lambda v, i: i % RANK == k), F.lit(0.0), lambda s, v: s + v))
    b_rows = emb.select(both, F.lit("bare").alias("slot"), F.col("vec_id").alias("row"), coeffs.alias("coeffs"))
    path = f"{shared_dir(spark)}/merged-{uuid.uuid4().hex}"
    merge_adapter(manifest, base_rows, keys, a_rows, b_rows, SCALING, path, num_experts=EXPERTS)
    written = spark.read.parquet(path)
    values = weights.tile_values(written.select("shard", "name", "expert", "row", "col_block", "values"), carry=("shard",)).drop("expert")
    return values.withColumn("value", F.col("value").cast("double"))
