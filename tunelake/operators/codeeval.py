"""Static scores of generated code: names it calls, its shape, its syntax."""

from __future__ import annotations

import ast
import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.functions.codetext import called_names, extract_code, length_sanity
from tunelake.functions.pytext import mean_of, text_or_empty
from tunelake.sinks.shared import shared_dir

# Fixed value: the variable that generated code must assign.
TARGET_NAME = "root_part"

# Module roots that generated code must not import.
FORBIDDEN_IMPORTS = (
    "sys", "os", "subprocess", "shutil", "matplotlib", "ocp_vscode",
    "tkinter", "pyqt5", "pyqt6", "pyside2", "pyside6",
)
# Calls that are always allowed.
SAFE_CALLS = (
    "range", "len", "min", "max", "abs", "int", "float", "str", "list",
    "tuple", "dict", "set", "sum", "enumerate", "zip", "round",
    "Vector", "Vertex", "Axis", "Plane",
)

# The pass/fail marks of a static score.
FLAGS = (
    "has_python_block", "parses", "defines_root_part", "no_forbidden", "api_in_whitelist",
    "length_sanity",
)

CHECKS_SCHEMA = T.StructType([
    T.StructField("parses", T.BooleanType()),
    T.StructField("syntax_error", T.StringType()),
    T.StructField("defines_target", T.BooleanType()),
    T.StructField("forbidden", T.BooleanType()),
])


def _check(code: str | None) -> tuple[bool, str | None, bool, bool]:
    if code is None:
        return False, None, False, False
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(code)
    except SyntaxError as e:
        return False, f"SyntaxError at line {e.lineno}: {e.msg}", False, False
    except (ValueError, RecursionError, MemoryError) as e:
        return False, type(e).__name__, False, False
    assigned: set[str] = set()
    imported: set[str] = set()
    for node in ast.walk(tree):
        match node:
            case ast.Assign(targets=targets):
                assigned |= {t.id for t in targets if isinstance(t, ast.Name)}
            case ast.AnnAssign(target=ast.Name(id=name)):
                assigned.add(name)
            case ast.Import(names=names):
                imported |= {n.name.partition(".")[0] for n in names}
            case ast.ImportFrom(module=str(module)):
                imported.add(module.partition(".")[0])
    return True, None, TARGET_NAME in assigned, not imported.isdisjoint(FORBIDDEN_IMPORTS)


@F.pandas_udf(CHECKS_SCHEMA)
def code_checks(code: pd.Series) -> pd.DataFrame:
    """Parse each code once: syntax, the assigned target, forbidden imports.

    Only plain and annotated assignments to the name count, at any depth.
    """
    return pd.DataFrame(
        [_check(c) for c in code],
        columns=["parses", "syntax_error", "defines_target", "forbidden"])


def api_whitelist(references: DataFrame, column: str = "reference_code") -> DataFrame:
    """Distinct names called by any reference, and the always-allowed ones."""
    safe = F.explode(F.array(*[F.lit(s) for s in SAFE_CALLS]))
    found = references.select(F.explode(called_names(F.col(column))).alias("symbol"))
    spark = references.sparkSession
    return found.union(spark.range(1).select(safe.alias("symbol"))).distinct()


def fixed_whitelist(whitelist: DataFrame) -> DataFrame:
    """Compute a whitelist once, so later uses do not read the references again."""
    shared_dir(whitelist.sparkSession)
    return whitelist.checkpoint()


def with_known_names(df: DataFrame, names: list[str], whitelist: DataFrame) -> DataFrame:
    """Add ``known``: those names of the row's arrays that the whitelist holds.

    Rows are fixed first under a number of their own, so that keys may repeat or be
    null. Names are then joined one by one; whether the whitelist is sent to all
    tasks or a name that every row calls is split is left to adaptive execution.
    """
    shared_dir(df.sparkSession)
    rows = df.withColumn("__row", F.monotonically_increasing_id()).checkpoint()
    used = F.array_distinct(F.concat(*[F.col(n) for n in names]))
    called = rows.select("__row", F.explode(used).alias("symbol"))
    known = (
        called.join(whitelist.select("symbol").distinct(), "symbol")
        .groupBy("__row").agg(F.collect_set("symbol").alias("known")))
    return rows.join(known, "__row", "left").withColumn(
        "known", F.coalesce("known", F.array().cast("array<string>"))).drop("__row")


def unknown_names(names: Column, known: Column) -> Column:
    return F.array_sort(F.array_except(names, known))


def coverage(generated: Column, reference: Column, known: Column) -> Column:
    """Shared part of the whitelisted names; two empty sets agree fully."""
    gen, ref = F.array_intersect(generated, known), F.array_intersect(reference, known)
    union = F.size(F.array_union(gen, ref))
    return (
        F.when((F.size(ref) == 0) & (F.size(gen) == 0), F.lit(1.0))
        .when(F.size(ref) == 0, F.lit(0.0))
        .otherwise(F.size(F.array_intersect(gen, ref)) / union)
    )


def with_code(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Add ``code`` (null when there is none) and ``has_python_block``."""
    return df.withColumn("__found", extract_code(F.col(prediction))).withColumns({
        "code": F.col("__found.code"), "has_python_block": F.col("__found.has_python"),
    }).drop("__found")


def with_names(df: DataFrame) -> DataFrame:
    """Add ``gen_names`` and ``ref_names``, the names both codes call."""
    return df.withColumns({
        "gen_names": called_names(F.col("code")),
        "ref_names": called_names(F.col("reference_code")),
    })


def score_static(
    pairs: DataFrame, whitelist: DataFrame, *, keys: tuple[str, ...] = ("example_id", "side"),
) -> DataFrame:
    """Score each prediction against its reference code, without running it.

    ``pairs`` holds ``keys``, ``prediction`` and ``reference_code``. Coverage
    and composite are not rounded. The texts are left behind as soon as their
    features are known, so any later shuffle moves features only.
    """
    keys = list(keys)
    has = F.col("code").isNotNull()
    features = (
        with_names(with_code(pairs))
        .withColumn("checks", code_checks(F.col("code")))
        .withColumn("length_sanity", length_sanity(
            F.coalesce("code", text_or_empty(F.col("prediction"))), F.col("reference_code")))
        .select(
            *keys, "has_python_block", "length_sanity", has.alias("has_code"),
            "gen_names", "ref_names",
            F.col("checks.parses").alias("parses"),
            F.col("checks.defines_target").alias("defines_root_part"),
            (~F.col("checks.forbidden")).alias("no_forbidden"))
    )
    known = F.col("known")
    scored = (
        with_known_names(features, ["gen_names", "ref_names"], whitelist)
        .withColumn("unknown_symbols", unknown_names(F.col("gen_names"), known))
        .withColumn("api_in_whitelist", F.col("has_code") & (F.size("unknown_symbols") == 0))
        .withColumn("api_coverage", F.when(
            F.col("has_code"), coverage(F.col("gen_names"), F.col("ref_names"), known)
        ).otherwise(0.0))
    )
    hard = sum(
        (F.col(f).cast("int") for f in FLAGS if f != "length_sanity"), start=F.lit(0)) / 5
    soft = (F.col("api_coverage") + F.col("length_sanity").cast("double")) / 2
    return scored.withColumn(
        "composite", F.when(F.col("has_code"), hard * 0.7 + soft * 0.3).otherwise(0.0)
    ).select(*keys, *FLAGS, "unknown_symbols", "api_coverage", "composite")


def aggregate_scores(scored: DataFrame) -> DataFrame:
    """Per side: percent of rows passing each flag, mean coverage and composite."""
    n = F.count(F.lit(1))
    return scored.groupBy("side").agg(
        n.alias("num"),
        *[(F.count_if(f) / n * 100).alias(f) for f in FLAGS],
        mean_of(F.col("api_coverage")).alias("api_coverage_mean"),
        mean_of(F.col("composite")).alias("composite_mean"),
    )
