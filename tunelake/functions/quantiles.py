"""Exact index quantiles from a tree of counts, without gathering a group in one task.

The value at quantile q of n sorted values is the one at zero-based index
``min(n - 1, int(q * n))``. That is one place above ``percentile_disc`` whenever
``q * n`` is a whole number, so no built-in percentile gives it.

Equal values are counted first (map-side combined, spread over value). Each value has
a 64-bit place that never falls as values rise; counts by its leading digits are the
levels of a tree. An index is followed from the top: at each level, the child that holds
it is found among the children of one node. Counts are exchanged by (group, digits), a node
has at most ``2**DIGIT_BITS`` children, and a leaf a few thousand values, so no sort
depends on how many rows or distinct values a group has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.sinks.shared import shared_dir

DIGIT_BITS = 21  # the top level has the rest of 64 bits
FRACTION_BITS = 40  # of a logarithm; a few thousand doubles share them
LEAST_EXPONENT = -1080


def place_of(value: Column, kind: T.DataType) -> Column:
    """A long that never falls as values rise, and is the same for few values only."""
    if isinstance(kind, T.DecimalType):
        if kind.precision > 18:
            raise TypeError(f"decimals of at most 18 digits have a place, not {kind.simpleString()}")
        return (value * F.lit(10 ** kind.scale).cast("decimal(19,0)")).cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        size = F.abs(value.cast("double"))
        # The logarithm of a larger value is never smaller, so neither is its floor.
        steps = F.floor((F.log2(size) - LEAST_EXPONENT) * F.lit(float(1 << FRACTION_BITS)))
        at = F.when(size == 0, 0).when(size == float("inf"), F.lit(1 << 60)).otherwise(steps)
        return F.when(F.isnan(value), F.lit(1 << 61)).when(value < 0, -at).otherwise(at)
    if isinstance(kind, T.IntegralType):
        return value.cast("long")
    raise TypeError(f"numbers have index quantiles, not {kind.simpleString()}")


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, __x, __c, __k): how often each value occurs in each group, and its place."""
    return (
        df.filter(reduce(and_, [F.col(c).isNotNull() for c in [*keys, value]]))
        .groupBy(*keys, F.col(value).alias("__x")).agg(F.count(F.lit(1)).alias("__c"))
        .withColumn("__k", place_of(F.col("__x"), df.schema[value].dataType))
    )


def index_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """One row per key: ``keys``, ``n`` and one column per entry of ``probs``.

    Rows with a null key or value are left out, a group of nulls only does not
    appear. NaN comes after all other values, as in Spark's own order.
    """
    keys = list(keys)
    x = F.col("__x")
    shared_dir(df.sparkSession)
    counts = value_counts(df, keys, value).checkpoint()  # read once for each level

    def level(rows: DataFrame, shift: int, *more: str) -> DataFrame:
        return rows.groupBy(*keys, *more, F.shiftright("__k", shift).alias("__at")).agg(F.sum("__c").alias("__c"))

    def found(children: DataFrame, by: list[str], order: str) -> DataFrame:
        """The child of each node that holds the index: ``__before`` counts what comes before it."""
        along = Window.partitionBy(*by).orderBy(order)
        return (
            children.withColumn("__before", F.col("__before") + F.sum("__c").over(along) - F.col("__c"))
            .filter((F.col("__before") <= F.col("__idx")) & (F.col("__idx") < F.col("__before") + F.col("__c"))).drop("__c")
        )

    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q")) for name, q in probs.items()]))
    n = F.sum("__c").over(Window.partitionBy(*keys))
    top = (
        level(counts, 2 * DIGIT_BITS).withColumn("n", n).withColumn("__p", wanted)
        .withColumn("__idx", F.least(F.col("n") - 1, F.floor(F.col("__p.q") * F.col("n"))))
        .withColumn("__name", F.col("__p.name")).drop("__p").withColumn("__before", F.lit(0).cast("long"))
    )
    node = found(top, [*keys, "__name"], "__at").withColumnRenamed("__at", "__up")
    children = level(counts, DIGIT_BITS).withColumn("__up", F.shiftright("__at", DIGIT_BITS))
    node = found(children.join(node, [*keys, "__up"]), [*keys, "__name", "__up"], "__at").drop("__up").withColumnRenamed("__at", "__up")
    # From here on only values below the nodes that hold an index matter.
    inside = counts.withColumn("__up", F.shiftright("__k", DIGIT_BITS)).join(node, [*keys, "__up"])
    state = ["__name", "__up", "n", "__idx", "__before"]
    node = found(level(inside, 0, *state), [*keys, "__name", "__up"], "__at").withColumnRenamed("__at", "__k")
    leaf = inside.drop("n", "__idx", "__before").join(node.drop("__up"), [*keys, "__name", "__k"])
    reached = found(leaf, [*keys, "__name", "__k"], "__x")
    return reached.groupBy(*keys).agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("__name") == name, x)).alias(name) for name in probs])
