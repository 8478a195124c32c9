"""Running values over long sorted groups, by ranges: no task holds more than a range, however long a group is."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.storage import stored

#: What a running value is: how rows add up within a range, over ranges, and how what comes before joins it.
_ADD = lambda before, own: F.coalesce(before + own, before, own)
KINDS = {
    "sum": (F.sum, F.sum, _ADD),
    "xor": (F.bit_xor, F.bit_xor, lambda before, own: F.coalesce(before.bitwiseXOR(own), before, own)),
    "max": (F.max, F.max, lambda before, own: F.greatest(before, own)),
    "min": (F.min, F.min, lambda before, own: F.least(before, own)),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda c: F.last(c, ignorenulls=True), lambda before, own: F.coalesce(own, before)),
}


def dealt(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """rows in ranges of (keys, order), stored, with their range as _range. Rows that are alike in all of these share one."""
    return stored(rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))


def running(ranges: DataFrame, keys: list[str], order: list[str], values: Mapping[str, tuple[str, Column]], before: bool = False) -> DataFrame:
    """The rows of dealt() with running values over each key's rows in ascending order, nulls first: by name, a kind of KINDS
    and what it runs over. before: without the row's own value. Rows that tie in the order run in any order.

    Two levels: windows within the ranges, and what a key's earlier ranges hold. A key lies in several ranges only if it is
    the first or the last of each, so what is carried over is two rows a range at most, and is broadcast.
    """
    w = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    spans = F.struct(*keys)
    edges = ranges.groupBy("_range").agg(F.min(spans).alias("first"), F.max(spans).alias("last"))
    shared = edges.select("_range", F.explode(F.array_distinct(F.array("first", "last"))).alias("_key")).groupBy("_key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("_key").alias("_s"))
    of_key = ranges.withColumn("_key", spans)
    split = of_key.join(F.broadcast(shared), F.col("_key").eqNullSafe(F.col("_s")), "left_semi")
    total = lambda kind, c: F.max(F.when(c.isNotNull(), F.struct(*order, c.alias("_v"))))["_v"] if kind == "last" else KINDS[kind][0](c)
    totals = split.groupBy("_range", "_key").agg(*[total(kind, c).alias(name) for name, (kind, c) in values.items()])
    upto = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col("_range").alias("_r"), F.col("_key").alias("_k"), *[KINDS[kind][1](F.col(name)).over(upto).alias(f"_before_{name}") for name, (kind, _) in values.items()])
    own = of_key.select("*", *[KINDS[kind][0](c).over(w).alias(f"_own_{name}") for name, (kind, c) in values.items()])
    joined = own.join(F.broadcast(carried), (F.col("_range") == F.col("_r")) & F.col("_key").eqNullSafe(F.col("_k")), "left")
    return joined.select(*ranges.columns, *[KINDS[kind][2](F.col(f"_before_{name}"), F.col(f"_own_{name}")).alias(name) for name, (kind, _) in values.items()])
