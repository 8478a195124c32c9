"""Distance-edge filters and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.storage import stored


def filter_edges(edges: DataFrame, score: float, mode: str = "default") -> DataFrame:
    """Edges (src, dst, weight) that stay. default: 0 < weight < score; ani: weight <= 1 - score."""
    if mode == "ani":
        return edges.filter(F.col("weight") <= 1 - score)
    if mode != "default":
        raise ValueError(f"unknown mode {mode}")
    return edges.filter((F.col("weight") > 0) & (F.col("weight") < score))


def near_values(rows: DataFrame, key: str, value: str, score: float, id: str = "id") -> DataFrame:
    """Edges (src, dst, weight) of rows (id, key, value) with the components of all pairs of a key whose values differ by less
    than score. Rows in a bin of that width are all such pairs, so each is linked to the bin's least; between a bin and the
    next only the closest rows matter. As many edges as rows and bins at most, by aggregation, without pairs or windows."""
    cut = rows.select(F.col(id).alias("id"), F.col(key).alias("key"), F.col(value).alias("value"), F.floor(F.col(value) / score).cast("long").alias("bin"))
    place = F.struct("value", "id")
    ends = stored(cut.groupBy("key", "bin").agg(F.min(place).alias("low"), F.max(place).alias("high")))
    own = cut.join(ends, ["key", "bin"]).filter(F.col("id") != F.col("low.id")).select(F.col("id").alias("src"), F.col("low.id").alias("dst"), (F.col("value") - F.col("low.value")).alias("weight"))
    after = ends.select("key", (F.col("bin") - 1).alias("bin"), F.col("low").alias("next"))
    between = ends.join(after, ["key", "bin"]).select(F.col("next.id").alias("src"), F.col("high.id").alias("dst"), (F.col("next.value") - F.col("high.value")).alias("weight"))
    return own.unionAll(between.filter(F.col("weight") < score))


def component_labels(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every vertex of the edges (src, dst): component is the smallest id reachable.

    Alternating star contraction: each round hooks every larger neighbour to the smallest one, then every
    vertex to its smallest smaller neighbour, until no edge changes. A round is two aggregations and joins on the
    vertex. A hub's edges are partly aggregated before the shuffle; the minima are stored, so that the skew join can split
    the join on the vertex (over an aggregation it can't).
    """
    pairs = edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).filter("a <> b and a is not null and b is not null")
    pairs = stored(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        if pairs.isEmpty():
            break
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stored(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        small_least = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(small_least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        pairs = stored(small)
        state = pairs.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("v").alias("id")).distinct()
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots.select("id", F.col("id").alias("component")))


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) for every row of vertices (id); isolated vertices are their own component."""
    labels = component_labels(edges)
    return vertices.select("id").distinct().join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def numbered(keys: DataFrame, order: list[str], name: str) -> DataFrame:
    """keys with their place in the order, from 0, as name: sorted ranges are numbered each for itself, and start where the
    ranges before them end, so no task holds more than a range and only the ranges' sizes meet in one."""
    dealt = stored(keys.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    before = F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = dealt.groupBy("_p").count().select("_p", before.alias("_before"))
    within = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    return within.join(starts, "_p").withColumn(name, (F.col("_before") + F.col("_n") - 1).cast("long")).select(*keys.columns, name)


def membership(components: DataFrame) -> DataFrame:
    """(id, cluster): clusters numbered from 0 by their smallest member. The numbering runs over components, not vertices."""
    numbers = numbered(components.select("component").distinct(), ["component"], "cluster")
    return components.join(numbers, "component").select("id", "cluster")
