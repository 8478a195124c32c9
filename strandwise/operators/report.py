"""Overview tables: ids, steps, metric selection, joins, fills and pivots."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def split_id(df: DataFrame, id_column: str = "id") -> DataFrame:
    """sample, cluster and step of 'sample_cluster_step'; the step ends at its first '.'; rows without '_' go."""
    part = F.split(id_column, "_", 3)
    out = df.filter(F.col(id_column).contains("_")).withColumns({"sample": part[0], "cluster": F.try_element_at(part, F.lit(2)), "step": F.substring_index(F.try_element_at(part, F.lit(3)), ".", 1)})
    return out.withColumn(id_column, F.concat_ws("_", "sample", "cluster", "step"))


def step_rank(step: Column) -> Column:
    """Order of steps: constraint, it100 down to it1, then itvariant-calling, consensus, singleton; unknown ones are null."""
    n = F.regexp_extract(step, "^it([0-9]+)$", 1).try_cast("int")
    return F.when(step == "constraint", 1).when(n.between(1, 100), 102 - n).when(step == "itvariant-calling", 102).when(step == "consensus", 103).when(step == "singleton", 104)


def last_iteration(df: DataFrame, ties: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(first row of each sample and cluster in step order, all other rows)."""
    w = Window.partitionBy("sample", "cluster").orderBy(F.asc_nulls_last(step_rank(F.col("step"))), *ties)
    ranked = df.withColumn("_n", F.row_number().over(w))
    return ranked.filter("_n = 1").drop("_n"), ranked.filter("_n > 1").drop("_n")


def fill_group(df: DataFrame, columns: list[str], keys: list[str], order: list[Column | str]) -> DataFrame:
    """Nulls filled forward, then backward, within the keys in that order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(back), F.first(c, ignorenulls=True).over(ahead)) for c in columns})


def split_constraints(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(constraint rows, others): the cluster holds '-CONSTRAINT', which is cut, or the step holds 'constraint'."""
    hit = F.coalesce(F.col("cluster").contains("-CONSTRAINT") | F.col("step").contains("constraint"), F.lit(False))
    return df.filter(hit).withColumn("cluster", F.replace("cluster", F.lit("-CONSTRAINT"), F.lit(""))), df.filter(~hit)


def try_select(df: DataFrame, columns: list[str | dict[str, str]]) -> DataFrame:
    """Columns that exist, in the order given, {old: new} renamed; others are ignored."""
    wanted = [(k, v) for c in columns for k, v in (c.items() if isinstance(c, dict) else [(c, c)])]
    return df.select(*[F.col(f"`{k}`").alias(v) for k, v in dict(wanted).items() if k in df.columns])


def try_drop(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def reorder(df: DataFrame, first: list[str]) -> DataFrame:
    head = [c for c in first if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in head + [c for c in df.columns if c not in head]])


def prefix_columns(df: DataFrame, prefix: str, but: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"({prefix}) {c}" for c in df.columns if c not in but})


def drop_null_columns(df: DataFrame) -> DataFrame:
    """df without columns that are null in all rows."""
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if filled[i]])


def find_column(df: DataFrame, name: str) -> str | None:
    """A column of that name, else the first that holds it."""
    return name if name in df.columns else next((c for c in df.columns if name in c), None)


def join_metrics(frames: list[DataFrame], on: str = "id") -> DataFrame:
    """Outer join of tables on their id; of columns with one name the first table's stay."""
    seen: set[str] = {on}
    parts = []
    for frame in frames:
        own = [c for c in frame.columns if c not in seen]
        seen.update(own)
        parts.append(frame.select(on, *[F.col(f"`{c}`") for c in own]))
    return functools.reduce(lambda a, b: a.join(b, on, "full"), parts)


def select_metrics(metrics: DataFrame, spec: list[tuple[str, str, str, str]], on: str = "id") -> DataFrame:
    """Wide table of metrics (module, section, id, metric, value) by spec (module, section, metric, name), in its order."""
    table = metrics.sparkSession.createDataFrame(spec, "module string, section string, metric string, name string")
    chosen = metrics.join(F.broadcast(table), ["module", "section", "metric"])
    return chosen.groupBy(on).pivot("name", list(dict.fromkeys(s[3] for s in spec))).agg(F.first("value", ignorenulls=True))


#: Most columns that a pivot makes of values in the data.
MOST_COLUMNS = 5000


def _names(df: DataFrame, column: str) -> list[str]:
    """The distinct values of a column in order, for columns of a report; over MOST_COLUMNS of them are an error."""
    found = [r[0] for r in df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(MOST_COLUMNS + 1).collect()]
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"{column} has over {MOST_COLUMNS} values, more than a report has columns")
    return found


def general_stats(metrics: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Wide table of (sample, namespace, title, value) with 'namespace. title (suffix)' as names, MOST_COLUMNS at most."""
    named = metrics.join(suffixes, ["namespace", "title"], "left") if suffixes is not None else metrics.withColumn("suffix", F.lit(None).cast("string"))
    name = F.concat(F.col("namespace"), F.lit(". "), F.col("title"), F.coalesce(F.concat(F.lit(" ("), "suffix", F.lit(")")), F.lit("")))
    named = named.withColumn("_name", name)
    return named.groupBy("sample").pivot("_name", _names(named, "_name")).agg(F.first("value", ignorenulls=True))


def group_label(species: Column, segment: Column, cluster: Column) -> Column:
    """'species (segment)', else species, else cluster."""
    return F.coalesce(F.concat(species, F.lit(" ("), segment, F.lit(")")), species, cluster)


def constraint_summary(df: DataFrame, values: list[str]) -> DataFrame:
    """A row a sample with 'group - variable' columns, grouped, in the order of values. df: sample, idgroup and values; groups
    become columns, so there are MOST_COLUMNS of them at most."""
    long = df.select("sample", "idgroup", *[F.col(v).cast("string").alias(v) for v in values]).unpivot(["sample", "idgroup"], values, "variable", "value").dropna().distinct()
    groups = _names(long, "idgroup")
    named = long.withColumn("_name", F.concat_ws(" - ", "idgroup", "variable"))
    wide = named.groupBy("sample").pivot("_name", [f"{g} - {v}" for g in groups for v in values]).agg(F.min("value"))
    return drop_null_columns(wide)


def final_genomes(df: DataFrame, cycles: int) -> DataFrame:
    """Rows (iteration, is_constraint, ...) of genomes that are final: those of the last refinement cycle, and constraints."""
    return df.filter((F.col("iteration").cast("string") == str(cycles)) | F.coalesce(F.col("is_constraint").cast("boolean"), F.lit(False)))


def final_counts(df: DataFrame) -> DataFrame:
    """(sample, n): rows of each sample at the earliest step rank that any row has."""
    ranked = df.withColumn("_r", step_rank(F.col("step")))
    least = ranked.agg(F.min("_r").alias("_least"))
    return ranked.join(F.broadcast(least), F.col("_r") == F.col("_least")).groupBy("sample").agg(F.count("*").alias("n"))


def contigs_overview(frames: list[DataFrame], clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all iterations, last iteration only): joined metrics with split ids, cluster columns and order."""
    wide = split_id(join_metrics(frames)).join(clusters, ["sample", "cluster"], "left")
    order = ["sample", "cluster", step_rank(F.col("step"))]
    return wide.orderBy(*order), last_iteration(wide)[0].orderBy(*order)


def mapping_overview(wide: DataFrame, constraints: DataFrame, columns: list[str]) -> DataFrame:
    """Constraint rows with their constraint's columns (id, ...), nulls filled within a sample and cluster in step order."""
    own, _ = split_constraints(wide)
    joined = own.join(constraints, own["cluster"] == constraints["id"], "left").drop(constraints["id"])
    filled = fill_group(joined, columns, ["sample", "cluster"], [F.asc_nulls_last(step_rank(F.col("step")))])
    return filled.filter(F.col("step").contains("constraint"))


def samples_overview(samples: DataFrame, summary: DataFrame) -> DataFrame:
    return samples.join(summary, "sample", "left")
