"""Input sheets: validation against rules, and endedness of samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Patterns of the sample sheet and of the constraint sheet. Names may not hold '_', which joins ids.
SAMPLES = {"sample": r"^[A-Za-z0-9\-]+$", "fastq_1": r"^\S+\.f(ast)?q\.gz$"}
SAMPLES_OPTIONAL = {"fastq_2": r"^\S+\.f(ast)?q\.gz$"}
CONSTRAINTS = {"id": r"^[^_\s]+$", "sequence": r"\.(fa|fasta|fna)(\.gz)?$"}


def validate(sheet: DataFrame, required: dict[str, str], optional: dict[str, str] | None = None, unique: list[list[str]] = (), rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, violating rows with failed: the names of the rules they break)."""
    checks = {c: F.coalesce(F.col(c).rlike(p), F.lit(False)) for c, p in required.items()}
    checks |= {c: F.coalesce(F.col(c) == "", F.lit(True)) | F.col(c).rlike(p) for c, p in (optional or {}).items()}
    checks |= {f"unique {', '.join(k)}": F.count("*").over(Window.partitionBy(*k)) == 1 for k in unique}
    checks |= rules or {}
    failed = F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())
    marked = sheet.withColumn("failed", failed)
    return marked.filter(F.size("failed") == 0).drop("failed"), marked.filter(F.size("failed") > 0)


def validate_samples(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validate(sheet, SAMPLES, SAMPLES_OPTIONAL)


def validate_constraints(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    segment = F.coalesce(F.col("segment"), F.lit("")) == ""
    species = F.coalesce(F.col("species"), F.lit("")) != ""
    return validate(sheet, CONSTRAINTS, unique=[["id"], ["id", "species", "segment", "samples"]], rules={"segment needs species": segment | species})


def mixed_endedness(sheet: DataFrame) -> DataFrame:
    """(sample): samples with both single-end and paired rows."""
    return sheet.groupBy("sample").agg(F.count_distinct("single_end").alias("n")).filter("n > 1").select("sample")
