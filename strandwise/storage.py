"""Tables kept between the rounds of iterative jobs."""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables stored since the innermost only_kept() began; None outside of any.
_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset and everything runs in one process (tests, bench), a new
    temporary folder, set once a session; a cluster without that setting is an error, as executors share no local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read from there: lineage ends, lost executors cost nothing.

    batch_rows: most rows of an Arrow batch while they are written, so that Python workers hold little of wide rows; the
    session's own setting is put back.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path, before = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}", spark.conf.get(key)
    if batch_rows:
        spark.conf.set(key, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    if (made := _made.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _names(table: DataFrame) -> set[str]:
    """Names of the stored tables that a table reads."""
    return {name for f in table.inputFiles() if (name := f.rpartition("/")[0].rpartition("/")[2]).startswith("table-")}


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Deletes the files of stored tables that nothing will read again."""
    for table in tables:
        for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
            if "/table-" in path:
                _delete(table.sparkSession, path)


@contextlib.contextmanager
def only_kept(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Within the context, tables are stored as ever; at its end all of them are deleted but those given to the function that it
    yields. For a step of which only the stored result is read again; a step that fails leaves nothing behind."""
    outer, own, kept = _made.get(), [], set()
    token = _made.set(own)

    def keep(table: DataFrame) -> DataFrame:
        kept.update(_names(table))
        return table

    try:
        yield keep
    finally:
        _made.reset(token)
        for path in own:
            if path.rpartition("/")[2] not in kept:
                _delete(spark, path)
            elif outer is not None:
                outer.append(path)
