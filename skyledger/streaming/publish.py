"""Replay-safe publication of alert documents (SNK-5, SNK-6, STR-6).

A document is written under its ``doc_id``: it replaces what the table holds
under that id, unless that is a newer version. One job publishes to a table at a
time; two at once could both miss what the other writes.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ALERT_DOCUMENT
from ..session import create_file, path_exists, remove_path

LAYOUT = ("index", "offset_block")
IDENTITY = ("doc_id", "version", "fingerprint")


def ensure_index(spark: SparkSession, path: str) -> None:
    """SNK-6: lay down the table with its explicit types, unless it is there."""
    empty = spark.createDataFrame([], ALERT_DOCUMENT)
    empty.write.mode("ignore").partitionBy(*LAYOUT).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALERT_DOCUMENT).parquet(path).select(*_columns())


def publish_batch(documents: DataFrame, batch_id: int, path: str) -> None:
    """Merge a batch into the table, one row per ``doc_id``.

    Of several versions the newest stays; of versions of the same time, or of
    none, the one published last. So a retried or replayed batch changes nothing,
    a corrected document replaces the wrong one, and an old one that comes late
    does not. The rule asks only what the table holds, not which batch wrote it.

    New documents are appended. Where documents are replaced, and only there,
    their folders are written anew; see ``replace_folders``.

    What is to do is found by ids, times and hashes alone, so whole documents move
    only if they are written; a batch that is published again moves none.
    """
    spark = documents.sparkSession
    finish_replacement(spark, path)
    batch = documents.select(*_columns()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # One row per folder that the batch writes to.
        touched = batch.select(*LAYOUT).distinct().collect()
        if not touched:
            return
        known = _known_ids(spark, path, touched)
        ids = newest_versions(batch.select(*IDENTITY, *LAYOUT))
        copies = F.max("copies").alias("copies")
        # A few rows per folder.
        found = compared(ids, known).groupBy(*LAYOUT, "change").agg(copies).collect()
        changes = {row.change for row in found}
        rows = batch if all(row.copies == 1 for row in found) else newest_versions(batch).drop("copies")
        judged = rows if changes == {"new"} else compared(rows, known)
        if "new" in changes:
            new = judged if changes == {"new"} else judged.filter("change = 'new'")
            _laid_out(new.select(*_columns())).mode("append").parquet(path)
        wrong = [row for row in found if row.change == "corrected"]
        if wrong:
            corrected = judged.filter("change = 'corrected'").select(*_columns()).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                replace_folders(spark, path, corrected, wrong)
            finally:
                corrected.unpersist()
    finally:
        batch.unpersist()


def newest_versions(documents: DataFrame) -> DataFrame:
    """One row per ``doc_id``, that of the latest version, and the number of its ``copies``. Rows are reduced before
    they move."""
    best = F.max_by(F.struct(*[F.col(f"`{n}`") for n in documents.columns]), F.struct("version", "fingerprint")).alias("best")
    return documents.groupBy(F.col("doc_id").alias("_id")).agg(best, F.count("*").alias("copies")).select("best.*", "copies")


def compared(batch: DataFrame, known: DataFrame | None) -> DataFrame:
    """The batch with ``change``: ``new`` or ``corrected``, or null where the table holds the document like this or newer.

    What the table holds is as large as its folders: it moves between tasks and not by way of the driver, however
    small its narrow columns are taken to be.
    """
    if known is None:
        return batch.withColumn("change", F.lit("new"))
    held = known.select("doc_id", F.col("version").alias("_version"), F.col("fingerprint").alias("_fingerprint"), F.lit(True).alias("_held"))
    newer = _after(F.col("version"), F.col("_version"))
    same_time = F.col("version").eqNullSafe(F.col("_version"))
    other = same_time & ~F.col("fingerprint").eqNullSafe(F.col("_fingerprint"))
    change = F.when(F.col("_held").isNull(), "new").when(newer | other, "corrected")
    return batch.join(held.hint("merge"), "doc_id", "left").withColumn("change", change).drop("_version", "_fingerprint", "_held")


def replace_folders(spark: SparkSession, path: str, corrected: DataFrame, wrong: list) -> None:
    """Write the folders of ``wrong`` anew, with ``corrected`` in place of the rows of the same ids.

    Replacing a folder deletes the old one first. So that nothing is lost if the
    job ends there, the new content is complete in a folder of its own before, and
    the next batch puts it in place if this one does not.
    """
    held = _folders(spark, path, wrong).join(corrected.select("doc_id").hint("merge"), "doc_id", "left_anti").select(*_columns())
    _laid_out(held.unionByName(corrected)).mode("overwrite").parquet(_pending(path))
    create_file(spark, _complete(path))
    finish_replacement(spark, path)


def finish_replacement(spark: SparkSession, path: str) -> None:
    """Put complete new content of folders in place; throw incomplete content away."""
    pending = _pending(path)
    if path_exists(spark, _complete(path)):
        rows = spark.read.schema(ALERT_DOCUMENT).parquet(pending).select(*_columns())
        _laid_out(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    # The mark goes first: content without it is never put in place.
    for left in (_complete(path), pending):
        if path_exists(spark, left):
            remove_path(spark, left)


def _pending(path: str) -> str:
    # Readers skip folders of such names.
    return f"{path}/_pending"


def _complete(path: str) -> str:
    return f"{path}/_pending_complete"


def _columns() -> list[Column]:
    return [F.col(f"`{n}`") for n in ALERT_DOCUMENT.names]


def _after(time: Column, other: Column) -> Column:
    """A time is after another and after none."""
    return F.coalesce(time > other, time.isNotNull() & other.isNull())


def _laid_out(rows: DataFrame):
    return rows.hint("rebalance", *[F.col(name) for name in LAYOUT]).write.partitionBy(*LAYOUT)


def _known_ids(spark: SparkSession, path: str, touched: list) -> DataFrame | None:
    """What the table holds in the folders a batch writes to, or None.

    Opens these folders only, and of their files three narrow columns, so the cost
    of a batch does not grow with the table.
    """
    held = _folders(spark, path, touched)
    return None if held is None else held.select(*IDENTITY)


def _folders(spark: SparkSession, path: str, touched: list) -> DataFrame | None:
    by_index: dict[str, list[str]] = {}
    for folder in touched:
        by_index.setdefault(folder["index"], []).append(str(folder["offset_block"]))
    held = None
    for index, blocks in sorted(by_index.items()):
        pattern = f"{path}/index={index}/offset_block={{{','.join(sorted(blocks))}}}"
        try:
            found = spark.read.schema(ALERT_DOCUMENT).option("basePath", path).parquet(pattern)
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        held = found if held is None else held.unionByName(found)
    return held
