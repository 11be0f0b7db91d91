"""Session and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def open_session(name: str, fair: bool = False) -> SparkSession:
    """A session in UTC; what concerns the cluster is left to its own settings. ``fair`` for jobs side by side."""
    builder = SparkSession.builder.appName(name)
    if fair:
        builder = builder.config("spark.scheduler.mode", "FAIR")
    spark = (
        # Recording the call site of every expression triples the time to build a plan.
        builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session may fall back on a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.gettempdir()
    raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark."""
    place, files = _place(spark, path)
    files.create(place, True).close()


def modified_at(spark: SparkSession, path: str) -> int:
    """When a file was written, in milliseconds by the clock of its store."""
    place, files = _place(spark, path)
    return files.getFileStatus(place).getModificationTime()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there whole or not at all."""
    place, files = _place(spark, path)
    draft, _ = _place(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(draft, place):
        # Some stores do not rename over a file that is there.
        files.delete(place, False)
        files.rename(draft, place)


def read_text(spark: SparkSession, path: str) -> str:
    place, files = _place(spark, path)
    source = files.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def names_below(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    place, files = _place(spark, path)
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def remove_path(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def forget(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch`` has named."""
    if "/skyledger/" not in path:
        raise ValueError(f"{path} is not a scratch folder")
    remove_path(spark, path)


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used before."""
    return f"{shared_folder(spark)}/skyledger/{label}-{uuid.uuid4().hex}"
