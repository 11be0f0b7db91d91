"""The message bus as Spark source and sink (SRC-1, SRC-2, SRC-7, SNK-1).

Jobs see the same columns whether records come from Kafka or from a folder of
bus records in Parquet, laid out as ``writer=<name>/topic=<name>/``. Each
streaming writer has a folder of its own, as a folder's sink log is the memory
of one query. Records of a folder that carry no offset are told apart by
``record_id``, their file and row, and ``record_day``, the day the file was
written. Records of a folder that carry no time have that of their file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..schemas import BUS_RECORD, NAMED_BUS_RECORD
from ..session import create_file, modified_at, path_exists


@dataclass(frozen=True)
class KafkaBus:
    """``min_partitions`` splits large topic partitions over more tasks, and
    ``max_offsets`` bounds a micro-batch, so that a replay from the earliest
    offset comes in pieces. ``options`` are further ones of the Kafka client,
    for reading and writing alike, such as those of its security; ``acks`` and
    ``compression`` are those of its producer."""

    servers: str
    starting_offsets: str = "latest"
    min_partitions: int | None = None
    max_offsets: int | None = None
    acks: str | None = None
    compression: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def _client(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers} | {f"kafka.{k}": v for k, v in self.options.items()}

    def _producer(self) -> dict[str, str]:
        asked = {"kafka.acks": self.acks, "kafka.compression.type": self.compression}
        return self._client() | {k: v for k, v in asked.items() if v}

    def _options(self, topics: Sequence[str]) -> dict[str, str]:
        options = self._client() | {
            "subscribe": ",".join(topics),
            "failOnDataLoss": "false",
        }
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options

    def read_stream(self, spark: SparkSession, topics: Sequence[str], checkpoint: str | None = None) -> DataFrame:
        reader = spark.readStream.format("kafka").options(**self._options(topics))
        if self.max_offsets:
            reader = reader.option("maxOffsetsPerTrigger", self.max_offsets)
        return reader.option("startingOffsets", self.starting_offsets).load()

    def read(self, spark: SparkSession, topics: Sequence[str]) -> DataFrame:
        """Everything the bus still holds."""
        return spark.read.format("kafka").options(**self._options(topics)).load()

    def write_stream(self, records: DataFrame, writer: str) -> DataStreamWriter:
        """Each record goes to the topic its own column names."""
        return records.writeStream.format("kafka").options(**self._producer()).outputMode("append")

    def write(self, records: DataFrame) -> None:
        records.write.format("kafka").options(**self._producer()).save()


@dataclass(frozen=True)
class FileBus:
    """``max_files`` bounds a micro-batch. ``starting_offsets`` says, as on Kafka, where a stream begins that has not
    run before: at the ``earliest`` record or at the ``latest``, which is to say with what arrives after its start."""

    folder: str
    max_files: int | None = None
    starting_offsets: str = "earliest"

    def _folders(self, topics: Sequence[str]) -> str:
        return f"{self.folder}/writer=*/topic={{{','.join(topics)}}}"

    def read_stream(self, spark: SparkSession, topics: Sequence[str], checkpoint: str | None = None) -> DataFrame:
        """Only the folders of these topics are listed and counted. ``checkpoint`` is that of the stream's writer."""
        reader = spark.readStream.schema(BUS_RECORD).option("basePath", self.folder)
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        records = reader.parquet(self._folders(topics))
        since = start_mark(spark, checkpoint, self.starting_offsets)
        if since is not None:
            # Files are of one time, so older ones are not opened.
            records = records.filter(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since)))
        return _named(records)

    def read(self, spark: SparkSession, topics: Sequence[str]) -> DataFrame:
        reader = spark.read.schema(BUS_RECORD).option("basePath", self.folder)
        try:
            return _named(reader.parquet(self._folders(topics)))
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], NAMED_BUS_RECORD)
            raise

    def write_stream(self, records: DataFrame, writer: str) -> DataStreamWriter:
        return (
            _as_bytes(records)
            .writeStream.format("parquet")
            .option("path", f"{self.folder}/writer={writer}")
            .partitionBy("topic")
            .outputMode("append")
        )

    def write(self, records: DataFrame) -> None:
        _as_bytes(records).write.mode("append").partitionBy("topic").parquet(f"{self.folder}/writer=batch")


Bus = KafkaBus | FileBus


def start_mark(spark: SparkSession, checkpoint: str | None, starting_offsets: str) -> int | None:
    """The time from which on a stream takes files, in milliseconds; None for all files.

    The first start decides and leaves a mark beside the checkpoint; its time is that of the store, as is that of the
    files. A stream that has run goes on as it began, whatever it is asked for now.
    """
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError(f"a folder bus starts at earliest or latest, not at {starting_offsets}")
    if checkpoint is None:
        if starting_offsets == "latest":
            raise ValueError("to start at the latest record, a stream has to name its checkpoint")
        return None
    mark = f"{checkpoint.rstrip('/')}-started"
    if not path_exists(spark, mark):
        if starting_offsets == "earliest" or path_exists(spark, f"{checkpoint}/offsets"):
            return None
        create_file(spark, mark)
    return modified_at(spark, mark)


def _as_bytes(records: DataFrame) -> DataFrame:
    return records.withColumns({name: F.col(name).cast("binary") for name in ("key", "value")})


def _named(records: DataFrame) -> DataFrame:
    file = F.col("_metadata")
    arrived = F.coalesce("timestamp", file["file_modification_time"])
    return records.select(
        *[arrived.alias(name) if name == "timestamp" else name for name in BUS_RECORD.names],
        F.concat_ws("-", file["file_name"], file["row_index"]).alias("record_id"),
        F.date_format(file["file_modification_time"], "yyyyMMdd").cast("long").alias("record_day"),
    )


def writer_name(job: str, checkpoint: str) -> str:
    """One name per job and checkpoint: a job that starts anew, with another memory, writes to another folder."""
    return f"{job}-{hashlib.sha256(checkpoint.encode()).hexdigest()[:12]}"
