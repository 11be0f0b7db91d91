"""Token ids in files: documents compressed one by one with a shared zstandard dictionary.

A store is a folder of three tables, written by Spark's own committed writes,
so it can lie wherever Spark can write and outlives lost executors:

``dictionary``  one row: the dictionary, its SHA-256, the bytes per id;
``segments``    bytes of consecutive documents, one zstandard frame after the other,
                with the documents' ids and the frames' offsets;
``starts``      the ids that stand before each segment.

Segments follow each other in ascending order of (``part``, ``segment``), which
is the ascending order of document ids, null first. Rows of one document id are
in the order of their ids' crc. One document is read by its segment's index and
one frame. A part is a range of document ids chosen to hold about as many rows
as any other; a range is written by one task and read in slices. An id, or
null, that has more rows than a range holds is spread over several ranges.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch
from .batches import hash_share, in_rows, text_slices
from .tokens import PieceEncoder, vocabulary_path

DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCUMENTS = 400
SAMPLE_BYTES = 16 << 10
SEGMENT_BYTES = 4 << 20
LEVEL = 3

_FRAMES = "part int, doc_id long, n_tokens long, order long, frame binary"
_SEGMENTS = (
    "part int, segment int, n_ids long, dictionary_sha256 string, doc_ids array<long>, n_tokens array<long>, "
    "offsets array<long>, frames binary"
)


def id_type(vocabulary_size: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary_size <= 1 << 16 else "<u4")


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from serialized documents; the samples themselves where there are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def fit_dictionary(docs: DataFrame, path: str, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary fitted on a sample: of about ``SAMPLE_DOCUMENTS`` documents, ``SAMPLE_BYTES`` each."""
    n = max(1, docs.count())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in text_slices(batches):
            encoder = encoder or PieceEncoder.of_worker(path)
            ids, bounds = encoder.encode(batch.column("text"))
            kind = id_type(encoder.vocabulary_size)
            raw = [ids[a : min(b, a + SAMPLE_BYTES // kind.itemsize)].astype(kind).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.record_batch({"ids": pa.array(raw, pa.binary())})

    chosen = docs.filter(hash_share(SAMPLE_DOCUMENTS / n, F.col("doc_id"))).select("text")
    rows = chosen.mapInArrow(work, "ids binary").take(4 * SAMPLE_DOCUMENTS)
    return train_dictionary(sorted(bytes(r.ids) for r in rows), size)


def part_of(ids: np.ndarray, order: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The range between ascending cuts that an id is in. An id that is several cuts, as it has many rows, is dealt
    over the ranges between these by ``order``, an unsigned 32-bit number."""
    low, high = np.searchsorted(cuts, ids, side="left"), np.searchsorted(cuts, ids, side="right")
    return np.where(high > low, low + 1 + (order * (high - low) >> 32), low)


def write_store(docs: DataFrame, folder: str, path: str | None = None) -> None:
    """Encode ``text`` of all rows and write them to a store in ascending ``doc_id`` order.

    A null or empty text is the end id alone. Repeated rows and repeated ids are
    all written. Other columns are ignored. No rows make an empty store.
    """
    spark, path = docs.sparkSession, path or vocabulary_path()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    trained = fit_dictionary(docs, path)
    name = hashlib.sha256(trained).hexdigest()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("named")).first()
    nameless = parts * (sizes.n - sizes.named) // max(1, sizes.n)
    ranges = parts - nameless
    cuts = docs.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 1 / (4 * ranges)) if ranges > 1 else []
    bounds = np.array(sorted(cuts), np.float64).astype(np.int64)
    shipped = spark.sparkContext.broadcast(trained)
    frame_schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("order", pa.int64()), ("frame", pa.binary())])
    segment_schema = pa.schema(
        [("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("dictionary_sha256", pa.string())]
        + [(n, pa.list_(pa.int64())) for n in ("doc_ids", "n_tokens", "offsets")]
        + [("frames", pa.binary())]
    )

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, compressor = PieceEncoder.of_worker(path), zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shipped.value))
        kind = id_type(encoder.vocabulary_size)
        for batch in text_slices(batches):
            ids, at = encoder.encode(batch.column("text"))
            narrow, spans = ids.astype(kind), list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
            doc_id = batch.column("doc_id")
            crc = np.array([zlib.crc32(ids[a:b]) for a, b in spans], np.int64)
            known, values = doc_id.is_valid().to_numpy(zero_copy_only=False), doc_id.fill_null(0).to_numpy()
            part = np.where(known, nameless + part_of(values, crc, bounds), crc * max(1, nameless) >> 32)
            yield in_rows({"part": part.astype(np.int32), "doc_id": doc_id, "n_tokens": np.diff(at), "order": crc, "frame": [compressor.compress(narrow[a:b].data) for a, b in spans]}, frame_schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, size, rows = None, 0, 0, []

        def segment_row() -> pa.RecordBatch:
            ids, counts, frames = zip(*rows, strict=True)
            offsets = np.cumsum([0, *map(len, frames)])
            return in_rows({"part": [part], "segment": [segment], "n_ids": [sum(counts)], "dictionary_sha256": [name], "doc_ids": [list(ids)], "n_tokens": [list(counts)], "offsets": [offsets.tolist()], "frames": [b"".join(frames)]}, segment_schema)

        for batch in batches:
            for p, *row in zip(*(batch.column(n).to_pylist() for n in ("part", "doc_id", "n_tokens", "frame")), strict=True):
                if rows and (p != part or size >= SEGMENT_BYTES):
                    yield segment_row()
                    segment, size, rows = segment + 1 if p == part else 0, 0, []
                part = p
                rows.append(row)
                size += len(row[2])
        if rows:
            yield segment_row()

    spark.createDataFrame([(name, bytearray(trained))], "sha256 string, dictionary binary").write.parquet(f"{folder}/dictionary")
    frames = docs.mapInArrow(compress, _FRAMES).repartitionById(parts, F.col("part"))
    frames = frames.sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "order")
    frames.mapInArrow(gather, _SEGMENTS).write.parquet(f"{folder}/segments")
    sizes = spark.read.schema(_SEGMENTS).parquet(f"{folder}/segments").select("part", "segment", "n_ids")
    # Parts are as many as shuffle partitions at most; the segments of one part are summed apart from the others.
    total = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).orderBy("part").collect()
    ends = np.cumsum([0, *(r.n_ids for r in total)]).tolist()
    first = spark.createDataFrame([(r.part, at) for r, at in zip(total, ends[:-1], strict=True)], "part int, first long")
    before = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).join(F.broadcast(first), "part")
    starts.select("part", "segment", (F.col("first") + F.col("before")).alias("start")).write.parquet(f"{folder}/starts")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a store as it stands in the files: where it starts, its number of ids and their crc."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    trained = bytes(row.dictionary)
    if hashlib.sha256(trained).hexdigest() != row.sha256:
        raise ValueError("the dictionary of the store does not have the hash it was written with")
    shipped, name = spark.sparkContext.broadcast(trained), row.sha256
    schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("within", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(shipped.value))
        for batch in batches:
            for part, segment, wrote, ids, counts, offsets, frames in zip(*(batch.column(n).to_pylist() for n in ("part", "segment", "dictionary_sha256", "doc_ids", "n_tokens", "offsets", "frames")), strict=True):
                if wrote != name:
                    raise ValueError(f"a segment was written with another dictionary: {wrote}")
                crc, found = [], []
                for n, a, b in zip(counts, offsets[:-1], offsets[1:], strict=True):
                    raw = reader.decompress(frames[a:b])
                    wide = np.frombuffer(raw, np.dtype(f"<u{len(raw) // n}")).astype("<u4")
                    found.append(len(wide))
                    crc.append(zlib.crc32(wide.data))
                n = len(ids)
                yield in_rows({"part": np.full(n, part, np.int32), "segment": np.full(n, segment, np.int32), "doc_id": ids, "within": np.cumsum([0, *found[:-1]]), "n_tokens": found, "ids_crc32": crc}, schema)

    documents = spark.read.schema(_SEGMENTS).parquet(f"{folder}/segments").mapInArrow(work, "part int, segment int, doc_id long, within long, n_tokens long, ids_crc32 long")
    starts = spark.read.parquet(f"{folder}/starts")
    return documents.join(starts, ["part", "segment"]).select("doc_id", (F.col("start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def token_ids(docs: DataFrame) -> DataFrame:
    """Write a store of all documents to the shared folder and read it back."""
    folder = scratch(docs.sparkSession, "token-ids")
    write_store(docs, folder)
    return read_ids(docs.sparkSession, folder)
