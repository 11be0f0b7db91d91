"""Near-duplicates by SimHash, found with covering locality-sensitive hashing.

Fingerprints link at a few differing bits at most. The tables' bit masks are
built so that for every way to choose that many bits there is a table whose
mask leaves all of them out: each bit position has a vector of ``radius + 1``
bits, and the mask of a table, itself such a vector other than zero, holds the
positions whose vector is not orthogonal to it. The vectors of ``radius``
positions never span the whole space, so some table is orthogonal to them all.
Two fingerprints within the radius therefore agree under some mask, always.

Only distinct fingerprints are compared, so exact copies cost nothing. A bucket
of many fingerprints is covered again, on the bits its mask left out, and so
on: each level fixes about half of the bits that were free, and what is left at
the last one is small by itself. Of a bucket, links enough to connect it as all
its links do are kept, one less than its fingerprints at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from .batches import in_rows, text_slices, unused

BITS = 64
SHINGLE = 3
RADIUS = 3
LARGE_BUCKET = 256
_SEED = 42


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is set where it is set in over half of the hashes; nothing gives zero."""
    if not len(hashes):
        return 0
    set_in = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        block = hashes[k : k + (1 << 16)].astype("<u8")
        set_in += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0])


def text_fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text in UTF-8; only A-Z are lower-cased, only ASCII white space separates."""
    words = text.lower().split()
    if not words:
        return 0
    of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return fingerprint_of(np.array([of(b" ".join(words), _SEED)], np.uint64))
    shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle))))  # noqa: B905
    return fingerprint_of(np.fromiter((of(s, _SEED) for s in shingles), np.uint64, len(words) - shingle + 1))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` of every row, from its whole text; a null text has no words. The sign bit is bit 63."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = pc.fill_null(batch.column("text"), b"").to_numpy(zero_copy_only=False)
            found = np.fromiter((text_fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            yield in_rows({"doc_id": batch.column("doc_id"), "fp": found.view(np.int64)}, schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, fp long")


def covering_masks(free: int, radius: int = RADIUS) -> list[int]:
    """Bit masks over the set bits of ``free``; for any ``radius`` of these, some mask holds none of them."""
    positions = [b for b in range(BITS) if free >> b & 1]
    tables = 1 << (radius + 1)
    # Vectors are dealt in turn, so masks are of even size; zero would be in no mask and is left out.
    vectors = {b: 1 + k % (tables - 1) for k, b in enumerate(positions)}
    return [sum(1 << b for b in positions if (vectors[b] & v).bit_count() % 2) for v in range(1, tables)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bucketed(fps: DataFrame, levels: dict[int, list[int]]) -> DataFrame:
    """Each fingerprint under each mask of its level: ``fp, used, key``, where ``used`` holds the bits already agreed on.

    ``levels`` maps what earlier masks have fixed to the masks still to apply.
    """
    options = None
    for fixed, masks in levels.items():
        each = F.array(*(F.lit(signed(fixed | m)).cast("long") for m in masks))
        options = each if options is None else F.when(F.col("used") == signed(fixed), each).otherwise(options)
    rows = fps.withColumn("next", F.explode(options))
    rows = rows.select("fp", F.col("next").alias("used"), F.col("fp").bitwiseAND(F.col("next")).alias("key"))
    # From the second level on, two ways can lead to the same bits.
    return rows if set(levels) == {0} else rows.distinct()


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect these fingerprints as all pairs within the radius do."""
    left, links = np.arange(len(fps)), []
    while len(left):
        queue, left = left[:1], left[1:]
        while len(queue) and len(left):
            here, queue = queue[0], queue[1:]
            near = np.bitwise_count(fps[left] ^ fps[here]) <= radius
            if near.any():
                links.extend((int(fps[here]), int(fps[k])) for k in left[near])
                queue = np.concatenate([queue, left[near]])
                left = left[~near]
    return links


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints within the radius that connect all that are linked.

    ``fps`` has one row per fingerprint.
    """
    spark = fps.sparkSession
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values, at = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            pairs = [p for k in range(len(at) - 1) for p in _forest(np.sort(values[at[k] : at[k + 1]]), radius)]
            if pairs:
                a, b = (np.array(side, np.uint64).view(np.int64) for side in zip(*pairs, strict=True))
                yield in_rows({"a": np.minimum(a, b), "b": np.maximum(a, b)}, schema)

    everything = (1 << BITS) - 1
    levels = {0: covering_masks(everything, radius)}
    rows, found = fps.select("fp", F.lit(0).cast("long").alias("used")), None
    while True:
        folder = scratch(spark, "buckets")
        _bucketed(rows, levels).write.parquet(folder)
        bucketed = spark.read.parquet(folder)
        sizes = bucketed.groupBy("used", "key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        shared = bucketed.join(sizes, ["used", "key"])
        # A mask whose free bits are few cannot leave a large bucket, so it needs no further level.
        last = F.bit_count(F.bitwise_not("used")) <= 8
        small = shared.filter((F.col("n") <= LARGE_BUCKET) | last)
        lists = small.groupBy("used", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
        near = lists.mapInArrow(work, "a long, b long")
        found = near if found is None else found.unionByName(near)
        large = shared.filter((F.col("n") > LARGE_BUCKET) & ~last).select("fp", "used")
        # One row per mask, of which there are as many as tables times levels at most.
        again = [r.used & everything for r in large.select("used").distinct().collect()]
        if not again:
            return found.distinct()
        levels = {fixed: covering_masks(everything & ~fixed, radius) for fixed in again}
        rows = large


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of these edges can reach; nodes compare as unsigned numbers.

    Rounds of large-star and small-star until nothing changes; each round is
    written to the shared folder, so a lost executor costs one round.
    """
    spark = edges.sparkSession
    flip = F.lit(-(1 << 63)).cast("long")

    def keep(rows: DataFrame) -> DataFrame:
        folder = scratch(spark, "components")
        rows.write.parquet(folder)
        return spark.read.parquet(folder)

    # With the sign bit flipped, signed order is unsigned order.
    now = keep(edges.select(F.col("a").bitwiseXOR(flip).alias("a"), F.col("b").bitwiseXOR(flip).alias("b")).filter("a <> b"))
    before = None
    while True:
        # To every larger neighbour of a node, the smallest of the node and its neighbours.
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()
        # To every smaller neighbour of a node, and the node itself, the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = small.unionByName(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()
        now = keep(small)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").bitwiseXOR(flip).alias("node"), F.col("b").bitwiseXOR(flip).alias("root"))
        before = mark


def memberships(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, root, component_id`` for every row; ``root`` is a fingerprint and names the component."""
    spark = docs.sparkSession
    folder = scratch(spark, "fingerprints")
    fingerprints(docs, shingle).write.parquet(folder)
    rows = spark.read.parquet(folder)
    smallest = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    edge_folder = scratch(spark, "links")
    links(smallest.select("fp"), radius).write.parquet(edge_folder)
    roots = components(spark.read.parquet(edge_folder))
    by_root = smallest.join(roots, smallest.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    reached = by_root.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = by_root.select("fp", "root").join(reached, "root")
    return rows.join(of_fp, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    ``fingerprint`` is 16 lower-case hexadecimal digits; ``component_id`` the
    smallest ``doc_id`` that links reach, itself included, null if all are. A
    null or empty text has the fingerprint zero, which links as any other.
    Repeated rows stay repeated; other columns are ignored. No rows give no rows.
    """
    named = memberships(docs, shingle, radius)
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the one with the smallest id stays.

    Null ids come last. Where several rows have that id, or none has one, the
    one with the smallest fingerprint stays; of rows alike in both, any one.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "memberships")
    memberships(docs, shingle, radius).write.parquet(folder)
    named = spark.read.parquet(folder)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")
    stays = named.groupBy("root").agg(F.min(place).alias("stays")).select("stays.doc_id", "stays.fp")
    # An id that stands for one row says by itself whether the row stays.
    per_id = named.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("component_id"))
    alone = F.col("doc_id").isNotNull() & (F.col("n") == 1)
    goes = per_id.filter(alone & (F.col("doc_id") != F.col("component_id"))).select("doc_id")
    shared_id, is_shared = unused("shared_id", docs.columns), unused("shared", docs.columns)
    shared = per_id.filter(~alone).select(F.col("doc_id").alias(shared_id), F.lit(True).alias(is_shared))
    kept = docs.join(goes, docs.doc_id.cast("long") == goes.doc_id, "left_anti")
    marked = kept.join(F.broadcast(shared) if per_id.filter(~alone).limit(1000).count() < 1000 else shared, kept.doc_id.cast("long").eqNullSafe(F.col(shared_id)), "left")
    single = marked.filter(F.col(is_shared).isNull()).select(*(kept[c] for c in docs.columns))
    several = marked.filter(F.col(is_shared)).select(*(kept[c] for c in docs.columns))
    return single.unionByName(_one_of_each(several, stays, shingle))


def _one_of_each(docs: DataFrame, stays: DataFrame, shingle: int) -> DataFrame:
    """Of rows that share their id or have none, those with an id and fingerprint that stay, once each."""
    schema = docs.schema
    names, kinds = [f.name for f in schema], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            fps = np.fromiter((text_fingerprint(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], [*names, fp])

    fp = unused("_fp", names)
    with_fp = docs.mapInArrow(work, f"{kinds}, {fp} long").dropDuplicates(["doc_id", fp])
    same = with_fp.doc_id.cast("long").eqNullSafe(stays.doc_id) & (with_fp[fp] == stays.fp)
    return with_fp.join(stays, same, "left_semi").select(*names)
