"""The trie of conversation openings: how many conversations share each first so many turns, and what that saves.

A node is a distinct sequence of first turns, known by a digest of 128 bits that
goes on from its parent's. Conversations become paths of digests, rows of paths
become nodes with their members counted, and what must be summed over subtrees is
summed in flat numpy arrays, shard by shard: a minimal perfect hash gives each
node of a shard a slot, which is verified by the digest kept there; parents are
slots too, and one pass from the deepest nodes up adds each to its parent.

How the trie is cut into shards. A node with more than ``limit`` members is
heavy. Heavy nodes are a crown of at most ``MOST_HEAVY`` nodes, since ``limit``
grows with the input; it is known to all tasks. Below it hang subtrees of light
nodes, which are cut again every ``BAND`` turns. Each such unit lies whole in one
shard, many units to a shard; only the sums of its top node leave it, added up by
parent before they move. So a first turn that a third of all conversations
share is a node of the crown, and what follows it is spread over all shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import forget, scratch
from .batches import for_tasks, in_rows, key_runs

BAND = 512
MOST_HEAVY = 100_000
LEAST_LIMIT = 20_000
SHARD_NODES = 200_000
MOST_SHARED = 64
_ROOT = bytes(16)
_LEVELS = 60
_PIECE = 10_000
_KEY = ("hi", "lo")

_PATHS = "conv_id long, band int, parent binary, digests binary, sizes binary, last boolean"
_PATH_SCHEMA = pa.schema([("conv_id", pa.int64()), ("band", pa.int32()), ("parent", pa.binary()), ("digests", pa.binary()), ("sizes", pa.binary()), ("last", pa.bool_())])
_LONGS = lambda *names: pa.schema([(n, pa.int64()) for n in names])
_STEP = ("hi", "lo", "phi", "plo", "uhi", "ulo", "stage", "depth", "size", "conv_id", "parent_conv_id")
_SUMS = ("hi", "lo", "phi", "plo", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "top")


def _ddl(names) -> str:
    return ", ".join(f"{n} long" for n in names)


class NodeTable:
    """A minimal perfect hash of distinct 128-bit keys, rows of two 64-bit words: bit arrays, one after the other,
    each of which takes the keys that fall on a place of their own and leaves the others to the next."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, placed = keys, 0
        while len(rest):
            if len(self.levels) == _LEVELS:
                raise ValueError("keys are not distinct")
            at = self._places(rest, len(self.levels), 2 * len(rest) + 16)
            alone = np.bincount(at, minlength=2 * len(rest) + 16) == 1
            ranks = np.cumsum(alone, dtype=np.int64) + (placed - 1)
            self.levels.append((alone, ranks))
            placed = int(ranks[-1]) + 1
            rest = rest[~alone[at]]
        self.keys = np.zeros((placed, 2), np.uint64)
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        h = keys[:, 0] ^ (keys[:, 1] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(30)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        return (h % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (alone, ranks) in enumerate(self.levels):
            at = self._places(keys[open_], level, len(alone))
            hit = alone[at]
            out[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for a key that is not in the table."""
        found = self._slots(keys)
        if len(self.keys):
            found[(self.keys[found] != keys).any(axis=1)] = -1
        return found


def turn_keys(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, key, n_bytes``: what the trie needs of a turn, narrow and native. A null role or text is empty;
    rows without a ``conv_id`` belong to no conversation and are left out."""
    role, text = (F.coalesce(F.col(n).cast("string"), F.lit("")) for n in ("role", "text"))
    key = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = rows.filter(F.col("conv_id").isNotNull())
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("n_bytes"))


def conversation_paths(keys: DataFrame, base: Column | None = None, shared: Column | None = None) -> DataFrame:
    """A row per conversation and ``BAND`` turns: the digests of its openings, the bytes of the texts they end with.

    A conversation's turns go by ``turn``, null first, equal ones by their key. With ``base`` and ``shared`` it
    is a branch: in place of its own first ``shared`` turns it has as many of conversation ``base``, which may have
    fewer or not be there. A family of branches is read as a stream, of which ``MOST_SHARED`` turns are held at most.
    """
    base = F.col("conv_id") if base is None else base
    shared = F.lit(0) if shared is None else shared
    rows = keys.select("conv_id", "turn", "key", "n_bytes", base.cast("long").alias("base"), shared.cast("int").alias("shared"))
    rows = rows.repartition("base").sortWithinPartitions("base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, opening, conv, own, done = None, [], None, 0, []
        band, parent, node, digests, sizes = 0, _ROOT, _ROOT, [], []

        def close(last: bool) -> None:
            nonlocal band, parent, digests, sizes
            done.append((conv, band, parent, b"".join(digests), np.array(sizes, "<i8").tobytes(), last))
            band, parent, digests, sizes = band + 1, node, [], []

        def grow(key: bytes, size: int) -> None:
            nonlocal node
            node = hashlib.blake2b(node + key, digest_size=16).digest()
            digests.append(node)
            sizes.append(size)
            if len(digests) == BAND:
                close(False)

        for batch in batches:
            for c, key, size, b, skip in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "key", "n_bytes", "base", "shared")), strict=True):
                if conv is None or c != conv or b != family:
                    if conv is not None:
                        close(True)
                    if b != family or conv is None:
                        family, opening = b, []
                    conv, own, band, parent, node = c, 0, 0, _ROOT, _ROOT
                    if c != b:
                        if skip > MOST_SHARED:
                            raise ValueError(f"a branch can share {MOST_SHARED} turns at most")
                        for turn in opening[:skip]:
                            grow(*turn)
                if c == b:
                    if own < MOST_SHARED:
                        opening.append((key, size))
                    grow(key, size)
                elif own >= skip:
                    grow(key, size)
                own += 1
            if done:
                yield in_rows(dict(zip(_PATH_SCHEMA.names, map(list, zip(*done, strict=True)), strict=True)), _PATH_SCHEMA)
                done.clear()
        if conv is not None:
            close(True)
            yield in_rows(dict(zip(_PATH_SCHEMA.names, map(list, zip(*done, strict=True)), strict=True)), _PATH_SCHEMA)

    return rows.select("conv_id", "key", "n_bytes", "base", "shared").mapInArrow(work, _PATHS)


def _words(column: pa.Array) -> np.ndarray:
    """Digests, laid end to end over all rows, as pairs of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 2)


def _pairs(batch: pa.RecordBatch, hi: str, lo: str) -> np.ndarray:
    return np.stack([batch.column(n).fill_null(0).to_numpy().view(np.uint64) for n in (hi, lo)], axis=1)


def _members(paths: DataFrame) -> DataFrame:
    """Per node, ``n`` members and the smallest of them."""
    schema = _LONGS("hi", "lo", "conv_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts = _words(batch.column("digests")), np.array([len(d) // 16 for d in batch.column("digests").to_pylist()], np.int64)
            conv = batch.column("conv_id").to_numpy()
            first = batch.column("band").to_numpy() == 0
            keys = np.concatenate([nodes, np.zeros((int(first.sum()), 2), np.uint64)]).view(np.int64)
            yield in_rows({"hi": keys[:, 0], "lo": keys[:, 1], "conv_id": np.concatenate([np.repeat(conv, counts), conv[first]])}, schema)

    return paths.mapInArrow(work, _ddl(schema.names)).groupBy(*_KEY).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))


class Crown:
    """The heavy nodes and the smallest member of each."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        keys = np.array([r[:2] for r in rows], np.int64).reshape(-1, 2).view(np.uint64)
        self.table = NodeTable(keys)
        self.conv_id = np.zeros(len(rows), np.int64)
        self.conv_id[self.table.slots(keys)] = [r[2] for r in rows]


def _steps(paths: DataFrame, crown) -> DataFrame:
    """A row per conversation and node of its path, with the unit and stage the node is in: stage 0 is the crown,
    stage ``k + 1`` the light nodes of band ``k``."""
    schema = _LONGS(*_STEP)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = crown()
        for batch in batches:
            nodes = _words(batch.column("digests"))
            counts = np.array([len(d) // 16 for d in batch.column("digests").to_pylist()], np.int64)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            conv, band = batch.column("conv_id").to_numpy(), batch.column("band").to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), counts)
            above = np.roll(nodes, 1, axis=0)
            some = np.flatnonzero(counts)
            above[bounds[some]] = _words(batch.column("parent"))[some]
            slots, parents = heavy.table.slots(nodes), heavy.table.slots(above)
            # Members grow fewer along a path: what is heavy comes first.
            n_heavy = np.bincount(row[slots >= 0], minlength=batch.num_rows)
            unit = nodes[np.minimum(bounds[:-1] + n_heavy, max(0, len(nodes) - 1))][row] if len(nodes) else nodes
            stage = np.where(slots >= 0, 0, band[row] + 1)
            depth = band[row] * BAND + np.arange(len(nodes)) - bounds[row] + 1
            size = np.frombuffer(b"".join(batch.column("sizes").to_pylist()), "<i8")
            known = pa.array(heavy.conv_id[parents] if len(heavy.conv_id) else np.zeros(len(nodes), np.int64), pa.int64(), mask=parents < 0)
            unit = np.where((slots >= 0)[:, None], np.uint64(0), unit)
            pairs = [words.view(np.int64)[:, k] for words in (nodes, above, unit) for k in (0, 1)]
            yield in_rows(dict(zip(_STEP, [*pairs, stage, depth, size, conv[row], known], strict=True)), schema)
            roots = conv[band == 0]
            nil = np.zeros(len(roots), np.int64)
            none = pa.nulls(len(roots), pa.int64())
            yield in_rows(dict(zip(_STEP, [nil, nil, none, none, nil, nil, nil, nil, nil, roots, none], strict=True)), schema)

    return paths.mapInArrow(work, _ddl(_STEP))


def _summed(nodes: DataFrame) -> DataFrame:
    """Sums over the subtrees of a partition, which holds whole units; ``top`` marks nodes whose parent is not in it.

    ``more_*`` is what nodes of other partitions have brought for a node.
    """
    schema = _LONGS(*_SUMS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        keys, parents = _pairs(rows, "hi", "lo"), _pairs(rows, "phi", "plo")
        table = NodeTable(keys)
        slots = table.slots(keys)
        n = len(table.keys)

        def scattered(name: str) -> np.ndarray:
            flat = np.zeros(n, np.int64)
            flat[slots] = rows.column(name).fill_null(0).to_numpy()
            return flat

        convs, size, depth, conv_id = (scattered(k) for k in ("n_convs", "size", "depth", "conv_id"))
        children, leaves, saved = (scattered(k) for k in ("more_children", "more_leaves", "more_saved"))
        parent = np.full(n, -1, np.int64)
        parent[slots] = np.where(rows.column("phi").is_null().to_numpy(zero_copy_only=False), -1, table.slots(parents))
        inside = np.flatnonzero(parent >= 0)
        np.add.at(children, parent[inside], 1)
        leaves += children == 0
        saved += (convs - 1) * size
        order = inside[np.argsort(-depth[inside], kind="stable")]
        starts = np.flatnonzero(np.diff(depth[order], prepend=-1))
        for level in np.split(order, starts[1:]):
            np.add.at(leaves, parent[level], leaves[level])
            np.add.at(saved, parent[level], saved[level])
        above = pa.array(conv_id[parent[slots]], pa.int64(), mask=parent[slots] < 0)
        given = pc.coalesce(above, rows.column("parent_conv_id"))
        flat = [a[slots] for a in (convs, children, leaves, saved)]
        yield in_rows(dict(zip(_SUMS, [*(rows.column(k) for k in ("hi", "lo", "phi", "plo", "conv_id", "depth")), given, *flat, (parent[slots] < 0).astype(np.int64)], strict=True)), schema)

    return nodes.mapInArrow(work, _ddl(_SUMS))


def _ends(paths: DataFrame, crown) -> DataFrame:
    """Per node where conversations end, the digest of their ids, ascending, joined by commas.

    Light nodes have few of them. For the others the ids are sorted over range partitions and joined there, so one
    task hashes text, in order, instead of sorting rows.
    """
    schema = _LONGS("hi", "lo", "conv_id", "heavy")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = crown()
        for batch in batches:
            ends = [d[-16:] or p for d, p in zip(batch.column("digests").to_pylist(), batch.column("parent").to_pylist(), strict=True)]
            keys = np.frombuffer(b"".join(ends), "<u8").reshape(-1, 2)
            yield in_rows({"hi": keys.view(np.int64)[:, 0], "lo": keys.view(np.int64)[:, 1], "conv_id": batch.column("conv_id"), "heavy": (heavy.table.slots(keys) >= 0).astype(np.int64)}, schema)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts, _ in key_runs(batches, ["hi", "lo"]):
            ids, pieces = batch.column("conv_id").to_pylist(), []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
                pieces.extend((batch.column("hi")[a].as_py(), batch.column("lo")[a].as_py(), ids[k], ",".join(map(str, ids[k : min(b, k + _PIECE)]))) for k in range(a, b, _PIECE))
            yield in_rows(dict(zip(piece_schema.names, map(list, zip(*pieces, strict=True)), strict=True)), piece_schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for hi, lo, text in zip(*(batch.column(n).to_pylist() for n in ("hi", "lo", "ids")), strict=True):
                if (hi, lo) != key:
                    if state:
                        done.append((*key, state.hexdigest()))
                    key, state = (hi, lo), hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
        if state:
            done.append((*key, state.hexdigest()))
            yield in_rows(dict(zip(end_schema.names, map(list, zip(*done, strict=True)), strict=True)), end_schema)

    piece_schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    end_schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("ends_sha256", pa.string())])
    ends = paths.filter("last").select("conv_id", "parent", "digests").mapInArrow(work, _ddl(schema.names))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    light = ends.filter("heavy = 0").groupBy(*_KEY).agg(F.sha2(ids, 256).alias("ends_sha256"))
    sorted_ = ends.filter("heavy = 1").repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id")
    pieces = sorted_.mapInArrow(joined, "hi long, lo long, first long, ids string")
    many = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(hashed, "hi long, lo long, ends_sha256 string")
    return light.unionByName(many)


def trie_nodes(paths: DataFrame, least_limit: int = LEAST_LIMIT, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """A row per node of the trie of these paths.

    ``conv_id``, the smallest member, and ``depth`` name a node; ``parent_conv_id`` is its parent's, null for the
    root. ``n_convs`` members start with it, ``n_children`` nodes follow it, ``n_leaves`` nodes of its subtree have no
    child. ``saved_tokens`` sums, over its subtree, the bytes of each node's last text times its members but one.
    ``ends_sha256`` is the digest of the ids of the members that end there. No conversations make no node.
    """
    spark = paths.sparkSession
    total = paths.agg(F.sum(F.octet_length("digests") / 16).alias("n"), F.max("band").alias("bands")).first()
    if total.bands is None:
        return spark.createDataFrame([], f"{_ddl(n for n in _SUMS if n not in ('hi', 'lo', 'phi', 'plo', 'top'))}, ends_sha256 string")
    limit = max(least_limit, int(total.n) // MOST_HEAVY)
    # The counts of all nodes but the root, which is one more, add up to the number of steps.
    heavy = _members(paths).filter((F.col("n") > limit) | ((F.col("hi") == 0) & (F.col("lo") == 0))).collect()
    crown = for_tasks(spark, Crown([(r.hi, r.lo, r.conv_id) for r in heavy]))
    same = [F.min(n).alias(n) for n in _STEP if n not in _KEY]
    folder = scratch(spark, "trie-nodes")
    _steps(paths, crown).groupBy(*_KEY).agg(F.count("*").alias("n_convs"), *same).write.partitionBy("stage").parquet(folder)
    nodes = spark.read.parquet(folder)
    sizes = {r.stage: r.n for r in nodes.groupBy("stage").agg(F.count("*").alias("n")).collect()}
    summed = None
    for stage in sorted(sizes, reverse=True):
        own = nodes.filter(F.col("stage") == stage)
        if stage > 1:
            # The parent of a unit's top may be a light node of the band before.
            before = nodes.filter(F.col("stage") == stage - 1).select(F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("conv_id").alias("before"))
            own = own.join(before, ["phi", "plo"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "before")).drop("before")
        names = ("children", "leaves", "saved")
        if summed is None:
            own = own.withColumns({f"more_{n}": F.lit(0).cast("long") for n in names})
        else:
            tops = summed.filter("top = 1").groupBy(F.col("phi").alias("hi"), F.col("plo").alias("lo"))
            brought = tops.agg(F.count("*").alias("more_children"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
            own = own.join(brought, list(_KEY), "left")
        shards = -(-sizes[stage] // shard_nodes) if stage else 1
        shard = F.pmod(F.xxhash64("uhi", "ulo"), F.lit(shards)).cast("int")
        target = scratch(spark, f"trie-stage-{stage}")
        _summed(own.repartitionById(shards, shard)).write.parquet(target)
        found = spark.read.parquet(target)
        summed = found if summed is None else summed.unionByName(found)
    forget(spark, folder)
    ended = summed.join(_ends(paths, crown), list(_KEY), "left")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return ended.select(*[n for n in _SUMS if n not in ("hi", "lo", "phi", "plo", "top")], F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def prefix_trie(rows: DataFrame, base: Column | None = None, shared: Column | None = None, least_limit: int = LEAST_LIMIT, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The trie of the conversations whose turns are ``rows`` of ``conv_id, turn, role, text``; see ``trie_nodes``.

    With ``base`` and ``shared``, columns of ``conv_id``, conversations are branches; see ``conversation_paths``. Rows
    repeated are turns of their own. Other columns are ignored.
    """
    spark, folder = rows.sparkSession, scratch(rows.sparkSession, "trie-paths")
    conversation_paths(turn_keys(rows), base, shared).write.parquet(folder)
    return trie_nodes(spark.read.parquet(folder), least_limit, shard_nodes)
