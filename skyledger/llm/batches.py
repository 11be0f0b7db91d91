"""Work on Arrow batches inside tasks: bounded slices, words coded as numbers, runs of rows."""

from __future__ import annotations

import pickle
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose text takes at most ``most`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            limit = (ends[start - 1] if start else 0) + most
            stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    # A worker lives on after its task; what its batches took goes back.
    pa.default_memory_pool().release_unused()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)


def sums_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of ``values[bounds[i]:bounds[i + 1]]`` for each i; 0 for an empty range."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def coded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """White-space words of each text: the distinct words, a code per word, and the bounds of each row.

    A null text has no word. White space is what Unicode says it is.
    """
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    coded = pc.dictionary_encode(words)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return coded.dictionary, codes, bounds - bounds[0]


def key_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, bool]]:
    """Batches of rows sorted by ``keys`` with the starts of their runs.

    The flag says whether the first run goes on from the last row of the batch before.
    """
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for key in keys:
            column = batch.column(key)
            if batch.num_rows > 1:
                a, b = column.slice(1), column.slice(0, batch.num_rows - 1)
                same = pc.if_else(pc.and_(pc.is_null(a), pc.is_null(b)), True, pc.fill_null(pc.equal(a, b), False))
                changed[1:] |= ~same.to_numpy(zero_copy_only=False)
        first = tuple(batch.column(key)[0].as_py() for key in keys)
        goes_on = last is not None and first == last
        changed[0] = True
        yield batch, np.flatnonzero(changed), goes_on
        last = tuple(batch.column(key)[batch.num_rows - 1].as_py() for key in keys)


def held_out_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls to this fold; a null id, which has no crc, is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True))


def hash_share(share: Column | float, *columns: Column) -> Column:
    """A filter that keeps about this share of the rows, the same ones in every run and layout."""
    unit = F.pmod(F.xxhash64(F.lit("share"), *columns), F.lit(1 << 40)) / float(1 << 40)
    return unit < share


def for_tasks(spark: SparkSession, thing: object) -> Callable[[], object]:
    """Broadcast something of bounded size with the code of its class; the result unpacks it inside a task."""
    box = spark.sparkContext.broadcast(cloudpickle.dumps(thing))
    return lambda: pickle.loads(box.value)


def unused(name: str, taken: list[str]) -> str:
    """A column name like this one that a table does not have; names that differ in case only are one name to Spark."""
    names = {t.lower() for t in taken}
    while name.lower() in names:
        name = f"_{name}"
    return name


def kept_by_worker(name: str, make: Callable[[], object]) -> object:
    """What this Python worker made under the name, in this task or in one before. A function comes anew with each task
    and so do its globals; the worker's table of modules stays. Keep only what has a bound of its own."""
    kept = vars(sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")))
    if name not in kept:
        kept[name] = make()
    return kept[name]


def in_rows(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of these columns, with their types taken from ``schema``."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type) for n, c in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
