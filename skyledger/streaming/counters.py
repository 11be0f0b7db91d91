"""Running totals of observed metrics, which outlive the process (AGG-6, AGG-7)."""

from __future__ import annotations

import json
import logging
import time
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..session import names_below, read_text, remove_path, write_text

log = logging.getLogger(__name__)


class CounterTable:
    """Totals by counter, query and batch: a small file for each of the last batches.

    A file holds the totals up to its batch. A batch that is repeated adds to the
    batch before it, as it did the first time, so it counts once. A query is known by
    its checkpoint: one that starts anew without memory has counts of its own, which
    come on top.
    """

    # The last batch of a query can be repeated, so the one before it must be there.
    KEEP = 2

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, name: str, query: str) -> str:
        return f"{self.path}/counter={name}/query={query}"

    def _batches(self, folder: str) -> list[int]:
        names = (name.removesuffix(".json") for name in names_below(self.spark, folder) if name.endswith(".json"))
        return sorted(int(name) for name in names if name.isdigit())

    def put(self, name: str, query: str, batch: int, counts: dict[str, int]) -> None:
        folder = self._folder(name, query)
        batches = self._batches(folder)
        before = [b for b in batches if b < batch]
        total = Counter(self._read(folder, before[-1]) if before else {})
        total.update(counts)
        write_text(self.spark, f"{folder}/{batch}.json", json.dumps(dict(total)))
        for old in [b for b in batches if b < batch][: -self.KEEP]:
            remove_path(self.spark, f"{folder}/{old}.json")

    def _read(self, folder: str, batch: int) -> dict[str, int]:
        return json.loads(read_text(self.spark, f"{folder}/{batch}.json"))

    def totals(self, name: str) -> Counter[str]:
        """Over all queries that have counted under this name."""
        total: Counter[str] = Counter()
        for query in names_below(self.spark, f"{self.path}/counter={name}"):
            folder = f"{self.path}/counter={name}/{query}"
            batches = self._batches(folder)
            if batches:
                total.update(self._read(folder, batches[-1]))
        return total

    def frame(self, names: list[str]) -> DataFrame:
        rows = [(name, entry, total) for name in names for entry, total in sorted(self.totals(name).items())]
        return self.spark.createDataFrame(rows, "counter string, entry string, total long")


class RunningCounts(StreamingQueryListener):
    """Adds up the counters that ``observe`` attaches to every micro-batch.

    The totals are those of this process or, with a table, of all runs. ``every`` is
    how many rows of the first counter lie between two log lines.
    """

    def __init__(self, name: str, every: int = 20, table: CounterTable | None = None):
        self.name, self.every, self.table = name, every, table
        self.totals: Counter[str] = Counter() if table is None else table.totals(name)
        self._reported = max(self.totals.values(), default=0) // every
        self._last: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        if row is not None:
            counts = row.asDict()
            if self.table is None:
                self.totals.update(counts)
            else:
                self.table.put(self.name, str(progress.id), progress.batchId, counts)
                self.totals = self.table.totals(self.name)
            passed = self.totals[next(iter(counts))] // self.every
            if passed > self._reported:
                self._reported = passed
                log.info("%s %s", self.name, dict(self.totals))
        self._last[str(progress.id)] = progress.batchId

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def wait_for(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Wait until the last batch of a query is counted: Spark reports batches some time after they end."""
        progress = query.lastProgress
        deadline = time.monotonic() + seconds
        while progress is not None and self._last.get(str(query.id), -1) < progress["batchId"]:
            if time.monotonic() > deadline:
                raise TimeoutError(f"batch {progress['batchId']} of {query.name} was not reported")
            time.sleep(0.05)
