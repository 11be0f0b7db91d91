"""Several streaming jobs in one session, each for itself (STR-3)."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

Start = Callable[[], StreamingQuery]
_POOL = "spark.scheduler.pool"
# Seconds after which the jobs are looked at, whether or not one has ended.
LOOK_EVERY = 10


@dataclass
class Together:
    """Jobs that run side by side. ``fallen`` has, by job, the exceptions it ended with."""

    spark: SparkSession
    starts: Mapping[str, Start]
    restarts: int = 0
    queries: dict[str, StreamingQuery] = field(default_factory=dict)
    fallen: dict[str, list[Exception]] = field(default_factory=dict)

    def start(self) -> Together:
        """Start all jobs, each in a scheduler pool of its name, so that in a session with fair scheduling a long
        batch of one does not hold up the others."""
        for name in self.starts:
            self._start(name)
        return self

    def _start(self, name: str) -> None:
        context = self.spark.sparkContext
        before = context.getLocalProperty(_POOL)
        # A query's batches run in the pool of the thread that starts it.
        context.setLocalProperty(_POOL, name)
        try:
            self.queries[name] = self.starts[name]()
        finally:
            context.setLocalProperty(_POOL, before)

    def running(self) -> list[str]:
        return [name for name, query in self.queries.items() if query.isActive]

    def look(self) -> None:
        """Note which jobs have fallen, and start them again while they have restarts left. The others go on."""
        for name, query in list(self.queries.items()):
            if query.isActive:
                continue
            problem = query.exception()
            if problem is None:
                continue
            falls = self.fallen.setdefault(name, [])
            if problem in falls:
                continue
            falls.append(problem)
            again = len(falls) <= self.restarts
            log.error("%s has fallen%s: %s", name, ", and starts again" if again else "", problem)
            if again:
                # It goes on from its checkpoint.
                self._start(name)

    def wait(self) -> dict[str, list[Exception]]:
        """Wait until no job runs any more, and return the falls."""
        streams = self.spark.streams
        while self.running():
            try:
                streams.awaitAnyTermination(LOOK_EVERY)
            except StreamingQueryException:
                # Told apart by looking at each job; other queries of the session may have fallen too.
                pass
            # What ends after this line ends the next wait at once.
            streams.resetTerminated()
            self.look()
        self.look()
        return self.fallen

    def stop(self) -> None:
        for query in self.queries.values():
            query.stop()
