"""Scheduling of the loads of one run: a pool and a tag for each source, and cancelling one source alone.

All jobs of a load run in a scheduler pool of the source's name, so with ``spark.scheduler.mode=FAIR`` a large source does not make small ones
wait for its tasks.  They carry a tag, by which they are cancelled.  A load is several jobs in a row, so whoever cancels goes on doing so until
the load has ended; what it had written is never committed, and a load that commits first stands.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import SparkSession

_POOL = "spark.scheduler.pool"


class RunControl:
    """Cancels the loads of a run: those that ``cancel`` names, and those that take longer than ``time_limit`` seconds.

    One control serves one run.  ``every`` is how often it looks, in seconds.
    """

    def __init__(self, spark: SparkSession, time_limit: float | None = None, every: float = 0.5):
        self.context: SparkContext = spark.sparkContext
        self.time_limit, self.every = time_limit, every
        self._token = uuid.uuid4().hex[:12]
        self._lock = threading.Lock()
        self._began: dict[str, float] = {}
        self._reasons: dict[str, str] = {}
        self._over = threading.Event()

    def tag(self, schema: str, view: str) -> str:
        """The tag of all jobs of a source in this run; Spark allows no commas in it."""
        return f"load {self._token} {schema}.{view}".replace(",", "_")

    def cancel(self, schema: str, view: str, reason: str = "on request") -> None:
        """Cancel a source, from any thread; one that has not begun will not begin, one that has ended stays as it is."""
        with self._lock:
            self._reasons.setdefault(self.tag(schema, view), f"cancelled: {reason}")

    def reason(self, schema: str, view: str) -> str | None:
        with self._lock:
            return self._reasons.get(self.tag(schema, view))

    @contextmanager
    def source(self, schema: str, view: str) -> Iterator[None]:
        """Jobs that this thread starts inside belong to the source."""
        tag = self.tag(schema, view)
        if stopped := self.reason(schema, view):
            raise RuntimeError(stopped)
        before = self.context.getLocalProperty(_POOL)
        self.context.setLocalProperty(_POOL, f"{schema}.{view}")
        self.context.addJobTag(tag)
        with self._lock:
            self._began[tag] = time.monotonic()
        try:
            yield
        finally:
            with self._lock:
                del self._began[tag]
            self.context.removeJobTag(tag)
            self.context.setLocalProperty(_POOL, before)

    def _look(self) -> None:
        while not self._over.wait(self.every):
            now = time.monotonic()
            with self._lock:
                for tag, began in self._began.items():
                    if self.time_limit is not None and now - began > self.time_limit:
                        self._reasons.setdefault(tag, f"cancelled: took more than {self.time_limit} seconds")
                running = [tag for tag in self._began if tag in self._reasons]
            for tag in running:
                self.context.cancelJobsWithTag(tag)

    @contextmanager
    def watching(self) -> Iterator[None]:
        """Look for loads to cancel while the run goes on."""
        watcher = threading.Thread(target=self._look, name="load watcher", daemon=True)
        watcher.start()
        try:
            yield
        finally:
            self._over.set()
            watcher.join()
