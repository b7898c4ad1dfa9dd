"""Restart of failed streaming queries from their checkpoint: one alone, or several side by side."""

from __future__ import annotations

import logging
import queue
import time
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)


def run_with_restart(start: Callable[[], StreamingQuery], max_restarts: int | None = None,
                     wait_seconds: float = 30.0) -> int:
    """Run until the query ends by itself; returns how often it was restarted.

    A failure, also of the start, stops the query, waits, and starts it again from its checkpoint.
    With ``max_restarts`` the failure after the last restart is raised.
    """
    restarts = 0
    while True:
        query = None
        try:
            query = start()
            query.awaitTermination()
            return restarts
        except PySparkException:
            if max_restarts is not None and restarts >= max_restarts:
                raise
            log.exception("query %s failed; restart %d follows", query and query.name, restarts + 1)
        finally:
            if query is not None:
                query.stop()
        restarts += 1
        time.sleep(wait_seconds)


class _Ended(StreamingQueryListener):
    """Puts the id of every query that ends, and its error, into a queue."""

    def __init__(self, ended: queue.Queue):
        self.ended = ended

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.put((str(event.runId), event.exception))


class Supervisor:
    """Keeps several queries running. ``start`` holds a function per name that starts the query from
    its own checkpoint.

    A listener tells which query ended, so no query is waited for: while one is down, or waits for
    its restart, the others run on. A query that ends by itself is done. One that fails more than
    ``max_restarts`` times in a row is given up; a batch that it wrote in between starts the count
    anew. ``run`` returns when no query is left; errors of those given up are raised then.
    """

    def __init__(self, spark: SparkSession, start: dict[str, Callable[[], StreamingQuery]],
                 max_restarts: int | None = None, wait_seconds: float = 30.0):
        self.spark, self.start = spark, start
        self.max_restarts, self.wait = max_restarts, wait_seconds
        self.restarts = dict.fromkeys(start, 0)
        self.given_up: dict[str, Exception | str] = {}
        self.active: dict[str, StreamingQuery] = {}
        self._tries = dict.fromkeys(start, 0)
        self._due: dict[str, float] = {}
        self._stopping = False

    def stop(self) -> None:
        """Stop all queries and restart none; ``run`` then returns."""
        self._stopping = True

    def _begin(self, name: str, ended: queue.Queue) -> None:
        try:
            query = self.active[name] = self.start[name]()
        except PySparkException as error:
            self._failed(name, error)
            return
        # it may have ended before its run id was known here
        if not query.isActive:
            ended.put((str(query.runId), query.exception()))

    def _failed(self, name: str, error: Exception | str) -> None:
        log.error("query %s failed: %s", name, error)
        if self._stopping:
            return
        if self.max_restarts is not None and self._tries[name] >= self.max_restarts:
            self.given_up[name] = error
            return
        self._due[name] = time.monotonic() + self.wait

    def _ended(self, run: str, error: Exception | str | None) -> None:
        name = next((n for n, q in self.active.items() if str(q.runId) == run), None)
        if name is None:
            return
        query = self.active.pop(name)
        if any(p.numInputRows for p in query.recentProgress):
            self._tries[name] = 0
        if error:
            self._failed(name, error)

    def run(self, poll_seconds: float = 1.0) -> dict[str, int]:
        """Number of restarts by name."""
        ended: queue.Queue = queue.Queue()
        listener = _Ended(ended)
        self.spark.streams.addListener(listener)
        try:
            for name in self.start:
                self._begin(name, ended)
            while (self.active or self._due) and not self._stopping:
                due = min(self._due.values(), default=time.monotonic() + poll_seconds)
                wait = min(max(due - time.monotonic(), 0.0), poll_seconds)
                try:
                    self._ended(*ended.get(timeout=wait or 0.001))
                except queue.Empty:
                    pass
                # a listener that lost an event must not leave a query unseen
                for query in list(self.active.values()):
                    if not query.isActive:
                        self._ended(str(query.runId), query.exception())
                for name in [n for n, at in self._due.items() if at <= time.monotonic()]:
                    del self._due[name]
                    self._tries[name] += 1
                    self.restarts[name] += 1
                    self._begin(name, ended)
        finally:
            self.spark.streams.removeListener(listener)
            for query in self.active.values():
                query.stop()
        if self.given_up:
            name, error = next(iter(self.given_up.items()))
            if isinstance(error, Exception):
                raise error
            raise RuntimeError(f"query {name}: {error}")
        return self.restarts
