"""Restarts: what fails is started again after a pause that doubles, until it is told to stop."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery


class Backoff:
    """Pauses of ``first`` seconds, doubling up to ``most``; from the start again after a run of ``healthy`` seconds."""

    def __init__(self, first: float = 1.0, most: float = 60.0, healthy: float = 60.0, clock: Callable[[], float] = time.monotonic):
        self.first, self.most, self.healthy, self.clock = first, most, healthy, clock
        self.next, self.since = first, clock()

    def started(self) -> None:
        self.since = self.clock()

    def failed(self) -> float:
        """Seconds to wait before the next start."""
        if self.clock() - self.since >= self.healthy:
            self.next = self.first
        wait, self.next = self.next, min(self.most, 2 * self.next)
        return wait


def keep_running(start: Callable[[], StreamingQuery], stop: threading.Event, backoff: Backoff | None = None, on_error: Callable[[Exception, float], None] | None = None) -> None:
    """Runs a query until ``stop`` is set, or it ends by itself; after an error it is started again from its checkpoint."""
    backoff = backoff or Backoff()
    while not stop.is_set():
        backoff.started()
        try:
            query = start()
            while not query.awaitTermination(1):
                if stop.is_set():
                    query.stop()
                    return
            return
        except Exception as e:  # noqa: BLE001 - whatever ended the query
            wait = backoff.failed()
            if on_error:
                on_error(e, wait)
            stop.wait(wait)


def first_success(fetch: Callable[[], object], stop: threading.Event, first: float = 300.0, most: float = 7200.0) -> object | None:
    """Tries until something can be fetched: 5 minutes after a failure, doubling up to 2 hours.  None if told to stop."""
    backoff = Backoff(first, most, float("inf"))
    while not stop.is_set():
        try:
            return fetch()
        except Exception:  # noqa: BLE001 - a feed fails in many ways
            stop.wait(backoff.failed())
    return None
