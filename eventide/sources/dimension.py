"""User dimension as a snapshot that is read again while the job runs.

A streaming query would keep the rows it was started with. The handlers ask the
dimension for its current snapshot once a trigger; when the snapshot is older
than ``refresh_seconds`` it is read again, its version goes up, and the old one
is released after the new one is there, so a trigger sees one version only."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


class Dimension:
    def __init__(self, read: Callable[[], DataFrame], refresh_seconds: float | None = None,
                 clock: Callable[[], float] = time.monotonic):
        self._read, self._every, self._clock = read, refresh_seconds, clock
        self._lock = threading.Lock()  # several queries share a dimension
        self._snapshot: DataFrame | None = None
        self._retired: DataFrame | None = None
        self._at = 0.0
        self.version = 0

    def current(self) -> DataFrame:
        """The snapshot to use for one trigger. The one before stays readable
        for triggers that still use it, until the next refresh."""
        with self._lock:
            due = self._every is not None and self._clock() - self._at >= self._every
            if self._snapshot is None or due:
                new = self._read().persist(StorageLevel.MEMORY_AND_DISK)
                new.count()  # one consistent read, now
                if self._retired is not None:
                    self._retired.unpersist()
                self._retired, self._snapshot = self._snapshot, new
                self._at = self._clock()
                self.version += 1
            return self._snapshot

    def release(self) -> None:
        with self._lock:
            for snapshot in (self._retired, self._snapshot):
                if snapshot is not None:
                    snapshot.unpersist()
            self._retired = self._snapshot = None


def fixed(users: DataFrame) -> Dimension:
    """A dimension that is never read again."""
    return Dimension(lambda: users)
