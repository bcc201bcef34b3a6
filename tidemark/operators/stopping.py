"""Work that can be stopped: its Spark jobs are cancelled by tag, and what it would commit afterwards is refused."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_here = threading.local()


class Stopped(RuntimeError):
    pass


class Work:
    """One piece of work on a driver thread. `stop` may be called from any other."""

    def __init__(self, name: str, spark: SparkSession | None = None):
        self.name, self.spark = name, spark
        self.tag, self._late = f"tidemark-{uuid.uuid4().hex}", threading.Event()

    @contextmanager
    def running(self) -> Iterator[None]:
        before = getattr(_here, "work", None)
        _here.work = self
        if self.spark is not None:
            self.spark.sparkContext.addJobTag(self.tag)
        try:
            check()
            yield
        finally:
            _here.work = before
            if self.spark is not None:
                self.spark.sparkContext.removeJobTag(self.tag)

    def stop(self) -> None:
        """From now on this work commits nothing, and its running jobs are cancelled, those of adaptive stages too."""
        self._late.set()
        if self.spark is not None:
            self.spark.sparkContext.cancelJobsWithTag(self.tag)

    @property
    def stopped(self) -> bool:
        return self._late.is_set()


def check() -> None:
    """Raises in a thread whose work has been stopped; called before jobs that can be spared and before every commit."""
    work = getattr(_here, "work", None)
    if work is not None and work.stopped:
        raise Stopped(f"{work.name} was stopped")
