"""A ledger of micro-batches, so that a replayed batch is written once.

One small file for each (writer, batch, target) and state: ``begun`` is
created before a target is written, ``done`` after. A replay finds ``done``
and skips the target, or finds ``begun`` alone and knows that an unfinished
write may have left rows there, which have to be taken back first. The ledger
stands in a shared folder and outlives the query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class BatchLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, writer: str, batch: int, target: str, state: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{writer}/{batch}/{target}.{state}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def state(self, writer: str, batch: int, target: str) -> str | None:
        """``done``, ``begun`` or None."""
        for s in ("done", "begun"):
            fs, p = self._file(writer, batch, target, s)
            if fs.exists(p):
                return s
        return None

    def mark(self, writer: str, batch: int, target: str, state: str) -> None:
        if state not in ("begun", "done"):
            raise ValueError(f"unknown state {state!r}")
        fs, p = self._file(writer, batch, target, state)
        fs.create(p, True).close()

    def forget_before(self, writer: str, batch: int) -> None:
        """Delete entries of the writer's batches before ``batch``; a query
        replays its last batches only."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{writer}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if fs.exists(folder):
            for s in fs.listStatus(folder):
                if int(s.getPath().getName()) < batch:
                    fs.delete(s.getPath(), True)
