"""A versioned table with an atomic pointer: appends that can be retried.

A table is a folder with ``data/<version>-<id>`` (Parquet, one row a key) and
``log/<version>.json``. An append writes the next version's data first and
then creates that version's log file, which exists or does not: readers see
the old table or the new one, never a part of either. The log names the run
that made each version, so a run that is repeated after it had finished
changes nothing, and one that died half way has left only an unreferenced
folder. Two writers that race for a version cannot both create its log file;
the later one starts again from the new version.

A version is the whole table, reduced to one row a key, so an append costs a
rewrite of the table: it is meant for dimensions such as the gazetteer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..operators.geo import dedup_gazetteer
from ..schema import GEO_KEYS

#: Versions whose data is kept for readers that have opened them.
KEEP = 2


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    runs: tuple[str, ...]


class VersionedTable:
    """A table under ``path``, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] = GEO_KEYS,
                 reduce: Callable[[DataFrame, list[str]], DataFrame] = dedup_gazetteer, keep: int = KEEP, remember_runs: int = 1000):
        self.spark, self.path, self.keys, self.reduce = spark, path.rstrip("/"), keys, reduce
        self.keep, self.remember_runs = keep, remember_runs

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    @property
    def _fs(self):
        return self._path("log").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _versions(self) -> list[str]:
        return [n for n in self._names("log") if n.endswith(".json")]

    def _read_log(self, name: str) -> Version:
        v = json.loads(self.spark.read.text(f"{self.path}/log/{name}", wholetext=True).first()["value"])
        return Version(v["number"], v["folder"], tuple(v["runs"]))

    def current(self) -> Version | None:
        """The newest version."""
        names = self._versions()
        return self._read_log(names[-1]) if names else None

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version (the current one by default)."""
        v = version or self.current()
        if v is None:
            raise FileNotFoundError(f"no version under {self.path}")
        return self.spark.read.parquet(f"{self.path}/data/{v.folder}")

    def _publish(self, v: Version) -> bool:
        """Create the version's log file; False if another writer has.

        The file is written under another name and renamed, which fails if
        the name is taken: readers never see a part of it.
        """
        jvm, target, draft = self.spark._jvm, self._path(f"log/{v.number:012d}.json"), self._path(f"log/_{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps({"number": v.number, "folder": v.folder, "runs": list(v.runs)}).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, target, options)
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def append(self, rows: DataFrame | Callable[[DataFrame | None], DataFrame], run_id: str) -> Version:
        """Publish a version with ``rows`` added, one row a key.

        ``rows`` may be a function of the current table (None at first), so
        that a run that lost a race computes them again. A run id that has
        published before changes nothing.
        """
        while True:
            names = self._versions()
            now = self._read_log(names[-1]) if names else None
            if now is not None and run_id in now.runs:
                return now
            old = self.read(now) if now is not None else None
            new = rows(old) if callable(rows) else rows
            whole = self.reduce(new if old is None else old.unionByName(new.select(*old.columns)), self.keys)
            number = now.number + 1 if now else 1
            folder = f"{number:012d}-{uuid.uuid4().hex[:12]}"
            whole.write.parquet(f"{self.path}/data/{folder}")
            v = Version(number, folder, (*(now.runs if now else ()), run_id)[-self.remember_runs:])
            if self._publish(v):
                self._vacuum(number)
                return v

    def _vacuum(self, number: int) -> None:
        """Delete data that no version from ``number - keep`` on can name, also
        what runs that died have left there."""
        for name in self._names("data"):
            if int(name.split("-")[0]) <= number - self.keep:
                self._fs.delete(self._path(f"data/{name}"), True)
        for name in self._versions():
            if int(name.split(".")[0]) <= number - self.keep:
                self._fs.delete(self._path(f"log/{name}"), True)


__all__ = ["VersionedTable", "Version"]
