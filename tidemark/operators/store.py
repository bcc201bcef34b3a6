"""Tables on Parquet: idempotent appends, upserts that keep the first created_at, replacement, and integrity checks.

A table is a folder of versions. Numbered manifests name the versions of all tables that count; the one with the highest
number is the store. A commit writes its tables, then a manifest beside the others, and gives it the next number as
its last act: readers see all tables of a commit or none, a crash before that leaves the last commit as it was, and of two
writers that began from the same number one fails.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import KEYS, PARTITIONED
from . import stopping


def insert_ignore(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The rows of `new` that an insert-or-ignore adds."""
    return new.dropDuplicates(key).join(existing.select(*key), key, "left_anti")


def upsert(existing: DataFrame, new: DataFrame, key: list[str], version: str = "updated_at", created: str | None = "created_at") -> DataFrame:
    """One row per key: the latest, with the earliest created_at. One shuffle on the key."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    w = Window.partitionBy(*key)
    if created:
        both = both.withColumn(created, F.min(created).over(w))
    ranked = both.withColumn("_rn", F.row_number().over(w.orderBy(F.desc("_new"), F.desc_nulls_last(version))))
    return ranked.where("_rn = 1").drop("_rn", "_new")


def replace(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    return existing.join(new.select(*key), key, "left_anti").unionByName(new)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


class Conflict(RuntimeError):
    """Another writer has made the commit that this one was going to be."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _numbers(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/_manifests")
        if not fs.exists(p):
            return []
        return sorted(int(m[1]) for f in fs.listStatus(p) if (m := re.fullmatch(r"(\d+)\.json", f.getPath().getName())))

    def manifest(self) -> tuple[int, dict[str, list[str]]]:
        """The number of the last commit, and each table's versions."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        fs, p = self._fs(f"{self.root}/_manifests/{numbers[-1]:012d}.json")
        stream = fs.open(p)
        try:
            return numbers[-1], json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, name: str) -> DataFrame | None:
        return self._read(self.manifest()[1], name)

    def _read(self, tables: dict[str, list[str]], name: str) -> DataFrame | None:
        reader = self.spark.read.schema(PARTITIONED[name][0]) if name in PARTITIONED else self.spark.read
        return reader.parquet(*[f"{self.root}/{name}/{v}" for v in tables[name]]) if tables.get(name) else None

    def commit(self, tables: dict[str, DataFrame], append: bool = False, upserts: dict[str, DataFrame] | None = None) -> None:
        """Writes all tables, then one manifest: a run's outputs appear together, or none of them. `upserts` are merged by key."""
        number, old = self.manifest()
        written = {name: self._write(name, df) for name, df in tables.items()}
        merged = {name: self._write(name, df if (before := self._read(old, name)) is None else upsert(before, df, KEYS[name])) for name, df in (upserts or {}).items()}
        self._publish(number, old | {name: [*(old.get(name, []) if append else []), v] for name, v in written.items()} | {name: [v] for name, v in merged.items()})

    def _write(self, name: str, df: DataFrame) -> str:
        v = uuid.uuid4().hex
        df.write.partitionBy(*PARTITIONED.get(name, ("", []))[1]).parquet(f"{self.root}/{name}/{v}")
        return v

    def _publish(self, number: int, tables: dict[str, list[str]]) -> None:
        """The manifest of the next number, made only if it isn't there; by a thread whose work was stopped, not at all."""
        stopping.check()
        fs, target = self._fs(f"{self.root}/_manifests/{number + 1:012d}.json")
        _, temp = self._fs(f"{self.root}/_manifests/.{uuid.uuid4().hex}")
        body = bytearray(json.dumps(tables, sort_keys=True).encode())
        out = fs.create(temp, True)
        out.write(body)
        out.close()
        try:
            if self._taken(fs, temp, target):
                raise Conflict(f"commit {number + 1} of {self.root} has been made by another writer")
        finally:
            fs.delete(temp, False)

    def _taken(self, fs, temp, target) -> bool:
        """Whether the number was taken; if not, it is now. On local disks a link is made, elsewhere a rename that replaces
        nothing: both fail where the name is there, so of two writers at once one is told."""
        if fs.getUri().getScheme() == "file":
            files, path = self.spark._jvm.java.nio.file.Files, lambda p: self.spark._jvm.java.io.File(p.toUri().getPath()).toPath()
            try:
                files.createLink(path(target), path(temp))
                return False
            except Exception as e:
                if "FileAlreadyExistsException" not in str(e):
                    raise
                return True
        return fs.exists(target) or not fs.rename(temp, target)

    def append_new(self, name: str, new: DataFrame, tries: int = 8) -> int:
        """Insert or ignore by the table's key; how many rows are new. Sources that collect side by side may commit at once:
        who comes second looks again at what is there."""
        for last in (*[False] * (tries - 1), True):
            number, tables = self.manifest()
            old = self._read(tables, name)
            rows = new.dropDuplicates(KEYS[name]) if old is None else insert_ignore(old, new, KEYS[name])
            v = self._write(name, rows)
            try:
                self._publish(number, tables | {name: [*tables.get(name, []), v]})
            except Conflict:
                if last:
                    raise
                continue
            return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{name}/{v}").count()

    def upsert(self, name: str, new: DataFrame, version: str = "updated_at", created: str | None = "created_at") -> None:
        old = self.read(name)
        self.commit({name: new if old is None else upsert(old, new, KEYS[name], version, created)})

    def append(self, name: str, rows: DataFrame) -> None:
        self.commit({name: rows}, append=True)

    def prune(self, name: str, column: str, before: str) -> None:
        """Retention: rows older than a time go."""
        old = self.read(name)
        if old is not None:
            self.commit({name: old.where(F.col(column) >= F.lit(before).cast("timestamp"))})
