"""Versions of a set of tables with one commit point (K3).

A full refresh of several tables writes all of them into a folder of its own.
One small manifest, which appears under its name in a single rename, then makes
them the current version together. Until then readers are on the version
before, whatever the refresh has written; a refresh that stops leaves files
that no manifest names. Tables read earlier keep their files until ``expire``
is asked to take old versions away.

The files are the cluster's (Hadoop's file system interface on the driver);
the number of a version is claimed by creating a file that must not exist, so
two refreshes at a time get two numbers, and the later one is current.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Version:
    """A folder being filled; nobody reads it before its commit."""

    path: str

    def table(self, name: str) -> str:
        return f"{self.path}/{name}"


class Snapshots:
    """The versions under ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        folder = self._path(f"{self.base}/_manifests")
        if not self._fs.exists(folder):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(folder)]

    def numbers(self) -> list[int]:
        """Numbers of the committed versions, oldest first."""
        return sorted(int(m.group(1)) for n in self._names() if (m := re.fullmatch(r"(\d+)\.json", n)))

    def begin(self) -> Version:
        return Version(f"{self.base}/versions/{uuid.uuid4().hex}")

    def _claim(self) -> int:
        n = max((int(m.group(1)) for x in self._names() if (m := re.match(r"(\d+)\.", x))), default=0)
        while True:
            n += 1
            if self._fs.createNewFile(self._path(f"{self.base}/_manifests/{n}.claim")):
                return n

    def commit(self, version: Version, tables: Sequence[str]) -> int:
        """Make ``tables`` of the version current, all at once; returns its number."""
        for t in tables:
            if not self._fs.exists(self._path(f"{version.table(t)}/_SUCCESS")):
                raise ValueError(f"table {t} is not completely written")
        n = self._claim()
        part = self._path(f"{self.base}/_manifests/{n}.part")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps({"path": version.path, "tables": list(tables)}).encode()))
        out.close()
        if not self._fs.rename(part, self._path(f"{self.base}/_manifests/{n}.json")):
            raise OSError(f"version {n} could not be committed")
        return n

    def _manifest(self, n: int) -> dict:
        name = f"{self.base}/_manifests/{n}.json"
        return json.loads(self.spark.read.text(name, wholetext=True).first()[0])

    def current(self) -> Version | None:
        """The newest committed version."""
        numbers = self.numbers()
        return Version(self._manifest(numbers[-1])["path"]) if numbers else None

    def read(self, table: str, number: int | None = None) -> DataFrame:
        """A table of the current version, or of an earlier one."""
        numbers = self.numbers()
        if not numbers or (number is not None and number not in numbers):
            raise FileNotFoundError(f"no committed version {'' if number is None else number} under {self.base}")
        manifest = self._manifest(number or numbers[-1])
        if table not in manifest["tables"]:
            raise KeyError(table)
        return self.spark.read.parquet(Version(manifest["path"]).table(table))

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all committed versions but the newest ``keep``; their readers must be done."""
        old = self.numbers()[: -max(keep, 1)]
        for n in old:
            path = self._manifest(n)["path"]
            self._fs.delete(self._path(f"{self.base}/_manifests/{n}.json"), False)
            self._fs.delete(self._path(path), True)
        return old


def open_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of the current version under ``base``."""
    return Snapshots(spark, base).read(name)
