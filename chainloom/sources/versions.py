"""A log of versions in a folder: each is a small JSON file that appears whole and only once, so the next number is won by one writer."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession


class VersionLog:
    """Versions 1, 2, ... under a folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf, self.folder = spark._jvm, spark._jsc.hadoopConfiguration(), folder.rstrip("/")
        self._array = spark.sparkContext._gateway.new_array
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    @staticmethod
    def _name(version: int) -> str:
        return f"v{version:020d}.json"

    def versions(self) -> list[int]:
        if not self._fs.exists(self._path("")):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path("")))
        return sorted(int(m[1]) for m in (re.fullmatch(r"v(\d{20})\.json", n) for n in names) if m)

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._path(self._name(version)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """The last version and its value; 0 and nothing before the first."""
        found = self.versions()
        return (found[-1], self.read(found[-1])) if found else (0, {})

    def commit(self, version: int, value: dict) -> None:
        """Make a version visible. Fails if it is there: another writer was first."""
        part = self._path(f".{uuid.uuid4().hex}")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        try:
            # A rename without the right to overwrite.
            context.rename(part, self._path(self._name(version)), self._array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception:
            self._fs.delete(part, False)
            raise

    def forget(self, version: int) -> None:
        self._fs.delete(self._path(self._name(version)), False)

    def delete(self, path: str) -> None:
        """Delete a folder of the same file system."""
        self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(path), True)

    def folders(self, path: str) -> list[str]:
        """Names of what lies in a folder."""
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []
