"""A folder whose content is replaced as a whole, on stores where a folder can't be renamed: each content is a folder of its own below the root, and a numbered
pointer tells which one counts.

A pointer is written beside its place and put there by a rename that fails where one is there already, so of two writers that began from one version
one wins, and whatever a writer dies in the middle of, readers find the old content or the new one."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another writer has put a version since the expected one."""


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.store = self._path(self.root).getFileSystem(self._conf)

    def _path(self, at: str):
        return self._jvm.org.apache.hadoop.fs.Path(at)

    def _pointers(self) -> list[int]:
        at = self._path(f"{self.root}/_versions")
        names = [s.getPath().getName() for s in self.store.listStatus(at)] if self.store.exists(at) else []
        return sorted(int(n) for n in names if re.fullmatch("[0-9]{10}", n))

    def _target(self, number: int) -> str:
        stream = self.store.open(self._path(f"{self.root}/_versions/{number:010d}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def current(self) -> tuple[int, str | None]:
        """The number of the version that counts, 0 if there is none, and its folder."""
        numbers = self._pointers()
        return (numbers[-1], f"{self.root}/{self._target(numbers[-1])}") if numbers else (0, None)

    def stage(self) -> str:
        """A new folder to write a content to; nobody reads it before it is put."""
        return f"{self.root}/v-{uuid.uuid4().hex[:16]}"

    def put(self, folder: str, expected: int) -> int:
        """Makes `folder` the version after `expected`, if that is still the one that counts."""
        if self.current()[0] != expected:
            raise Conflict(f"version {self.current()[0]} counts and not {expected}")
        beside = self._path(f"{self.root}/_versions/.{uuid.uuid4().hex}")
        out = self.store.create(beside, False)
        out.write(folder.rpartition("/")[2].encode())
        out.close()
        self._rename(beside, self._path(f"{self.root}/_versions/{expected + 1:010d}"))
        return expected + 1

    def _rename(self, beside, to) -> None:
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.store.getUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(beside, to, options)
        except Exception as error:
            self.store.delete(beside, False)
            if "FileAlreadyExistsException" in str(error):
                raise Conflict(f"{to.getName()} is there already") from None
            raise

    def clear(self, keep: int = 1) -> None:
        """Deletes the contents of all but the last `keep` versions, and what was staged and never put; no writer may be at work."""
        held = {self._target(n) for n in self._pointers()[-keep:]}
        for status in self.store.listStatus(self._path(self.root)):
            name = status.getPath().getName()
            if name.startswith("v-") and name not in held:
                self.store.delete(status.getPath(), True)
