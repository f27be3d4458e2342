"""A small text in a folder that the parts of a service share, as numbered files.

A writer adds the next number under another name and renames it, so that no reader sees half a text,
and the last few numbers stay, so that none is deleted while it is read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

KEEP = 8


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self.jvm, self.path = context._jvm, path
        self.files = self._at(path).getFileSystem(context._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def numbers(self) -> list[int]:
        folder = self._at(self.path)
        if not self.files.exists(folder):
            return []
        return sorted(int(name) for name in (s.getPath().getName() for s in self.files.listStatus(folder)) if name.isdigit())

    def get(self) -> str | None:
        """The newest text; None if there is none yet."""
        numbers = self.numbers()
        if not numbers:
            return None
        source = self.files.open(self._at(f"{self.path}/{numbers[-1]:020d}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def put(self, text: str) -> None:
        self.files.mkdirs(self._at(self.path))
        numbers = self.numbers()
        draft = self._at(f"{self.path}/_{uuid.uuid4().hex}")
        out = self.files.create(draft)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self.files.rename(draft, self._at(f"{self.path}/{(numbers[-1] if numbers else 0) + 1:020d}")):
            self.files.delete(draft, False)
            raise OSError(f"cannot write to {self.path}")
        for n in numbers[: 1 - KEEP]:
            self.files.delete(self._at(f"{self.path}/{n:020d}"), False)
