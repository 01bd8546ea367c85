"""Durable generations (M15, T3): which files make up a table is said by a numbered commit, not by a folder name.

A commit is a small JSON file ``_geracoes/<number>`` in the table's folder.  A writer notes the number it starts from,
writes its data elsewhere, and publishes ``number + 1`` by a rename that fails if that commit is there already: of two
writers that started from the same generation one wins, the other gets ``Conflict`` and its data stay unreferenced.
Order is by number, never by a clock.  Any process that opens the folder sees the same current generation, so a reset
(an empty generation) holds for all.  (HDFS renames so atomically; a local disk, as in tests, checks first and then renames.)

Readers may go on with the generation they opened.  ``expire`` removes commits that were superseded longer ago than a
stated time, and the data folders that no remaining commit names.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published the generation that this one was to be."""


class Generations:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _listed(self, name: str) -> list:
        path = self._path(name)
        return list(self._fs.listStatus(path)) if self._fs.exists(path) else []

    # ------------------------------------------------------------------ readers
    def numbers(self) -> list[int]:
        names = (f.getPath().getName() for f in self._listed("_geracoes"))
        return sorted(int(n) for n in names if n.isdigit())

    def content(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"_geracoes/{number:012d}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """(number, content); (0, {}) before the first commit."""
        numbers = self.numbers()
        return (numbers[-1], self.content(numbers[-1])) if numbers else (0, {})

    # ------------------------------------------------------------------ writers
    def new_folder(self, label: str = "v") -> str:
        """The name of a data folder that no other writer uses."""
        return f"{label}={uuid.uuid4().hex[:16]}"

    def publish(self, base: int, content: dict) -> int:
        """Commit generation ``base + 1``, or raise Conflict if that is taken."""
        fs, number = self._jvm.org.apache.hadoop.fs, base + 1
        draft, final = self._path(f"_rascunhos/{uuid.uuid4().hex}"), self._path(f"_geracoes/{number:012d}")
        self._fs.mkdirs(final.getParent())
        stream = self._fs.create(draft)
        stream.write(json.dumps(content, sort_keys=True).encode())
        stream.close()
        try:
            options = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
            fs.FileContext.getFileContext(draft.getFileSystem(self._conf).getUri(), self._conf).rename(draft, final, options)
        except Exception as e:
            self._fs.delete(draft, False)
            if self._fs.exists(final):
                raise Conflict(f"generation {number} of {self.root} was published by another writer") from e
            raise
        return number

    def expire(self, keep_seconds: float, data: str, named, now: float | None = None) -> list[str]:
        """Remove commits superseded more than ``keep_seconds`` ago, then folders of ``data`` that no remaining commit
        names (``named(content)`` gives a commit's folders) and that are older than that too: a writer may be at work
        in a younger one.  Returns the folders removed."""
        limit = ((time.time() if now is None else now) - keep_seconds) * 1000
        numbers = self.numbers()
        made = {int(f.getPath().getName()): f.getModificationTime() for f in self._listed("_geracoes")
                if f.getPath().getName().isdigit()}
        for number, successor in zip(numbers, numbers[1:]):
            if made[successor] < limit:
                self._fs.delete(self._path(f"_geracoes/{number:012d}"), False)
        kept = {folder for number in self.numbers() for folder in named(self.content(number))}
        gone = [f.getPath().getName() for f in self._listed(data)
                if f.getPath().getName() not in kept and f.getModificationTime() < limit]
        for name in gone:
            self._fs.delete(self._path(f"{data}/{name}"), True)
        return gone
