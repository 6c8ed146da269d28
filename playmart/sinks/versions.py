"""Tables whose parts are replaced without a moment in which a reader finds none.

A table is a folder.  Every write goes to a fresh sub-folder; then one small
pointer file names, for every part of the table, the folder that holds it now.
Pointers are numbered and written under another name first, so a reader sees
a whole one or the one before: on any file system, since only a rename to a name
that doesn't exist is needed.  Several parts (all reports of one refresh, all
days of one load) switch together.  Folders that no recent pointer names are
removed by ``vacuum``.  One writer per table is part of the contract.

The pointer holds one short entry per part (report or day), never per row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


class Files:
    """The few file operations that are not reads or writes of tables, on the path's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self.at(self.root).getFileSystem(self._conf)

    def at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def make(self, path: str) -> None:
        self._fs.mkdirs(self.at(path))

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.at(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.at(path)))

    def modified(self, path: str) -> list[tuple[str, int]]:
        """(path, modification time in milliseconds) of the files below a folder."""
        found, out = self._fs.listFiles(self.at(path), True), []
        while found.hasNext():
            s = found.next()
            out.append((s.getPath().toString(), s.getModificationTime()))
        return out

    def stamp(self, path: str, millis: int) -> None:
        """Set a file's modification time."""
        self._fs.setTimes(self.at(path), millis, -1)

    def read(self, path: str) -> str:
        stream = self._fs.open(self.at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Whole or not at all; ``path`` must be new."""
        folder, name = path.rsplit("/", 1)
        hidden = f"{folder}/.{name}-{uuid.uuid4().hex[:8]}"
        stream = self._fs.create(self.at(hidden), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._fs.rename(self.at(hidden), self.at(path)):
            self._fs.delete(self.at(hidden), False)
            raise FileExistsError(path)

    def move(self, path: str, to: str) -> None:
        if not self._fs.rename(self.at(path), self.at(to)):
            raise OSError(f"{path} could not be renamed to {to}")

    def delete(self, path: str) -> None:
        self._fs.delete(self.at(path), True)


class VersionedTable:
    """Parts of a table by name, each read from the folder that the newest pointer gives."""

    POINTERS = "_pointers"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)

    def _pointers(self) -> list[str]:
        return [n for n in self.files.names(f"{self.root}/{self.POINTERS}") if n.endswith(".json") and not n.startswith(".")]

    def current(self) -> dict[str, str]:
        """part -> folder below the root; empty before the first publication."""
        names = self._pointers()
        return json.loads(self.files.read(f"{self.root}/{self.POINTERS}/{names[-1]}")) if names else {}

    def folder(self) -> str:
        """The name of a fresh folder to write a version to."""
        return f"v-{uuid.uuid4().hex[:12]}"

    def publish(self, parts: dict[str, str]) -> None:
        """Let the given parts point to new folders (relative to the root), all at once; others stay."""
        names = self._pointers()
        number = int(names[-1].split(".")[0]) + 1 if names else 1
        self.files.make(f"{self.root}/{self.POINTERS}")
        self.files.write(f"{self.root}/{self.POINTERS}/{number:012d}.json", json.dumps(self.current() | parts, sort_keys=True))

    def replace(self, frames: dict[str, DataFrame]) -> None:
        """Write each frame as the new version of its part and switch to all of them together."""
        folder = self.folder()
        for part, df in frames.items():
            df.write.parquet(f"{self.root}/{folder}/{part}")
        self.publish({part: f"{folder}/{part}" for part in frames})

    def paths(self, parts: Iterable[str] | None = None) -> list[str]:
        now = self.current()
        return [f"{self.root}/{now[p]}" for p in (sorted(now) if parts is None else parts) if p in now]

    def read(self, part: str) -> DataFrame | None:
        found = self.paths([part])
        return self.spark.read.parquet(found[0]) if found else None

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the last ``keep`` pointers names; returns them."""
        names = self._pointers()
        for old in names[:-keep]:
            self.files.delete(f"{self.root}/{self.POINTERS}/{old}")
        used = set()
        for name in names[-keep:]:
            used |= set(json.loads(self.files.read(f"{self.root}/{self.POINTERS}/{name}")).values())
        gone = []
        for version in self.files.names(self.root):
            if not version.startswith("v-"):
                continue
            held = {u.split("/", 1)[1] for u in used if u.startswith(f"{version}/")}
            whole = f"{self.root}/{version}"
            lost = [whole] if not held else [f"{whole}/{n}" for n in self.files.names(whole)
                                             if n not in held and not n.startswith("_")]
            for path in lost:
                self.files.delete(path)
            gone += lost
        return gone
