"""What a table's loads must remember between batches: the last id given out, and the load under way.

A load of the fact is several writes (plays, their keys, the list of touched
days).  Before the first of them the journal names the batch, its block of ids
and its days; after the last one it is closed.  A load that finds an open entry
knows which days to look at and which ids to look for, so it can finish or
undo what a crash left, without reading the table.

States are numbered files, each written under another name and renamed.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from .versions import Files


class Journal:
    """``state()``: high_water (last id given out) and open (None, or batch, first, last, days)."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)

    def _names(self) -> list[str]:
        return [n for n in self.files.names(self.root) if n.endswith(".json") and not n.startswith(".")]

    def state(self) -> dict:
        names = self._names()
        return json.loads(self.files.read(f"{self.root}/{names[-1]}")) if names else {"high_water": 0, "open": None}

    def put(self, high_water: int, opened: dict | None = None) -> None:
        names = self._names()
        number = int(names[-1].split(".")[0]) + 1 if names else 1
        self.files.make(self.root)
        self.files.write(f"{self.root}/{number:012d}.json", json.dumps({"high_water": high_water, "open": opened}))
        for old in names[:-1]:
            self.files.delete(f"{self.root}/{old}")
