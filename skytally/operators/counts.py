"""Counts per group of a table's current rows, kept up to date by what has changed.

Stored counts belong to one list of the table.  To bring them to the newest list, the keys of the batches that
came in between are looked up in both: each old row leaves its group, each new one enters its own, and these
signed counts are added to the stored ones.  A compaction changes no row, and so no count.  The whole table is
counted only at first, or where the old list is retired.

A refresh that breaks off leaves the old counts; one that is repeated begins from them again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.operators.tables import KeyedTable
from skytally.session import shared_dir
from skytally.sources import files


class MaintainedCounts:
    def __init__(self, table: KeyedTable, by: list[str], name: str = "n"):
        """``by``: the table's columns that name a group; ``name``: the column of its count."""
        self.table, self.by, self.name = table, by, name
        self.path = f"{table.path}_counts/{'-'.join(by)}"

    def _stored(self) -> dict | None:
        found = [n for n in files.names(self.table.spark, f"{self.path}/list") if n.startswith("version=") and not n.endswith(".tmp")]
        if not found:
            return None
        newest = max(found, key=lambda n: int(n.split("=")[1]))
        return json.loads(files.read(self.table.spark, f"{self.path}/list/{newest}")) | {"version": int(newest.split("=")[1])}

    def _counts(self, rows: DataFrame, sign: int) -> DataFrame:
        return rows.groupBy(*self.by).agg((F.count("*") * sign).alias(self.name))

    def read(self, stored: dict) -> DataFrame:
        return self.table.spark.read.parquet(f"{self.path}/{stored['folder']}")

    def refresh(self) -> DataFrame:
        """The counts of the table's newest list, by the columns ``by``."""
        spark, table, stored, version = self.table.spark, self.table, self._stored(), self.table.version()
        if stored and stored["of"] == version:
            return self.read(stored)
        changed = table.changed_keys(stored["of"]) if stored else None
        if changed is None:
            counts = self._counts(table.read_version(version), 1)
        else:
            path = shared_dir(spark, "changed-keys")
            changed.write.parquet(path)
            changed = spark.read.parquet(path)
            gone = self._counts(table.lookup(changed, stored["of"]), -1)
            come = self._counts(table.lookup(changed, version), 1)
            both = self.read(stored).unionByName(gone).unionByName(come)
            counts = both.groupBy(*self.by).agg(F.sum(self.name).alias(self.name)).filter(F.col(self.name) != 0)
        folder = f"counts/of={version}/attempt=a{uuid.uuid4().hex}"
        counts.write.parquet(f"{self.path}/{folder}")
        number = stored["version"] + 1 if stored else 1
        files.write(spark, f"{self.path}/list/version={number}", json.dumps({"of": version, "folder": folder}))
        return self.read({"folder": folder})
