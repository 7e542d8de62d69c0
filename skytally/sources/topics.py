"""Topics landed as files: a stream source with offsets, and the writer of such files.

A topic is a folder; a partition of it is ``partition=<number>``; a file holds the messages of one range of offsets,
``<first>-<last>.parquet`` (twenty digits each, both inclusive) with the columns value, offset and timestamp.

The source remembers one offset per partition.  A batch is a range of each partition, cut at files, so that
reading is spread over tasks; ``maxOffsetsPerTrigger`` bounds it.  Offsets that should be there and are not (files
removed before they were read, a hole between two files, a file with fewer messages than its name says, a
topic begun anew) stop the stream, unless ``failOnDataLoss`` is "false"; then what is left is read.

Files are reached through Arrow, by a local path or the URI of a file system that Arrow knows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from skytally.sources.feeds import topic_arrival

# Executors get the source itself, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "value binary, partition int, offset long, timestamp timestamp"
_FILE = re.compile(r"^([0-9]{20})-([0-9]{20})\.parquet$")


class OffsetsLost(Exception):
    """Messages that the stream was to read next are gone."""


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass(frozen=True)
class Held:
    """A file with messages from ``first`` up to, not including, ``end``."""

    path: str
    first: int
    end: int


def holdings(path: str) -> dict[int, list[Held]]:
    """The files of each partition by offset, from their names alone."""
    system, root = _system(path)
    found: dict[int, list[Held]] = {}
    for info in system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        folder, name = os.path.split(info.path)
        m, part = _FILE.match(name), os.path.basename(folder).removeprefix("partition=")
        if info.is_file and part.isdigit():
            files = found.setdefault(int(part), [])
            if m:
                files.append(Held(info.path, int(m[1]), int(m[2]) + 1))
    return {part: sorted(files, key=lambda h: h.first) for part, files in found.items() if files}


@dataclass
class Range(InputPartition):
    """What one task reads: offsets from ``start`` up to, not including, ``end`` out of one file."""

    path: str
    partition: int
    start: int
    end: int

    def __post_init__(self):
        super().__init__(None)


class LandedTopic(DataSource):
    """Options: ``path``, ``maxOffsetsPerTrigger`` (with ``checkpoint``, the query's), ``failOnDataLoss``."""

    @classmethod
    def name(cls) -> str:
        return "landed_topic"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LandedTopicReader(self.options)


class LandedTopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.limit = int(options["maxOffsetsPerTrigger"]) if options.get("maxOffsetsPerTrigger") else None
        self.checkpoint = options.get("checkpoint")
        self.strict = options.get("failOnDataLoss", "true").lower() != "false"
        if self.limit is not None and (self.limit < 1 or not self.checkpoint):
            raise ValueError("maxOffsetsPerTrigger needs a number above 0 and the option checkpoint, the query's folder")
        self._at: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {str(part): files[0].first for part, files in holdings(self.path).items()}

    def latestOffset(self) -> dict:
        """The ends of all partitions, or what the limit allows from where the query is, shared out by what is left."""
        ends = {str(part): files[-1].end for part, files in holdings(self.path).items()}
        at, first = self._position(), self.initialOffset()
        if at is None:
            # No log yet: a query that begins, where the partitions do.
            at = {} if self.limit is None else first
        for part, offset in at.items():
            if ends.get(part, -1) < offset:
                # Begun anew or gone: the batch that is planned with it says so.
                ends[part] = self._lost(f"partition {part} ends at {ends.get(part)}, read was up to {offset}", offset)
        if self.limit is None:
            return ends
        left = {p: end - at.get(p, first.get(p, end)) for p, end in ends.items()}
        total, share, taken = sum(left.values()), self.limit, {}
        for part in sorted(left, key=lambda p: (left[p], p)):
            # Each gets its part of what is left, a message at least as long as the limit allows.
            n = min(left[part], max(1, share * left[part] // total)) if left[part] and share else 0
            taken[part] = n
            share, total = share - n, total - left[part]
        return {p: ends[p] - left[p] + taken[p] for p in ends}

    def _position(self) -> dict[str, int] | None:
        """Where the next batch starts: as planned last, or out of the query's own log after a restart."""
        if self._at is None and self.checkpoint:
            system, root = _system(self.checkpoint)
            infos = system.get_file_info(pafs.FileSelector(f"{root}/offsets", allow_not_found=True))
            batches = [int(i.base_name) for i in infos if i.base_name.isdigit()]
            if batches:
                with system.open_input_stream(f"{root}/offsets/{max(batches)}") as log:
                    last = log.read().decode().strip().splitlines()[-1]
                self._at = {p: int(o) for p, o in json.loads(last).items()} if last.startswith("{") else None
        return self._at

    def _lost(self, what: str, instead: int) -> int:
        if self.strict:
            raise OffsetsLost(f"{what}; set failOnDataLoss to false to go on with what is left")
        return instead

    def partitions(self, start: dict, end: dict) -> list[Range]:
        found, ranges = holdings(self.path), []
        for part, stop in end.items():
            files = found.get(int(part), [])
            at = int(start.get(part, files[0].first if files else stop))
            if stop < at:
                raise OffsetsLost(f"partition {part} was read up to {at}, not only to {stop}")
            for file in files:
                if file.end <= at or file.first >= stop:
                    continue
                if file.first > at:
                    self._lost(f"partition {part} has no offsets {at} to {file.first - 1}", at)
                low, at = max(at, file.first), min(stop, file.end)
                ranges.append(Range(file.path, int(part), low, at))
            if at < stop:
                self._lost(f"partition {part} has no offsets {at} to {stop - 1}", at)
        self._at = {p: int(o) for p, o in end.items()}
        return ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system, _ = _system(self.path)
        seen = partition.start
        with pq.ParquetFile(system.open_input_file(partition.path)) as file:
            for batch in file.iter_batches(1024, columns=["value", "offset", "timestamp"]):
                offset = batch.column("offset")
                batch = batch.filter(pc.and_(pc.greater_equal(offset, partition.start), pc.less(offset, partition.end)))
                if not batch.num_rows:
                    continue
                offsets = batch.column("offset").to_numpy()
                # Offsets of a file rise by one; a hole is a loss like a missing file.
                if self.strict and (offsets[0] != seen or offsets[-1] - offsets[0] != len(offsets) - 1):
                    raise OffsetsLost(f"{partition.path} lacks offsets from {seen} on")
                seen = int(offsets[-1]) + 1
                columns = [
                    batch.column("value").cast(pa.binary()),
                    pa.array([partition.partition] * batch.num_rows, pa.int32()),
                    batch.column("offset"),
                    batch.column("timestamp").cast(pa.timestamp("us", "UTC")),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["value", "partition", "offset", "timestamp"])
        if self.strict and seen != partition.end:
            raise OffsetsLost(f"{partition.path} lacks offsets from {seen} on")


def topic_messages(spark: SparkSession, path: str, **options) -> DataFrame:
    """A landed topic from its first offset, as (value, arrival): the counterpart of ``kafka_messages``."""
    spark.dataSource.register(LandedTopic)
    return topic_arrival(spark.readStream.format("landed_topic").options(**options).option("path", path).load())


def land_topic(messages: DataFrame, path: str, per_file: int = 100_000) -> None:
    """Write (value, partition, offset, timestamp) as a landed topic.

    Offsets that share a multiple of ``per_file`` go to one file; they have no holes.  A file has its name once it is
    complete, and a repeated task writes the same files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(path)

        def close(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows)
            part, offsets = table.column("partition")[0].as_py(), table.column("offset")
            first, last = offsets[0].as_py(), offsets[-1].as_py()
            if last - first != len(offsets) - 1:
                raise ValueError(f"partition {part} has holes or repeated offsets between {first} and {last}")
            folder = f"{root}/partition={part}"
            system.create_dir(folder, recursive=True)
            name, unfinished = f"{folder}/{first:020d}-{last:020d}.parquet", f"{folder}/{uuid.uuid4().hex}.unfinished"
            with system.open_output_stream(unfinished) as out:
                pq.write_table(table.select(["value", "offset", "timestamp"]), out)
            system.move(unfinished, name)
            return pa.RecordBatch.from_pydict({"file": [name]})

        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            keys = list(zip(batch.column("partition").to_pylist(), batch.column("file").to_pylist()))
            at = 0
            while at < len(keys):
                end = at
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if held and keys[at] != key:
                    yield close(held)
                    held = []
                key = keys[at]
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield close(held)

    rows = messages.select("value", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"), "timestamp")
    rows = rows.withColumn("file", F.floor(F.col("offset") / per_file))
    rows = rows.repartition("partition", "file").sortWithinPartitions("partition", "offset")
    rows.mapInArrow(write, "file string").write.format("noop").mode("append").save()
