"""The two kinds of stored table, both plain Parquet folders.

``KeyedTable`` holds the current row of each key.  An upsert only writes its own rows, collapsed to
one per key, to a folder of its own.  Readers overlay these deltas on the base.  ``compact`` folds them
into it: it rewrites the segments (for flights: days) that hold a changed key.  Beside each segment lies a
summary of its keys (``keysets``): compaction and ``lookup`` open only segments that may hold a wanted key.

``SnapshotTable`` holds the result rows of every run, one folder per batch.

No folder is written twice: each attempt has a name of its own, and what is live is said by a small
list, rewritten as a whole by every commit.  So a write that breaks off, or is repeated, leaves nothing
that a reader could see; ``retire`` removes what no recent list names.  Each table has one writer at a
time; readers need no lock.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, replace
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from skytally.operators import keysets
from skytally.operators.conform import conform, storage_schema
from skytally.operators.keyed import latest_per_key
from skytally.schemas import KeyedSpec, SnapshotSpec
from skytally.session import shared_dir
from skytally.sources import files


#: Folders that one task writes, where a table has many segments.
FOLDERS_PER_TASK = 64


class Entry(NamedTuple):
    """One line of a table's list.

    ``base``: the folder of a segment.  ``keys``: that of its key summary, of ``number`` buckets.  ``delta``: the folder of
    a writer's batch, by arrival.  ``folded``: batches ``first`` to ``number`` of a writer are in the base.  ``batch``: the
    folder of a run, with its time in seconds as ``first``.  ``view``: a view that follows the table.
    """

    kind: str
    name: str
    segment: int | None = None
    seq: int | None = None
    writer: str | None = None
    number: int | None = None
    first: int | None = None


@dataclass(frozen=True)
class _List:
    version: int
    entries: tuple[Entry, ...]

    def of(self, kind: str) -> list[Entry]:
        return [e for e in self.entries if e.kind == kind]

    def without(self, drop) -> _List:
        return replace(self, entries=tuple(e for e in self.entries if not drop(e)))

    def plus(self, *entries: Entry) -> _List:
        return replace(self, entries=self.entries + entries)


class _Stored:
    """A table's path and its list of live folders."""

    def __init__(self, spark: SparkSession, root: str, spec: KeyedSpec | SnapshotSpec):
        self.spark = spark
        self.spec = spec
        self.path = f"{root.rstrip('/')}/{spec.database}/{spec.name}"

    def _versions(self) -> list[int]:
        found = files.names(self.spark, f"{self.path}/list")
        return [int(n.split("=")[1]) for n in found if n.startswith("version=") and not n.endswith(".tmp")]

    def _load(self, version: int) -> _List:
        lines = files.read(self.spark, f"{self.path}/list/version={version}").splitlines()
        return _List(version, tuple(Entry(*json.loads(line)) for line in lines))

    def _state(self) -> _List:
        """The newest list: one small file, however often the table has changed."""
        versions = self._versions()
        return self._load(max(versions)) if versions else _List(0, ())

    def _commit(self, state: _List) -> None:
        """Make the state the newest; fails if another writer has committed since it was read."""
        text = "\n".join(json.dumps(e) for e in state.entries)
        files.write(self.spark, f"{self.path}/list/version={state.version + 1}", text)
        self._follow(replace(state, version=state.version + 1))

    def publish(self, view: str) -> None:
        """Create a view of the table in this session's catalog.

        Each later commit, read and ``retire`` brings the views of its own session's catalog up to date if they lag,
        whoever wrote the table and whatever was lost on the way; until then a view shows an older list.
        """
        state = self._state()
        if view not in [e.name for e in state.of("view")]:
            self._commit(state.plus(Entry("view", view)))
        else:
            self._follow(state)

    def _follow(self, state: _List) -> None:
        """Rewrite the views that were made from another list than this one; a view's comment names its list."""
        for view in state.of("view"):
            if self.spark.catalog.databaseExists(view.name.split(".")[0]):
                made = f"list {state.version} of {self.path}"
                known = self.spark.catalog.tableExists(view.name)
                if not known or self.spark.catalog.getTable(view.name).description != made:
                    self.spark.sql(f"CREATE OR REPLACE VIEW {view.name} COMMENT '{made}' AS {self.definition(state)}")

    def retire(self, keep: int = 10) -> list[str]:
        """Delete the folders that none of the newest ``keep`` lists names, and older lists.

        Readers that began before these lists must have ended.  Returns what was deleted.
        """
        self._follow(self._state())
        kept = sorted(self._versions(), reverse=True)[:keep]
        live = {e.name for v in kept for e in self._load(v).entries}
        gone = [f for f in self._folders() if f not in live] if kept else []
        gone += [f"list/version={v}" for v in self._versions() if kept and v < kept[-1]]
        for folder in gone:
            files.delete(self.spark, f"{self.path}/{folder}")
            if folder.startswith("base/"):
                # A segment's key summary goes with it.
                files.delete(self.spark, f"{self.path}/keys/{folder.removeprefix('base/')}")
        return gone

    def _folders(self) -> list[str]:
        """All attempts' folders, as lists name them."""
        found = []
        for top in ("base", "deltas", "batches"):
            for middle in files.names(self.spark, f"{self.path}/{top}"):
                found += [
                    f"{top}/{middle}/{n}"
                    for n in files.names(self.spark, f"{self.path}/{top}/{middle}")
                    if n.startswith("attempt=")
                ]
        return found

    def _read(self, top: str, folders: list[str], schema: StructType) -> DataFrame | None:
        """Rows of the named folders, and of no others."""
        if not folders:
            return None
        paths = [f"{self.path}/{f}" for f in folders]
        # Folders are listed by a few tasks, each many: a task of its own for each costs more than the listing.
        key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, str(min(int(before), 4 * self.spark.sparkContext.defaultParallelism)))
        try:
            return self.spark.read.schema(schema).option("basePath", f"{self.path}/{top}").parquet(*paths)
        finally:
            self.spark.conf.set(key, before)


def _attempt() -> str:
    # The letter keeps Spark from taking the name for a number.
    return f"attempt=a{uuid.uuid4().hex}"


def _no_rows(schema: StructType) -> str:
    """SQL text of an empty relation."""
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    return f"(SELECT {columns} WHERE false)"


class KeyedTable(_Stored):
    def __init__(self, spark: SparkSession, root: str, spec: KeyedSpec, order_by: tuple[str, ...] = ()):
        """By default the last arrival wins; with ``order_by`` (e.g. ``("time",)``) the greatest value does."""
        super().__init__(spark, root, spec)
        self.order_by = list(order_by)

    def upsert(self, rows: DataFrame, batch_id: int | None = None, arrival: str | None = None, writer: str = "") -> None:
        """Insert the rows, replacing those with the same key; ``arrival`` orders rows of one batch.

        A batch is known by its writer and number: running it again replaces it in its old place, or changes
        nothing once it is folded into the base.  Other writers' numbers don't matter; batches
        count in the order in which they first came, so a number that comes late, after greater ones, counts as the
        newest.  Without a number it is a new batch.
        Without ``arrival`` or ``order_by`` a key that a batch holds twice fails it.
        """
        state = self._state()
        own = [e for e in state.of("delta") if e.writer == writer]
        folded = [_range(e) for e in state.of("folded") if e.writer == writer]
        if batch_id is None:
            batch_id = max([-1, *(last for _, last in folded), *(e.number for e in own)]) + 1
        if any(first <= batch_id <= last for first, last in folded):
            return
        before = [e for e in own if e.number == batch_id]
        seq = before[0].seq if before else max([0, *(e.seq for e in state.entries if e.seq is not None)]) + 1
        columns = self.spec.schema.fieldNames()
        order = [*self.order_by, *([arrival] if arrival else [])]
        batch = rows.select(*columns, *[c for c in order if c not in columns])
        if order:
            # Ties in the order are settled by the columns, the same way every time.
            rest = [c for c in columns if c not in (*order, self.spec.key)]
            latest = latest_per_key(batch, self.spec.key, [*order, *rest])
        else:
            latest = _single(batch, self.spec.key)
        name = f"deltas/seq={seq}/{_attempt()}"
        conform(latest, self.spec.schema).write.parquet(f"{self.path}/{name}")
        folder = Entry("delta", name, seq=seq, writer=writer, number=batch_id)
        # The greatest place so far outlives the batches that held it.
        top = Entry("top", "", seq=max([seq, *(e.seq for e in state.of("top"))]))
        self._commit(state.without(lambda e: e in before or e.kind == "top").plus(folder, top))

    def read(self, since: int | None = None) -> DataFrame:
        """The current row of each key.

        ``since`` skips the folders of all lower segments, for callers whose filter drops those
        rows anyway.  Where another column than the segment's decides which row is current, an old segment
        can hold it, and nothing is skipped.
        """
        state = self._state()
        self._follow(state)
        if self.order_by and self.order_by[0] != self.spec.segment_column:
            since = None
        base = self._base([e for e in state.of("base") if since is None or e.segment >= since])
        return self._overlay(base, self._deltas(state))

    def exists(self) -> bool:
        """Whether anything was ever committed."""
        return bool(self._versions())

    def pending(self) -> int:
        """Number of batches that are not in the base yet."""
        return len(self._state().of("delta"))

    def version(self) -> int:
        """The number of the newest list."""
        return self._state().version

    def read_version(self, version: int) -> DataFrame:
        """The rows that were current by an older list, while it is kept."""
        state = self._load(version) if version else _List(0, ())
        return self._overlay(self._base(state.of("base")), self._deltas(state))

    def changed_keys(self, since: int) -> DataFrame | None:
        """The distinct keys whose rows may have changed since a list; None if it is not kept any more.

        They are those of the batches that came since then, and of those that were replaced.
        """
        if since not in (versions := sorted(self._versions())):
            return None
        lists = [self._load(v) for v in versions if v >= since]
        known = {e.name: e for e in lists[0].of("delta")}
        folders: dict[str, Entry] = {}
        for before, after in zip(lists, lists[1:]):
            now = {e.name: e for e in after.of("delta")}
            folders |= {n: e for n, e in now.items() if n not in known}
            for e in before.of("delta"):
                ranges = [_range(f) for f in after.of("folded") if f.writer == e.writer]
                if e.name not in now and not any(a <= e.number <= b for a, b in ranges):
                    folders[e.name] = e
        rows = self._deltas(_List(0, tuple(folders.values())))
        if rows is None:
            return self.spark.sql(f"SELECT `{self.spec.key}` FROM {_no_rows(storage_schema(self.spec.schema))}")
        return rows.select(self.spec.key).distinct()

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The current rows of the given keys (a frame with the key column); only segments that may hold one are opened.

        ``version`` asks an older list, while it is kept.
        """
        state = self._state() if version is None else self._load(version)
        key = self.spec.key
        wanted = keys.select(key).filter(F.col(key).isNotNull()).distinct()
        base, deltas = self._base(self._may_hold(state, wanted)), self._deltas(state)
        parts = [part.join(wanted, key, "left_semi") if part is not None else None for part in (base, deltas)]
        return self._overlay(*parts)

    def _may_hold(self, state: _List, keys: DataFrame) -> list[Entry]:
        """Base entries of the segments that may hold one of the keys, by their summaries alone."""
        summaries = state.of("keys")
        known = {e.segment for e in summaries}
        held = set()
        if summaries:
            schema = StructType([*keysets.SCHEMA.fields]).add("segment", LongType()).add("attempt", StringType())
            rows = self._read("keys", [e.name for e in summaries], schema)
            found = keysets.may_hold(rows, "segment", keys, self.spec.key, [e.number for e in summaries])
            # One number per segment at most.
            held = {row["segment"] for row in found.collect()}
        # A segment of an older table may have no summary yet.
        return [e for e in state.of("base") if e.segment in held or e.segment not in known]

    def definition(self, state: _List | None = None) -> str:
        """SQL text of the current rows as they are now."""
        state = state or self._state()

        def part(top: str, kind: str) -> str | None:
            attempts = ", ".join(f"'{e.name.rsplit('=', 1)[1]}'" for e in state.of(kind))
            return f"(SELECT * FROM parquet.`{self.path}/{top}` WHERE attempt IN ({attempts}))" if attempts else None

        return self._current(part("base", "base"), part("deltas", "delta"))

    def compact(self) -> None:
        """Fold all batches so far into the base."""
        state = self._state()
        deltas = self._deltas(state)
        if deltas is None:
            return
        old = state.of("base")
        segments = deltas.selectExpr(f"bigint({self.spec.segment}) AS segment")
        if old:
            # The summaries tell which segments to look at, their key columns which ones to rewrite.
            changed = deltas.select(self.spec.key).distinct()
            suspects = self._base(self._may_hold(state, changed))
            if suspects is not None:
                segments = segments.union(suspects.join(changed, self.spec.key, "left_semi").select("segment"))
        # One number per segment that holds a changed key, before or now.
        touched = {row["segment"] for row in segments.distinct().collect()}
        rows = self._overlay(self._base([e for e in old if e.segment in touched]), deltas)
        attempt, order = _attempt(), ["segment", *self.spec.cluster_by]
        rows = rows.selectExpr("*", f"bigint({self.spec.segment}) AS segment")
        (
            rows.withColumn("attempt", F.lit(attempt.split("=")[1]))
            .repartitionByRange(*self._tasks(len(touched)), *order)
            .sortWithinPartitions(*order)
            .write.mode("append")
            .partitionBy("segment", "attempt")
            .parquet(f"{self.path}/base")
        )
        # Readers move over with the list; a touched segment without rows is in it no more.
        found = files.parents(self.spark, f"{self.path}/base", attempt)
        written = [Entry("base", f"base/segment={s}/{attempt}", segment=s) for s in sorted(touched) if f"segment={s}" in found]
        written += self._summarised(written, attempt)
        folded: dict[str, list[tuple[int, int]]] = {}
        for e in state.of("folded"):
            folded.setdefault(e.writer, []).append(_range(e))
        for e in state.of("delta"):
            folded.setdefault(e.writer, []).append((e.number, e.number))
        ranges = [Entry("folded", "", writer=w, number=b, first=a) for w, found in folded.items() for a, b in _merged(found)]
        gone = lambda e: e.kind in ("delta", "folded") or e.kind in ("base", "keys") and e.segment in touched
        self._commit(state.without(gone).plus(*written, *ranges))

    def _tasks(self, segments: int) -> list[int]:
        """The number of tasks that write so many segments, if it is they that count: each is a folder and takes its time,
        however few its bytes.  Of few segments the bytes count, and Spark finds the number by them."""
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return [max(least, math.ceil(segments / FOLDERS_PER_TASK))] if segments >= least else []

    def _summarised(self, written: list[Entry], attempt: str) -> list[Entry]:
        """Write the key summaries of the segments just written."""
        rows = self._base(written)
        if rows is None:
            return []
        summary = keysets.summarise(rows, "segment", self.spec.key).withColumn("attempt", F.lit(attempt.split("=")[1]))
        # A large segment's summary is dealt over tasks too.
        dealt = summary.repartition(*self._tasks(len(written)), "segment", F.floor(F.col("bucket") / 1024))
        dealt.write.mode("append").partitionBy("segment", "attempt").parquet(f"{self.path}/keys")
        schema = StructType([*keysets.SCHEMA.fields]).add("segment", LongType()).add("attempt", StringType())
        folders = [f"keys/segment={e.segment}/{attempt}" for e in written]
        sizes = self._read("keys", folders, schema).groupBy("segment").agg(F.max("buckets").alias("buckets"))
        return [Entry("keys", f"keys/segment={r['segment']}/{attempt}", segment=r["segment"], number=r["buckets"]) for r in sizes.collect()]

    def _overlay(self, base: DataFrame | None, deltas: DataFrame | None) -> DataFrame:
        text = self._current("{base}" if base is not None else None, "{deltas}" if deltas is not None else None)
        frames = {"base": base, "deltas": deltas}
        return self.spark.sql(text, **{name: df for name, df in frames.items() if df is not None})

    def _current(self, base: str | None, deltas: str | None) -> str:
        """SQL text that overlays the live deltas on the live base, given the names of both."""
        key = f"`{self.spec.key}`"
        columns = ", ".join(f"`{c}`" for c in self.spec.schema.fieldNames())
        kept = f"(SELECT {columns} FROM {base})" if base else None
        if deltas is None:
            return f"SELECT {columns} FROM {kept or _no_rows(storage_schema(self.spec.schema))}"
        changed = f"(SELECT DISTINCT {key} FROM {deltas}) AS changed ON changed.{key} = kept.{key}"
        candidates = f"SELECT {columns}, bigint(seq) AS _seq FROM {deltas}"
        if kept and self.order_by:
            candidates += f" UNION ALL SELECT *, -1L FROM {kept} AS kept LEFT SEMI JOIN {changed}"
        order = ", ".join(f"`{c}` DESC NULLS LAST" for c in [*self.order_by, "_seq"])
        newest = (
            f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _n "
            f"FROM ({candidates})) WHERE _n = 1"
        )
        return f"SELECT * FROM {kept} AS kept LEFT ANTI JOIN {changed} UNION ALL {newest}" if kept else newest

    def _base(self, entries: list[Entry]) -> DataFrame | None:
        schema = storage_schema(self.spec.schema).add("segment", LongType()).add("attempt", StringType())
        return self._read("base", [e.name for e in entries], schema)

    def _deltas(self, state: _List) -> DataFrame | None:
        schema = storage_schema(self.spec.schema).add("seq", LongType()).add("attempt", StringType())
        return self._read("deltas", [e.name for e in state.of("delta")], schema)


def _range(entry: Entry) -> tuple[int, int]:
    """The batches that a folded entry stands for; older lists held the last one alone."""
    return (entry.first if entry.first is not None else 0, entry.number)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _single(batch: DataFrame, key: str) -> DataFrame:
    """The batch, which fails when it is computed if a key stands in it twice."""
    n = F.count("*").over(Window.partitionBy(key))
    wrong = F.raise_error(F.concat(F.lit("rows of one batch need an arrival column: repeated key "), F.col(key).cast("string")))
    return batch.withColumn("_n", n).filter(F.when(F.col(key).isNotNull() & (F.col("_n") > 1), wrong.cast("boolean")).otherwise(True)).drop("_n")


class SnapshotTable(_Stored):
    def append(self, result: DataFrame, batch_id: int, created_at: datetime) -> None:
        """Store a run's rows, stamped with its time; running the same batch again replaces it.

        Readers see the old rows until the new ones are complete.  ``id`` counts the batch's rows from 1 in the
        result's order.
        """
        first_pass = shared_dir(self.spark, "numbered")
        rows = numbered(conform(result, self.spec.result), "id", first_pass)
        rows = rows.withColumn("created_at", F.lit(created_at))
        name = f"batches/batch_id={batch_id}/{_attempt()}"
        rows.write.parquet(f"{self.path}/{name}")
        files.delete(self.spark, first_pass)
        state = self._state().without(lambda e: e.kind == "batch" and e.number == batch_id)
        self._commit(state.plus(Entry("batch", name, number=batch_id, first=math.floor(created_at.timestamp()))))

    def read(self, batch_ids: list[int] | None = None, since: int | None = None) -> DataFrame:
        """Rows of all runs, or of those named, with ``batch_id``; other folders are not opened.

        ``since`` leaves out the runs whose time lies before that second.
        """
        state = self._state()
        self._follow(state)
        live = [e for e in state.of("batch") if batch_ids is None or e.number in batch_ids]
        # A batch of an older list has no time there.
        live = [e.name for e in live if since is None or e.first is None or e.first >= since]
        rows = self._read("batches", live, self._schema().add("attempt", StringType()))
        return rows.drop("attempt") if rows is not None else self.spark.sql(f"SELECT * FROM {_no_rows(self._schema())}")

    def batch(self, batch_id: int) -> DataFrame:
        return self.read([batch_id])

    def definition(self, state: _List | None = None) -> str:
        columns = ", ".join(f"`{c}`" for c in self._schema().fieldNames())
        attempts = ", ".join(f"'{e.name.rsplit('=', 1)[1]}'" for e in (state or self._state()).of("batch"))
        if not attempts:
            return f"SELECT {columns} FROM {_no_rows(self._schema())}"
        return f"SELECT {columns} FROM parquet.`{self.path}/batches` WHERE attempt IN ({attempts})"

    def _schema(self) -> StructType:
        return storage_schema(self.spec.schema).add("batch_id", LongType())


def numbered(rows: DataFrame, name: str, path: str) -> DataFrame:
    """``rows`` with a first column that counts them from 1 in their order.

    Rows are written once, to ``path``, with their partition and place.  The partitions' sizes, a row each, give where
    each partition's numbers begin; no task sees all rows.
    """
    spark = rows.sparkSession
    # The upper bits are the partition, the lower 33 the place in it.
    rows.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.schema(rows.schema.add("_at", LongType())).parquet(path)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = stored.withColumn("_part", part).join(begins, "_part")
    return joined.select((F.col("_before") + place + 1).alias(name), *rows.columns)
