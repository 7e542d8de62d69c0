from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pytest
from conftest import AS_OF, flight, frame, rows
from pyspark.sql import functions as F

from skytally import schemas
from skytally.plans import jobs
from skytally.operators.tables import KeyedTable, SnapshotTable
from skytally.plans.pipeline import Warehouse, run_all

NOW = datetime(2024, 5, 1, tzinfo=timezone.utc)


def messages(spark, entries):
    """(id, time) observations in arrival order."""
    records = [flight(key, "AA", "AAA", "P1", "P2", 0, time, f"model {i}") for i, (key, time) in enumerate(entries)]
    df = frame(spark, schemas.FLIGHT.schema, *records)
    return df.withColumn("arrival", F.split_part("aircraft_model", F.lit(" "), F.lit(2)).cast("int"))


ENTRIES = [("a", 5), ("b", 1), ("a", 3), ("c", 7), ("b", 2), ("a", 4), ("d", 1), ("c", 6)]
LAST = [("a", 4), ("b", 2), ("c", 6), ("d", 1)]
GREATEST = [("a", 5), ("b", 2), ("c", 7), ("d", 1)]


def state(table):
    return rows(table.read().select("id", "time"))


@pytest.mark.parametrize("seed", range(3))
def test_any_split_into_batches_gives_the_same_table(spark, tmp_path, seed):
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(1, len(ENTRIES)), 2))
    stream = messages(spark, ENTRIES)
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    by_time = KeyedTable(spark, str(tmp_path / "t"), schemas.FLIGHT, order_by=("time",))
    for n, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(ENTRIES)])):
        batch = stream.filter((F.col("arrival") >= low) & (F.col("arrival") < high))
        for t in (table, by_time):
            t.upsert(batch, n, arrival="arrival")
            if rng.random() < 0.5:
                t.compact()
    assert state(table) == LAST
    assert state(by_time) == GREATEST


def test_running_a_batch_again_changes_nothing(spark, tmp_path):
    stream = messages(spark, ENTRIES)
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    assert state(table) == []
    table.upsert(stream, 0, "arrival")
    table.upsert(stream, 0, "arrival")
    assert state(table) == LAST
    table.compact()
    table.upsert(messages(spark, [("a", 99)]), 1, "arrival")
    table.upsert(stream, 0, "arrival")
    assert state(table) == [("a", 99), *LAST[1:]]
    table.compact()
    table.compact()
    assert state(table) == [("a", 99), *LAST[1:]]


class Interrupted(KeyedTable):
    """Writes, but never gets to say so."""

    def _commit(self, state):
        raise RuntimeError("lost")


def test_interrupted_compaction_is_invisible(spark, tmp_path):
    table, broken = (kind(spark, str(tmp_path), schemas.FLIGHT) for kind in (KeyedTable, Interrupted))
    table.upsert(messages(spark, ENTRIES), 0, "arrival")
    table.compact()
    table.upsert(messages(spark, [("a", 9), ("e", 86401)]), 1, "arrival")
    with pytest.raises(RuntimeError):
        broken.compact()
    expected = [("a", 9), ("b", 2), ("c", 6), ("d", 1), ("e", 86401)]
    assert state(table) == expected
    table.compact()
    assert state(table) == expected


def test_key_that_moves_after_an_interrupted_compaction_is_held_once(spark, tmp_path):
    table, broken = (kind(spark, str(tmp_path), schemas.FLIGHT) for kind in (KeyedTable, Interrupted))
    table.upsert(messages(spark, [("a", 2)]), 0, "arrival")
    with pytest.raises(RuntimeError):
        broken.compact()
    table.compact()
    with pytest.raises(RuntimeError):
        table.upsert(messages(spark, [("a", 3)]), 1, "arrival")
        broken.compact()
    # Its first segment has no rows any more, and the folder left there stays dead.
    table.upsert(messages(spark, [("a", 5 * 86400)]), 2, "arrival")
    table.compact()
    assert state(table) == [("a", 5 * 86400)]
    assert state(KeyedTable(spark, str(tmp_path), schemas.FLIGHT)) == [("a", 5 * 86400)]
    assert [e.segment for e in table._state().of("base")] == [5]


def test_batches_of_two_writers_with_one_number_both_count(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    table.upsert(messages(spark, [("k0", 1)]), 0, "arrival", writer="one")
    table.upsert(messages(spark, [("k1", 1), ("k0", 2)]), 0, "arrival", writer="two")
    assert state(table) == [("k0", 2), ("k1", 1)]
    # Again in its old place: the second writer's row still came later.
    table.upsert(messages(spark, [("k0", 3), ("k2", 3)]), 0, "arrival", writer="one")
    assert state(table) == [("k0", 2), ("k1", 1), ("k2", 3)]
    table.compact()
    table.upsert(messages(spark, [("new", 1)]), 0, "arrival", writer="three")
    table.upsert(messages(spark, [("lost", 1)]), 0, "arrival", writer="one")
    table.upsert(messages(spark, [("fresh", 1)]), arrival="arrival")
    table.upsert(messages(spark, [("fresh", 2)]), arrival="arrival")
    assert state(table) == [("fresh", 2), ("k0", 2), ("k1", 1), ("k2", 3), ("new", 1)]


def test_order_by_another_column_skips_no_segment(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT, order_by=("altitude",))
    at = lambda time, altitude: messages(spark, [("a", time)]).withColumn("altitude", F.lit(altitude))
    table.upsert(at(5, 900), 0, "arrival")
    table.compact()
    table.upsert(at(9 * 86400, 10), 1, "arrival")
    assert rows(table.read(since=9).select("id", "time", "altitude")) == [("a", 5, 900)]


def test_repeated_key_needs_an_arrival(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    with pytest.raises(Exception, match="repeated key a"):
        table.upsert(messages(spark, [("a", 1), ("a", 2)]), 0)
    assert state(table) == []


def test_retire_removes_what_recent_lists_do_not_name(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    for n in range(4):
        table.upsert(messages(spark, [("a", n), (f"b{n}", n)]), n, "arrival")
        table.compact()
    before = state(table)
    folders = table._folders()
    gone = table.retire(keep=1)
    assert len(folders) == 8 and len(table._folders()) == 1 and len(gone) == 7 + 7
    assert state(table) == before and table._versions() == [8] and table.retire(keep=1) == []


def test_compaction_rewrites_only_segments_with_changed_keys(spark, tmp_path):
    day = 86400
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    table.upsert(messages(spark, [("a", 1), ("b", day + 1), ("c", 2 * day + 1), ("n", None)]), 0, "arrival")
    table.compact()
    table.upsert(messages(spark, [("b", 2 * day + 5)]), 1, "arrival")
    table.compact()
    assert state(table) == [("a", 1), ("b", 2 * day + 5), ("c", 2 * day + 1), ("n", None)]
    attempts = {s.name: len(list(s.iterdir())) for s in Path(table.path, "base").glob("segment=*")}
    assert attempts == {"segment=-1": 1, "segment=0": 1, "segment=1": 1, "segment=2": 2}
    assert [e.segment for e in table._state().of("base")] == [-1, 0, 2]
    # Only the named folders are opened.
    late = table.read(since=2).select("id")
    assert rows(late) == [("b",), ("c",)]
    assert all("segment=2" in f for f in late.inputFiles()) and len(table.read().inputFiles()) < 5


def test_null_key_fails_the_batch(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    with pytest.raises(Exception, match="NULL in a required column"):
        table.upsert(messages(spark, [(None, 1)]), 0, "arrival")
    assert state(table) == []


def test_filter_on_current_rows_reaches_the_base_scan(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    table.upsert(messages(spark, ENTRIES), 0, "arrival")
    table.compact()
    table.upsert(messages(spark, [("a", 1)]), 1, "arrival")
    plan = table.read().filter("time > 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(time,3)" in plan
    assert "aircraft_model" not in plan


def test_snapshots_accumulate_and_are_safe_to_repeat(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), schemas.MOST_ACTIVE_FLIGHTS_PER_BUILDER)
    result = spark.createDataFrame([("b", 2), ("a", 1), (None, 5)], "builder string, flight_count bigint")
    table.append(result.orderBy(F.desc("flight_count")), 1, NOW)
    table.append(result, 2, NOW)
    table.append(result.limit(1), 2, NOW)
    assert rows(table.read().groupBy("batch_id").count()) == [(1, 3), (2, 1)]
    first = table.batch(1)
    assert first.select("created_at").distinct().count() == 1
    assert [r["builder"] for r in first.orderBy("id").collect()] == [None, "b", "a"]


@pytest.fixture
def warehouse(spark, tmp_path, flights, airlines, airports):
    w = Warehouse(spark, str(tmp_path))
    w.flight.upsert(flights, 0)
    w.airline.upsert(airlines, 0)
    w.airport.upsert(airports, 0)
    return w


def test_run_all(spark, warehouse):
    with pytest.raises(Exception, match="NULL in a required column"):
        run_all(warehouse, AS_OF)
    done = run_all(warehouse, AS_OF, on_null="quarantine")
    assert done["airport_and_zone_transition"].count() == 7
    assert done["current_longest_flight"].first()["flight_id"] == "f6"
    assert rows(done["average_flight_distance_per_continent"].select("continent", "average_flight_distance")) == [
        ("Africa", 4711),
        ("Europe", 5552),
        ("North America", 5552),
    ]
    run_all(warehouse, AS_OF, on_null="quarantine")
    run_all(warehouse, AS_OF + 60, on_null="quarantine")
    history = warehouse.snapshots["airport_and_zone_transition"].read()
    assert rows(history.groupBy("batch_id").count()) == [(AS_OF, 7), (AS_OF + 60, 7)]


def test_earlier_run_done_again_gives_the_same(spark, warehouse):
    def stored():
        return {n: rows(t.batch(AS_OF - 300).drop("id")) for n, t in warehouse.snapshots.items()}

    run_all(warehouse, AS_OF - 300, on_null="quarantine", replay=True)
    before = stored()
    run_all(warehouse, AS_OF, on_null="quarantine", replay=True)
    run_all(warehouse, AS_OF - 300, on_null="quarantine", replay=True)
    assert stored() == before and before["airport_and_zone_transition"]


def test_reading_one_batch_opens_its_folder_alone(spark, warehouse):
    for as_of in (AS_OF, AS_OF + 60):
        run_all(warehouse, as_of, on_null="quarantine")
    files = warehouse.snapshots["airport_and_zone_transition"].batch(AS_OF).inputFiles()
    assert files and all(f"batch_id={AS_OF}/" in f for f in files)


def test_catalog_names_the_tables(spark, warehouse):
    run_all(warehouse, AS_OF, on_null="quarantine")
    warehouse.flight.compact()
    warehouse.create_catalog()
    # The views follow: no second call is needed.
    warehouse.flight.upsert(messages(spark, [("f1", 4)]), 1, "arrival")
    warehouse.flight.compact()
    warehouse.flight.upsert(messages(spark, [("f1", 5), ("new", 6)]), 2, "arrival")
    try:
        assert rows(spark.table("raw_data.flight").select("id", "time")) == state(warehouse.flight)
        found = spark.sql("SELECT builder, flight_count FROM analytics_data.most_active_flights_per_builder")
        assert found.count() == 6
        joined = spark.sql(
            """SELECT f.id, a.name FROM raw_data.flight f JOIN raw_data.airline a ON f.airline_icao = a.icao
            WHERE f.time < 10"""
        )
        assert rows(joined) == [("f1", "Alpha"), ("new", "Alpha")]
        assert spark.sql("SELECT * FROM raw_data.airport").count() == 6
    finally:
        for database in ("raw_data", "processed_data", "analytics_data"):
            spark.sql(f"DROP DATABASE {database} CASCADE")
    warehouse.register_views()
    assert spark.sql("SELECT * FROM flight").count() == 8


def test_hot_route_is_split_in_a_shuffled_join(spark, airports):
    """A third of the flights on one route: the join's hot partition is split, and no row is lost."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        hot = F.expr("id % 3 = 0")
        many = spark.range(0, n, 1, 8).select(
            F.col("id").cast("string").alias("id"),
            F.lit("AA").alias("airline_iata"),
            F.lit("AAA").alias("airline_icao"),
            F.when(hot, "P1").otherwise(F.concat(F.lit("Q"), F.expr("string(id % 500)"))).alias("origin_airport_iata"),
            F.lit("P3").alias("destination_airport_iata"),
            F.lit(AS_OF).alias("time"),
        )
        others = spark.range(500).selectExpr(
            "concat('J', id) icao", "0 altitude", "'x' country", "concat('Q', id) iata", "float(1) latitude",
            "float(id % 90) longitude", "'n' name", "'Asia' continent",
        )
        found = jobs.airport_and_zone_transition(many, airports.unionByName(others), AS_OF)
        assert found.count() == n
        found.write.format("noop").mode("overwrite").save()
        collected = found.select("flight_id", "origin_airport_name")
        assert len(collected.collect()) == n
        assert "skew=true" in collected._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def opened(monkeypatch, *tops):
    """The folders that tables read from then on."""
    found, read = [], KeyedTable._read

    def spy(self, top, folders, schema):
        if top in tops:
            found.extend(folders)
        return read(self, top, folders, schema)

    monkeypatch.setattr(KeyedTable, "_read", spy)
    return found


def test_late_batch_of_a_writer_is_kept(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    table.upsert(messages(spark, [("k1", 1)]), 5, "arrival")
    table.compact()
    table.upsert(messages(spark, [("k1", 2), ("k2", 2)]), 3, "arrival")
    assert state(table) == [("k1", 2), ("k2", 2)]
    table.upsert(messages(spark, [("k1", 3), ("k2", 3)]), 3, "arrival")
    table.compact()
    # Folded now, like 5; 4 still isn't.
    for number in (3, 5):
        table.upsert(messages(spark, [("k1", 9), ("k9", 9)]), number, "arrival")
    assert state(table) == [("k1", 3), ("k2", 3)]
    table.upsert(messages(spark, [("k4", 4)]), 4, "arrival")
    table.upsert(messages(spark, [("k6", 6)]), arrival="arrival")
    table.compact()
    assert state(table) == [("k1", 3), ("k2", 3), ("k4", 4), ("k6", 6)]
    assert [(e.first, e.number) for e in table._state().of("folded")] == [(3, 6)]


def test_compaction_opens_only_segments_that_may_hold_a_changed_key(spark, tmp_path, monkeypatch):
    day = 86400
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    table.upsert(messages(spark, [(f"k{d}-{i}", d * day + i) for d in range(6) for i in range(50)]), 0, "arrival")
    table.compact()
    table.upsert(messages(spark, [("k2-7", 5 * day), ("new", 4 * day), ("other", 9 * day)]), 1, "arrival")
    folders = opened(monkeypatch, "base")
    table.compact()
    # Key columns of day 2 alone; whole rows of the days that change; the new folders, for their summaries.
    assert sorted(f.split("/")[1] for f in folders) == sorted(
        ["segment=2"] + ["segment=2", "segment=4", "segment=5"] + ["segment=2", "segment=4", "segment=5", "segment=9"]
    )
    assert len(state(table)) == 302 and ("k2-7", 5 * day) in state(table)
    assert sorted(e.segment for e in table._state().of("keys")) == [0, 1, 2, 3, 4, 5, 9]


def test_lookup_opens_only_segments_that_may_hold_a_key(spark, tmp_path, monkeypatch):
    day = 86400
    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    table.upsert(messages(spark, [(f"k{d}-{i}", d * day + i) for d in range(6) for i in range(50)]), 0, "arrival")
    table.compact()
    table.upsert(messages(spark, [("k2-7", 5 * day), ("new", 4 * day)]), 1, "arrival")
    wanted = spark.createDataFrame([("k0-1",), ("k2-7",), ("new",), ("nobody",), (None,), ("new",)], "id string")
    folders = opened(monkeypatch, "base")
    assert rows(table.lookup(wanted).select("id", "time")) == [("k0-1", 1), ("k2-7", 5 * day), ("new", 4 * day)]
    assert sorted({f.split("/")[1] for f in folders}) == ["segment=0", "segment=2"]
    assert table.lookup(wanted.limit(0)).count() == 0
    # A table without summaries, as it was stored before there were any, is read whole.
    table._commit(table._state().without(lambda e: e.kind == "keys"))
    assert rows(table.lookup(wanted).select("id", "time")) == [("k0-1", 1), ("k2-7", 5 * day), ("new", 4 * day)]
    table.compact()
    assert sorted(e.segment for e in table._state().of("keys")) == [2, 4, 5]


def test_summaries_never_deny_a_key(spark):
    from skytally.operators import keysets

    keys = spark.range(30000).select((F.col("id") % 7).alias("segment"), F.concat(F.lit("é"), "id").alias("key"))
    keys = keys.filter("segment <> 6 OR key < 'é2'")
    summary = keysets.summarise(keys, "segment", "key").cache()
    sizes = [r[0] for r in summary.select("buckets").distinct().collect()]
    assert len(sizes) == 2
    for number in (0, 3, 13, 29995):
        found = keysets.may_hold(summary, "segment", keys.filter(F.col("key") == f"é{number}"), "key", sizes)
        assert rows(found) == [(number % 7,)]
    assert rows(keysets.may_hold(summary, "segment", keys, "key", sizes)) == [(k,) for k in range(7)]
    others = spark.range(100000, 101000).select(F.concat(F.lit("é"), "id").alias("key"))
    assert keysets.may_hold(summary, "segment", others, "key", sizes).count() <= 1


def test_ids_of_a_batch_are_consecutive_in_its_order(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), schemas.MOST_ACTIVE_FLIGHTS_PER_BUILDER)
    result = spark.range(0, 5000, 1, 7).select(F.format_string("%05d", "id").alias("builder"), F.lit(1).cast("long").alias("flight_count"))
    table.append(result.repartitionByRange(5, "builder").sortWithinPartitions("builder"), 1, NOW)
    found = table.read().orderBy("id").collect()
    assert [r["id"] for r in found] == list(range(1, 5001))
    assert [r["builder"] for r in found] == sorted(r["builder"] for r in found)
    table.append(result.limit(0), 1, NOW)
    assert table.read().count() == 0


def test_history_is_read_from_the_first_run_with_an_active_flight(spark, tmp_path, airlines, airports, monkeypatch):
    w = Warehouse(spark, str(tmp_path))
    w.airline.upsert(airlines, 0)
    w.airport.upsert(airports, 0)
    seen = lambda key, time: flight(key, "AA", "AAA", "P1", "P2", 0, time, "Boeing 1")
    hour = 3600
    read, since = SnapshotTable.read, []

    def spy(self, batch_ids=None, since_=None, **named):
        found = read(self, batch_ids, named.get("since", since_))
        if self.spec.name == "airport_and_zone_transition" and batch_ids is None:
            since.append({f.split("batch_id=")[1].split("/")[0] for f in found.inputFiles()})
        return found

    monkeypatch.setattr(SnapshotTable, "read", spy)
    for n, ids in enumerate((["a", "b"], ["b", "c"], ["c"], ["d"], ["b", "d"])):
        as_of = (n + 1) * hour
        w.flight.upsert(frame(spark, schemas.FLIGHT.schema, *[seen(i, as_of - 10) for i in ids]), n)
        run_all(w, as_of)
    # b comes back in the last run: its first one was the first; before, runs without an active flight stay closed.
    starts = [min(int(b) for b in found) // hour for found in since if found]
    assert starts[-5:] == [1, 1, 2, 4, 1]
    count = rows(w.snapshots["airline_with_most_active_flights_per_continent"].read([5 * hour]).select("flight_count"))
    # An index that is lost, or of an older warehouse, is made again from the history.
    from skytally.sources import files

    files.delete(spark, w.seen.path)
    run_all(w, 5 * hour)
    assert count == rows(w.snapshots["airline_with_most_active_flights_per_continent"].read([5 * hour]).select("flight_count"))
    assert rows(w.seen.read()) == [("a", hour), ("b", hour), ("c", 2 * hour), ("d", 4 * hour)]


def test_views_that_lag_follow_at_the_next_read(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path), replace(schemas.FLIGHT, database="lagging"))
    spark.sql("CREATE DATABASE IF NOT EXISTS lagging")
    try:
        table.publish("lagging.flight")
        table.upsert(messages(spark, [("a", 1)]), 0, "arrival")
        assert rows(spark.table("lagging.flight").select("id")) == [("a",)]
        # The session is lost after the list is written and before the views are.
        with monkeypatch.context() as lost:
            lost.setattr(KeyedTable, "_follow", lambda self, state: None)
            table.upsert(messages(spark, [("b", 1)]), 1, "arrival")
        assert rows(spark.table("lagging.flight").select("id")) == [("a",)]
        assert state(table) == [("a", 1), ("b", 1)]
        assert rows(spark.table("lagging.flight").select("id")) == [("a",), ("b",)]
        with monkeypatch.context() as lost:
            lost.setattr(KeyedTable, "_follow", lambda self, state: None)
            table.compact()
        table.retire(keep=1)
        assert rows(spark.table("lagging.flight").select("id")) == [("a",), ("b",)]
    finally:
        spark.sql("DROP DATABASE lagging CASCADE")


def test_maintained_counts_equal_a_full_pass(spark, tmp_path, monkeypatch):
    from skytally.operators.counts import MaintainedCounts

    table = KeyedTable(spark, str(tmp_path), schemas.FLIGHT)
    counts = MaintainedCounts(table, ["airline_icao", "aircraft_model"], "flights")
    draw, day = random.Random(4), 86400
    assert counts.refresh().count() == 0

    def batch(keys):
        made = [flight(f"k{k}", "AA", draw.choice(["A", "B", None]), "P1", "P2", 0, draw.randrange(9) * day + k, draw.choice(["x", "y", None])) for k in keys]
        return frame(spark, schemas.FLIGHT.schema, *made)

    full = lambda: rows(jobs.flights_per_model(table.read()))
    table.upsert(batch(range(200)), 0)
    assert rows(counts.refresh()) == full()
    table.compact()
    for n in range(1, 5):
        table.upsert(batch(draw.sample(range(260), 15)), n)
        if n == 2:
            # Again, with other rows: those of the first try leave.
            table.upsert(batch(draw.sample(range(260), 15)), n)
        if n == 3:
            table.compact()
        with monkeypatch.context() as here:
            here.setattr(KeyedTable, "read_version", lambda *a: pytest.fail("counted all"))
            now = rows(counts.refresh())
        assert now == full()
    # Where the old list is gone, all is counted.
    table.upsert(batch(range(5)), 9)
    table.compact()
    table.retire(keep=1)
    assert rows(counts.refresh()) == full()


def test_many_segments_are_written_by_many_tasks(spark, tmp_path):
    spec = replace(schemas.FLIGHT, segment="time div 10")
    table = KeyedTable(spark, str(tmp_path), spec)
    for n in range(2):
        table.upsert(messages(spark, [(f"k{i}", 10 * i + n) for i in range(40)]), n, "arrival")
        table.compact()
    assert len(table._state().of("base")) == 40 and len(state(table)) == 40
    for top in ("base", "keys"):
        attempts = {}
        for f in Path(table.path, top).glob("segment=*/attempt=*/part-*.parquet"):
            attempts.setdefault(f.parent.name, set()).add(f.name.split("-")[1])
        # Four shuffle partitions; before, one task wrote what is small.
        assert [len(tasks) for tasks in attempts.values()] == [4, 4]


def test_summaries_grow_with_keys_alone(spark):
    from skytally.operators import keysets

    keys = spark.range(4000).select((F.col("id") % 400).alias("segment"), F.concat(F.lit("k"), "id").alias("key"))
    summary = keysets.summarise(keys, "segment", "key").cache()
    # An asked key meets the rows of its own hash, not a row of each set.
    assert summary.count() == 4000 and summary.select("hash").distinct().count() == 4000
    wanted = keys.filter("key IN ('k7', 'k1207', 'k8')")
    assert rows(keysets.may_hold(summary, "segment", wanted, "key", [1])) == [(7,), (8,)]
    # A summary as older tables have it, without hashes, denies nothing.
    older = summary.union(spark.sql("SELECT 999L, 1, 0, CAST(NULL AS LONG)"))
    assert rows(keysets.may_hold(older, "segment", wanted, "key", [1])) == [(7,), (8,), (999,)]
