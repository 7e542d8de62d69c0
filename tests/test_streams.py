from __future__ import annotations

import json
import os

import pytest
from conftest import AS_OF, rows
from pyspark.sql import functions as F

from skytally import schemas
from skytally.operators.tables import KeyedTable
from skytally.plans import jobs
from skytally.sources.feeds import landed_messages, landed_observations
from skytally.streaming.ingest import ingest, ingest_batch, publish
from skytally.streaming.messages import decode, to_messages

NAMES = schemas.FLIGHT.schema.fieldNames()


def message(**values):
    return {**dict.fromkeys(NAMES), "id": "f", **values}


def land(folder, name, *lines, at):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    os.utime(path, (at, at))


def run(spark, folder, table, **options):
    ingest(
        landed_messages(spark, str(folder)),
        table,
        str(folder) + "_checkpoint",
        trigger={"availableNow": True},
        **options,
    ).awaitTermination()


def test_decode_reasons(spark):
    absent = message()
    del absent["squawk"]
    lines = [
        json.dumps(message(altitude=100, details={"deep": [1, 2]})),
        json.dumps(message(altitude="N/A")),
        json.dumps(absent),
        "not json",
        "[1, 2]",
        json.dumps(message(id=None)),
        json.dumps(message(altitude="350", squawk=1200, latitude=1, ground_speed=99.5)),
        json.dumps(message(altitude=True)),
        json.dumps(message(altitude=3000000000)),
    ]
    df = spark.createDataFrame([(i, bytearray(x, "utf-8")) for i, x in enumerate(lines)], "n int, value binary")
    df = df.union(spark.createDataFrame([(9, bytearray(b'{"id": "\xff"}'))], "n int, value binary"))
    found = {r["n"]: r for r in decode(df, schemas.FLIGHT.schema).collect()}
    assert [found[i]["_reason"] for i in range(10)] == [
        None,
        "wrong type: altitude",
        "absent: squawk",
        "not a JSON object",
        "not a JSON object",
        "NULL key: id",
        None,
        "wrong type: altitude",
        "wrong type: altitude",
        "not UTF-8",
    ]
    assert (found[6]["altitude"], found[6]["squawk"], found[6]["latitude"], found[6]["ground_speed"]) == (350, "1200", 1.0, 100)


def test_stream_upserts_in_arrival_order_and_resumes(spark, tmp_path):
    folder, table = tmp_path / "in", KeyedTable(spark, str(tmp_path / "w"), schemas.FLIGHT)
    land(folder, "b.txt", message(id="a", time=50), message(id="b", time=1), message(id="a", time=40), at=1000)
    run(spark, folder, table)
    assert rows(table.read().select("id", "time")) == [("a", 40), ("b", 1)]
    # The later file wins, though its name sorts first and its time is older.
    land(folder, "a.txt", message(id="a", time=30), "broken", message(id="c", time="soon"), at=2000)
    run(spark, folder, table, compact_every=1)
    run(spark, folder, table)
    assert rows(table.read().select("id", "time")) == [("a", 30), ("b", 1)]
    refused = spark.read.parquet(f"{table.path}_quarantine")
    assert rows(refused.select("reason")) == [("not a JSON object",), ("wrong type: time",)]


def test_event_time_order_is_an_option(spark, tmp_path):
    folder = tmp_path / "in"
    table = KeyedTable(spark, str(tmp_path / "w"), schemas.FLIGHT, order_by=("time",))
    land(folder, "a.txt", message(id="a", time=50), at=1000)
    run(spark, folder, table)
    land(folder, "b.txt", message(id="a", time=40), at=2000)
    run(spark, folder, table)
    assert rows(table.read().select("id", "time")) == [("a", 50)]


def test_jobs_can_run_after_each_batch(spark, tmp_path):
    folder, table = tmp_path / "in", KeyedTable(spark, str(tmp_path / "w"), schemas.FLIGHT)
    land(folder, "a.txt", message(airline_iata="AA", on_ground=0, time=AS_OF), at=1000)
    airlines = spark.createDataFrame([("AA", "Alpha")], "code string, name string")
    seen = []
    run(
        spark, folder, table, partitions=2,
        after_batch=lambda t, n: seen.append((n, rows(jobs.most_flights_in_progress(t.read(), airlines, AS_OF)))),
    )
    assert seen == [(0, [("AA", "Alpha", 1)])]


def test_bad_message_can_stop_the_batch(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "w"), schemas.FLIGHT)
    batch = spark.createDataFrame([(bytearray(b"broken"), 1)], "value binary, arrival int")
    with pytest.raises(Exception, match="not a JSON object"):
        ingest_batch(batch, table, 0, None, on_bad="fail")
    with pytest.raises(ValueError):
        ingest_batch(batch, table, 0, None, on_bad="?")
    assert table.read().count() == 0


def test_publish_and_read_back(spark, tmp_path):
    schema = schemas.FLIGHT.schema
    land(tmp_path / "feed", "a.json", message(id="a", time=5, altitude=7), message(id="b"), at=1000)
    seen = landed_observations(spark, str(tmp_path / "feed"), schema).withColumn("_private", F.lit(1))
    publish(
        seen, str(tmp_path / "c"), format="text", trigger={"availableNow": True}, path=str(tmp_path / "topic")
    ).awaitTermination()
    sent = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "topic")).collect()]
    assert sorted(sent, key=lambda m: m["id"]) == [message(id="a", time=5, altitude=7), message(id="b")]


def test_messages_decode_to_the_same_rows(spark, flights):
    back = decode(to_messages(flights), schemas.FLIGHT.schema).drop("value", "_reason")
    assert rows(back) == rows(flights)


def drained(stream, root):
    stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(
        f"{root}/out"
    ).awaitTermination()
    return rows(stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out"))


def test_active_flights_per_window_over_a_restart(spark, tmp_path, airlines):
    from skytally.streaming.windows import active_per_window

    kinds = "id string, airline_iata string, on_ground int, time int"
    stream = lambda: active_per_window(landed_observations(spark, str(tmp_path / "in"), kinds), airlines, 600, "0 seconds")
    seen = lambda key, code, ground, time: {"id": key, "airline_iata": code, "on_ground": ground, "time": time}
    # At 600: a is in the air, b has landed, c has no code, d was seen at 600 itself, e belongs to the next window.
    first = [seen("a", "AA", 0, 5), seen("b", "BB", 0, 7), seen("b", "BB", 1, 9), seen("c", "", 0, 9), seen("d", "ZZ", 0, 600), seen("e", "AA", 0, 601)]
    land(tmp_path / "in", "1", *first, at=1)
    at_600 = [(600, "AA", "Alpha", 1), (600, "AA", "Alpha Cargo", 1), (600, "ZZ", None, 1)]
    got = lambda found: {tuple(sorted(map(str, r))) for r in found}
    assert got(drained(stream(), tmp_path / "run")) == got(at_600)
    # The window of e is still open.
    land(tmp_path / "in", "2", seen("a", "BB", 0, 601), seen("f", "AA", 0, 1300), at=2)
    at_1200 = [(1200, "AA", "Alpha", 1), (1200, "AA", "Alpha Cargo", 1), (1200, "BB", "Beta", 1)]
    assert got(drained(stream(), tmp_path / "run")) == got(at_600 + at_1200)
    land(tmp_path / "in", "3", seen("g", "AA", 0, 30), seen("h", "AA", 0, 9000), at=3)
    at_1800 = [(1800, "AA", "Alpha", 1), (1800, "AA", "Alpha Cargo", 1)]
    assert got(drained(stream(), tmp_path / "run")) == got(at_600 + at_1200 + at_1800)


def test_details_that_come_late_or_never(spark, tmp_path):
    from skytally.streaming.windows import with_details

    read = lambda name, kinds: landed_observations(spark, str(tmp_path / name), kinds)
    stream = lambda: with_details(read("list", "id string, time int"), read("details", "id string, time int, model string"), 300, "0 seconds")
    land(tmp_path / "list", "1", {"id": "a", "time": 100}, {"id": "b", "time": 110}, {"id": "c", "time": 120}, at=1)
    land(tmp_path / "details", "1", {"id": "a", "time": 150, "model": "x"}, at=1)
    assert drained(stream(), tmp_path / "run") == [("a", 100, "x")]
    # b's details come after a restart and in time, c's too late.
    land(tmp_path / "details", "2", {"id": "b", "time": 410, "model": "y"}, {"id": "c", "time": 421, "model": "z"}, at=2)
    assert drained(stream(), tmp_path / "run") == [("a", 100, "x"), ("b", 110, "y")]
    land(tmp_path / "list", "2", {"id": "end", "time": 9000}, at=3)
    land(tmp_path / "details", "3", {"id": "end", "time": 9000, "model": "e"}, at=3)
    assert ("c", 120, None) in drained(stream(), tmp_path / "run")


def test_large_batch_is_spread_over_more_tasks(spark, tmp_path, monkeypatch):
    from skytally.streaming import ingest as module

    monkeypatch.setattr(module, "PER_TASK", 10)
    tasks, batch = [], module.ingest_batch
    monkeypatch.setattr(module, "ingest_batch", lambda m, *a: (tasks.append(m.rdd.getNumPartitions()), batch(m, *a)))
    folder, table = tmp_path / "in", KeyedTable(spark, str(tmp_path / "w"), schemas.FLIGHT)
    land(folder, "a.txt", *[message(id=f"a{i}", time=i) for i in range(35)], at=1000)
    run(spark, folder, table, partitions=2)
    land(folder, "b.txt", message(id="a1", time=50), at=2000)
    run(spark, folder, table, partitions=2)
    assert tasks == [4, 2] and table.read().count() == 35
