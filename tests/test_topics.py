from __future__ import annotations

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skytally.sources import topics
from skytally.sources.topics import LandedTopicReader, OffsetsLost, land_topic, topic_messages


def land(spark, path, low, high, per_file=10):
    """Messages ``low`` to ``high`` of each of three partitions, the last one half as long."""
    rows = spark.range(3).select(F.col("id").alias("partition"), F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("offset"))
    rows = rows.filter("partition < 2 OR offset < 20")
    value = F.concat_ws("/", "partition", "offset").cast("binary")
    land_topic(rows.select(value.alias("value"), "partition", "offset", F.timestamp_seconds("offset").alias("timestamp")), path, per_file)


def reader(path, **options):
    return LandedTopicReader({"path": str(path), **options})


def test_files_and_offsets(spark, tmp_path):
    land(spark, str(tmp_path), 0, 25)
    assert sorted(p.name for p in (tmp_path / "partition=0").iterdir()) == [f"{a:020d}-{b:020d}.parquet" for a, b in ((0, 9), (10, 19), (20, 24))]
    r = reader(tmp_path)
    assert r.initialOffset() == {"0": 0, "1": 0, "2": 0} and r.latestOffset() == {"0": 25, "1": 25, "2": 20}
    ranges = r.partitions({"0": 3, "1": 25}, {"0": 12, "1": 25, "2": 20})
    assert [(x.partition, x.start, x.end) for x in ranges] == [(0, 3, 10), (0, 10, 12), (2, 0, 10), (2, 10, 20)]
    assert [v for b in r.read(ranges[1]) for v in b.column("value").to_pylist()] == [b"0/10", b"0/11"]
    assert r.partitions({"0": 25}, {"0": 25}) == []


def test_limit_is_shared_out_and_goes_on_after_a_restart(spark, tmp_path):
    land(spark, str(tmp_path / "topic"), 0, 25)
    options = {"maxOffsetsPerTrigger": "14", "checkpoint": str(tmp_path / "checkpoint")}
    at, ranges = reader(tmp_path / "topic", **options).initialOffset(), 0
    os.makedirs(tmp_path / "checkpoint/offsets")
    for n in range(20):
        r = reader(tmp_path / "topic", **options)
        end = r.latestOffset()
        moved = sum(end.values()) - sum(at.values())
        assert 0 <= moved <= 14 and all(end[p] >= at[p] for p in at)
        if not moved:
            break
        ranges += sum(x.end - x.start for x in r.partitions(at, end))
        at = end
        (tmp_path / f"checkpoint/offsets/{n}").write_text("v1\n{}\n" + json.dumps(at))
    assert ranges == 70 and at == {"0": 25, "1": 25, "2": 20}


def test_losses_are_told(spark, tmp_path):
    land(spark, str(tmp_path), 0, 40)
    part = tmp_path / "partition=1"
    files = sorted(part.iterdir())
    r = reader(tmp_path)
    with pytest.raises(OffsetsLost, match="read up to 30"):
        r.partitions({"1": 30}, {"1": 20})
    files[2].rename(tmp_path / "away")
    with pytest.raises(OffsetsLost, match="no offsets 20 to 29"):
        r.partitions({"1": 5}, {"1": 40})
    loose = reader(tmp_path, failOnDataLoss="false")
    assert [(x.start, x.end) for x in loose.partitions({"1": 5}, {"1": 40})] == [(5, 10), (10, 20), (30, 40)]
    files[3].rename(tmp_path / "away too")
    with pytest.raises(OffsetsLost, match="no offsets 20 to 39"):
        r.partitions({"1": 5}, {"1": 40})
    r.partitions({"0": 0}, {"0": 40, "1": 0})
    r._at = {"0": 41, "1": 20}
    with pytest.raises(OffsetsLost, match="partition 0 ends at 40"):
        r.latestOffset()
    # A file with fewer messages than its name says.
    short = topics.Range(str(sorted((tmp_path / "partition=0").iterdir())[0]), 0, 5, 12)
    with pytest.raises(OffsetsLost, match="lacks offsets from 10"):
        list(r.read(short))
    with pytest.raises(ValueError, match="checkpoint"):
        reader(tmp_path, maxOffsetsPerTrigger="5")


def read_all(spark, path, root, trigger, **options):
    messages = topic_messages(spark, path, **options).select(F.col("value").cast("string").alias("value"), "arrival.partition", "arrival.offset", "arrival.timestamp")
    query = messages.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(**trigger).start(f"{root}/out")
    try:
        query.processAllAvailable() if "processingTime" in trigger else query.awaitTermination()
    finally:
        query.stop()
    return query


def test_stream_stops_and_resumes(spark, tmp_path):
    path, root = str(tmp_path / "topic"), str(tmp_path / "run")
    land(spark, path, 0, 25)
    read_all(spark, path, root, {"availableNow": True})
    land(spark, path, 25, 70)
    query = read_all(spark, path, root, {"processingTime": "0 seconds"}, maxOffsetsPerTrigger="31", checkpoint=f"{root}/checkpoint")
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [31, 31, 28]
    found = spark.read.parquet(f"{root}/out")
    assert found.count() == found.distinct().count() == 160
    assert found.filter("value <> concat_ws('/', partition, offset) OR unix_timestamp(timestamp) <> offset").count() == 0
    # The next file goes before it is read.
    land(spark, path, 70, 90)
    next(Path(path, "partition=0").glob(f"{70:020d}-*")).unlink()
    with pytest.raises(Exception, match="no offsets 70 to 79"):
        read_all(spark, path, root, {"availableNow": True})
    read_all(spark, path, root, {"availableNow": True}, failOnDataLoss="false")
    assert spark.read.parquet(f"{root}/out").count() == 160 + 30


def test_messages_with_holes_are_not_landed(spark, tmp_path):
    rows = spark.range(3).selectExpr("cast('x' as binary) value", "0 partition", "id * 2 offset", "timestamp_seconds(0) timestamp")
    with pytest.raises(Exception, match="holes or repeated offsets"):
        land_topic(rows, str(tmp_path))


def test_partition_is_put_in_order_by_many_tasks(spark, monkeypatch):
    from skytally.sources import feeds

    monkeypatch.setattr(feeds, "RANGE", 4)
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    stamps = [5, 3, None, 9, 1, 2, 10, 4, 4, 4, None, 12, 1]
    sent = [(str(o).encode(), p, o, t) for p in (0, None) for o, t in enumerate(stamps)]
    raw = spark.createDataFrame(sent, "value binary, partition int, offset long, t long").withColumn("timestamp", F.timestamp_seconds("t"))
    found = feeds.in_batch(feeds.topic_arrival(raw)).withColumn("task", F.spark_partition_id())
    spark.conf.set(small, "false")
    try:
        got = found.select("arrival.partition", "arrival.offset", F.unix_timestamp("arrival.timestamp").alias("t"), "task").collect()
    finally:
        spark.conf.unset(small)
    want = [max(t for t in stamps[: o + 1] if t is not None) for o in range(len(stamps))]
    for part in (0, None):
        mine = sorted((r for r in got if r["partition"] == part), key=lambda r: r["offset"])
        assert [r["t"] for r in mine] == want
        # Before, one task had all of a partition.
        assert len({r["task"] for r in mine}) > 1
