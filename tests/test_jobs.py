from __future__ import annotations

from datetime import datetime, timezone

import pytest
from conftest import AS_OF, frame, rows
from pyspark.sql import functions as F

from skytally import schemas
from skytally.operators.tables import SnapshotTable
from skytally.plans import jobs

OLD, NEW = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 2, tzinfo=timezone.utc)


def test_most_flights_in_progress(flights, airlines):
    # f2 is exactly 600 s old, f3 and f4 have no code, f6 is on the ground; AA names two airlines.
    assert rows(jobs.most_flights_in_progress(flights, airlines, AS_OF)) == [
        ("AA", "Alpha", 2),
        ("AA", "Alpha Cargo", 2),
        ("ZZ", None, 1),
    ]


def test_airlines_sharing_code_and_name_form_one_group(spark, flights, airlines):
    twice = airlines.union(airlines.filter("icao = 'AAA'").selectExpr("'AAC'", "code", "name", "country"))
    assert rows(jobs.most_flights_in_progress(flights, twice, AS_OF)) == rows(
        jobs.most_flights_in_progress(flights, airlines, AS_OF)
    )


def test_counts_equal_the_join_then_count(spark, flights, airlines):
    flights.createOrReplaceTempView("fl")
    airlines.createOrReplaceTempView("al")
    expected = spark.sql(
        f"""SELECT fl.airline_iata, al.name, CAST(COUNT(DISTINCT fl.id) AS INT) FROM fl
        LEFT JOIN al ON al.code = fl.airline_iata
        WHERE time > {AS_OF - 600} AND on_ground = 0 AND airline_iata != '' GROUP BY 1, 2"""
    )
    assert rows(jobs.most_flights_in_progress(flights, airlines, AS_OF)) == rows(expected)
    models = spark.sql(
        """SELECT a.name, a.country, f.aircraft_model, CAST(COUNT(*) AS INT) FROM al a
        JOIN fl f ON f.airline_icao = a.icao GROUP BY 1, 2, 3"""
    )
    assert rows(jobs.aircraft_model_per_airline_country(flights, airlines)) == rows(models)


def test_transitions(flights, airports):
    found = jobs.airport_and_zone_transition(flights, airports, AS_OF)
    ends = rows(found.select("flight_id", "origin_airport_name", "destination_airport_name"))
    assert ends == [
        ("f1", "NI1", "NI2"),
        ("f1", "NI1", "NI2b"),
        ("f3", "NI5", "NI2"),
        ("f3", "NI5", "NI2b"),
        ("f5", "NI2", "NI1"),
        ("f5", "NI2b", "NI1"),
        ("f6", "NI1", "NI4"),
    ]
    km = {r["flight_id"]: r["distance_km"] for r in found.collect()}
    assert km["f1"] == pytest.approx(5551.759, abs=0.001)
    assert km["f6"] is None
    wider = jobs.airport_and_zone_transition(flights, airports, AS_OF, seconds=600)
    assert wider.filter("flight_id = 'f7'").first()["distance_km"] == 0.0


def test_transition_columns_are_the_stored_ones(flights, airports):
    stored = schemas.AIRPORT_AND_ZONE_TRANSITION.result.fieldNames()
    assert jobs.airport_and_zone_transition(flights, airports, AS_OF).columns == stored


def test_models_null_policy(flights, airlines, spark, tmp_path):
    complete, rejects = jobs.aircraft_model_per_airline_country(flights, airlines, on_null="quarantine")
    assert rows(complete) == [
        ("Alpha", "France", "Airbus A320", 1),
        ("Alpha", "France", "Boeing 737-8", 1),
        ("Alpha", "France", "Boeing 777", 1),
        ("Alpha", "France", "Cessna", 1),
        ("Beta", "Unknown", "Embraer", 1),
    ]
    assert rows(rejects) == [("Beta", "Unknown", None, 1)]
    table = SnapshotTable(spark, str(tmp_path), schemas.AIRCRAFT_MODEL_PER_AIRLINE_COUNTRY)
    with pytest.raises(Exception, match="NULL in a required column"):
        table.append(jobs.aircraft_model_per_airline_country(flights, airlines), 1, NEW)
    assert table.read().count() == 0


def test_model_order_puts_nulls_last(flights, airlines):
    ordered = [tuple(r)[:3] for r in jobs.aircraft_model_per_airline_country(flights, airlines).collect()]
    assert ordered[0] == ("Alpha", "France", "Airbus A320")
    assert ordered[-1] == ("Beta", "Unknown", None)


def history(spark, *entries):
    columns = ("flight_id", "airline_iata", "origin_zone_name", "destination_zone_name", "distance_km", "created_at")
    return frame(spark, schemas.AIRPORT_AND_ZONE_TRANSITION.schema, *[dict(zip(columns, e)) for e in entries])


@pytest.fixture
def transitions(spark):
    return history(
        spark,
        ("f1", "AA", "Europe", "Europe", 5.0, OLD),
        ("f1", "AA", "Asia", "Asia", 2.0, NEW),
        ("f5", "ZZ", "Asia", "Asia", 3.0, NEW),
        ("f6", "BB", None, None, 9.0, NEW),
        ("f6", "BB", "Africa", "Africa", 99.0, OLD),
        ("f7", None, "Africa", "Africa", 3.5, OLD),
        ("f2", "AA", "Africa", "Africa", 1000.0, OLD),
        ("gone", "AA", "Africa", "Africa", 1000.0, NEW),
    )


def test_active_flights_per_continent(transitions, airlines, flights):
    found = jobs.airline_with_most_active_flights_per_continent(transitions, airlines, flights, AS_OF)
    # f1 changed its route and counts in both zones; f6 is on the ground and still counts.
    assert rows(found) == [
        ("AA", "Alpha", "Asia", 1),
        ("AA", "Alpha", "Europe", 1),
        ("AA", "Alpha Cargo", "Asia", 1),
        ("AA", "Alpha Cargo", "Europe", 1),
        ("BB", "Beta", "Africa", 1),
        ("ZZ", None, "Asia", 1),
        (None, None, "Africa", 1),
    ]


def test_average_distance_rounds_half_even_over_newest_rows(transitions, flights):
    found = jobs.average_flight_distance_per_continent(transitions, flights, AS_OF)
    assert rows(found) == [("Africa", 4), ("Asia", 2), (None, 9)]


def test_average_distance_needs_no_second_join(spark, transitions, flights):
    transitions.createOrReplaceTempView("azt")
    flights.createOrReplaceTempView("fl")
    joined = spark.sql(
        f"""WITH one AS (
          SELECT flight_id, MAX(STRUCT(created_at, origin_zone_name z, distance_km d)) m FROM azt
          LEFT JOIN fl ON fl.id = azt.flight_id WHERE time > {AS_OF - 600} GROUP BY 1)
        SELECT m.z, CAST(BROUND(AVG(m.d), 0) AS INT) FROM one LEFT JOIN fl ON fl.id = one.flight_id GROUP BY 1"""
    )
    assert rows(joined) == rows(jobs.average_flight_distance_per_continent(transitions, flights, AS_OF))


def test_longest_flight_is_of_the_newest_batch(spark, transitions):
    assert jobs.current_longest_flight(transitions).first()["flight_id"] == "gone"
    unknown = transitions.union(history(spark, ("f9", "AA", "Asia", "Asia", None, NEW)))
    assert jobs.current_longest_flight(unknown).first()["flight_id"] == "f9"
    assert jobs.current_longest_flight(unknown, nulls="last").first()["flight_id"] == "gone"
    unstamped = unknown.union(history(spark, ("f0", "AA", "Asia", "Asia", 1.0, None)))
    assert jobs.current_longest_flight(unstamped).first()["flight_id"] == "f0"
    assert jobs.current_longest_flight(transitions.limit(0)).count() == 0


def test_flights_per_builder(flights):
    assert rows(jobs.most_active_flights_per_builder(flights)) == [
        ("", 1),
        ("Airbus", 1),
        ("Boeing", 2),
        ("Cessna", 1),
        ("Embraer", 1),
        (None, 1),
    ]


def test_top_models_and_ties(spark):
    models = spark.createDataFrame(
        [("a", "X", m, n) for m, n in (("m1", 5), ("m2", 4), ("m3", 4), ("m4", 4), ("m5", 1))] + [("b", "X", "m5", 9)],
        "airline_name string, country string, model_name string, aircraft_count int",
    )
    top = jobs.top_models_per_country
    assert [r[1:] for r in rows(top(models))] == [("m1", 5, 2), ("m2", 4, 3), ("m5", 10, 1)]
    assert len(rows(top(models, ties="rank"))) == 5
    assert len(rows(top(models, k=2, ties="dense_rank"))) == 2
    assert len(rows(top(models, k=3, ties="dense_rank"))) == 5


def test_top_airline_per_continent(spark):
    counts = spark.createDataFrame(
        [("AA", "A", "Asia", 2), ("BB", "B", "Asia", 3), ("CC", "C", None, 1)],
        "airline_code string, airline_name string, continent string, flight_count int",
    )
    assert rows(jobs.top_airlines_per_continent(counts).select("airline_code", "continent")) == [
        ("BB", "Asia"),
        ("CC", None),
    ]


@pytest.mark.parametrize("broadcast", ["64MB", "-1"])
def test_jobs_agree_with_and_without_broadcast(spark, transitions, flights, airlines, airports, broadcast):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, broadcast)
    try:
        assert len(rows(jobs.airport_and_zone_transition(flights, airports, AS_OF))) == 7
        assert rows(jobs.average_flight_distance_per_continent(transitions, flights, AS_OF)) == [
            ("Africa", 4),
            ("Asia", 2),
            (None, 9),
        ]
        found = jobs.airline_with_most_active_flights_per_continent(transitions, airlines, flights, AS_OF)
        assert len(rows(found)) == 7
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_fan_out_is_spread(spark, airports, monkeypatch):
    """600 airports without a code, and flights without one at both ends: all pairs, in many tasks."""
    others = spark.range(600).selectExpr(
        "concat('J', id) icao", "0 altitude", "'x' country", "if(id % 2 = 0, '', concat('Q', id)) iata", "float(id % 90) latitude",
        "float(id % 80) longitude", "concat('n', id) name", "if(id % 3 = 0, 'Asia', NULL) continent",
    )
    places = airports.unionByName(others)
    moving = spark.range(0, 3000, 1, 4).selectExpr(
        "string(id) id", "'AA' airline_iata", "'AAA' airline_icao", "if(id % 1000 = 7, '', if(id % 100 = 3, NULL, 'P1')) origin_airport_iata",
        "if(id % 500 = 7, '', 'P2') destination_airport_iata", f"{AS_OF} time",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        monkeypatch.setattr(jobs, "HOT_TILE", 16)
        found = jobs.airport_and_zone_transition(moving, places, AS_OF, method="sphere")
        tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        n = 301
        # '' at both ends three times, '' at the destination alone thrice more; the others meet both airports of P2.
        assert sum(tasks) == 3 * n * n + 3 * n + (3000 - 6 - 30) * 2
        assert len(tasks) >= 8 and max(tasks) < 2 * sorted(tasks)[len(tasks) // 2]
        monkeypatch.setattr(jobs, "HOT_TILE", 10**9)
        plain = jobs.airport_and_zone_transition(moving, places, AS_OF, method="sphere")
        total = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()
        assert total(found) == total(plain)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_route_repeats_few_rows(spark, airports, monkeypatch):
    """However many airports share a code, a flight is repeated for a number of tiles that the partitions set."""
    others = spark.range(400).selectExpr(
        "if(id % 7 = 3, NULL, concat('J', id % 390)) icao", "0 altitude", "'x' country", "'' iata", "float(id % 90) latitude",
        "if(id % 11 = 0, NULL, float(id % 80)) longitude", "concat('n', id) name", "'Asia' continent",
    )
    places = airports.unionByName(others)
    moving = spark.range(40).selectExpr(
        "string(id % 30) id", "'AA' airline_iata", "'AAA' airline_icao", "CASE WHEN id < 6 THEN '' WHEN id % 9 > 0 THEN 'P1' END"
        " origin_airport_iata", "if(id < 4, '', 'P2') destination_airport_iata", f"{AS_OF} time",
    )
    repeated, deal = [], jobs.for_each_tile
    monkeypatch.setattr(jobs, "for_each_tile", lambda *args: repeated.append(deal(*args)) or repeated[-1])
    monkeypatch.setattr(jobs, "HOT_TILE", 1)
    found = jobs.airport_and_zone_transition(moving, places, AS_OF)
    # Four partitions: 8 x 8 tiles, of 401 x 401 airports.  Two flights are from '' to P2, which has two airports.
    assert max(df.count() for df in repeated) <= 4 * 8 * 8 + 2 * 8 * 2 + 34 * 2
    monkeypatch.setattr(jobs, "HOT_TILE", 10**9)
    plain = jobs.airport_and_zone_transition(moving, places, AS_OF)
    total = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()
    assert total(found) == total(plain) and total(found)[0] > 4 * 401 * 401


@pytest.mark.parametrize("tile", [1, 10**9])
def test_length_is_rounded_once_per_route(spark, flights, airports, monkeypatch, tile):
    """Rounded for each route, below the join that makes a row of every flight; the same numbers as rounded after it."""
    monkeypatch.setattr(jobs, "HOT_TILE", tile)
    found = jobs.airport_and_zone_transition(flights, airports, AS_OF, decimals=1)
    after = jobs.airport_and_zone_transition(flights, airports, AS_OF)
    assert rows(found) == rows(after.withColumn("distance_km", F.round(F.col("distance_km").cast("double"), 1)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan[: plan.index("Join Inner")]
