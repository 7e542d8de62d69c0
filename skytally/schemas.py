"""Table definitions of the three zones: raw (current state), processed and analytics (snapshots)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VarcharType,
)

TEXT, INT, REAL = StringType(), IntegerType(), FloatType()
SHORT, LONG = VarcharType(100), VarcharType(255)


def _schema(columns: dict, required: tuple[str, ...] = ()) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in columns.items()])


@dataclass(frozen=True)
class KeyedSpec:
    """A table holding one row per key.

    ``segment`` is SQL for the whole number of the part a row is stored in, ``cluster_by`` the
    order of rows within a part, ``segment_column`` the column that segments grow with.
    """

    database: str
    name: str
    schema: StructType
    key: str
    cluster_by: tuple[str, ...] = ()
    segment: str = "0"
    segment_column: str = ""


@dataclass(frozen=True)
class SnapshotSpec:
    """A table to which each run appends its result rows."""

    database: str
    name: str
    result: StructType

    @property
    def schema(self) -> StructType:
        return StructType(
            [
                StructField("id", LongType(), False),
                *self.result.fields,
                StructField("created_at", TimestampType()),
            ]
        )


FLIGHT = KeyedSpec(
    "raw_data",
    "flight",
    _schema(
        {
            "id": TEXT,
            "aircraft_code": TEXT,
            "airline_iata": TEXT,
            "airline_icao": TEXT,
            "altitude": INT,
            "callsign": TEXT,
            "destination_airport_iata": TEXT,
            "ground_speed": INT,
            "heading": INT,
            "icao_24bit": TEXT,
            "latitude": REAL,
            "longitude": REAL,
            "number": TEXT,
            "on_ground": INT,
            "origin_airport_iata": TEXT,
            "registration": TEXT,
            "squawk": TEXT,
            "time": INT,
            "vertical_speed": INT,
            "aircraft_model": TEXT,
        },
        required=("id",),
    ),
    key="id",
    cluster_by=("time", "id"),
    segment="coalesce(time div 86400, -1)",
    segment_column="time",
)

AIRLINE = KeyedSpec(
    "raw_data",
    "airline",
    _schema({"icao": TEXT, "code": TEXT, "name": TEXT, "country": TEXT}, required=("icao",)),
    key="icao",
)

AIRPORT = KeyedSpec(
    "raw_data",
    "airport",
    _schema(
        {
            "icao": TEXT,
            "altitude": INT,
            "country": TEXT,
            "iata": TEXT,
            "latitude": REAL,
            "longitude": REAL,
            "name": TEXT,
            "continent": TEXT,
        },
        required=("icao",),
    ),
    key="icao",
)

_ENDS = {
    f"{end}_{column}": kind
    for end in ("origin", "destination")
    for column, kind in (
        ("airport_name", SHORT),
        ("airport_latitude", REAL),
        ("airport_longitude", REAL),
        ("zone_name", SHORT),
    )
}

MOST_FLIGHTS_IN_PROGRESS = SnapshotSpec(
    "processed_data",
    "most_flights_in_progress",
    _schema({"airline_code": SHORT, "airline_name": SHORT, "flight_count": INT}),
)

AIRPORT_AND_ZONE_TRANSITION = SnapshotSpec(
    "processed_data",
    "airport_and_zone_transition",
    _schema({"flight_id": SHORT, "airline_iata": SHORT, "airline_icao": SHORT, **_ENDS, "distance_km": REAL}),
)

AIRCRAFT_MODEL_PER_AIRLINE_COUNTRY = SnapshotSpec(
    "processed_data",
    "aircraft_model_per_airline_country",
    _schema(
        {"airline_name": LONG, "country": LONG, "model_name": LONG, "aircraft_count": INT},
        required=("airline_name", "country", "model_name", "aircraft_count"),
    ),
)

AIRLINE_WITH_MOST_ACTIVE_FLIGHTS_PER_CONTINENT = SnapshotSpec(
    "analytics_data",
    "airline_with_most_active_flights_per_continent",
    _schema({"airline_code": SHORT, "airline_name": SHORT, "continent": SHORT, "flight_count": INT}),
)

AVERAGE_FLIGHT_DISTANCE_PER_CONTINENT = SnapshotSpec(
    "analytics_data",
    "average_flight_distance_per_continent",
    _schema({"continent": SHORT, "average_flight_distance": INT}),
)

CURRENT_LONGEST_FLIGHT = SnapshotSpec(
    "analytics_data",
    "current_longest_flight",
    _schema({"flight_id": SHORT, "airline_iata": SHORT, **_ENDS, "distance_km": REAL}),
)

MOST_ACTIVE_FLIGHTS_PER_BUILDER = SnapshotSpec(
    "analytics_data",
    "most_active_flights_per_builder",
    _schema({"builder": TEXT, "flight_count": INT}),
)

# An index, not a result: the second of the first run whose transitions hold a flight.
TRANSITION_SEEN = KeyedSpec(
    "processed_data",
    "transition_seen",
    _schema({"flight_id": TEXT, "first_seen": LongType()}, required=("flight_id",)),
    key="flight_id",
    cluster_by=("flight_id",),
    segment="first_seen div 86400",
    segment_column="first_seen",
)

KEYED = (FLIGHT, AIRLINE, AIRPORT)
SNAPSHOTS = (
    MOST_FLIGHTS_IN_PROGRESS,
    AIRPORT_AND_ZONE_TRANSITION,
    AIRCRAFT_MODEL_PER_AIRLINE_COUNTRY,
    AIRLINE_WITH_MOST_ACTIVE_FLIGHTS_PER_CONTINENT,
    AVERAGE_FLIGHT_DISTANCE_PER_CONTINENT,
    CURRENT_LONGEST_FLIGHT,
    MOST_ACTIVE_FLIGHTS_PER_BUILDER,
)
