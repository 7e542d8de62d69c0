from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skytally import schemas
from skytally.operators.conform import storage_schema
from skytally.session import build_session

AS_OF = 1000000


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def frame(spark, schema, *rows):
    """Rows given as dicts; columns left out are NULL."""
    stored = storage_schema(schema)
    return spark.createDataFrame([tuple(r.get(n) for n in stored.fieldNames()) for r in rows], stored)


def flight(id, iata, icao, origin, dest, ground, time, model):
    return {
        "id": id, "airline_iata": iata, "airline_icao": icao, "origin_airport_iata": origin,
        "destination_airport_iata": dest, "on_ground": ground, "time": time, "aircraft_model": model,
    }


def airport(icao, iata, lat, lon, continent):
    return {"icao": icao, "iata": iata, "latitude": lat, "longitude": lon, "continent": continent, "name": f"N{icao}"}


@pytest.fixture(scope="session")
def flights(spark):
    return frame(
        spark,
        schemas.FLIGHT.schema,
        flight("f1", "AA", "AAA", "P1", "P2", 0, 999900, "Boeing 737-8"),
        flight("f2", "AA", "AAA", "P1", "P3", 0, 999400, "Airbus A320"),
        flight("f3", "", "AAA", "", "P2", 0, 999950, "Boeing 777"),
        flight("f4", None, "BBB", "P1", "P9", 0, 999950, None),
        flight("f5", "ZZ", "ZZZ", "P2", "P1", 0, 999950, ""),
        flight("f6", "BB", "BBB", "P1", "P4", 1, 999950, "Embraer"),
        flight("f7", "AA", "AAA", "P1", "P1", 0, 999650, "Cessna"),
    ).cache()


@pytest.fixture(scope="session")
def airlines(spark):
    rows = [("AAA", "AA", "Alpha", "France"), ("AAB", "AA", "Alpha Cargo", "France"), ("BBB", "BB", "Beta", "Unknown")]
    return frame(spark, schemas.AIRLINE.schema, *[dict(zip(("icao", "code", "name", "country"), r)) for r in rows])


@pytest.fixture(scope="session")
def airports(spark):
    return frame(
        spark,
        schemas.AIRPORT.schema,
        airport("I1", "P1", 40.6, -73.8, "North America"),
        airport("I2", "P2", 51.6, -0.5, "Europe"),
        airport("I2b", "P2", 51.6, -0.5, "Europe"),
        airport("I3", "P3", 0.0, 0.0, "Africa"),
        airport("I4", "P4", None, None, "North America"),
        airport("I5", "", 10.0, 10.0, "Africa"),
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])
