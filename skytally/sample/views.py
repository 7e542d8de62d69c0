"""Flights, airlines and airports out of the sample star schema, so the jobs can run over it."""

from __future__ import annotations

import functools
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The newest order date of the sample data, and the windows that stand for 600 s and 300 s.
AS_OF = 996624000
EARLIER = 992736000
ACTIVE = 90 * 86400
TRANSITION = 45 * 86400


@functools.cache
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table; its schema is read from the files once per session."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def epoch(c: str) -> str:
    """Seconds since 1970 of a timestamp without zone, whatever the session's zone is."""
    return f"int(unix_date(date({c})) * 86400 + hour({c}) * 3600 + minute({c}) * 60 + second({c}))"


def instant(seconds: int) -> datetime:
    return datetime.fromtimestamp(seconds, timezone.utc)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    return places.selectExpr(
        "c_name AS icao",
        "int(c_custkey % 3000) AS altitude",
        "n_name AS country",
        "CASE WHEN c_custkey % 50 = 49 THEN '' ELSE concat('A', string(c_custkey - if(c_custkey % 10 = 9, 1, 0))) END AS iata",
        "CASE WHEN c_custkey % 41 != 0 THEN float(c_custkey * 37 % 170 - 85) END AS latitude",
        "CASE WHEN c_custkey % 41 != 0 THEN float(c_custkey * 73 % 358 - 179) END AS longitude",
        "concat('Airport ', c_name) AS name",
        "r_name AS continent",
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey")
    )
    return suppliers.selectExpr(
        "concat('S', string(s_suppkey)) AS icao",
        "concat('C', string(s_suppkey % 10)) AS code",
        "s_name AS name",
        "n_name AS country",
    )


def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an order's lines say about its flight; orders without lines have none."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    return lines.agg(
        F.min("l_partkey").alias("model_part"), F.max("l_partkey").alias("last_part"), F.max("l_suppkey").alias("carrier")
    )


def observations(orders: DataFrame, lines: DataFrame, part: DataFrame | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One flight per order; the 20 columns of the flight table, after the order's own to ``keep``.

    Model, destination and carrier come from the order's lines.  Without ``part`` the model is NULL, for
    queries that have no use for it.
    """
    flights = orders.join(lines, F.expr("l_orderkey = o_orderkey"), "left")
    if part is not None:
        flights = flights.join(part.select("p_partkey", "p_name"), F.expr("p_partkey = model_part"), "left")
    return flights.selectExpr(
        *keep,
        "string(o_orderkey) AS id",
        "string(NULL) AS aircraft_code",
        "CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 != 0 THEN concat('C', string(o_orderkey % 12)) END"
        " AS airline_iata",
        "concat('S', string(carrier)) AS airline_icao",
        "int(o_orderkey % 40000) AS altitude",
        "string(NULL) AS callsign",
        "concat('A', string(last_part)) AS destination_airport_iata",
        "int(NULL) AS ground_speed",
        "int(NULL) AS heading",
        "string(NULL) AS icao_24bit",
        "float(NULL) AS latitude",
        "float(NULL) AS longitude",
        "string(NULL) AS number",
        "int(o_orderstatus = 'F') AS on_ground",
        "concat('A', string(o_custkey)) AS origin_airport_iata",
        "string(NULL) AS registration",
        "string(NULL) AS squawk",
        f"{epoch('o_orderdate')} AS time",
        "int(NULL) AS vertical_speed",
        "p_name AS aircraft_model" if part is not None else "string(NULL) AS aircraft_model",
    )


def flights(spark: SparkSession, sf_dir: str, model: bool = True) -> DataFrame:
    return observations(
        table(spark, sf_dir, "orders"), first_lines(spark, sf_dir), table(spark, sf_dir, "part") if model else None
    )
