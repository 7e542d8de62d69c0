"""The snapshot queries J1-J8.

Each takes DataFrames and the run's clock and returns the result columns; storing the result is
``skytally.plans.pipeline``.  Aggregates are taken before the dimension join wherever that gives
the same rows: the join then sees one row per key however many flights share it, and duplicate
dimension codes fan out over the few aggregated rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions.clock import Instant, half_even_int
from skytally.functions.geo import geodesic_km
from skytally.functions.text import first_word
from skytally.operators import keyed
from skytally.operators.conform import split_nulls
from skytally.operators.filters import equal_columns, in_the_air, non_empty, recent
from skytally.operators.lookup import at_most_tiles, fan_out, for_each_tile, hot_codes, tiled

#: Airports of one code that a row meets at once.
HOT_TILE = 32


def most_flights_in_progress(
    flights: DataFrame,
    airlines: DataFrame,
    as_of: Instant,
    seconds: int = 600,
    repeated_ids: str | None = None,
    replay: bool = False,
) -> DataFrame:
    """Flights now in the air per airline code and name.

    ``id`` is the key of the flight table, so counting needs no distinct ids.  For input that holds an
    id more than once ``repeated_ids`` is "exact" or "approximate".
    """
    count = {None: F.count, "exact": F.count_distinct, "approximate": F.approx_count_distinct}[repeated_ids]
    active = non_empty(in_the_air(recent(flights, as_of, seconds, replay=replay)), "airline_iata")
    counts = active.groupBy(F.col("airline_iata").alias("airline_code")).agg(
        count("id").cast("int").alias("flight_count")
    )
    named = fan_out(counts, _names_by_code(airlines), "airline_code", "code", "left")
    return named.select("airline_code", "airline_name", "flight_count").orderBy(
        F.desc("flight_count"), "airline_code", "airline_name"
    )


def airport_and_zone_transition(
    flights: DataFrame,
    airports: DataFrame,
    as_of: Instant,
    seconds: int = 300,
    method: str = "spheroid",
    replay: bool = False,
    decimals: int | None = None,
) -> DataFrame:
    """Each recent flight with both airports, their zones and the route length.

    Airports and distance are worked out once per distinct route; the flights then join the
    finished routes.  Codes of more than ``HOT_TILE`` airports, like that of all airports without one, are
    met in tiles: both ends of a route and its flights are dealt on one grid of the ends' tiles, each field of it
    with its own pairs of airports and in a task of its own.  The grid is bounded by the number of partitions, so that
    what is repeated for its fields grows as the input does; only the pairs and the rows of the result are more.
    With ``decimals`` the length is rounded to so many, once per route, and a double.
    """
    active = recent(flights, as_of, seconds, replay=replay).select(
        "id", "airline_iata", "airline_icao", "origin_airport_iata", "destination_airport_iata"
    )
    ends = ["origin_airport_iata", "destination_airport_iata"]
    keys, hot = list(ends), hot_codes(airports, "iata", HOT_TILE)
    legs = active.select(*ends).distinct()
    # One look at the airports decides; without such a code the plan is the plain one.
    split = not hot.isEmpty()
    if split:
        partitions = int(legs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Some 16 fields of the grid for each partition, enough to deal them evenly.
        hot = at_most_tiles(hot, 4 * math.ceil(math.sqrt(partitions)))
        for end in ends:
            active, legs = (for_each_tile(rows, end, hot, f"_{end}_tile") for rows in (active, legs))
            keys.append(f"_{end}_tile")
    sides = []
    for end in ("origin", "destination"):
        code, tile = f"{end}_airport_iata", f"_{end}_airport_iata_tile"
        columns = [
            f"iata AS _{end}",
            f"name AS {end}_airport_name",
            f"latitude AS {end}_airport_latitude",
            f"longitude AS {end}_airport_longitude",
            f"continent AS {end}_zone_name",
        ]
        if split:
            side = tiled(airports, "iata", hot, "icao", "_tile").selectExpr(*columns, f"_tile AS _{end}_tile")
            met = (F.col(code) == F.col(f"_{end}")) & (F.col(tile) == F.col(f"_{end}_tile"))
            # By number: small partitions stay apart, as it is not their own size that counts but that of what they become.
            sides.append(legs.join(side, met).drop(f"_{end}", f"_{end}_tile").repartition(partitions, *keys))
        else:
            legs = fan_out(legs, airports.selectExpr(*columns), code, f"_{end}")
    if split:
        legs = sides[0].join(sides[1], keys)
    length = geodesic_km(
        "origin_airport_latitude",
        "origin_airport_longitude",
        "destination_airport_latitude",
        "destination_airport_longitude",
        method,
    ).cast("float")
    legs = legs.withColumn("distance_km", length if decimals is None else F.round(length.cast("double"), decimals))
    columns = [c for c in legs.columns if c not in keys]
    if split:
        # Not by broadcast: flights of one route and their tiles would stay in one task.  The legs come first, so that
        # each is read once and the few flights of its route are gone through again and again.
        met = legs.repartition(partitions, *keys).hint("merge").join(active, keys)
    else:
        met = active.join(legs, keys)
    return met.selectExpr("id AS flight_id", "airline_iata", "airline_icao", *columns)


def flights_per_model(flights: DataFrame) -> DataFrame:
    """Flights per airline and model: what J3 and J7 need of the flights, in one pass over them."""
    return flights.groupBy("airline_icao", "aircraft_model").agg(F.count("id").alias("flights"))


def _weighted(rows: DataFrame, *by) -> DataFrame:
    """Rows per group, of flights themselves or of their counts."""
    n = F.sum("flights") if "flights" in rows.columns else F.count("*")
    return rows.groupBy(*by).agg(n.cast("long").alias("n"))


def aircraft_model_per_airline_country(
    flights: DataFrame, airlines: DataFrame, on_null: str = "fail"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Aircraft models in use per airline and country.

    Storing a NULL name, country or model fails the batch; ``on_null="quarantine"`` returns
    (complete groups, the others) instead.  ``flights`` can be ``flights_per_model`` of them.
    """
    models = _weighted(flights, "airline_icao", F.col("aircraft_model").alias("model_name"))
    named = fan_out(
        models, airlines.select("icao", F.col("name").alias("airline_name"), "country"), "airline_icao", "icao"
    )
    counts = named.groupBy("airline_name", "country", "model_name").agg(F.sum("n").cast("int").alias("aircraft_count"))
    order = [F.asc_nulls_last(c) for c in ("country", "airline_name", "model_name")]
    if on_null == "fail":
        return counts.orderBy(*order)
    if on_null != "quarantine":
        raise ValueError(f"unknown null policy {on_null!r}")
    complete, rejects = split_nulls(counts, ["airline_name", "country", "model_name"])
    return complete.orderBy(*order), rejects


def airline_with_most_active_flights_per_continent(
    transitions: DataFrame,
    airlines: DataFrame,
    flights: DataFrame,
    as_of: Instant,
    seconds: int = 600,
    replay: bool = False,
) -> DataFrame:
    """Active flights that stay in one zone, per airline and zone.

    ``transitions`` is the history of all batches: a flight counts while its current row is recent.
    """
    local = equal_columns(transitions, "origin_zone_name", "destination_zone_name").select(
        "flight_id", F.col("airline_iata").alias("airline_code"), F.col("origin_zone_name").alias("continent")
    )
    counts = (
        _still_active(local.distinct(), flights, as_of, seconds, replay)
        .groupBy("continent", "airline_code")
        .agg(F.count("flight_id").cast("int").alias("flight_count"))
    )
    named = fan_out(counts, _names_by_code(airlines), "airline_code", "code", "left")
    return named.select("airline_code", "airline_name", "continent", "flight_count").orderBy(
        F.desc("flight_count"), "continent", "airline_code", "airline_name"
    )


def average_flight_distance_per_continent(
    transitions: DataFrame, flights: DataFrame, as_of: Instant, seconds: int = 600, replay: bool = False
) -> DataFrame:
    """Mean route length of active flights by origin zone, each flight once.

    Of a flight's rows over all batches the newest counts; among equally new ones the choice is
    made by the columns used here, so it is the same on every run.
    """
    active = _still_active(
        transitions.select("flight_id", "created_at", F.col("origin_zone_name").alias("continent"), "distance_km"),
        flights,
        as_of,
        seconds,
        replay,
    )
    one_each = keyed.latest_per_key(active, "flight_id", ["created_at", "continent", "distance_km"])
    return one_each.groupBy("continent").agg(half_even_int(F.avg("distance_km")).alias("average_flight_distance"))


def current_longest_flight(transitions: DataFrame, nulls: str = "first") -> DataFrame:
    """The longest flight of the newest batch.

    A route of unknown length comes first, as NULLs do in a descending order; ``nulls="last"``
    prefers a known one.  The newest stamp is found from its own column alone, and only rows of
    that batch are read in full.
    """
    # A missing stamp sorts as the newest.
    newest = transitions.agg(F.max(F.struct(F.col("created_at").isNull().alias("m"), "created_at")).alias("s"))
    batch = transitions.filter(F.col("created_at").eqNullSafe(newest.select("s.created_at").scalar()))
    columns = [
        "flight_id",
        "airline_iata",
        *[f"{e}_{c}" for e in ("origin", "destination") for c in
          ("airport_name", "airport_latitude", "airport_longitude", "zone_name")],
        "distance_km",
    ]
    order = [keyed.descending("distance_km", nulls), *[F.asc(c) for c in columns if c != "distance_km"]]
    return keyed.top_rows(batch.select(*columns), order)


def most_active_flights_per_builder(flights: DataFrame) -> DataFrame:
    """Flights ever seen per aircraft builder, the first word of the model.

    ``flights`` can be ``flights_per_model`` of them.
    """
    counts = _weighted(flights, first_word("aircraft_model").alias("builder"))
    counts = counts.select("builder", F.col("n").cast("int").alias("flight_count"))
    return counts.orderBy(F.desc("flight_count"), "builder")


def top_models_per_country(models: DataFrame, k: int = 3, ties: str = "row_number") -> DataFrame:
    """The k most used aircraft models of each airline country, out of one batch of J3."""
    totals = models.groupBy("country", "model_name").agg(F.sum("aircraft_count").cast("int").alias("flight_count"))
    order = [F.desc("flight_count")]
    if ties == "row_number":
        order.append(F.asc_nulls_last("model_name"))
    return keyed.top_k_per_group(totals, "country", order, k, ties)


def top_airlines_per_continent(counts: DataFrame, k: int = 1) -> DataFrame:
    """The k airlines with most active flights of each continent, out of one batch of J4."""
    order = [F.desc("flight_count"), F.asc_nulls_last("airline_code"), F.asc_nulls_last("airline_name")]
    return keyed.top_k_per_group(counts, "continent", order, k)


def _names_by_code(airlines: DataFrame) -> DataFrame:
    """Distinct (code, name): airlines that share both form one result group."""
    return airlines.select("code", F.col("name").alias("airline_name")).distinct()


def _still_active(
    rows: DataFrame, flights: DataFrame, as_of: Instant, seconds: int, replay: bool = False
) -> DataFrame:
    """Rows whose flight was observed in the window.  The input has few rows per flight, so a
    shuffled join meets no hot key; if the active ids are few, Spark broadcasts them."""
    ids = recent(flights, as_of, seconds, replay=replay).select(F.col("id").alias("flight_id"))
    return rows.join(ids, "flight_id", "left_semi")
