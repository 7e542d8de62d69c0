"""Every job and operator as a query over the sample tables.

Each query reads whole tables.  The ones that store something write below the folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from skytally.functions.clock import half_even_int, window_start
from skytally.functions.geo import geodesic_km
from skytally.functions.text import field_after, first_word, non_empty_cells, strip
from skytally.functions.country import COUNTRIES, OVERRIDES, override_continents, standard_continents
from skytally.operators import filters, keyed, lookup, records, sketches
from skytally.operators.conform import conform, split_nulls
from skytally.operators.counts import MaintainedCounts
from skytally.operators.tables import KeyedTable, SnapshotTable
from skytally.plans import jobs, refdata
from skytally.plans.pipeline import Warehouse, run_all
from skytally.sample import views
from skytally.sample.views import ACTIVE, AS_OF, EARLIER, TRANSITION
from skytally.schemas import AIRLINE, AIRPORT, FLIGHT, KeyedSpec, SnapshotSpec
from skytally.session import shared_dir
from skytally.sources.feeds import (
    in_batch,
    landed_messages,
    landed_observations,
    read_feed,
    read_reference,
    read_reference_object,
    topic_arrival,
    write_reference,
)
from skytally.sources.objects import read_large_object
from skytally.sources.pages import DETAILS_CLASS
from skytally.sources.topics import land_topic, topic_messages
from skytally.streaming.ingest import ingest, publish
from skytally.streaming.messages import decode, to_messages
from skytally.streaming.windows import active_per_window as active_per_window_stream
from skytally.streaming.windows import with_details

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _km(c: str = "distance_km") -> Column:
    return F.round(F.col(c).cast("double"), 1)


def transitions(spark: SparkSession, sf_dir: str, as_of: int, method: str = "spheroid") -> DataFrame:
    return jobs.airport_and_zone_transition(
        views.flights(spark, sf_dir, model=False), views.airports(spark, sf_dir), as_of, TRANSITION, method, replay=True
    )


def history(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Two batches of transitions, stamped with their clocks."""
    early, late = (
        jobs.airport_and_zone_transition(flights, airports, as_of, TRANSITION, replay=True).selectExpr(
            "*", f"timestamp_seconds({as_of}) AS created_at"
        )
        for as_of in (EARLIER, AS_OF)
    )
    return early.unionByName(late)


# --- whole jobs -------------------------------------------------------------------------------


@query
def most_flights_in_progress(spark, sf_dir):
    return jobs.most_flights_in_progress(
        views.flights(spark, sf_dir, model=False), views.airlines(spark, sf_dir), AS_OF, ACTIVE
    )


@query
def airport_and_zone_transition(spark, sf_dir):
    return transitions(spark, sf_dir, AS_OF).withColumn("distance_km", _km())


@query
def airport_and_zone_transition_sphere(spark, sf_dir):
    return transitions(spark, sf_dir, AS_OF, "sphere").withColumn("distance_km", _km())


@query
def airport_and_zone_transition_hot(spark, sf_dir):
    """One order in a hundred flies from '' to '': between all pairs of airports without a code."""
    flights = views.flights(spark, sf_dir, model=False)
    for end in ("origin_airport_iata", "destination_airport_iata"):
        flights = flights.withColumn(end, F.when(F.expr("bigint(id) % 100 = 0"), "").otherwise(F.col(end)))
    return jobs.airport_and_zone_transition(
        flights, views.airports(spark, sf_dir), AS_OF, TRANSITION, replay=True, decimals=1
    )


@query
def aircraft_model_per_airline_country(spark, sf_dir):
    return jobs.aircraft_model_per_airline_country(views.flights(spark, sf_dir), views.airlines(spark, sf_dir))


@query
def airline_with_most_active_flights_per_continent(spark, sf_dir):
    flights = views.flights(spark, sf_dir, model=False)
    return jobs.airline_with_most_active_flights_per_continent(
        history(flights, views.airports(spark, sf_dir)), views.airlines(spark, sf_dir), flights, AS_OF, ACTIVE
    )


@query
def average_flight_distance_per_continent(spark, sf_dir):
    flights = views.flights(spark, sf_dir, model=False)
    return jobs.average_flight_distance_per_continent(
        history(flights, views.airports(spark, sf_dir)), flights, AS_OF, ACTIVE
    )


@query
def average_flight_distance_joined(spark, sf_dir):
    """The same with each transition joined to its current flight first, a join by key that adds and takes no row."""
    flights = views.flights(spark, sf_dir, model=False)
    moves = history(flights, views.airports(spark, sf_dir))
    moves = lookup.fan_out(moves, flights.select(F.col("id").alias("_id"), "time"), "flight_id", "_id", "left")
    return jobs.average_flight_distance_per_continent(moves, flights, AS_OF, ACTIVE)


@query
def current_longest_flight(spark, sf_dir):
    transitions = history(views.flights(spark, sf_dir, model=False), views.airports(spark, sf_dir))
    return jobs.current_longest_flight(transitions).withColumn("distance_km", _km())


@query
def current_longest_flight_known(spark, sf_dir):
    transitions = history(views.flights(spark, sf_dir, model=False), views.airports(spark, sf_dir))
    return jobs.current_longest_flight(transitions, nulls="last").withColumn("distance_km", _km())


@query
def most_active_flights_per_builder(spark, sf_dir):
    return jobs.most_active_flights_per_builder(views.flights(spark, sf_dir))


@query
def top_models_per_country(spark, sf_dir):
    return jobs.top_models_per_country(aircraft_model_per_airline_country(spark, sf_dir))


@query
def top_models_per_country_rank(spark, sf_dir):
    return jobs.top_models_per_country(aircraft_model_per_airline_country(spark, sf_dir), ties="rank")


@query
def top_models_per_country_dense_rank(spark, sf_dir):
    return jobs.top_models_per_country(aircraft_model_per_airline_country(spark, sf_dir), ties="dense_rank")


@query
def top_airline_per_continent(spark, sf_dir):
    return jobs.top_airlines_per_continent(airline_with_most_active_flights_per_continent(spark, sf_dir))


def _airline_feed(spark, sf_dir):
    return views.airlines(spark, sf_dir).select(
        F.col("icao").alias("ICAO"), F.col("code").alias("Code"), F.col("name").alias("Name")
    )


def _airline_reference(spark, sf_dir):
    """Entries for suppliers not in debt; the richest have no country, others an empty or NULL one."""
    balance = F.col("s_acctbal")
    country = F.when(balance > 8000, F.lit("")).when(balance <= 7000, F.col("n_name"))
    entry = F.when(balance > 9000, F.create_map(F.lit("name"), F.col("s_name"))).otherwise(
        F.create_map(F.lit("name"), F.col("s_name"), F.lit("country"), country)
    )
    return (
        views.table(spark, sf_dir, "supplier")
        .join(views.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .filter(balance >= 0)
        .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("key"), entry.alias("value"))
    )


@query
def load_airlines(spark, sf_dir):
    """The feed, then the enriched feed, upserted into the airline table."""
    table = KeyedTable(spark, shared_dir(spark, "airline"), AIRLINE)
    feed = _airline_feed(spark, sf_dir)
    table.upsert(records.lower_names(feed).withColumn("country", F.lit("to be replaced")), 0)
    table.upsert(refdata.load_airlines(feed, refdata.reference_countries(_airline_reference(spark, sf_dir))), 1)
    return table.read()


@query
def load_airports(spark, sf_dir):
    """Customers of one market segment stand for airports of a country only the override table knows."""
    segment = views.table(spark, sf_dir, "customer").select(F.col("c_name").alias("icao"), "c_mktsegment")
    feed = (
        views.airports(spark, sf_dir)
        .drop("continent")
        .join(segment, "icao")
        .withColumn("country", F.when(F.col("c_mktsegment") == "BUILDING", "Hong Kong").otherwise(F.col("country")))
        .withColumnRenamed("c_mktsegment", "_segment")
    )
    return refdata.load_airports(feed, override_continents(spark), _standard(spark, sf_dir))


@query
def load_airports_built_in(spark, sf_dir):
    """Airports of all countries that the built-in tables know, by name."""
    names = [name for row in COUNTRIES.values() for name in row.split(", ")] + list(OVERRIDES)
    number = F.regexp_extract("icao", "([0-9]+)$", 1).cast("int")
    country = F.element_at(F.array(*[F.lit(n) for n in names]), number % len(names) + 1)
    return refdata.load_airports(views.airports(spark, sf_dir).drop("continent").withColumn("country", country))


def _standard(spark, sf_dir):
    """Nations as countries; region keys 0-4 stand for continent codes."""
    nation = views.table(spark, sf_dir, "nation")
    names = nation.select(F.col("n_name").alias("country"), F.col("n_nationkey").cast("string").alias("alpha2"))
    code = F.element_at(F.array(*[F.lit(c) for c in ("AF", "NA", "AS", "EU", "OC")]), F.col("n_regionkey") + 1)
    codes = nation.select(F.col("n_nationkey").cast("string").alias("alpha2"), code.alias("continent_code"))
    return standard_continents(names, codes)


def _cells(spark, sf_dir):
    """Rows of cells per supplier page: empty cells, repeated codes, empty codes, short rows, no colon."""
    supplier = views.table(spark, sf_dir, "supplier").join(
        views.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    number, balance = F.col("s_suppkey").cast("string"), F.col("s_acctbal")
    code = F.when(balance < 0, F.lit("")).otherwise(F.concat(F.lit("Z"), (F.col("s_suppkey") % 60).cast("string")))
    country = F.when(balance > 9000, F.lit("no colon")).otherwise(F.concat(F.lit("Country:"), "n_name", F.lit(":x")))
    rows = F.array(
        F.array(F.col("s_name"), F.lit("")),
        F.array().cast("array<string>"),
        F.array(F.lit(""), F.concat(F.lit("IATA:"), number), F.lit("Callsign:")),
        F.array(F.concat(F.lit("ICAO:"), code), F.lit("a"), F.lit("b"), F.lit("c"), country),
    )
    return supplier.select(F.col("s_suppkey").alias("page_id"), rows.alias("rows"))


@query
def clean_airline_countries(spark, sf_dir):
    return refdata.clean_airline_countries(_cells(spark, sf_dir))[0]


@query
def clean_airline_countries_rejects(spark, sf_dir):
    return refdata.clean_airline_countries(_cells(spark, sf_dir))[1].select("page_id")


@query
def extract_page_tables(spark, sf_dir):
    """The whole sample pages with a table written into each; only those whose address has a query
    carry it with the wanted class."""
    wanted = F.col("url").contains("?")
    css = F.when(wanted, F.lit(DETAILS_CLASS)).otherwise(F.lit("table"))
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    markup = F.concat(
        F.lit("<article><TABLE id=t class='"), css, F.lit("'><tr><th>Detail</th></tr>\n<tr><td>\n "), title,
        F.lit(" </td><td><b>url:</b> <i>"), F.regexp_replace("url", "&", "&amp;"), F.lit("</i></td></tr><tr><td></td></tr></table>"),
    )
    html = F.concat(
        F.substring_index("html", "<article>", 1), markup,
        F.expr("substring(html, length(substring_index(html, '<article>', 1)) + length('<article>') + 1)"),
    )
    pages = views.table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    rows = refdata.extract_page_tables(pages).select("page_id", F.posexplode("rows").alias("row_no", "cells"))
    return rows.select("page_id", "row_no", F.posexplode_outer("cells").alias("cell_no", "cell"))


@query
def extract_page_tables_raw(spark, sf_dir):
    """Rows found in each of the sample pages as they are: none has a table."""
    pages = views.table(spark, sf_dir, "pages").select("page_id", "html")
    found = refdata.extract_page_tables(pages).select("page_id", F.size("rows").alias("row_count"))
    return pages.select("page_id").join(found, "page_id", "left").fillna(0, ["row_count"])


def _order_stream(spark, sf_dir):
    """Orders as a stream; a glob names the table whether it is a file or a folder."""
    path = f"{sf_dir}/orders.parque[t]"
    orders = spark.readStream.schema(views.table(spark, sf_dir, "orders").schema).parquet(path)
    return orders, views.first_lines(spark, sf_dir), views.table(spark, sf_dir, "part")


@query
def ingest_flights(spark, sf_dir):
    """Stream of one message per order into a table with one row per customer: the last order wins.

    Costly orders carry a text as altitude and are refused.
    """
    root = shared_dir(spark, "ingest")
    seen = _messages(*_order_stream(spark, sf_dir))
    table = KeyedTable(spark, root, FLIGHT)
    tasks = spark.sparkContext.defaultParallelism
    ingest(
        seen, table, f"{root}/checkpoint", trigger={"availableNow": True}, partitions=tasks
    ).awaitTermination()
    return table.read().select("id", "airline_iata", "airline_icao", "altitude", "on_ground", "time", "aircraft_model")


def _messages(orders, lines, part):
    flight = F.struct(
        F.col("o_custkey").cast("string").alias("id"),
        F.when(F.col("o_totalprice") > 400000, F.lit("N/A"))
        .otherwise(F.col("altitude").cast("string"))
        .alias("altitude"),
        *[F.col(c) for c in FLIGHT.schema.fieldNames() if c not in ("id", "altitude")],
        F.struct(F.col("o_totalprice")).alias("details"),
    )
    rows = views.observations(orders, lines, part, keep=("o_orderkey", "o_custkey", "o_totalprice"))
    value = F.to_json(flight, {"ignoreNullFields": "false"}).cast("binary")
    return rows.select(value.alias("value"), F.col("o_orderkey").alias("arrival"))


@query
def publish_flights(spark, sf_dir):
    """Orders as a stream of JSON messages in text files."""
    root = shared_dir(spark, "publish")
    seen = views.observations(*_order_stream(spark, sf_dir)).withColumn("_internal", F.lit(1))
    publish(
        seen, f"{root}/checkpoint", format="text", trigger={"availableNow": True}, path=f"{root}/messages"
    ).awaitTermination()
    return spark.read.schema("value string").text(f"{root}/messages")


@query
def snapshot_run(spark, sf_dir):
    """All jobs run and stored for two clocks, then the earlier one again; the values in all tables."""
    # 90 days stand for 600 s here, so a stored span is longer than a day too.
    warehouse = Warehouse(spark, shared_dir(spark, "run"), segment_seconds=4 * ACTIVE)
    warehouse.flight.upsert(views.flights(spark, sf_dir), 0)
    warehouse.flight.compact()
    warehouse.airline.upsert(views.airlines(spark, sf_dir), 0)
    warehouse.airport.upsert(views.airports(spark, sf_dir), 0)
    for as_of in (EARLIER, AS_OF, EARLIER):
        run_all(
            warehouse,
            as_of,
            active_seconds=ACTIVE,
            transition_seconds=TRANSITION,
            replay=True,
            on_null="quarantine",
        )
    values = None
    for name, (*texts, n) in _RESULTS.items():
        number = F.round(F.col(n).cast("double"), 1) if n == "distance_km" else F.col(n).cast("double")
        columns = [F.col(t).alias(c) for t, c in zip(texts, "abc")]
        columns += [F.lit(None).cast("string").alias(c) for c in "abc"[len(texts) :]]
        rows = warehouse.snapshots[name].read().select(
            F.lit(name).alias("table_name"), "batch_id", *columns, number.alias("n")
        )
        values = rows if values is None else values.unionByName(rows)
    return values


# What is compared of each stored table: up to three texts and a number.
_RESULTS = {
    "most_flights_in_progress": ("airline_code", "airline_name", "flight_count"),
    "airport_and_zone_transition": ("flight_id", "origin_airport_name", "destination_airport_name", "distance_km"),
    "aircraft_model_per_airline_country": ("airline_name", "country", "model_name", "aircraft_count"),
    "airline_with_most_active_flights_per_continent": ("airline_code", "airline_name", "continent", "flight_count"),
    "average_flight_distance_per_continent": ("continent", "average_flight_distance"),
    "current_longest_flight": ("flight_id", "origin_airport_name", "destination_airport_name", "distance_km"),
    "most_active_flights_per_builder": ("builder", "flight_count"),
}


# --- single operators -------------------------------------------------------------------------


@query
def recent_filter(spark, sf_dir):
    return filters.recent(views.flights(spark, sf_dir, model=False), AS_OF, ACTIVE).select("id", "time")


@query
def recent_filter_short(spark, sf_dir):
    return filters.recent(views.flights(spark, sf_dir, model=False), AS_OF, TRANSITION, replay=True).select("id", "time")


@query
def in_the_air_non_empty(spark, sf_dir):
    return filters.non_empty(filters.in_the_air(views.flights(spark, sf_dir, model=False)), "airline_iata").select(
        "id", "airline_iata"
    )


@query
def same_zone_filter(spark, sf_dir):
    return filters.equal_columns(transitions(spark, sf_dir, AS_OF), "origin_zone_name", "destination_zone_name").select(
        "flight_id", "origin_zone_name", "origin_airport_name", "destination_airport_name"
    )


@query
def inner_join_fan_out(spark, sf_dir):
    airports = views.airports(spark, sf_dir).select("iata", F.col("name").alias("airport_name"))
    return lookup.fan_out(
        views.flights(spark, sf_dir, model=False).select("id", "origin_airport_iata"), airports, "origin_airport_iata", "iata"
    )


@query
def left_join_fan_out(spark, sf_dir):
    """Every flight with every airline of its code, counted per pair so the result stays small."""
    counts = views.flights(spark, sf_dir, model=False).groupBy("airline_iata").agg(F.count("*").alias("flight_count"))
    names = views.airlines(spark, sf_dir).select("code", F.col("name").alias("airline_name"))
    return lookup.fan_out(counts, names, "airline_iata", "code", "left")


@query
def semi_join_active(spark, sf_dir):
    """Transitions of the earlier batch whose flight is still active."""
    old = transitions(spark, sf_dir, EARLIER).select("flight_id", "origin_zone_name").distinct()
    return jobs._still_active(old, views.flights(spark, sf_dir, model=False), AS_OF, ACTIVE)


@query
def lookup_default(spark, sf_dir):
    countries = refdata.reference_countries(_airline_reference(spark, sf_dir))
    return lookup.with_default(
        views.airlines(spark, sf_dir).select("icao"), countries, "icao", "country", "Unknown"
    )


@query
def lookup_two_levels(spark, sf_dir):
    """Zone names out of the override table where it knows the country, else out of the nations."""
    countries = views.table(spark, sf_dir, "customer").join(
        views.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    named = countries.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "MACHINERY", "Greenland")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Nowhere")
        .otherwise(F.col("n_name"))
        .alias("country"),
    )
    return lookup.first_of(
        named, [override_continents(spark), _standard(spark, sf_dir)], "country", "continent", on_unknown="null"
    )


@query
def distinct_on(spark, sf_dir):
    """The newest event of each user."""
    return keyed.distinct_on(
        views.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts"
    ).select("user_id", "event_id", "event_type")


@query
def top_k_per_group(spark, sf_dir):
    """The three dearest orders of each customer."""
    orders = views.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return keyed.top_k_per_group(orders, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query
def topk_nulls_first(spark, sf_dir):
    latitudes = views.airports(spark, sf_dir).select("icao", "latitude")
    return keyed.top_rows(latitudes, [keyed.descending("latitude"), F.asc("icao")], 5)


@query
def topk_nulls_last(spark, sf_dir):
    latitudes = views.airports(spark, sf_dir).select("icao", "latitude")
    return keyed.top_rows(latitudes, [keyed.descending("latitude", "last"), F.asc("icao")], 5)


@query
def three_key_sort(spark, sf_dir):
    """Airports ordered by country, code and name, NULLs last."""
    return views.airports(spark, sf_dir).select("country", "iata", "name").orderBy(
        *[F.asc_nulls_last(c) for c in ("country", "iata", "name")]
    )


EVENT_STATE = KeyedSpec(
    "raw_data",
    "event_state",
    StructType(
        [
            StructField("user_id", LongType(), False),
            StructField("event_id", LongType()),
            StructField("event_type", StringType()),
            StructField("value", DoubleType()),
        ]
    ),
    key="user_id",
)


@query
def upsert_latest(spark, sf_dir):
    """Events upserted in three batches, folded after the second; a later batch wins even with an
    older time, and running a batch again changes nothing."""
    table = KeyedTable(spark, shared_dir(spark, "upsert"), EVENT_STATE)
    events = views.table(spark, sf_dir, "events")
    batch = F.when(F.col("event_type") == "click", 2).when(F.col("event_type") == "error", 1).otherwise(0)
    for number in (0, 1, 1, 2, 2):
        table.upsert(events.filter(batch == number), number, arrival="ts")
        if number == 1:
            table.compact()
    return table.read()


class _Interrupted(KeyedTable):
    """Writes like its parent, but is lost before the list says so."""

    def _commit(self, state):
        raise InterruptedError


def _event_batches(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    batch = F.when(F.col("event_type") == "click", 2).when(F.col("event_type") == "error", 1).otherwise(0)
    return [events.filter(batch == number) for number in (0, 1, 2)]


@query
def upsert_after_interrupted_compaction(spark, sf_dir):
    """The batches of ``upsert_latest``; a compaction is lost after each, and another one follows."""
    root = shared_dir(spark, "upsert")
    # Segments by event: each later batch moves its users to other segments.
    spec = replace(EVENT_STATE, segment="event_id % 7")
    table, lost = KeyedTable(spark, root, spec), _Interrupted(spark, root, spec)
    for number, events in enumerate(_event_batches(spark, sf_dir)):
        table.upsert(events, number, arrival="ts")
        with contextlib.suppress(InterruptedError):
            lost.compact()
        if number != 1:
            table.compact()
    return table.read()


@query
def upsert_two_writers(spark, sf_dir):
    """The same batches by three writers that all count from 0; the first runs its own again."""
    table = KeyedTable(spark, shared_dir(spark, "upsert"), EVENT_STATE)
    batches = _event_batches(spark, sf_dir)
    for number, events in enumerate(batches):
        table.upsert(events, 0, arrival="ts", writer=f"writer {number}")
    table.upsert(batches[0], 0, arrival="ts", writer="writer 0")
    table.compact()
    table.upsert(batches[1], 0, arrival="ts", writer="writer 1")
    table.retire(keep=1)
    return table.read()


@query
def upsert_late_batch(spark, sf_dir):
    """The second batch first and folded, then the first one, late; both again change nothing."""
    table = KeyedTable(spark, shared_dir(spark, "upsert"), EVENT_STATE)
    batches = _event_batches(spark, sf_dir)
    for number in (1, 0, 1, 2, 0):
        table.upsert(batches[number], number, arrival="ts")
        if number < 2:
            table.compact()
    return table.read()


@query
def upsert_pruned_compaction(spark, sf_dir):
    """The batches of ``upsert_latest`` in segments of a thousand events, folded after each: of the base only segments
    whose key summary can hold a changed user are looked at."""
    spec = replace(EVENT_STATE, segment="event_id div 1000", segment_column="event_id")
    table = KeyedTable(spark, shared_dir(spark, "upsert"), spec)
    for number, events in enumerate(_event_batches(spark, sf_dir)):
        table.upsert(events, number, arrival="ts")
        table.compact()
    return table.read()


@query
def lookup_current_rows(spark, sf_dir):
    """The current rows of the users that ever met an error, by key; the last batch is not folded yet."""
    spec = replace(EVENT_STATE, segment="event_id div 1000", segment_column="event_id")
    table = KeyedTable(spark, shared_dir(spark, "upsert"), spec)
    for number, events in enumerate(_event_batches(spark, sf_dir)):
        table.upsert(events, number, arrival="ts")
        if number < 2:
            table.compact()
    return table.lookup(views.table(spark, sf_dir, "events").filter("event_type = 'error'"))


@query
def maintained_counts(spark, sf_dir):
    """Users by the type of their last event, brought up to date after each batch by the rows that changed."""
    spec = replace(EVENT_STATE, segment="event_id div 1000", segment_column="event_id")
    table = KeyedTable(spark, shared_dir(spark, "upsert"), spec)
    counts = MaintainedCounts(table, ["event_type"], "users")
    for number, events in enumerate(_event_batches(spark, sf_dir)):
        table.upsert(events, number, arrival="ts")
        counts.refresh()
        if number < 2:
            table.compact()
    return counts.refresh()


@query
def active_per_window(spark, sf_dir):
    """Landed observations as a stream: flights in the air per airline at the end of each 90 days.  An order is an
    observation of its customer; a last one, years later, closes all windows."""
    root = shared_dir(spark, "windows")
    flights = views.flights(spark, sf_dir, model=False).select(F.col("origin_airport_iata").alias("id"), "airline_iata", "on_ground", "time", F.expr("bigint(id)").alias("seq"))
    flights.write.json(f"{root}/landed")
    _landed_end(flights, f"{root}/landed")
    seen = landed_observations(spark, f"{root}/landed", flights.schema)
    counts = active_per_window_stream(seen, views.airlines(spark, sf_dir), ACTIVE, "0 seconds", ("seq",))
    return _drained(counts, root)


def _landed_end(flights: DataFrame, path: str) -> None:
    """One more record, ten years after the last, that lets a stream's watermark pass all others."""
    spark, kinds = flights.sparkSession, flights.schema
    last = [AS_OF + 10 * 365 * 86400 if f.name == "time" else "end" if f.name == "id" else None for f in kinds]
    spark.createDataFrame([tuple(last)], kinds).write.mode("append").json(path)


def _drained(stream: DataFrame, root: str) -> DataFrame:
    """All that a stream gives for what has landed."""
    stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


@query
def flights_with_details(spark, sf_dir):
    """Two landed streams: orders, and details of three in four of them, some within a day and some too late."""
    root = shared_dir(spark, "details")
    flights = views.flights(spark, sf_dir).select("id", "time", "aircraft_model", F.expr("bigint(id)").alias("n"))
    listed = flights.select("id", "time")
    late = F.expr("int(n % 7) * 21600")
    details = flights.filter("n % 4 > 0").select("id", (F.col("time") + late).cast("int").alias("time"), "aircraft_model")
    for rows, name in ((listed, "listed"), (details, "details")):
        rows.write.json(f"{root}/{name}")
        _landed_end(rows, f"{root}/{name}")
    met = with_details(
        landed_observations(spark, f"{root}/listed", listed.schema), landed_observations(spark, f"{root}/details", details.schema),
        wait=86400, delay="0 seconds",
    )
    return _drained(met, root).filter("id <> 'end'")


@query
def upsert_new_checkpoint(spark, sf_dir):
    """``ingest_flights`` from a new checkpoint after a compaction: its batches, again from 0, count."""
    root = shared_dir(spark, "ingest")
    # The sample orders span years: stored by quarters rather than days.
    table = KeyedTable(spark, root, replace(FLIGHT, segment=f"coalesce(time div {ACTIVE}, -1)"))
    for n, keep in enumerate(("o_orderkey % 2 = 0", "true")):
        orders, lines, part = _order_stream(spark, sf_dir)
        ingest(
            _messages(orders.filter(keep), lines, part), table, f"{root}/checkpoint-{n}", trigger={"availableNow": True},
            partitions=spark.sparkContext.defaultParallelism, compact_every=1,
        ).awaitTermination()
    return table.read().select("id", "airline_iata", "airline_icao", "altitude", "on_ground", "time", "aircraft_model")


@query
def ingest_resumed(spark, sf_dir):
    """Landed message files: each customer's first order, a stop, then the last orders from the same
    checkpoint.  Within a file a customer stands once."""
    root = shared_dir(spark, "ingest")
    table = KeyedTable(spark, root, FLIGHT)
    orders = views.table(spark, sf_dir, "orders")
    ends = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))
    lines, part = views.first_lines(spark, sf_dir), views.table(spark, sf_dir, "part")
    for end in ("first", "last"):
        these = orders.join(ends.select(F.col(end).alias("o_orderkey")), "o_orderkey", "left_semi")
        sent = _messages(these, lines, part).select(F.col("value").cast("string").alias("value"))
        sent.write.mode("append").text(f"{root}/messages")
        ingest(
            landed_messages(spark, f"{root}/messages"), table, f"{root}/checkpoint", trigger={"availableNow": True}
        ).awaitTermination()
    return table.read().select("id", "airline_iata", "altitude", "on_ground", "time", "aircraft_model")


@query
def ingest_topic(spark, sf_dir):
    """The messages of ``ingest_flights`` landed as a topic of eight partitions, read by offsets in bounded batches:
    a first batch, a stop, then the rest from the same checkpoint."""
    root = shared_dir(spark, "topic")
    orders = views.table(spark, sf_dir, "orders")
    sent = _messages(orders, views.first_lines(spark, sf_dir), views.table(spark, sf_dir, "part"))
    part = F.col("o_custkey") % 8
    offset = F.row_number().over(Window.partitionBy(part).orderBy("o_orderkey")) - 1
    places = orders.select("o_orderkey", part.alias("partition"), offset.alias("offset"))
    topic = sent.join(places, F.col("arrival") == F.col("o_orderkey")).withColumn("timestamp", F.timestamp_seconds("o_orderkey"))
    land_topic(topic, f"{root}/topic", per_file=2000)
    table = KeyedTable(spark, root, FLIGHT)
    limit = {"maxOffsetsPerTrigger": max(1, orders.count() // 3), "checkpoint": f"{root}/checkpoint"}
    for trigger in ({"availableNow": True}, {"processingTime": "0 seconds"}):
        stream = ingest(topic_messages(spark, f"{root}/topic", **limit), table, f"{root}/checkpoint", trigger=trigger)
        try:
            stream.processAllAvailable() if "processingTime" in trigger else stream.awaitTermination()
        finally:
            stream.stop()
    return table.read().select("id", "airline_iata", "airline_icao", "altitude", "on_ground", "time", "aircraft_model")


@query
def publish_landed(spark, sf_dir):
    """Observations landed as JSON records, streamed from there to messages."""
    root = shared_dir(spark, "publish")
    views.flights(spark, sf_dir).write.json(f"{root}/landed")
    seen = landed_observations(spark, f"{root}/landed", FLIGHT.schema)
    publish(
        seen, f"{root}/checkpoint", format="text", trigger={"availableNow": True}, path=f"{root}/messages"
    ).awaitTermination()
    return spark.read.schema("value string").text(f"{root}/messages")


@query
def jobs_after_each_batch(spark, sf_dir):
    """The first job over the state that a stream has just brought up to date."""
    root = shared_dir(spark, "ingest")
    table, airlines = KeyedTable(spark, root, FLIGHT), views.airlines(spark, sf_dir)

    def report(state: KeyedTable, batch_id: int) -> None:
        found = jobs.most_flights_in_progress(state.read(), airlines, AS_OF, ACTIVE)
        found.write.mode("overwrite").parquet(f"{root}/report")

    ingest(
        _messages(*_order_stream(spark, sf_dir)), table, f"{root}/checkpoint", trigger={"availableNow": True},
        partitions=spark.sparkContext.defaultParallelism, after_batch=report,
    ).awaitTermination()
    return spark.read.parquet(f"{root}/report")


@query
def topic_offset_order(spark, sf_dir):
    """Events as rows of a topic with stamps that run backwards: offsets decide in a partition."""
    events = views.table(spark, sf_dir, "events")
    raw = events.select(
        F.col("event_id").cast("string").cast("binary").alias("value"),
        F.expr(f"timestamp_seconds({views.epoch('ts')} - (event_id * 37 % 1000) * 60)").alias("timestamp"),
        F.expr("int(user_id % 4)").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    ordered = in_batch(topic_arrival(raw))
    return ordered.select(
        F.col("value").cast("string").cast("long").alias("event_id"), F.unix_timestamp("arrival.timestamp").alias("arrived")
    )


@query
def landed_airline_feed(spark, sf_dir):
    """The airline feed as landed JSON records, and the countries as stored reference lines."""
    root = shared_dir(spark, "feed")
    _airline_feed(spark, sf_dir).write.json(f"{root}/feed")
    write_reference(_airline_reference(spark, sf_dir), f"{root}/reference", "key", "value")
    feed = read_feed(spark, f"{root}/feed", "ICAO string, Code string, Name string")
    countries = refdata.reference_countries(read_reference(spark, f"{root}/reference", "map<string, string>"))
    table = KeyedTable(spark, root, AIRLINE)
    table.upsert(refdata.load_airlines(feed, countries), arrival="_arrival")
    return table.read()


@query
def landed_airport_feed(spark, sf_dir):
    """The airport feed as landed JSON records, read, given its continents and stored."""
    root = shared_dir(spark, "feed")
    feed = views.airports(spark, sf_dir).drop("continent")
    renamed = feed.select(*[F.col(c).alias(c.capitalize()) for c in feed.columns])
    renamed.write.json(f"{root}/feed")
    landed = read_feed(spark, f"{root}/feed", renamed.schema)
    table = KeyedTable(spark, root, AIRPORT)
    table.upsert(refdata.load_airports(records.lower_names(landed), override_continents(spark), _standard(spark, sf_dir)), arrival="_arrival")
    return table.read()


@query
def reference_objects(spark, sf_dir):
    """Legacy reference files of one JSON object each, and their lines read back."""
    root = shared_dir(spark, "reference")
    entry = F.create_map(F.lit("name"), F.col("s_name"), F.lit("country"), F.col("n_name"))
    suppliers = views.table(spark, sf_dir, "supplier").join(
        views.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    objects = suppliers.select(F.to_json(F.create_map(F.col("s_suppkey").cast("string"), entry)).alias("value"))
    # By number: each row becomes a file, so it is not their bytes that count.
    objects = objects.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    objects.write.option("maxRecordsPerFile", 1).text(f"{root}/objects")
    found = read_reference_object(spark, f"{root}/objects", "map<string, string>")
    write_reference(found, f"{root}/lines", "key", "value")
    lines = read_reference(spark, f"{root}/lines", "map<string, string>")
    return lines.select(F.col("key").alias("icao"), F.col("value")["name"].alias("name"), F.col("value")["country"].alias("country"))


@query
def reference_large_object(spark, sf_dir):
    """The suppliers as members of one JSON object in one file, read by many tasks; names hold commas, braces and quotes."""
    root = shared_dir(spark, "object")
    suppliers = views.table(spark, sf_dir, "supplier").join(views.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    name = F.concat("s_name", F.lit(', "{[\\'))
    entry = F.create_map(F.lit("name"), name, F.lit("country"), F.col("n_name"))
    member = F.to_json(F.create_map(F.col("s_suppkey").cast("string"), entry))
    # Joined by commas, without the braces around each: written as one file, as such files come.
    members = suppliers.select(F.substring(member, F.lit(2), F.length(member) - 2).alias("value"))
    whole = members.agg(F.array_join(F.collect_list("value"), ", ").alias("value"))
    whole.select(F.concat(F.lit("{"), "value", F.lit("}")).alias("value")).write.text(f"{root}/object")
    found = read_large_object(spark, f"{root}/object", "map<string, string>")
    return found.select(F.col("key").alias("icao"), F.col("value")["name"].alias("name"), F.col("value")["country"].alias("country"))


@query
def upsert_airports(spark, sf_dir):
    """The airport load, stored twice."""
    table = KeyedTable(spark, shared_dir(spark, "airport"), AIRPORT)
    for _ in range(2):
        table.upsert(load_airports(spark, sf_dir))
    table.compact()
    return table.read()


@query
def catalog_views(spark, sf_dir):
    """Catalog views created before the data, read by SQL after upserts and a compaction."""
    warehouse = Warehouse(spark, shared_dir(spark, "catalog"), segment_seconds=4 * ACTIVE)
    warehouse.create_catalog()
    flights = views.flights(spark, sf_dir)
    warehouse.airline.upsert(views.airlines(spark, sf_dir))
    warehouse.airport.upsert(views.airports(spark, sf_dir))
    warehouse.flight.upsert(flights.filter("bigint(id) % 3 > 0"))
    warehouse.flight.compact()
    warehouse.flight.upsert(flights.filter("bigint(id) % 3 < 2"))
    warehouse.snapshots["most_active_flights_per_builder"].append(
        jobs.most_active_flights_per_builder(warehouse.flight.read()), 1, views.instant(AS_OF)
    )
    current = spark.sql(
        """SELECT a.name AS airline, count(*) AS flights, count(DISTINCT p.icao) AS airports FROM raw_data.flight f
        JOIN raw_data.airline a ON f.airline_icao = a.icao LEFT JOIN raw_data.airport p ON p.iata = f.origin_airport_iata
        GROUP BY a.name
        UNION ALL SELECT concat('builder ', builder), flight_count, batch_id FROM analytics_data.most_active_flights_per_builder"""
    )
    return current


@query
def json_refused(spark, sf_dir):
    """Why messages are refused: other than JSON, a member that is absent, one of the wrong type, a NULL key."""
    kind = F.col("event_id") % 6
    value = (
        F.when(kind == 0, F.concat(F.lit("[1, "), F.col("props"), F.lit("]")))
        .when(kind == 1, F.concat(F.lit('{"other": '), F.col("event_id"), F.lit("}")))
        .when(kind == 2, F.concat(F.lit('{"k": "x", "id": '), F.col("event_id"), F.lit("}")))
        .when(kind == 3, F.lit('{"k": 1, "id": null}'))
        .when(kind == 4, F.lit("event"))
        .otherwise(F.concat(F.lit('{"k": null, "id": '), F.col("event_id"), F.lit("}")))
    )
    messages = views.table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    schema = StructType([StructField("id", LongType(), False), StructField("k", IntegerType())])
    return decode(messages, schema).select("event_id", "id", "k", "_reason")


EVENT_NEWEST = KeyedSpec(
    "raw_data",
    "event_newest",
    StructType([*EVENT_STATE.schema.fields, StructField("seen", IntegerType())]),
    key="user_id",
)


@query
def upsert_event_time(spark, sf_dir):
    """The same batches, but the event with the greatest time wins."""
    table = KeyedTable(spark, shared_dir(spark, "upsert"), EVENT_NEWEST, order_by=("seen", "event_id"))
    events = views.table(spark, sf_dir, "events").withColumn("seen", F.expr(views.epoch("ts")))
    batch = F.when(F.col("event_type") == "click", 2).when(F.col("event_type") == "error", 1).otherwise(0)
    for number in (0, 1, 2):
        table.upsert(events.filter(batch == number), number)
        if number == 1:
            table.compact()
    return table.read()


@query
def snapshot_append(spark, sf_dir):
    """Two batches of counts appended, the second written twice."""
    spec = SnapshotSpec(
        "analytics_data",
        "events_per_type",
        StructType([StructField("event_type", StringType()), StructField("event_count", IntegerType())]),
    )
    table = SnapshotTable(spark, shared_dir(spark, "snapshot"), spec)
    counts = views.table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("event_count"))
    for batch_id, as_of in ((1, EARLIER), (2, AS_OF), (2, AS_OF)):
        table.append(counts, batch_id, views.instant(as_of))
    return table.read().select("event_type", "event_count", F.unix_timestamp("created_at").alias("stamp"), "batch_id")


@query
def snapshot_ids(spark, sf_dir):
    """Ids of a stored result count its rows from 1 in its order."""
    spec = SnapshotSpec("analytics_data", "orders", StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType())]))
    table = SnapshotTable(spark, shared_dir(spark, "snapshot"), spec)
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    table.append(orders.orderBy(F.desc("o_custkey"), "o_orderkey"), 1, views.instant(AS_OF))
    return table.read().select("id", "o_orderkey")


@query
def last_wins_per_key(spark, sf_dir):
    """The last page wins: keys repeat over the supplier pages, in integer order of the page."""
    pages = views.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("page_id"), (F.col("s_suppkey") % 60).alias("code"), "s_name"
    )
    return keyed.latest_per_key(pages, "code", ["page_id"])


@query
def distinct_count(spark, sf_dir):
    return views.flights(spark, sf_dir, model=False).groupBy("airline_icao").agg(
        F.count_distinct("origin_airport_iata").cast("int").alias("origins"),
        F.count("airline_iata").cast("int").alias("with_code"),
    )


@query
def distinct_count_sketched(spark, sf_dir):
    """Origins per airline over eight stored batches of sketches, against the exact count; a group of a few values is exact."""
    flights = views.flights(spark, sf_dir, model=False)
    path = shared_dir(spark, "sketches")
    batch = F.expr("int(bigint(id) % 8)").alias("batch")
    sketches.sketched(flights.select("airline_icao", "origin_airport_iata", batch), ["batch", "airline_icao"], "origin_airport_iata").write.parquet(path)
    about = sketches.united(spark.read.parquet(path), ["airline_icao"], "about")
    exact = flights.groupBy("airline_icao").agg(F.count_distinct("origin_airport_iata").alias("origins"))
    near = F.abs(F.col("about") - F.col("origins")) <= 4 * sketches.relative_error() * F.col("origins") + 1
    met = about.join(exact.withColumnRenamed("airline_icao", "_code"), F.col("airline_icao").eqNullSafe(F.col("_code")))
    return met.select("airline_icao", "origins", near.alias("within"))


@query
def mean_half_even(spark, sf_dir):
    return views.flights(spark, sf_dir, model=False).groupBy("airline_iata").agg(
        half_even_int(F.avg(F.col("altitude").cast("float"))).alias("mean_altitude")
    )


@query
def conform_types(spark, sf_dir):
    """Half prices assigned to whole numbers, counts narrowed, lengths and NULLs checked."""
    schema = StructType(
        [
            StructField("p_partkey", IntegerType(), False),
            StructField("half", IntegerType()),
            StructField("size", IntegerType()),
            StructField("p_name", StringType(), False),
        ]
    )
    parts = views.table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") / 2).alias("half"), F.col("p_size").cast("long").alias("size"), "p_name"
    )
    return conform(parts, schema)


@query
def null_policy(spark, sf_dir):
    """Airports that lack a required coordinate."""
    rejects = split_nulls(views.airports(spark, sf_dir), ["latitude", "longitude"])[1]
    return rejects.select("icao", "name")


@query
def json_projection(spark, sf_dir):
    """Properties of events as JSON messages: a member kept, one that is absent, and the type check."""
    events = views.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    good = decode(events, StructType([StructField("k", IntegerType())]))
    return good.select("event_id", "k", "_reason")


@query
def json_messages(spark, sf_dir):
    return to_messages(views.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")).union(
        to_messages(views.airlines(spark, sf_dir))
    )


@query
def lower_case_public_columns(spark, sf_dir):
    feed = _airline_feed(spark, sf_dir).withColumn("_internal", F.lit(1))
    return records.project(records.public_columns(records.lower_names(feed)), ["icao", "code", "name"])


@query
def split_part_first_word(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", first_word("p_name").alias("builder"))


@query
def colon_field(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select(
        "page_id", field_after("url").alias("after_colon"), field_after("url", "?").alias("after_question")
    )


@query
def strip_whitespace(spark, sf_dir):
    padded = F.concat(F.lit(" \t\n"), "c_name", F.lit("\r\n  "))
    return views.table(spark, sf_dir, "customer").select("c_custkey", strip(padded).alias("name"))


@query
def flatten_cells(spark, sf_dir):
    cells = _cells(spark, sf_dir).select("page_id", non_empty_cells("rows").alias("cells"))
    return cells.select(
        "page_id", F.size("cells").alias("cell_count"), F.get("cells", F.lit(3)).alias("fourth")
    )


@query
def window_threshold(spark, sf_dir):
    """Start of a 600 s window before each event, rounded to whole seconds."""
    fraction = F.date_part(F.lit("SECOND"), "ts") - F.second("ts")
    stamp = F.timestamp_micros(F.expr(views.epoch("ts")).cast("long") * 1000000 + (fraction * 1000000).cast("long"))
    return views.table(spark, sf_dir, "events").select("event_id", window_start(stamp, 600).alias("threshold"))


@query
def geodesic_sphere(spark, sf_dir):
    return _pairs(spark, sf_dir, "sphere")


@query
def geodesic_spheroid(spark, sf_dir):
    return _pairs(spark, sf_dir, "spheroid")


def _pairs(spark, sf_dir, method):
    """From each airport's place to a place derived from its altitude."""
    lat2, lon2 = (F.col("altitude") % 90).cast("double"), (F.col("altitude") % 150).cast("double") - 75
    return views.airports(spark, sf_dir).select(
        "icao", F.round(geodesic_km("latitude", "longitude", lat2, lon2, method), 3).alias("km")
    )
