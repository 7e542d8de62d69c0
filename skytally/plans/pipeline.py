"""The warehouse of all tables, and one run of all snapshot jobs over it."""

from __future__ import annotations

import math
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally import schemas
from skytally.operators.counts import MaintainedCounts
from skytally.operators.filters import recent
from skytally.operators.tables import KeyedTable, SnapshotTable
from skytally.plans import jobs
from skytally.session import shared_dir

TRANSITION = schemas.AIRPORT_AND_ZONE_TRANSITION.name


class Warehouse:
    def __init__(
        self, spark: SparkSession, root: str, order_by: tuple[str, ...] = (), segment_seconds: int = 86400
    ):
        """``order_by`` makes the flight table keep the row with the greatest value, not the last arrival.

        Flights are stored by the day of their last observation, or another span: updates meet the
        newest spans, and the others are left alone.  Keep the span as the table was begun with.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.segment_seconds = segment_seconds
        flight = replace(schemas.FLIGHT, segment=f"coalesce(time div {segment_seconds}, -1)")
        self.flight = KeyedTable(spark, root, flight, order_by)
        self.airline = KeyedTable(spark, root, schemas.AIRLINE)
        self.airport = KeyedTable(spark, root, schemas.AIRPORT)
        self.snapshots = {s.name: SnapshotTable(spark, root, s) for s in schemas.SNAPSHOTS}
        self.seen = KeyedTable(spark, root, schemas.TRANSITION_SEEN)
        # What J3 and J7 need of the flights, kept up to date by the batches that came since the last run.
        self.per_model = MaintainedCounts(self.flight, ["airline_icao", "aircraft_model"], "flights")

    def create_catalog(self) -> None:
        """Create the three databases, and in them a view of every table for SQL users.

        The tables keep the views in this session's catalog up to date from then on (see ``publish``).
        """
        for database in ("raw_data", "processed_data", "analytics_data"):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for table in (self.flight, self.airline, self.airport, *self.snapshots.values()):
            table.publish(f"{table.spec.database}.{table.spec.name}")

    def register_views(self) -> None:
        """Temporary views flight, airline, airport over the current rows, and one per snapshot history."""
        for table in (self.flight, self.airline, self.airport):
            table.read().createOrReplaceTempView(table.spec.name)
        for name, table in self.snapshots.items():
            table.read().createOrReplaceTempView(name)


def first_transitions(warehouse: Warehouse, ids: DataFrame, compact_every: int = 24) -> DataFrame:
    """(flight_id, first_seen): the second of the first stored run with a transition of each of the flights, if any.

    The index is complete before it is asked: a warehouse whose history is older than its index gets one
    from the whole history, once.
    """
    seen = warehouse.seen
    if not seen.exists():
        history = warehouse.snapshots[TRANSITION].read()
        first = F.floor(F.min(F.coalesce(F.col("created_at").cast("double"), F.lit(0.0)))).cast("long")
        seen.upsert(history.filter("flight_id IS NOT NULL").groupBy("flight_id").agg(first.alias("first_seen")))
        seen.compact()
    elif seen.pending() >= compact_every:
        seen.compact()
    return seen.lookup(ids)


def run_all(
    warehouse: Warehouse,
    as_of: int,
    batch_id: int | None = None,
    created_at: datetime | None = None,
    active_seconds: int = 600,
    transition_seconds: int = 300,
    method: str = "spheroid",
    replay: bool = False,
    on_null: str = "fail",
) -> dict[str, DataFrame]:
    """Run J1-J8 once for the clock ``as_of`` and store the results as batch ``batch_id``.

    The transitions are stored first and the jobs that need them read the stored history, so they
    are computed once per run; of the history only runs since the first that holds an active flight.  A batch run again, after a failure or by mistake, replaces itself.
    ``replay`` bounds all windows at the clock, for runs that are done later; the flights are still as they
    are now, so a flight observed again since then is missing from a replay.
    A NULL where J3 requires a value fails the run, or with ``on_null="quarantine"`` is stored aside.
    Returns the stored batch of each table, and the two rankings.
    """
    batch_id = as_of if batch_id is None else batch_id
    created_at = created_at or datetime.fromtimestamp(as_of, timezone.utc)
    spark = warehouse.spark
    airlines, airports = warehouse.airline.read(), warehouse.airport.read()

    def kept(rows: DataFrame, purpose: str) -> DataFrame:
        path = shared_dir(spark, purpose)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    # The deltas are laid over the base once for all jobs with a window, which need only the days it touches (a
    # second more, as its start is rounded).  Those without a window need counts that are maintained.
    start = as_of - max(active_seconds, transition_seconds) - 1
    lately = warehouse.flight.read(since=start // warehouse.segment_seconds).filter(F.col("time") >= start)
    lately = kept(
        lately.select(
            "id", "airline_iata", "airline_icao", "origin_airport_iata", "destination_airport_iata", "on_ground", "time"
        ),
        "lately",
    )
    per_model = warehouse.per_model.refresh()
    done = {}

    def store(name: str, result: DataFrame) -> DataFrame:
        warehouse.snapshots[name].append(result, batch_id, created_at)
        done[name] = warehouse.snapshots[name].batch(batch_id)
        return done[name]

    # Few rows of a long scan: merge them into files of a fair size.
    moves = jobs.airport_and_zone_transition(lately, airports, as_of, transition_seconds, method, replay)
    moves = kept(moves.hint("rebalance"), "transitions")
    # The index knows the batch's flights before the batch is there: a run that breaks off in between leaves
    # a bound that is too low, never one that is too high.
    now = math.floor(created_at.timestamp())
    first = kept(first_transitions(warehouse, lately.select(F.col("id").alias("flight_id"))), "first-seen")
    fresh = moves.select("flight_id").filter("flight_id IS NOT NULL").distinct().join(first, "flight_id", "left")
    fresh = fresh.filter(F.col("first_seen").isNull() | (F.col("first_seen") > now))
    warehouse.seen.upsert(fresh.select("flight_id", F.lit(now).cast("long").alias("first_seen")))
    own = store(TRANSITION, moves)
    # The history that J4 and J5 read begins with the first run that holds a flight still active now; folders of
    # earlier runs are not opened.
    active = recent(lately, as_of, active_seconds, replay=replay).select(F.col("id").alias("flight_id"))
    since = first.join(active, "flight_id", "left_semi").agg(F.min("first_seen")).first()[0]
    since = now if since is None else min(since, now)
    # Runs that came later don't count, so that a run done again gives what it gave.
    earlier = F.col("created_at").isNull() | (F.col("created_at") <= F.lit(created_at))
    history = warehouse.snapshots[TRANSITION].read(since=since).filter(earlier)
    store(
        "most_flights_in_progress",
        jobs.most_flights_in_progress(lately, airlines, as_of, active_seconds, replay=replay),
    )
    models = jobs.aircraft_model_per_airline_country(per_model, airlines, on_null)
    if on_null == "quarantine":
        models, rejects = models
        rejects.write.mode("overwrite").parquet(
            f"{warehouse.snapshots['aircraft_model_per_airline_country'].path}_quarantine/batch_id={batch_id}"
        )
    models = store("aircraft_model_per_airline_country", models)
    per_continent = store(
        "airline_with_most_active_flights_per_continent",
        jobs.airline_with_most_active_flights_per_continent(
            history, airlines, lately, as_of, active_seconds, replay
        ),
    )
    store(
        "average_flight_distance_per_continent",
        jobs.average_flight_distance_per_continent(history, lately, as_of, active_seconds, replay),
    )
    # The newest batch with rows is this run's, unless it has none.
    newest = warehouse.snapshots[TRANSITION].read().filter(earlier) if own.isEmpty() else own
    store("current_longest_flight", jobs.current_longest_flight(newest))
    store("most_active_flights_per_builder", jobs.most_active_flights_per_builder(per_model))
    done["top_models_per_country"] = jobs.top_models_per_country(models)
    done["top_airlines_per_continent"] = jobs.top_airlines_per_continent(per_continent)
    return done
