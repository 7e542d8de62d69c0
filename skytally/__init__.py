"""Air-traffic analytics on Spark: streaming upsert, dimension loads and snapshot queries."""

from skytally.plans.jobs import (
    aircraft_model_per_airline_country,
    airline_with_most_active_flights_per_continent,
    airport_and_zone_transition,
    average_flight_distance_per_continent,
    current_longest_flight,
    most_active_flights_per_builder,
    most_flights_in_progress,
    top_airlines_per_continent,
    top_models_per_country,
)
from skytally.plans.pipeline import Warehouse, run_all
from skytally.plans.refdata import (
    clean_airline_countries,
    extract_page_tables,
    load_airlines,
    load_airports,
    reference_countries,
    reference_entries,
)
from skytally.session import build_session
from skytally.streaming.ingest import ingest, publish

__all__ = [
    "Warehouse",
    "aircraft_model_per_airline_country",
    "airline_with_most_active_flights_per_continent",
    "airport_and_zone_transition",
    "average_flight_distance_per_continent",
    "build_session",
    "clean_airline_countries",
    "current_longest_flight",
    "extract_page_tables",
    "ingest",
    "load_airlines",
    "load_airports",
    "most_active_flights_per_builder",
    "most_flights_in_progress",
    "publish",
    "reference_countries",
    "reference_entries",
    "run_all",
    "top_airlines_per_continent",
    "top_models_per_country",
]
