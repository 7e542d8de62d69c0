"""Reference data and dimension loads J9-J12."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions.country import built_in_continents, override_continents
from skytally.functions.text import field_after, non_empty_cells
from skytally.operators.keyed import latest_per_key
from skytally.operators.lookup import first_of, with_default
from skytally.operators.records import lower_names, project, public_columns
from skytally.schemas import AIRLINE, AIRPORT
from skytally.sources.pages import DETAILS_CLASS, extract_tables


def load_airlines(feed: DataFrame, countries: DataFrame) -> DataFrame:
    """Airline feed (names in any case) with the country of its ICAO code.

    ``countries`` is (icao, country), one row per code that has a country entry.
    """
    named = with_default(lower_names(feed), countries, "icao", "country", "Unknown")
    return project(named, _kept(named, AIRLINE.schema.fieldNames()))


def load_airports(
    feed: DataFrame,
    overrides: DataFrame | None = None,
    standard: DataFrame | None = None,
    on_unknown: str = "fail",
) -> DataFrame:
    """Airport feed with the continent of its country; the override table wins.

    Without tables of one's own the built-in ones hold.
    """
    spark = feed.sparkSession
    overrides = override_continents(spark) if overrides is None else overrides
    standard = built_in_continents(spark) if standard is None else standard
    arrival = [c for c in feed.columns if c == "_arrival"]
    public = feed.select(*public_columns(feed).columns, *arrival)
    placed = first_of(public, [overrides, standard], "country", "continent", on_unknown)
    return project(placed, _kept(placed, AIRPORT.schema.fieldNames()))


def clean_airline_countries(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cell rows per page to (icao, name, country), and the pages that cannot be read so.

    Of the page's non-empty cells the first is the name, the fourth and eighth hold the ICAO code
    and the country after a colon.  A page with an empty code is left out; of pages with the same
    code the highest page id counts.
    """
    cells = non_empty_cells("rows")
    fields = pages.select("page_id", "rows", cells.alias("cells")).select(
        "page_id",
        "rows",
        F.get("cells", F.lit(0)).alias("name"),
        field_after(F.get("cells", F.lit(3))).alias("icao"),
        field_after(F.get("cells", F.lit(7))).alias("country"),
    )
    readable = F.col("icao").isNotNull() & ((F.col("icao") == "") | F.col("country").isNotNull())
    good = fields.filter(readable & (F.col("icao") != "")).select("page_id", "icao", "name", "country")
    clean = latest_per_key(good, "icao", ["page_id"]).select("icao", "name", "country")
    return clean, fields.filter(~readable).select("page_id", "rows")


def extract_page_tables(pages: DataFrame, wanted: str = DETAILS_CLASS) -> DataFrame:
    """Raw pages to rows of cells."""
    return extract_tables(pages, wanted)


def _kept(df: DataFrame, columns: list[str]) -> list[str]:
    return columns + [c for c in df.columns if c == "_arrival"]


def reference_countries(reference: DataFrame) -> DataFrame:
    """(icao, country) of the cleaned reference (key, value map) where an entry has a country."""
    return reference.filter(F.map_contains_key("value", "country")).select(
        F.col("key").alias("icao"), F.col("value")["country"].alias("country")
    )


def reference_entries(clean: DataFrame) -> DataFrame:
    """(icao, value map) as stored by ``write_reference``."""
    value = F.create_map(F.lit("name"), F.col("name"), F.lit("country"), F.col("country"))
    return clean.select("icao", value.alias("value"))
