"""Stateful streams over observations: active flights per window, and flights with their details.

Both emit a row once the watermark says that nothing more can change it, in append mode; state that the watermark
has passed is dropped.  A restart goes on from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.operators.lookup import fan_out


def active_per_window(
    observations: DataFrame, airlines: DataFrame | None = None, seconds: int = 600, delay: str = "60 seconds", order: tuple[str, ...] = ()
) -> DataFrame:
    """J1 at the end of each window of so many seconds: (as_of, airline_code, [airline_name,] flight_count).

    Of a flight's observations in the window the one with the greatest ``time`` counts (ties: by ``order``), if it is in
    the air and has an airline code.  An observation belongs to the window that ends at or after it, as in J1 a
    row exactly ``seconds`` old is out.  Observations that come later than ``delay`` after newer ones are left out.
    """
    seen = observations.select(
        "id", "airline_iata", "on_ground", "time", *order, F.timestamp_seconds(F.col("time") - 1).alias("_at")
    ).withWatermark("_at", delay)
    newest = F.max_by(F.struct("airline_iata", "on_ground"), F.struct("time", *order, "airline_iata", "on_ground"))
    last = seen.groupBy(F.window("_at", f"{seconds} seconds"), "id").agg(newest.alias("last"))
    flying = last.filter((F.col("last.on_ground") == 0) & (F.col("last.airline_iata") != ""))
    counts = flying.groupBy("window", F.col("last.airline_iata").alias("airline_code")).agg(F.count("*").cast("int").alias("flight_count"))
    counts = counts.select(F.unix_timestamp("window.end").alias("as_of"), "airline_code", "flight_count")
    if airlines is None:
        return counts
    names = airlines.select("code", F.col("name").alias("airline_name")).distinct()
    return fan_out(counts, names, "airline_code", "code", "left")


def with_details(listed: DataFrame, details: DataFrame, wait: int = 300, delay: str = "60 seconds") -> DataFrame:
    """A stream of listed flights, each with the details that come for it within ``wait`` seconds.

    ``listed`` has id and time, ``details`` id, time and further columns, which are NULL where no details came in time;
    such a flight is emitted once the watermarks of both streams are past its wait.  Several details give several rows.
    """
    left = listed.withColumn("_listed", F.timestamp_seconds("time")).withWatermark("_listed", delay)
    own = [c for c in details.columns if c not in ("id", "time")]
    right = details.select(F.col("id").alias("_id"), F.timestamp_seconds("time").alias("_told"), *own).withWatermark("_told", delay)
    met = (
        (F.col("id") == F.col("_id"))
        & (F.col("_told") >= F.col("_listed"))
        & (F.col("_told") <= F.col("_listed") + F.expr(f"INTERVAL {wait} SECONDS"))
    )
    return left.join(right, met, "left_outer").select(*listed.columns, *own)
