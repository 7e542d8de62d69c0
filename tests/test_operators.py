from __future__ import annotations

import pytest
from conftest import AS_OF, rows
from pyspark.sql import functions as F
from pyspark.sql.types import (
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

from skytally.operators import filters, keyed, lookup, records
from skytally.operators.conform import conform, split_nulls


def test_recent_is_strict(flights):
    ids = {r["id"] for r in filters.recent(flights, AS_OF, 600).collect()}
    assert ids == {"f1", "f3", "f4", "f5", "f6", "f7"}
    assert filters.recent(flights, 999900, 300, replay=True).count() == 2


def test_filters_drop_nulls(spark, flights):
    assert {r["airline_iata"] for r in filters.non_empty(flights, "airline_iata").collect()} == {"AA", "ZZ", "BB"}
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), (None, None)], "x string, y string")
    assert rows(filters.equal_columns(pairs, "x", "y")) == [("a", "a")]


def test_recency_filter_reaches_the_scan(spark, flights, tmp_path):
    flights.write.parquet(str(tmp_path / "f"))
    scan = filters.recent(spark.read.parquet(str(tmp_path / "f")), AS_OF, 600).select("id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(time,999400)" in plan
    assert "ReadSchema: struct<id:string,time:int>" in plan


def test_fan_out(spark):
    left = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "n int, k string")
    right = spark.createDataFrame([("a", 10), ("a", 11), ("b", 12)], "code string, v int")
    assert rows(lookup.fan_out(left, right, "k", "code")) == [(1, "a", 10), (1, "a", 11)]
    assert rows(lookup.fan_out(left, right, "k", "code", "left")) == [
        (1, "a", 10),
        (1, "a", 11),
        (2, "z", None),
        (3, None, None),
    ]


def test_default_is_for_a_missing_key_only(spark):
    feed = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "icao string")
    known = spark.createDataFrame([("A", "France"), ("B", ""), ("C", None)], "icao string, country string")
    assert rows(lookup.with_default(feed, known, "icao", "country", "Unknown")) == [
        ("A", "France"),
        ("B", ""),
        ("C", None),
        ("D", "Unknown"),
    ]


def test_first_table_wins(spark):
    feed = spark.createDataFrame([(1, "Hong Kong"), (2, "France"), (3, "Nowhere"), (4, None)], "n int, country string")
    first = spark.createDataFrame([("Hong Kong", "Asia")], "country string, continent string")
    second = spark.createDataFrame([("Hong Kong", "Europe"), ("France", "Europe")], "country string, continent string")
    found = lookup.first_of(feed, [first, second], "country", "continent", on_unknown="null")
    assert [r[2] for r in rows(found)] == ["Asia", "Europe", None, None]
    with pytest.raises(Exception, match="no continent for country Nowhere"):
        lookup.first_of(feed.filter("n <= 3"), [first, second], "country", "continent").collect()
    with pytest.raises(ValueError):
        lookup.first_of(feed, [first], "country", "continent", on_unknown="?")


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 9, "old"), ("a", 10, "new"), ("b", None, "x"), ("b", 1, "y")], "k string, seq int, v string"
    )
    assert rows(keyed.latest_per_key(df, "k", ["seq"])) == [("a", 10, "new"), ("b", 1, "y")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(0, 30000, 1, 8).select(key.alias("k"), "id")
    latest = keyed.latest_per_key(df, "k", ["id"])
    assert latest.count() == 20001
    assert latest.filter("k = -1").first()["id"] == 29997
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_distinct_on_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([("a", 1, "z"), ("a", 2, "x"), ("a", 2, "y")], "k string, t int, v string")
    assert rows(keyed.distinct_on(df, "k", "t")) == [("a", 2, "y")]


def test_descending_puts_nulls_first(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r[0] for r in keyed.top_rows(df, [keyed.descending("v")], 2).collect()] == [None, 2]
    assert [r[0] for r in keyed.top_rows(df, [keyed.descending("v", "last")], 2).collect()] == [2, 1]


TARGET = StructType(
    [
        StructField("n", IntegerType(), False),
        StructField("mean", IntegerType()),
        StructField("km", FloatType()),
        StructField("name", VarcharType(5)),
    ]
)


def source(spark, *row):
    return spark.createDataFrame([row], "name string, n bigint, mean double, km double, extra int")


def test_conform(spark):
    df = conform(source(spark, "abcde", 3, 2.5, 0.1, 1), TARGET)
    assert df.columns == ["n", "mean", "km", "name"]
    assert df.first()["mean"] == 2
    assert df.schema["km"].dataType == FloatType()
    assert conform(source(spark, None, 3, None, None, 1), TARGET).first()[1:] == (None, None, None)


@pytest.mark.parametrize(
    "row, message",
    [
        (("abcdef", 3, 1.0, 0.1, 1), "longer than 5"),
        (("a", 2**31, 1.0, 0.1, 1), "out of range"),
        (("a", None, 1.0, 0.1, 1), "NULL in a required column"),
        (("a", 1, 1e12, 0.1, 1), "out of range"),
    ],
)
def test_conform_refuses(spark, row, message):
    with pytest.raises(Exception, match=message):
        conform(source(spark, *row), TARGET).collect()


def test_split_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "n int, s string")
    kept, rejected = split_nulls(df, ["n", "s"])
    assert rows(kept) == [(1, "a")]
    assert rejected.count() == 2


def test_record_shape(spark):
    df = spark.createDataFrame([("AF", "Air", 1)], StructType(
        [StructField("ICAO", StringType()), StructField("Name", StringType()), StructField("_hidden", IntegerType())]
    ))
    assert records.public_columns(records.lower_names(df)).columns == ["icao", "name"]
    with pytest.raises(KeyError, match="code"):
        records.project(df, ["ICAO", "code"])


def test_sketches_of_batches_unite_within_the_stated_error(spark):
    from skytally.operators import sketches

    rows = spark.range(60000).selectExpr("id % 3 AS g", "id % 5 AS batch", "string(id div 2) AS v").union(
        spark.range(4).selectExpr("9L", "id", "if(id = 0, NULL, 'same')")
    )
    stored = sketches.sketched(rows, ["batch", "g"], "v").cache()
    for batches in ((0,), (0, 1, 2, 3, 4)):
        found = {r["g"]: r["n"] for r in sketches.united(stored.filter(F.col("batch").isin(*batches)), ["g"]).collect()}
        exact = {r["g"]: r["n"] for r in rows.filter(F.col("batch").isin(*batches)).groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
        assert found.keys() == exact.keys()
        assert all(abs(found[g] - n) <= 4 * sketches.relative_error() * n for g, n in exact.items())
    assert found[9] == 1
    assert max(len(r["sketch"]) for r in stored.collect()) < 20000
