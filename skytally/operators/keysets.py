"""Summaries of key sets as their keys' hashes, asked by a join.

A summary has a row for each key: 64 bits of its hash.  A set can hold a key only if it has the key's hash, so no key
that is in a set is ever denied, and one that isn't is only let through if two hashes meet.

An asked key meets the rows of its own hash and no others, however many sets there are: the work grows with the keys and
not with keys times sets, as it would if each small set had to answer for itself.  Nothing is sorted or grouped to make
a summary.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

#: Keys of a bucket, about; large sets are dealt over tasks by buckets.
PER_BUCKET = 1024
#: Numbers of buckets grow by this factor.
STEP = 1.25

SCHEMA = StructType([StructField("buckets", IntegerType()), StructField("bucket", IntegerType()), StructField("hash", LongType())])


def bucket_number(keys: Column) -> Column:
    """How many buckets a set of so many keys has."""
    least = F.greatest(keys / PER_BUCKET, F.lit(1.0))
    return F.ceil(F.pow(F.lit(STEP), F.ceil(F.log(least) / math.log(STEP)))).cast("int")


def summarise(keys: DataFrame, group: str, key: str) -> DataFrame:
    """(group, buckets, bucket, hash) of the keys of each group; repeated keys are allowed.

    Keys are counted per task before they meet; their rows stay where they are.
    """
    keys = keys.select(F.col(group).alias("_group"), F.xxhash64(key).alias("hash"))
    sizes = keys.groupBy("_group").agg(bucket_number(F.count("*")).alias("buckets"))
    rows = keys.join(F.broadcast(sizes), "_group")
    return rows.select(F.col("_group").alias(group), "buckets", F.pmod("hash", "buckets").cast("int").alias("bucket"), "hash")


def may_hold(summaries: DataFrame, group: str, keys: DataFrame, key: str, buckets: list[int]) -> DataFrame:
    """The distinct groups that may hold one of the keys.  ``buckets``: the numbers of buckets in use.

    A summary of another form, as older tables have it, says nothing: its group may hold any key.
    """
    summaries = summaries.filter(F.col("buckets").isin(sorted(set(buckets))))
    asked = keys.select(F.xxhash64(key).alias("hash")).distinct()
    held = summaries.join(asked, "hash", "left_semi").select(group)
    return held.union(summaries.filter("hash IS NULL").select(group)).distinct()
