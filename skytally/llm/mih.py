"""Nearest vectors by inner product through multi-index hashing.

Vectors become binary codes: signs after a rotation that is learned (ITQ: principal directions, then the
rotation that moves them closest to the signs) on a bounded random sample.  To make the largest inner
product a smallest angle, vectors are scaled by the largest norm of all and get one more component
that fills them up to length 1.  A code is split into substrings of 8 bits, and each substring has an
index from its 256 values to the rows that hold it.  Codes within Hamming radius r agree with the query up
to r // m bits in one of the m substrings, so probing all values that near finds every one of them;
full codes are then compared, and the rows within r ranked by their exact inner products.

The radius is learned on the sample: it covers 98.5 % of the true neighbours there, and as neighbours
among all rows are nearer than among the sample's, more of theirs.  A query that finds fewer than k
rows in it is asked again with the greatest radius, so it gets k rows if there are so many.

Rows are indexed in blocks of about ``BLOCK`` rows, and queries are asked in batches: every block
meets every batch in a task of its own, and gives k rows a query.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, nor do rows with a null id.  A query doesn't find rows with its own id.  Ties go to the smaller id;
repeated rows are found as rows of their own.  A query that is repeated is asked once, and an id with
several vectors asks with each of them, for k rows each.  No queries or an empty table give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import stored

BLOCK, BATCH = 4096, 1024
MAX_BITS = 64
_POPCOUNT = np.bitwise_count(np.arange(256, dtype=np.uint8))
_NEAR = _POPCOUNT[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


class Code(NamedTuple):
    """How vectors become codes: scale, mean and projection; ``radius`` is that of the search."""

    norm: float
    mean: np.ndarray
    projection: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.projection.shape[1]

    def of(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Codes as rows of 8 bytes at most."""
        z = (_unit(x) if query else _filled(x, self.norm)) - self.mean
        return np.packbits(z @ self.projection > 0, axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.hstack([x / np.where(length > 0, length, 1), np.zeros((len(x), 1))])


def _filled(x: np.ndarray, norm: float) -> np.ndarray:
    x = x / norm
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1, keepdims=True)))])


def _distance(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return _POPCOUNT[codes ^ code].sum(axis=1, dtype=np.int32)


def learn(sample: np.ndarray, norm: float, k: int, seed: int = 3, rounds: int = 40, covered: float = 0.985) -> Code:
    """The rotation and the radius from the sample's vectors."""
    z = _filled(sample, norm)
    mean = z.mean(axis=0)
    centred = z - mean
    # Whole bytes; vectors of fewer components than bits get random directions besides.
    bits = min(MAX_BITS, -(-sample.shape[1] // 8) * 8)
    directions = np.linalg.svd(centred, full_matrices=True)[2] if len(sample) < 5000 else np.linalg.eigh(centred.T @ centred)[1][:, ::-1].T
    random = np.random.default_rng(seed)
    base = directions[:bits].T
    if base.shape[1] < bits:
        base = np.hstack([base, np.linalg.qr(random.normal(size=(z.shape[1],) * 2))[0][:, : bits - base.shape[1]]])
    if base.shape[1] < bits:
        base = np.hstack([base, random.normal(size=(z.shape[1], bits - base.shape[1]))])
    rotation = np.linalg.qr(random.normal(size=(bits, bits)))[0]
    low = centred @ base
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.sign(low @ rotation).T @ low)
        rotation = (u @ v).T
    code = Code(norm, mean, base @ rotation, bits)
    asked = sample[: min(400, len(sample))]
    stored_codes, asked_codes = code.of(sample, False), code.of(asked, True)
    far = []
    for n, (x, c) in enumerate(zip(asked, asked_codes)):
        score = sample @ x
        score[n] = -np.inf
        far.extend(_distance(stored_codes[np.argsort(-score)[: min(k, len(sample) - 1)]], c))
    return code._replace(radius=int(np.quantile(far, covered, method="higher")) if far else bits)


class Index(NamedTuple):
    """A block: rows, and of each substring and value the rows that hold it, as bits."""

    ids: np.ndarray
    vectors: np.ndarray
    codes: np.ndarray
    buckets: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, code: Code) -> Index:
        codes = code.of(vectors, False)
        held = np.zeros((codes.shape[1], 256, len(ids)), bool)
        for j in range(codes.shape[1]):
            held[j, codes[:, j], np.arange(len(ids))] = True
        return cls(ids, vectors, codes, np.packbits(held, axis=2))

    def probe(self, query: np.ndarray, radius: int, known: dict) -> np.ndarray:
        """Rows with a code within the radius of the query's."""
        reach = radius // len(query)
        found = np.zeros(self.buckets.shape[2], np.uint8)
        for j, value in enumerate(query.tolist()):
            if (j, value, reach) not in known:
                near = np.flatnonzero(_NEAR[value] <= reach)
                known[j, value, reach] = np.bitwise_or.reduce(self.buckets[j, near], axis=0)
            found |= known[j, value, reach]
        rows = np.flatnonzero(np.unpackbits(found, count=len(self.ids)))
        return rows[_distance(self.codes[rows], query) <= radius]

    def nearest(self, ids: np.ndarray, keys: np.ndarray, queries: np.ndarray, code: Code, radius: int, k: int):
        """(query id and key, row id, score) of each query's k nearest rows of the block within the radius."""
        known: dict = {}
        for own, key, query, bits in zip(ids, keys, queries, code.of(queries, True)):
            rows = self.probe(bits, radius, known)
            rows = rows[self.ids[rows] != own]
            if not len(rows):
                continue
            part = self.vectors[rows]
            rough = part @ query
            if len(rows) > k:
                # Rounding may differ by place; near ties of the k-th are all looked at again.
                least = np.partition(rough, len(rows) - k)[len(rows) - k]
                near = rough >= least - 1e-9 * (abs(least) + np.abs(rough).max() + 1e-300)
                rows, part = rows[near], part[near]
            score = (part * query).sum(axis=1)
            order = np.lexsort((self.ids[rows], -score))[:k]
            yield np.full(len(order), own), np.full(len(order), key), self.ids[rows[order]], score[order]


def _packed(rows: DataFrame, group: str) -> DataFrame:
    """One row per group: its ids, keys and vectors as binary values."""

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        ids, keys = (part[c].to_numpy(np.int64) for c in ("vec_id", "key"))
        vectors = np.stack(part["v"].to_list()).astype(np.float64)
        return pd.DataFrame({group: [key[0]], "ids": [ids.tobytes()], "keys": [keys.tobytes()], "vectors": [vectors.tobytes()]})

    return rows.groupBy(group).applyInPandas(pack, f"{group} long, ids binary, keys binary, vectors binary")


def _search(blocks: DataFrame, queries: DataFrame, code: Code, radius: int, k: int, n_blocks: int) -> DataFrame:
    """The k best rows of each query."""
    batches = _packed(queries, "batch").toDF("batch", "asked", "asked_keys", "asked_vectors")
    # Every batch goes to every block, by an equality join on the block's number.
    met = batches.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")))
    pairs = met.join(blocks, "block").select("ids", "vectors", "asked", "asked_keys", "asked_vectors")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple[bytes, Index] | None = None
        for part in parts:
            for row in part.itertuples(index=False):
                if last is None or last[0] != row.ids:
                    ids = np.frombuffer(row.ids, np.int64)
                    last = (row.ids, Index.build(ids, np.frombuffer(row.vectors).reshape(len(ids), -1), code))
                asked = np.frombuffer(row.asked, np.int64)
                vectors = np.frombuffer(row.asked_vectors).reshape(len(asked), -1)
                found = list(last[1].nearest(asked, np.frombuffer(row.asked_keys, np.int64), vectors, code, radius, k))
                if found:
                    columns = [np.concatenate(c) for c in zip(*found)]
                    yield pd.DataFrame(dict(zip(("query_id", "query_key", "vec_id", "score"), columns)))

    found = pairs.mapInPandas(run, "query_id long, query_key long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    sample_rows: int = 10_000,
    radius: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row that ``is_query`` names.

    The rotation is fitted on about ``sample_rows`` rows; all rows are indexed.
    """
    empty = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if usual is None:
        return spark.createDataFrame([], empty)
    # An id's vectors are told apart by their hash values.
    rows = rows.filter(F.size("v") == usual["n"]).withColumn("key", F.xxhash64("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    total, asked, longest = rows.agg(F.count("*"), F.count_if("asks"), F.max(norm)).first()
    if not asked:
        return spark.createDataFrame([], empty)
    n_blocks, n_batches = -(-total // BLOCK), -(-asked // BATCH)
    # By a hash of the id: the same sample in any partitioning, bounded up to chance.
    part = int(min(1.0, sample_rows / total) * 1_000_000)
    sample = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1_000_000)) < part)
    sample = [r["v"] for r in sample.select("v").orderBy(F.xxhash64("vec_id"), "v").limit(2 * sample_rows).collect()]
    if len(sample) < 2:
        sample = [r["v"] for r in rows.select("v").limit(sample_rows).collect()]
    code = learn(np.array(sample), longest, k)
    radius = code.radius if radius is None else radius

    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("long")
    blocks = stored(_packed(rows.withColumn("block", place(n_blocks)), "block"), "mih-blocks")
    queries = stored(rows.filter("asks").dropDuplicates(["vec_id", "key"]).withColumn("batch", place(n_batches)), "mih-queries")
    found = stored(_search(blocks, queries, code, radius, k, n_blocks), "mih-found")
    # Queries with too few rows within the radius: all codes are within the greatest one.
    enough = found.groupBy("query_id", "query_key").count().filter(F.col("count") >= min(k, total - 1))
    enough = enough.select(F.col("query_id").alias("vec_id"), F.col("query_key").alias("key"))
    few = stored(queries.join(enough, ["vec_id", "key"], "left_anti").select(queries.columns), "mih-few")
    if radius < code.bits and not few.isEmpty():
        again = _search(blocks, few, code, code.bits, k, n_blocks)
        asked_again = few.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query_key"))
        found = found.join(asked_again, ["query_id", "query_key"], "left_anti").unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
