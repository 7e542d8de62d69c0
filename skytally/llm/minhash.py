"""Near-duplicate texts: SuperMinHash signatures, banding, verification on full sets, components.

SuperMinHash gives every shingle a random permutation of the signature's places and, at rank j of it,
a random value in [j, j+1); each place keeps its least value.  Ranks are worked off in step for all
shingles of many texts: once all places of a text hold values below j+1, later ranks can change
nothing and the text is finished, for most texts after one or two ranks.

Texts with equal shingle sets are one class and are compared through one of them.  Classes that agree
in a band of the signature meet in a bucket.  Each is compared with the bucket's smallest id, not with
all others; the confirmed links give components.  Then the buckets that still hold several components
are searched for further links between different components, so that no link is lost that could join
two of them.  Such a bucket is cut in tiles by its members and their shingles, and each two tiles meet in a group of
their own: there all signatures are compared in numpy, and members that come near enough then on full sets.  With 25 bands of 5 places, a pair at similarity 0.85 meets in no bucket with probability
(1 - 0.85**5)**25 = 4e-7; at 0.80, 37 bands do the same.  Links are confirmed on the words themselves.

A null or empty text, or one without words, has an empty set and is linked with nothing.  Ids identify
texts: a repeated row gives a repeated result row.  Rows with a null id get a null component and are not
kept.  ``one_of_each`` compares rows instead: of rows with one id and text one stays, and texts without an id, or
with an id that another text has too, are compared like others, where those with an id of their own go first.  Texts that tie in everything but the id go to the smallest id.  Other columns are not looked at,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm import graph
from skytally.llm.common import arrow_rows, begin, fresh, stored
from skytally.llm.shingles import SHINGLE, mixed, shingle_sets, slices, words

BANDS, ROWS = 25, 5
#: Rows of an Arrow batch: pairs of them hold two whole texts.
ARROW_ROWS = 1000
PLACES = BANDS * ROWS
_U = np.uint64


def signatures(elements: np.ndarray, sizes: np.ndarray, places: int = PLACES) -> np.ndarray:
    """SuperMinHash of many sets at once: rank and fraction in 32 bits, one row of ``places`` per set.

    ``elements`` holds the sets one after the other.  A row of an empty set is all ones.
    """
    out = np.full((len(sizes), places), 0xFFFFFFFF, np.uint32)
    bits = 32 - (places - 1).bit_length()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    picks: list[np.ndarray] = []  # what each of the ranks so far was exchanged with, of each element
    for rank in range(places):
        if not len(elements):
            break
        random = mixed(elements, 100 + rank)
        pick = (rank + ((random >> _U(32)) * _U(places - rank) >> _U(32))).astype(np.int64)
        # Fisher-Yates: what stands at the picked place now, found by undoing the exchanges so far.
        place = pick
        for earlier in range(rank - 1, -1, -1):
            place = np.where(place == picks[earlier], earlier, place)
        value = (_U(rank << bits) + (random & _U((1 << bits) - 1))).astype(np.uint32)
        np.minimum.at(out.reshape(-1), owner * places + place, value)
        picks.append(pick)
        open_sets = np.zeros(len(sizes), bool)
        rows = np.unique(owner)
        open_sets[rows] = out[rows].max(axis=1) >= (rank + 1) << bits
        left = open_sets[owner]
        if not left.all():
            elements, owner, picks = elements[left], owner[left], [p[left] for p in picks]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band."""
    bands = signature.shape[1] // ROWS
    parts = signature.astype(np.uint64).reshape(len(signature), bands, ROWS)
    key = np.arange(bands, dtype=np.uint64)[None, :] * np.ones((len(signature), 1), np.uint64)
    for k in range(ROWS):
        key = mixed(key * _U(0x9E3779B97F4A7C15) + parts[:, :, k], 3)
    return key


_FEATURES = "doc_id long, n long, key1 long, key2 long, sig array<int>, bands array<long>"


def _features(batches: Iterator[pa.RecordBatch], places: int = PLACES) -> Iterator[pa.RecordBatch]:
    begin("minhash")
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for start, end, offsets, data in slices(texts):
            sets = shingle_sets(*words(offsets, data))
            sizes = np.array([len(s) for s in sets])
            elements = np.concatenate(sets)
            sig = signatures(elements, sizes, places)
            sig[sizes == 0] = 0
            # Sums of scrambled elements name the set, whatever its order.
            ends = np.concatenate([[0], np.cumsum(sizes)])
            keys = []
            for salt in (5, 6):
                total = np.concatenate([[_U(0)], np.cumsum(mixed(elements, salt))])
                keys.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
            lists = lambda a, kind: pa.ListArray.from_arrays(
                np.arange(0, a.size + 1, a.shape[1], dtype=np.int32), pa.array(a.reshape(-1), kind)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(start, end - start),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys[0]),
                    pa.array(keys[1]),
                    lists(sig.view(np.int32), pa.int32()),
                    lists(band_keys(sig).view(np.int64), pa.int64()),
                ],
                ["doc_id", "n", "key1", "key2", "sig", "bands"],
            )


@lru_cache(4)
def _set(text: str) -> frozenset:
    w = text.encode("utf-8", "surrogatepass").lower().split()
    return frozenset(zip(*(w[k:] for k in range(SHINGLE)))) if len(w) >= SHINGLE else frozenset([tuple(w)] if w else [])


def _linked(num: int, den: int):
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        found = []
        for x, y in zip(a, b):
            x, y = _set(x or ""), _set(y or "")
            both = len(x & y)
            found.append(both > 0 and den * both >= num * (len(x) + len(y) - both))
        return pd.Series(found, dtype=bool)

    return linked


def _confirmed(pairs: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    with_a = pairs.join(texts.toDF("a", "text_a"), "a")
    both = with_a.join(texts.toDF("b", "text_b"), "b")
    return both.filter(_linked(num, den)(F.col("text_a"), F.col("text_b"))).select("a", "b")


#: Members of a tile of a bucket, and shingles of them; two tiles are compared in one task.
GROUP, GROUP_SHINGLES = 1000, 500_000
#: Rows of small buckets that share a group, as groups cost more than buckets.
PACK = 1000


def _tiles(rows: DataFrame, total: int = 0) -> DataFrame:
    """(pack, i, j, bucket, doc_id, component, n) once for each two tiles (i, j) of the bucket in which a row stands.

    A large bucket is a pack of its own; buckets of one tile, of ``total`` rows, share packs.
    """
    many = F.ceil(F.greatest(F.count("*") / GROUP, F.sum("n") / GROUP_SHINGLES)).cast("int")
    counts = rows.groupBy("bucket").agg(many.alias("splits"))
    dealt = rows.join(counts, "bucket").withColumn("split", F.pmod(F.xxhash64("doc_id"), F.col("splits")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    i, j = F.least("split", "other").alias("i"), F.greatest("split", "other").alias("j")
    # Tiles of large buckets and packs can't be taken for each other: their j differs.
    name = F.xxhash64("bucket")
    pack = F.when(F.col("splits") == 1, F.pmod(name, F.lit(total // PACK + 1))).otherwise(name)
    j = F.when(F.col("splits") == 1, -1).otherwise(j).alias("j")
    return dealt.select(pack.alias("pack"), i, j, *rows.columns)


def _by_bucket(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The buckets of a pack, or a bucket's two tiles."""
    part = part.sort_values(["bucket", "doc_id"]).reset_index(drop=True)
    bucket = part["bucket"].to_numpy()
    cuts = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)) + 1
    for a, b in zip([0, *cuts.tolist()], cuts.tolist()):
        if b - a > 1:
            yield part.iloc[a:b]


def _near_in_tiles(tiles: DataFrame, places: int, num: int, den: int) -> DataFrame:
    """The rows (bucket, doc_id, component) that come near one of another component, by size and signature."""
    # Six standard deviations of the agreement below the threshold; full sets decide on the rest.
    least = places * (num / den - 6 * (num / den * (1 - num / den) / places) ** 0.5)

    def agreement(own: np.ndarray, sig: np.ndarray) -> np.ndarray:
        if len(sig) <= 32:
            return (own[:, None, :] == sig[None, :, :]).sum(axis=2)
        agree = np.zeros((len(own), len(sig)), np.int16)
        for mine, place in zip(own.T, np.ascontiguousarray(sig.T)):
            agree += mine[:, None] == place[None, :]
        return agree

    def near(part: pd.DataFrame) -> pd.DataFrame:
        begin("minhash")
        out = [part.iloc[:0]]
        for rows in _by_bucket(part):
            n, component, sig = rows["n"].to_numpy(), rows["component"].to_numpy(), np.stack(rows["sig"].to_numpy())
            if (component == component[0]).all():
                continue
            found = np.zeros(len(rows), bool)
            for at in range(0, len(rows), 256):
                own = slice(at, at + 256)
                sizes = den * np.minimum(n[own, None], n[None, :]) >= num * np.maximum(n[own, None], n[None, :])
                apart = sizes & (component[own, None] != component[None, :])
                found[own] = ((agreement(sig[own], sig) >= least) & apart).any(axis=1)
            out.append(rows[found])
        return pd.concat(out)[["bucket", "doc_id", "component"]]

    found = tiles.groupBy("pack", "i", "j").applyInPandas(near, "bucket long, doc_id long, component long")
    return found.distinct()


def _links_between(close: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between members (bucket, doc_id, component) of a bucket in different components.

    All pairs of two tiles are compared on their full sets (of 64-bit shingle values) where they are; only
    links that join components leave the task.
    """
    ids = stored(close.select("doc_id").distinct(), "minhash-close-ids")
    sets = texts.join(ids, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, elements binary").dropDuplicates(["doc_id"])
    sets = stored(sets, "minhash-close-sets")
    sizes = sets.select("doc_id", F.floor(F.octet_length("elements") / 8).alias("n"))
    rows = _tiles(close.select("bucket", "doc_id", "component").join(sizes, "doc_id"), close.count()).drop("n")

    def linked_pairs(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
        sets = [np.frombuffer(e, np.uint64) for e in rows["elements"]]
        n = np.array([len(s) for s in sets])
        values, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # Shingles of one member alone are in no intersection.
        column = np.cumsum(held > 1) - 1
        owner, shared = np.repeat(np.arange(len(sets)), n), held[place] > 1
        owner, place = owner[shared], column[place[shared]]
        both = np.zeros((len(sets), len(sets)), np.int64)
        width = min(4096, int(column[-1]) + 1)
        for at in range(0, int(column[-1]) + 1, 4096):
            inside = (place >= at) & (place < at + width)
            matrix = np.zeros((len(sets), width), np.float32)
            matrix[owner[inside], place[inside] - at] = 1
            both += (matrix @ matrix.T).astype(np.int64)
        component = rows["component"].to_numpy()
        linked = (both > 0) & (den * both >= num * (n[:, None] + n[None, :] - both))
        linked &= component[:, None] != component[None, :]
        yield from zip(*np.nonzero(np.triu(linked)))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        begin("minhash")
        root = {c: c for c in part["component"].tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        out = []
        for rows in _by_bucket(part):
            doc_id, component = rows["doc_id"].tolist(), rows["component"].tolist()
            for a, b in linked_pairs(rows):
                p, q = find(component[a]), find(component[b])
                if p != q:
                    root[p] = q
                    out.append((doc_id[b], doc_id[a]))
        return pd.DataFrame(out, columns=["a", "b"])

    return rows.join(sets, "doc_id").groupBy("pack", "i", "j").applyInPandas(compare, "a long, b long")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end, offsets, data in slices(batch.column(1)):
            elements = [s.tobytes() for s in shingle_sets(*words(offsets, data))]
            ids = batch.column(0).slice(start, end - start)
            yield pa.RecordBatch.from_arrays([ids, pa.array(elements, pa.binary())], ["doc_id", "elements"])


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = 85, den: int = 100, bands: int = BANDS
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row; links have intersection / union >= num / den."""
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        return _near_duplicates(docs, doc_id, text, num, den, bands)


def _near_duplicates(docs: DataFrame, doc_id: str, text: str, num: int, den: int, bands: int) -> DataFrame:
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    places = bands * ROWS
    features = stored(texts.mapInArrow(lambda batches: _features(batches, places), _FEATURES), "minhash-features")
    # One class for each different set; the sums per task keep a class of any size apart from the shuffle.
    keyed = features.filter("n > 0 AND doc_id IS NOT NULL")
    classes = keyed.groupBy("key1", "key2").agg(F.min("doc_id").alias("class"))
    member = features.select("doc_id", "n", "key1", "key2")
    heads = stored(
        features.join(classes.select(F.col("class").alias("doc_id")), "doc_id", "left_semi")
        .filter("n > 0")
        .select("doc_id", "n", "sig", "bands"),
        "minhash-classes",
    )
    rows = heads.select("doc_id", F.explode("bands").alias("bucket"))
    hubs = rows.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    meet = stored(rows.join(hubs.select("bucket", "hub"), "bucket"), "minhash-buckets")
    pairs = stored(
        meet.filter("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct(),
        "minhash-pairs",
    )
    links = stored(_confirmed(pairs, texts, num, den), "minhash-links")
    found = graph.components(links)

    # Buckets that hold more than one component: look for links between these.
    label = F.coalesce("component", "doc_id").alias("component")
    of = meet.join(found.toDF("doc_id", "component"), "doc_id", "left").select("bucket", "doc_id", label)
    split = of.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    open_rows = stored(of.join(split.select("bucket"), "bucket", "left_semi"), "minhash-open")
    full = _tiles(open_rows.join(heads.select("doc_id", "n"), "doc_id"), open_rows.count()).join(heads.select("doc_id", "sig"), "doc_id")
    close = stored(_near_in_tiles(full, places, num, den), "minhash-close")
    if not close.isEmpty():
        links = stored(links.union(_links_between(close, texts, num, den)), "minhash-all-links")
        found = graph.components(links)

    named = classes.join(found.toDF("class", "component"), "class", "left").select(
        "key1", "key2", F.coalesce("component", "class").alias("component")
    )
    same = (member["key1"] == named["key1"]) & (member["key2"] == named["key2"]) & (member["n"] > 0)
    return member.join(named, same, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kwargs) -> DataFrame:
    """``docs`` without the texts that a similar one with a smaller id stands for, one row of each text."""
    key, digest, least, name = fresh(docs, "key", "digest", "least", "name")
    rows = docs.withColumn(digest, F.xxhash64(text))
    # Ids that several texts have: the others get keys of their own, like texts without an id.
    own = rows.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias(name))
    shared = own.agg(F.min(digest).alias(least), F.max(digest).alias("greatest")).filter(f"{least} <> greatest")
    shared = stored(shared.select(name, least), "minhash-shared-ids")
    rows = rows.join(shared, F.col(doc_id).cast("long") == F.col(name), "left")
    # Greater than the ids in use.
    made = F.shiftrightunsigned(F.xxhash64(F.col(doc_id).cast("long"), text), 2).bitwiseOR(F.lit(1 << 62))
    named = F.col(doc_id).isNotNull() & (F.col(least).isNull() | (F.col(least) == F.col(digest)))
    rows = rows.withColumn(key, F.when(named, F.col(doc_id).cast("long")).otherwise(made))
    rows = rows.select(*docs.columns, key)
    again = stored(rows.groupBy(key).count().filter("count > 1").select(F.col(key).alias(name)), "minhash-again")
    if not again.isEmpty():
        # Only rows whose key stands there more than once are moved.
        copies = rows.join(again, F.col(key) == F.col(name), "left_semi")
        place = F.row_number().over(Window.partitionBy(key).orderBy(F.to_json(F.struct(*docs.columns))))
        first = copies.withColumn(name, place).filter(F.col(name) == 1).drop(name)
        rows = rows.join(again, F.col(key) == F.col(name), "left_anti").unionByName(first)
    found = near_duplicates(rows, key, text, **kwargs)
    gone = stored(found.filter("doc_id <> component_id").select("doc_id").distinct(), "minhash-gone")
    return rows.join(gone.toDF(name), F.col(key) == F.col(name), "left_anti").select(docs.columns)


def kept(doc: Column, component: Column) -> Column:
    return F.coalesce(doc == component, F.lit(False))
