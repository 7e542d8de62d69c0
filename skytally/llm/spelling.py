"""Spelling variants: words that differ by one code point, each led to the far more frequent near word.

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z in lower case, of a least length
and number of occurrences over all texts.  Two are near if one inserted, deleted or replaced code
point makes them equal.  A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is at least ``ratio`` times its own; following forms leads to the root.

How near words are found: for each length L, words of length L meet words of lengths L and L + 1 (adjacent length
blocks) that share their first L // 2 code points, or their last L - L // 2: one edit leaves one of the two
halves as it is, so no pair is lost.  In a block, NumPy products of the words' letter-count rows, stacked by size
of the block, give all squared distances at once; one edit changes one count by one, or two, so pairs beyond 2 are dropped.
Of the rest the edit is verified on code points.  A pair that shares both halves counts in the first block only,
so no pair needs to be made distinct.  Blocks of more than ``TILE`` words are cut in tiles, and each two tiles of a block
meet in a group of their own, spread over all tasks.  Tasks give each word's number of near words and its
best one, not the pairs.

Null and empty texts have no words.  Repeated rows count as often as they stand there; a null id is the
empty text in a transformation that asks for it.  Texts and runs of any length are whole.  Other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import stored

#: Words of a block that meet in one group.
TILE = 1024
#: Rows that a task works on at once, and the most code points a word compared in arrays has.
CHUNK, LONG = 32768, 64
#: Different words that a task counts before it hands them on.
HELD = 200_000

# Runs in UTF-8: a-z, and U+00C0 to U+00FF as two bytes.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def runs(text: str) -> list[bytes]:
    """All runs of letters, A-Z in lower case, in UTF-8."""
    return _RUN.findall(text.encode("utf-8", "surrogatepass").lower())


Change = Callable[[int | None, bytes], bytes]


def delete_some(every: int) -> Change:
    """Where crc32 of ``<id>:<run>`` is a multiple of ``every``, the code point at that value modulo the length goes."""

    def change(doc_id: int | None, run: bytes) -> bytes:
        crc = zlib.crc32(run, zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id))
        if crc % every:
            return run
        word = run.decode()
        at = crc % len(word)
        return (word[:at] + word[at + 1 :]).encode()

    return change


def count_words(
    docs: DataFrame, doc_id: str, text: str, least_length: int = 7, least_count: int = 2, change: Change | None = None
) -> DataFrame:
    """(word, n) of all words; each task adds up what it can before the shuffle."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = [w.decode() for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.as_py()
                if not value:
                    continue
                for run, n in Counter(runs(value)).items():
                    # In bytes no word is shorter than in code points.
                    if len(run) >= least_length:
                        word = change(key, run) if change else run
                        if len(word) >= least_length:
                            held[word] += n
                if len(held) > HELD:
                    yield batch_of(held)
                    held.clear()
        yield batch_of(held)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(count, "word string, n long").filter(F.length("word") >= least_length)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# --- near words -----------------------------------------------------------------------------------------


def _blocked(words: DataFrame, least_length: int) -> DataFrame:
    """(block, tile_a, tile_b, tile, size, side, word, n): every group in which a word meets others.

    ``size`` is the L of the block, ``side`` 0 for blocks with equal beginnings and 1 for equal ends.
    """
    length = F.length("word")
    places = F.array(*[F.struct((length - d).alias("size"), F.lit(side).alias("side")) for d in (0, 1) for side in (0, 1)])
    rows = words.select("word", "n", F.explode(places).alias("p")).select("word", "n", "p.*")
    # Where no word is of the block's length, those that are one longer have nobody to meet.
    rows = rows.filter(F.col("size") >= least_length)
    half = F.floor(F.col("size") / 2).cast("int")
    part = F.when(F.col("side") == 0, F.substr("word", F.lit(1), half)).otherwise(F.right("word", F.col("size") - half))
    rows = rows.withColumn("block", F.xxhash64("size", "side", part))
    large = rows.groupBy("block").agg(F.count("*").alias("members")).filter(F.col("members") > TILE)
    tiles = stored(large.select("block", F.ceil(F.col("members") / TILE).cast("int").alias("tiles")), "spelling-large-blocks")
    rows = rows.join(tiles, "block", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    tile = F.pmod(F.xxhash64("word", F.lit(7)), F.col("tiles")).cast("int")
    rows = rows.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.select(
        "block",
        F.least("tile", "other").alias("tile_a"),
        F.greatest("tile", "other").alias("tile_b"),
        "tile",
        "size",
        "side",
        "word",
        "n",
    )


def _letter_counts(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """One row per word: how often it holds each of a-z and U+00C0 to U+00FF."""
    column = np.where(codes < 0xC0, codes - 97, codes - 0xC0 + 26)
    return np.bincount(owner * 90 + column, minlength=n * 90).reshape(n, 90).astype(np.float64)


def near_edit(a: str, b: str) -> bool:
    """True for exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


class _Words:
    """The words of a chunk in arrays: code points from the left and from the right, lengths, letter counts."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), self.length)
        self.counts = _letter_counts(codes, owner, len(words))
        self.square = np.einsum("ij,ij->i", self.counts, self.counts)
        # Short words in a matrix; long ones are compared one by one.
        starts = np.cumsum(self.length) - self.length
        place = np.arange(len(codes)) - starts[owner]
        short = self.length[owner] <= LONG
        width = int(min(self.length.max(initial=1), LONG))
        self.left = np.zeros((len(words), width), np.uint16)
        self.left[owner[short], place[short]] = codes[short]
        self.right = np.zeros((len(words), width), np.uint16)
        self.right[owner[short], width - self.length[owner[short]] + place[short]] = codes[short]

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs differ by one edit; a's words are not the longer ones."""
        out = np.zeros(len(a), bool)
        short = self.length[b] <= LONG
        x, y = a[short], b[short]
        same = self.left[x] == self.left[y]
        width = same.shape[1]
        prefix = np.where(same.all(axis=1), width, same.argmin(axis=1))
        same = self.right[x] == self.right[y]
        suffix = np.where(same.all(axis=1), width, same[:, ::-1].argmin(axis=1))
        size, equal = self.length[x], self.length[x] == self.length[y]
        out[short] = np.where(equal, (prefix + suffix == size - 1), np.minimum(prefix, size) + np.minimum(suffix, size) >= size)
        for k in np.flatnonzero(~short):
            out[k] = near_edit(self.words[a[k]], self.words[b[k]])
        return out


def _candidates(words: _Words, begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of each group at a squared distance of 1 or 2 of their letter counts.

    Groups of like size are stacked, filled up with rows that are far from all others.
    """
    top = 2
    while len(begins):
        now = sizes <= top
        stack = max(1, 2_000_000 // (top * max(top, 90)))
        for at in range(0, int(now.sum()), stack):
            begin, size = begins[now][at : at + stack], sizes[now][at : at + stack]
            member = np.minimum(begin[:, None] + np.arange(top), len(words.words) - 1)
            there = np.arange(top) < size[:, None]
            counts = words.counts[member]
            square = words.square[member]
            distance = square[:, :, None] + square[:, None, :] - 2 * (counts @ counts.transpose(0, 2, 1))
            close = (distance <= 2) & there[:, :, None] & there[:, None, :] & np.triu(np.ones((top, top), bool), 1)
            g, i, j = np.nonzero(close)
            yield member[g, i], member[g, j]
        begins, sizes = begins[~now], sizes[~now]
        top *= 2


def _near_in_groups(table: pa.Table) -> pa.RecordBatch:
    """(word, n_near, best_n, best) of the words of whole groups, in which they have near words."""
    key = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("block", "tile_a", "tile_b")], axis=1)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]).any(axis=1)
    begins = np.flatnonzero(new)
    sizes = np.diff(begins, append=len(key))
    many = sizes > 1
    words = _Words(table.column("word").to_pylist())
    tile, size, side = (table.column(c).to_numpy() for c in ("tile", "size", "side"))
    crossed = key[:, 1] != key[:, 2]
    found_a, found_b = [], []
    for a, b in _candidates(words, begins[many], sizes[many]):
        # Two lengths of one block, the shorter one first; tiles of their own are compared where they are alone.
        swap = words.length[a] > words.length[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        ok = (words.length[a] == size[a]) & (size[a] == size[b]) & (side[a] == side[b]) & (~crossed[a] | (tile[a] != tile[b]))
        a, b = a[ok], b[ok]
        ok = words.near(a, b)
        a, b = a[ok], b[ok]
        # Blocks are named by hash: the halves themselves decide, and a pair with both alike counts at side 0.
        keep = np.ones(len(a), bool)
        for k in range(len(a)):
            x, y, whole = words.words[a[k]], words.words[b[k]], int(size[a[k]])
            first = x[: whole // 2] == y[: whole // 2]
            keep[k] = first if side[a[k]] == 0 else not first and x[whole // 2 :] == y[len(y) - (whole - whole // 2) :]
        found_a.append(a[keep])
        found_b.append(b[keep])
    a = np.concatenate([*found_a, *found_b, np.zeros(0, np.int64)]).astype(np.int64)
    b = np.concatenate([*found_b, *found_a, np.zeros(0, np.int64)]).astype(np.int64)
    n = table.column("n").to_numpy()
    best: dict[int, tuple[int, str]] = {}
    near = Counter()
    for x, y in zip(a.tolist(), b.tolist()):
        near[x] += 1
        now = (-int(n[y]), words.words[y])
        if x not in best or now < best[x]:
            best[x] = now
    columns = [
        pa.array([words.words[x] for x in best], pa.string()),
        pa.array([near[x] for x in best], pa.int64()),
        pa.array([best[x][0] for x in best], pa.int64()),
        pa.array([best[x][1] for x in best], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "less_n", "best"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a chunk ends where a group does."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def whole(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, rows
        table = pa.Table.from_batches(held)
        end = rows
        if not last:
            key = [table.column(c).to_numpy() for c in ("block", "tile_a", "tile_b")]
            other = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in key]))
            end = int(other[-1]) + 1 if len(other) else 0
        if end:
            yield _near_in_groups(table.slice(0, end).combine_chunks())
        held = table.slice(end).combine_chunks().to_batches()
        rows -= end

    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            held.append(batch.slice(at, CHUNK))
            rows += held[-1].num_rows
            if rows >= CHUNK:
                yield from whole(False)
    if rows:
        yield from whole(True)


def near_words(words: DataFrame, least_length: int = 1) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n), of a least length, that have near words."""
    rows = _blocked(words, least_length)
    group = ["block", "tile_a", "tile_b"]
    found = rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(_near, "word string, n_near long, less_n long, best string")
    best = F.min(F.struct("less_n", "best"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.less_n")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form, root) of (word, form): forms are followed to the last, one step of all words a round.

    A form is ``ratio`` times as frequent as its word, so there are no circles and few steps.
    """
    found = stored(forms.select("word", "form", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    step = forms.select(F.col("word").alias("at"), F.col("form").alias("next"))
    while not found.filter("moved").isEmpty():
        done, going = found.filter("NOT moved"), found.filter("moved")
        going = going.join(step, going["root"] == step["at"], "left")
        going = going.select("word", "form", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        found = stored(done.unionByName(going), "spelling-roots")
    return found.select("word", "form", "root")


def variants(words: DataFrame, ratio: int = 10, least_length: int = 1) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n), of a least length."""
    words = stored(words, "spelling-words")
    near = near_words(words, least_length)
    rows = words.join(near, "word", "left")
    led = F.col("best_n") >= ratio * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(led, F.col("best")).alias("form"), F.when(led, F.col("best_n")).alias("form_n")), "spelling-near")
    root = roots(rows.filter("form IS NOT NULL").select("word", "form")).select("word", "root")
    return rows.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
