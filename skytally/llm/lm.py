"""A Katz backoff language model, and the log-probability of every text under it.

    P(w | h) = d(c) c(hw) / c(h)        if the n-gram hw was seen c times in training
             = a(h) P(w | h')           if not; h' is h without its first word

The discounts d are Good-Turing's for counts up to ``K``, from a line fitted to the counts of counts where
these don't fall as it needs.  Backoff weights are normalised exactly:
a(h) = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w | h') over the same w).  Where no count of a
history is discounted, its denominator grows by one, so that some mass is left for other words.  At
the bottom stands (c + 0.5) / (N + 0.5 (V + 1)), where one of the V + 1 classes is the unknown word.
Histories reach over the text's begin, where they hold a begin mark.

How the counts meet the texts: texts are packed into blocks of about ``BLOCK_TOKENS`` tokens.  A first round adds up
the words and numbers them, frequent ones low.  Then each block lists its distinct n-grams of the highest order once,
with their training counts, as a tree (last word of the history, next word, words further back), dealt to buckets
by the last word of the history.  So all histories that end alike meet in one bucket, with the n-grams of all lower
orders, which are sums over the tree: one shuffle serves every order.  The buckets' trees with their counts are
the model, a stored table partitioned by history.  Once the counts of counts are known, each bucket works out
discounts, exact weights and probabilities from the lowest order up, and answers what the blocks listed.
Nothing moves once per token, and a message holds at least one n-gram, so that messages don't outgrow the tokens.

A word too frequent for one bucket is dealt to several by all other words of the n-gram.  Of what these buckets
share, each lists counts of n-grams, then sums of histories order by order, and gets the totals back from
buckets of their own; each total is formed from one row per bucket and key.  Without such a word there are no such rounds.

Words are known by 64-bit hash values, and what split buckets share too.

Null and empty texts are the end token alone; a text of any length belongs to one block.  Rows with a null id are
trained on.  Repeated rows count as often as they stand there.  Without training texts every word has probability
0.5 / (0.5 (V + 1)) = 1, as the unknown word.  Columns but id and text aren't looked at; an empty table gives
an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import arrow_rows, stored, stored_by
from skytally.llm.shingles import mixed, slices, words

BLOCK_TOKENS = 700_000
BUCKET_TOKENS = 1_000_000
#: Counts above this are trusted as they are.
K = 5
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_END, _BEGIN = mixed(np.array([1, 2], np.uint64), 77)
_NULL_ID = np.iinfo(np.int64).min


@cache
def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: like places of all values side by side, compressed."""
    parts = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        packed = _codec().compress(planes, asbytes=True) if planes else b""
        parts.append(struct.pack("<2sqq", a.dtype.str[1:].encode(), len(a), len(packed)) + packed)
    return b"".join(parts)


def load(data: bytes) -> list[np.ndarray]:
    arrays, at, head = [], 0, struct.calcsize("<2sqq")
    while at < len(data):
        kind, n, size = struct.unpack_from("<2sqq", data, at)
        dtype = np.dtype(kind.decode())
        planes = b""
        if n:
            planes = pa.decompress(data[at + head : at + head + size], n * dtype.itemsize, "zstd", asbytes=True)
        arrays.append(np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T.copy().reshape(-1).view(dtype))
        at += head + size
    return arrays


def _deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=np.zeros(1, a.dtype))


def _least(a: np.ndarray) -> np.ndarray:
    """The counts in as few bytes as they need."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 256 else np.uint32 if top < 1 << 32 else np.uint64)


# Texts into blocks.


def _row(kinds: dict[str, pa.DataType], *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds.values())], list(kinds))


_BLOCK = {"block": pa.int64(), "n_tokens": pa.int64(), "texts": pa.binary(), "vocabulary": pa.binary(), "tokens": pa.binary()}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    ids: list[np.ndarray] = []
    held: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    tokens: list[np.ndarray] = []
    n = 0

    def block() -> pa.RecordBatch:
        vocabulary, place, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        # Frequent words get small numbers, which compress better.
        rank = np.empty(len(counts), np.uint32)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts), dtype=np.uint32)
        texts = dump(np.concatenate(ids), np.concatenate(held).astype(np.uint8), np.concatenate(sizes))
        return _row(_BLOCK, number, n, texts, dump(_deltas(vocabulary), _least(counts)), dump(rank[place]))

    for batch in batches:
        batch_ids = batch.column(0).fill_null(_NULL_ID).to_numpy()
        batch_held = batch.column(1).to_numpy(zero_copy_only=False)
        for start, end, offsets, data in slices(batch.column(2)):
            ends, values = words(offsets, data)
            own = np.insert(values, ends[1:], _END)
            ids.append(batch_ids[start:end])
            held.append(batch_held[start:end])
            sizes.append(np.diff(ends) + 1)
            tokens.append(own)
            n += len(own)
            if n >= BLOCK_TOKENS:
                yield block()
                ids, held, sizes, tokens, n, number = [], [], [], [], 0, number + 1
    if ids:
        yield block()


class Block:
    """A block as it is written; the begin mark is a word of its own, seen once per text and never trained on."""

    def __init__(self, texts: bytes, vocabulary: bytes, tokens: bytes):
        self.ids, held, self.sizes = load(texts)
        self.held = held.astype(bool)
        gaps, counts = load(vocabulary)
        words = np.cumsum(gaps, dtype=np.uint64)
        order = np.argsort(-counts.astype(np.int64), kind="stable")
        token = order[load(tokens)[0]]
        self.begin = int(np.searchsorted(words, _BEGIN))
        self.words = np.insert(words, self.begin, _BEGIN)
        self.token = token + (token >= self.begin)
        self.trained = np.repeat(~self.held, self.sizes)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)

    def unigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The block's words, how often they were trained on and how often they stand there."""
        n = len(self.words)
        every = np.bincount(self.token, minlength=n)
        every[self.begin] = len(self.ids)
        return self.words, np.bincount(self.token[self.trained], minlength=n), every

    def set_unigrams(self, replies: list[bytes], facts: Facts) -> None:
        """Take the words' numbers and counts; words are sorted by number from here on."""
        rank, trained, every = [np.concatenate(c).astype(np.int64) for c in zip(*map(load, replies))]
        number = rank * facts.n_buckets + bucket_of(self.words, facts.n_buckets)
        order = np.argsort(number)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.number, self.words, self.seen = number[order], self.words[order], trained[order]
        self.parts = 1 + every[order] * facts.n_buckets // max(facts.tokens, 1)
        self.token, self.begin = place[self.token], int(place[self.begin])

    def before(self, k: int) -> np.ndarray:
        """The word k places before each token."""
        word = np.roll(self.token, k)
        for j in range(k):
            word[(self.begins + j)[self.sizes > j]] = self.begin
        return word

    def grams(self, facts: Facts) -> None:
        """The distinct n-grams of the highest order, as a tree under pairs of a bucket and a history's last word."""
        n, last = len(self.words), self.before(1)
        buckets, owner, pair = bucket_of(mixed(self.words, 31), facts.n_buckets), np.arange(n), last
        split = np.flatnonzero(self.parts[last] > 1)
        if len(split):
            rest = mixed(self.words, 32)[self.token[split]]
            for k in range(2, facts.order):
                rest = mixed(rest ^ self.words[self.before(k)[split]], 33)
            word = last[split]
            share = rest % self.parts[word].astype(np.uint64)
            own = bucket_of(mixed(self.words[word] + share * _STEP, 31), facts.n_buckets)
            keys, place = np.unique(own * n + word, return_inverse=True)
            pair = last.copy()
            pair[split] = n + place
            buckets, owner = np.concatenate([buckets, keys // n]), np.concatenate([owner, keys % n])
        order = np.lexsort((owner, buckets))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at, word, self.levels = rank[pair], self.token, []
        for k in range(2, facts.order + 1):
            if k > 2:
                word = self.before(k - 1)
            keys, at = np.unique(at * n + word, return_inverse=True)
            self.levels.append((keys // n, keys % n))
        self.gram_of_token = at
        self.counts = np.bincount(at[self.trained], minlength=len(keys))
        # Pairs that no n-gram has are left out.
        used = _firsts(self.levels[0][0])
        pairs = order[self.levels[0][0][used]]
        self.buckets, self.last = buckets[pairs], owner[pairs]
        self.levels[0] = (np.repeat(np.arange(len(used)), np.diff(used, append=len(self.levels[0][0]))), self.levels[0][1])

    def requests(self) -> Iterator[tuple[int, bytes]]:
        sizes = [len(self.last), *[len(word) for _, word in self.levels]]
        children = [np.bincount(parent, minlength=n) for (parent, _), n in zip(self.levels, sizes)]
        ends = [np.concatenate([[0], np.cumsum(c)]) for c in children]
        for b, lo, hi in _runs(self.buckets):
            last = self.last[lo:hi]
            data = [_least(_deltas(self.number[last])), _least(self.parts[last])]
            for k, (_, word) in enumerate(self.levels):
                data.append(_least(children[k][lo:hi]))
                lo, hi = ends[k][lo], ends[k][hi]
                if k:
                    data.append(_least(self.number[word[lo:hi]]))
                else:
                    words, place = np.unique(word[lo:hi], return_inverse=True)
                    data += [_least(place), _least(_deltas(self.number[words])), _least(self.seen[words])]
            yield b, dump(*data, _least(self.counts[lo:hi]))


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Ascending with the keys."""
    return ((keys >> _U(32)) * _U(n_buckets) >> _U(32)).astype(np.int64)


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, begin, end) of each run."""
    begins = _firsts(sorted_values)
    for lo, hi in zip(begins, [*begins[1:], len(sorted_values)]):
        yield int(sorted_values[lo]), int(lo), int(hi)


def _firsts(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(sorted_values, prepend=-1))


# A bucket's sums.


def _sum_words(requests: list[bytes], facts: Facts) -> tuple[list[bytes], list[int]]:
    """Replies with numbers and total counts; all trained tokens, distinct trained words and split words of the bucket."""
    parts = [load(r) for r in requests]
    keys = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    _, place = np.unique(keys, return_inverse=True)
    trained, every = (np.bincount(place, weights=np.concatenate([p[k] for p in parts])).astype(np.int64) for k in (1, 2))
    rank = np.empty(len(every), np.int64)
    rank[np.argsort(-every, kind="stable")] = np.arange(len(every))
    ends = np.cumsum([0] + [len(p[0]) for p in parts])
    replies = [dump(*[_least(x[place[a:b]]) for x in (rank, trained, every)]) for a, b in zip(ends[:-1], ends[1:])]
    return replies, [int(trained.sum()), int((trained > 0).sum()), int((every * facts.n_buckets >= facts.tokens).sum())]


def _sum_shared(requests: list[bytes], facts: Facts) -> tuple[list[bytes], list[int]]:
    """Replies with totals, and with a mark where a key is listed first; per order, how many keys have 1 .. K + 1."""
    parts = [load(r) for r in requests]
    keys = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    _, first, place = np.unique(keys, return_index=True, return_inverse=True)
    totals = []
    for column in zip(*[p[2:] for p in parts]):
        total = np.bincount(place, weights=np.concatenate(column))
        totals.append(total if column[0].dtype.kind == "f" else total.astype(np.int64))
    listed = np.zeros(len(keys), np.uint8)
    listed[first] = 1
    order = np.concatenate([p[1] for p in parts])[first]
    ends = np.cumsum([0] + [len(p[0]) for p in parts])
    replies = []
    for a, b in zip(ends[:-1], ends[1:]):
        own = [t[place[a:b]] for t in totals]
        replies.append(dump(*[x if x.dtype.kind == "f" else _least(x) for x in own], listed[a:b]))
    return replies, [int((totals[0][order == m] == r).sum()) for m in range(2, facts.order) for r in range(1, K + 2)]


class Part:
    """A part of the model's table: all n-grams dealt to a bucket, as a tree, with their training counts."""

    def __init__(self, state: bytes):
        data = iter(load(state))
        self.last, self.parts = np.cumsum(next(data), dtype=np.int64), next(data)
        self.words, self.seen = np.cumsum(next(data), dtype=np.int64), next(data).astype(np.int64)
        n_levels = int(next(data)[0])
        self.levels = [(np.repeat(np.arange(len(c)), c), next(data)) for c in (next(data) for _ in range(n_levels))]
        self.counts, self.blocks, sizes, steps = (next(data) for _ in range(4))
        self.place = np.split(np.cumsum(steps, dtype=np.int64), np.cumsum(sizes)[:-1])

    @staticmethod
    def of(requests: list[bytes], blocks: list[int], order: int) -> bytes:
        parts = [load(r) for r in requests]
        joined = lambda k: np.concatenate([p[k] for p in parts])
        numbers = lambda k: np.concatenate([np.cumsum(p[k], dtype=np.int64) for p in parts])
        last, at = np.unique(numbers(0), return_inverse=True)
        split = np.ones(len(last), np.int64)
        split[at] = joined(1)
        words, place = np.unique(numbers(4), return_inverse=True)
        seen = np.zeros(len(words), np.int64)
        seen[place] = joined(5)
        begins = np.cumsum([0] + [len(p[4]) for p in parts[:-1]])
        next_word = place[np.concatenate([p[3].astype(np.int64) + b for p, b in zip(parts, begins)])]
        data, n = [], len(last)
        for k in range(order - 1):
            # Children per n-gram, then their words: the next word, and from there on the words further back.
            word = joined(5 + 2 * k).astype(np.int64) if k else next_word
            span = int(word.max()) + 1
            keys, at = np.unique(np.repeat(at, joined(4 + 2 * k if k else 2)) * span + word, return_inverse=True)
            data += [_least(np.bincount(keys // span, minlength=n)), _least(keys % span)]
            n = len(keys)
        counts = np.bincount(at, weights=joined(-1), minlength=n).astype(np.int64)
        sizes = np.array([len(p[-1]) for p in parts])
        steps = np.diff(at, prepend=0)
        steps = steps.astype(np.int32) if n < 1 << 31 else steps
        return dump(
            _least(_deltas(last)), _least(split), _least(_deltas(words)), _least(seen), np.array([order - 1], np.uint8), *data,
            _least(counts), np.array(blocks, np.int64), _least(sizes), steps,
        )

    def tallies(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per order, what this bucket counted of each n-gram, and whether its last history word is split."""
        counts = [self.counts.astype(np.int64)]
        for (parent, _), (above, _) in zip(self.levels[:0:-1], self.levels[-2::-1]):
            counts.insert(0, np.bincount(parent, weights=counts[0], minlength=len(above)).astype(np.int64))
        split = [(self.parts > 1)[self.levels[0][0]]]
        for parent, _ in self.levels[1:]:
            split.append(split[-1][parent])
        return counts, split

    def sums(self) -> list[int]:
        """Per order, how many n-grams that lie in no other bucket were seen 1 .. K + 1 times."""
        counts, split = self.tallies()
        split[-1] = np.zeros(len(split[-1]), bool)
        return [int((c[~s] == r).sum()) for c, s in zip(counts, split) for r in range(1, K + 2)]

    def listed(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """What the counts of n-grams that lie in several buckets are asked by: a key each, and orders and counts."""
        counts, split = self.tallies()
        (parent, word), keys = self.levels[0], []
        key = mixed(mixed(self.last.astype(np.uint64), 41)[parent] ^ mixed(self.words.astype(np.uint64), 42)[word], 43)
        for k, s in enumerate(split[:-1]):
            if k:
                parent, word = self.levels[k]
                key = mixed(key[parent] ^ mixed(word.astype(np.uint64), 44), 45 + k)
            keys.append(key[s])
        orders = [np.full(len(x), k + 2, np.uint8) for k, x in enumerate(keys)]
        return np.concatenate(keys), [np.concatenate(orders), np.concatenate([c[s] for c, s in zip(counts, split[:-1])])]

    def advance(self, facts: Facts, replies: list[list[bytes]]) -> tuple[np.ndarray, list[np.ndarray]] | np.ndarray:
        """The probability of every n-gram of the highest order; or what must be known of other buckets first, as keys and columns."""
        counts, split = self.tallies()
        own = [np.ones(len(c), bool) for c in counts]
        asked = iter(replies)
        if facts.split and facts.order > 2:
            total, first = _totals(next(asked), self.listed()[0])[:2]
            ends = np.cumsum([0] + [int(s.sum()) for s in split[:-1]])
            for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                counts[k][split[k]], own[k][split[k]] = total[a:b], first[a:b] == 1
        p = ((self.seen + 0.5) / (facts.total + 0.5 * (facts.distinct + 1)))[self.levels[0][1]]
        history = self.levels[0][0]
        key, shared = mixed(self.last.astype(np.uint64), 51), self.parts > 1
        for k, (parent, word) in enumerate(self.levels):
            if k:
                word = word.astype(np.int64)
                span = int(word.max()) + 1
                found, first, at = np.unique(history[parent] * span + word, return_index=True, return_inverse=True)
                over, history = history[parent][first], at
                key, shared = mixed(key[over] ^ mixed(word[first].astype(np.uint64), 52), 53 + k), shared[over]
                p = p[parent]
            c, n = counts[k], len(key)
            mine = own[k] & (c > 0)
            stats = [np.bincount(history, weights=c * mine, minlength=n).astype(np.int64)]
            stats += [np.bincount(history[mine & (c == r)], minlength=n) for r in range(1, K + 1)]
            stats.append(np.bincount(history[mine], weights=p[mine], minlength=n))
            if facts.split:
                reply = next(asked, None)
                if reply is None:
                    return key[shared], [np.full(int(shared.sum()), k + 2, np.uint8), *[x[shared] for x in stats]]
                for x, total in zip(stats, _totals(reply, key[shared])):
                    x[shared] = total
            total, follows, lower = stats[0].astype(float), np.stack(stats[1:-1], axis=1), stats[-1]
            d = np.concatenate([[0.0], facts.discounts[k], [1.0]])
            lost = (follows * np.arange(1, K + 1) * (1 - d[1:-1])).sum(axis=1)
            undiscounted = lost < 1e-9
            left = np.where(undiscounted, 1.0, lost) / (total + undiscounted)
            weight = np.where(total > 0, left / np.maximum(1 - lower, 1e-300), 1.0)
            p = np.where(c > 0, d[np.minimum(c, K + 1)] * c / (total + undiscounted)[history], weight[history] * p)
        return p


def _asked(keys: np.ndarray, columns: list[np.ndarray], n_buckets: int) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(keys, kind="stable")
    keys, columns = keys[order], [c[order] for c in columns]
    for b, lo, hi in _runs(bucket_of(keys, n_buckets)):
        yield b, dump(_deltas(keys[lo:hi]), *[c[lo:hi] if c.dtype.kind == "f" else _least(c[lo:hi]) for c in columns])


def _totals(replies: list[bytes], keys: np.ndarray) -> list[np.ndarray]:
    """The columns of the replies, in the keys' order; empty ones where nothing was asked."""
    order, columns = np.argsort(keys, kind="stable"), []
    for found in zip(*map(load, replies)):
        column = np.concatenate(found)
        columns.append(np.empty_like(column))
        columns[-1][order] = column
    return columns or [np.zeros(0, np.int64)] * (K + 3)


_REQUEST = {"bucket": pa.int32(), "sender": pa.int64(), "data": pa.binary()}
_REQUEST_SQL = "bucket int, sender long, data binary"
_REPLY_SQL = "bucket int, sender long, data binary, sums array<long>"
_STATE_SQL = "bucket int, split boolean, state binary, other int, data binary, sums array<long>"


def _answered(requests: DataFrame, answers, facts: Facts, purpose: str) -> DataFrame:
    """One reply per request, and one row per bucket (sender NULL) with its sums."""

    def answer(table: pa.Table) -> pa.Table:
        # In one order, so that sums of fractions come out the same every time.
        table = table.sort_by("sender")
        replies, sums = answers(table.column("data").to_pylist(), facts)
        bucket = table.column("bucket")[0].as_py()
        n = table.num_rows
        return pa.table(
            {
                "bucket": pa.array([bucket] * (n + 1), pa.int32()),
                "sender": pa.array([*table.column("sender").to_pylist(), None], pa.int64()),
                "data": pa.array([*replies, None], pa.binary()),
                "sums": pa.array([None] * n + [sums], pa.list_(pa.int64())),
            }
        )

    return stored(requests.groupBy("bucket").applyInArrow(answer, _REPLY_SQL), purpose)


def _counted(requests: DataFrame, facts: Facts) -> DataFrame:
    """The model's table: a row per bucket; and what split buckets ask of others (``other`` not NULL)."""

    def count(table: pa.Table) -> pa.Table:
        table = table.sort_by("sender")
        state = Part.of(table.column("data").to_pylist(), table.column("sender").to_pylist(), facts.order)
        part = Part(state)
        split = bool((part.parts > 1).any())
        asked = list(_asked(*part.listed(), facts.n_buckets)) if split and facts.order > 2 else []
        n = len(asked)
        return pa.table(
            {
                "bucket": pa.array([table.column("bucket")[0].as_py()] * (n + 1), pa.int32()),
                "split": pa.array([split] * (n + 1)),
                "state": pa.array([state, *[None] * n], pa.binary()),
                "other": pa.array([None, *[b for b, _ in asked]], pa.int32()),
                "data": pa.array([None, *[d for _, d in asked]], pa.binary()),
                "sums": pa.array([part.sums(), *[None] * n], pa.list_(pa.int64())),
            }
        )

    return stored_by(requests.groupBy("bucket").applyInArrow(count, _STATE_SQL), "bucket", "lm-table")


def _sums(rows: DataFrame, n: int) -> np.ndarray:
    row = rows.filter("sums IS NOT NULL").agg(*[F.sum(F.col("sums")[k]) for k in range(n)]).first() if n else []
    return np.array([int(x or 0) for x in row], np.int64)


def _discounts(n: np.ndarray) -> np.ndarray:
    """Katz's form of Good-Turing, as it comes out of the numbers 1 .. K + 1; not a number where one is missing."""
    r = np.arange(1, K + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        common = (K + 1) * n[K] / n[0]
        found = ((r + 1) * n[1:] / (r * n[:-1]) - common) / (1 - common)
    return np.where(n[1:] * n[:-1] * n[K] * n[0] > 0, found, np.nan) if common < 1 else np.full(K, np.nan)


def good_turing(n: list[int]) -> np.ndarray:
    """Discounts of the counts 1 .. K from the numbers of n-grams seen 1 .. K + 1 times.

    From the first count on whose own discount is not between 0 and 1, or not above the lower counts' once it is
    applied, the numbers come from a line fitted to log n over log r (Gale's Simple Good-Turing).  It
    gives discounts if it falls steeper than -1; where it doesn't, or only one number isn't 0 (a handful of
    texts), there is no Good-Turing estimate, and one absolute discount is used instead.
    """
    r = np.arange(1, K + 2)
    counts = np.array(n, float)
    held = np.flatnonzero(counts) + 1
    if len(held) > 1:
        # Next to counts that nothing was seen as often as, the number is shared with these.
        before, after = np.concatenate([[0], held[:-1]]), np.append(held[1:], 2 * held[-1] - held[-2])
        slope = np.polyfit(np.log(held), np.log(2 * counts[held - 1] / (after - before)), 1)[0]
        if slope < -1 - 1e-9:
            fitted, own = _discounts(r**slope), _discounts(counts)
            for k in range(K, -1, -1):
                d = np.concatenate([own[:k], fitted[k:]])
                if (d > 0).all() and (d < 1).all() and (np.diff(d * r[:-1]) > 0).all():
                    return d
            return fitted
    absolute = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    return 1 - absolute / np.arange(1, K + 1)


class Facts(NamedTuple):
    """The few numbers that all tasks need."""

    order: int
    tokens: int
    n_buckets: int
    total: int = 0
    distinct: int = 0
    split: bool = False
    discounts: tuple[np.ndarray, ...] = ()


def _with_replies(rows: DataFrame, key: str, replies: list[DataFrame], how: str = "inner") -> DataFrame:
    """Rows with the replies to them, in the order of the buckets that they come from."""
    for k, reply in enumerate(replies):
        own = reply.filter("sender IS NOT NULL")
        own = own.select(F.col("sender").cast(rows.schema[key].dataType).alias(key), F.struct(F.col("bucket").alias("source"), "data").alias("part"))
        rows = rows.join(own.groupBy(key).agg(F.array_sort(F.collect_list("part")).alias(f"reply{k}")), key, how)
    return rows


def _replies(row: pa.RecordBatch, first: int) -> list[list[bytes]]:
    return [[r["data"] for r in row.column(k)[0].as_py() or []] for k in range(first, row.num_columns)]


def _told(row: pa.RecordBatch, facts: Facts) -> tuple[Block, list[list[bytes]]]:
    """The block of a one-row batch with its words' numbers and counts; the other replies."""
    block = Block(*[row.column(k)[0].as_py() for k in (1, 2, 3)])
    numbers, *others = _replies(row, 4)
    block.set_unigrams(numbers, facts)
    return block, others


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


def score(
    docs: DataFrame, held_out: Column, order: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each text; ``order`` is 2 or more.

    The model is learned from the rows where ``held_out`` isn't true.  Scores are log10 probabilities.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).alias("text")
    )
    kinds = "block long, n_tokens long, texts binary, vocabulary binary, tokens binary"
    blocks = stored_by(rows.mapInArrow(_blocks, kinds), "block", "lm-blocks")
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    facts = Facts(order, tokens, max(1, -(-tokens // BUCKET_TOKENS)))
    plain = blocks.select("block", "texts", "vocabulary", "tokens")

    def words_of(batches: Iterator[pa.RecordBatch], facts: Facts = facts) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys, trained, every = Block(*[batch.column(c)[k].as_py() for c in (1, 2, 3)]).unigrams()
                for b, lo, hi in _runs(bucket_of(keys, facts.n_buckets)):
                    data = dump(_deltas(keys[lo:hi]), _least(trained[lo:hi]), _least(every[lo:hi]))
                    yield _row(_REQUEST, b, batch.column(0)[k].as_py(), data)

    with arrow_rows(spark, 4):
        numbers = _answered(plain.mapInArrow(words_of, _REQUEST_SQL), _sum_words, facts, "lm-words")
    total, distinct, n_split = _sums(numbers, 3).tolist()
    facts = facts._replace(total=total, distinct=distinct, split=n_split > 0)

    def grams_of(batches: Iterator[pa.RecordBatch], facts: Facts = facts) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, _ = _told(batch.slice(k, 1), facts)
                block.grams(facts)
                for b, data in block.requests():
                    yield _row(_REQUEST, b, batch.column(0)[k].as_py(), data)

    told = _with_replies(plain, "block", [numbers])
    with arrow_rows(spark, 4):
        table = _counted(told.mapInArrow(grams_of, _REQUEST_SQL), facts)
    sums = _sums(table, (order - 1) * (K + 1)).reshape(order - 1, K + 1)
    shared = []
    if facts.split and order > 2:
        asked = table.filter("other IS NOT NULL").select(F.col("other").alias("bucket"), F.col("bucket").cast("long").alias("sender"), "data")
        with arrow_rows(spark, 4):
            shared.append(_answered(asked, _sum_shared, facts, "lm-shared-1"))
        sums[:-1] += _sums(shared[0], (order - 2) * (K + 1)).reshape(order - 2, K + 1)
    facts = facts._replace(discounts=tuple(good_turing(n.tolist()) for n in sums))
    states = table.filter("other IS NULL").select("bucket", "split", "state")

    def asks(batches: Iterator[pa.RecordBatch], facts: Facts = facts) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                for b, data in _asked(*Part(row.column(2)[0].as_py()).advance(facts, _replies(row, 3)), facts.n_buckets):
                    yield _row(_REQUEST, b, row.column(0)[0].as_py(), data)

    for k in range(2, order + 1) if facts.split else ():
        asked = _with_replies(states.filter("split"), "bucket", shared, "left").mapInArrow(asks, _REQUEST_SQL)
        with arrow_rows(spark, 4):
            shared.append(_answered(asked, _sum_shared, facts, f"lm-shared-{k}"))

    def answers(batches: Iterator[pa.RecordBatch], facts: Facts = facts) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                part = Part(row.column(2)[0].as_py())
                p = part.advance(facts, _replies(row, 3))
                for block, place in zip(part.blocks.tolist(), part.place):
                    values, index = np.unique(p[place], return_inverse=True)
                    yield _row(_REQUEST, row.column(0)[0].as_py(), block, dump(_deltas(values.view(np.int64)), _least(index)))

    def scored(batches: Iterator[pa.RecordBatch], facts: Facts = facts) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, (found,) = _told(batch.slice(k, 1), facts)
                block.grams(facts)
                p = [np.cumsum(values).view(np.float64)[index] for values, index in map(load, found)]
                sums = lambda x: np.add.reduceat(x[block.token], block.begins)
                base = np.log10((block.seen + 0.5) / (facts.total + 0.5 * (facts.distinct + 1)))
                columns = [
                    pa.array(block.ids, mask=block.ids == _NULL_ID),
                    pa.array(block.held),
                    pa.array(block.sizes),
                    pa.array(sums((block.seen > 0).astype(np.int64))),
                    pa.array(sums(base)),
                    pa.array(np.add.reduceat(np.log10(np.concatenate(p))[block.gram_of_token], block.begins)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORES.split(", ")])

    answered = _with_replies(states, "bucket", shared, "left").mapInArrow(answers, _REQUEST_SQL)
    found = _with_replies(plain, "block", [numbers, answered]).mapInArrow(scored, _SCORES)
    with arrow_rows(spark, 4):
        found = stored(found, "lm-scores")
    return found.withColumn("train_tokens", F.lit(facts.total).cast("long"))
