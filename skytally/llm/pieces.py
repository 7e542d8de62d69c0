"""Sampled segmentations into SentencePiece pieces, without replacement, and their decoding.

A text's segmentations form a lattice over its characters.  Blanks stand at a piece's begin only, or are
all of it, and no piece holds a line end, so the lattice is a chain of small ones, one per unit (a run of
blanks with the characters up to the next blank, or a line end), which are built once per different unit.  What
follows a place in a unit depends on the rest of it alone, so units that end alike share the nodes of their end.

Each segmentation has the probability of its pieces, and sampling k of them without replacement is
taking the k largest of their Gumbel-perturbed log-probabilities.  These are found best first, as
in A* search: a set of unexplored segmentations is known by the part they share with a found one
and by what they exclude; its bound, the greatest perturbed value in it, is drawn exactly (a Gumbel
at the set's log-probability, cut off at its parent's value).  The set with the greatest bound is
opened next: it yields the next sample and splits.  The bound of the best set left after k samples
is the threshold that the inclusion score P(sampled) = 1 - exp(-exp(log_prob - threshold)) refers to.

Randomness is a function of the row key, the sample's number and the place in the text: the same row
gives the same samples on every machine and in any partitioning.

The BPE model has ranks, not probabilities: the piece of rank r weighs 1 / (r + 3) ** power.
Characters without a piece, and a literal word mark, are spelled in byte pieces; so decoding gives
back every text.  Null and empty texts have one segmentation, the empty one, with log_prob 0 and
inclusion 1; texts with fewer than k segmentations give what they have.  Rows with equal keys and
texts give equal samples, a null key is a key of its own.  Only id and text are looked at, whatever
other columns there are; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import begin, keeps
from skytally.llm.shingles import mixed

MARK = "▁"
_UNIT = re.compile(r" +[^ \n]*|[^ \n]+|\n")
_U = np.uint64
#: Edges of lattices that a worker keeps (about 40 bytes each, with nodes and units) before it starts anew.
MAX_EDGES = 2_500_000
#: Bytes of text worked on at once; a longer text is taken alone.
SLICE_BYTES = 500_000


class _Trie:
    """The pieces by their characters: state 0 is the empty beginning."""

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        states, moves = {"": 0}, []
        for piece in pieces:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in states:
                    moves.append((states[piece[: n - 1]] << 21 | ord(piece[n - 1]), len(states)))
                    states[piece[:n]] = len(states)
        moves.sort()
        self._keys, self._next = (np.array(c, np.int64) for c in zip(*moves))
        found = [pieces.get(s, (-1, -math.inf)) for s in states]
        self.piece = np.array([k for k, _ in found], np.int32)
        self.weight = np.exp(np.array([w for _, w in found]))
        self._other = re.compile("[^" + "".join(re.escape(p) for p in pieces if len(p) == 1) + "]")

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each state goes with the character, and whether it goes anywhere."""
        key = state << 21 | code
        place = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return self._next[place], self._keys[place] == key

    def spells(self, unit: str) -> bool:
        """Whether each character is a piece."""
        return self._other.search(unit) is None


class Lattices:
    """Lattices of units, one after the other in flat arrays that grow as units are met."""

    def __init__(self, model_path: str, power: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * n
        byte_ids = [0] * 256
        pieces: dict[str, tuple[int, float]] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
                if MARK in piece.lstrip(MARK) or "\n" in piece:
                    raise ValueError(f"piece {i} joins units: {piece!r}")
                pieces[piece.replace(MARK, " ")] = (i, -power * math.log(i + 3))
        self.pieces, self.longest = pieces, max(map(len, pieces))
        self.byte_ids, self.byte_score = byte_ids, -power * math.log(4 * n)
        # Units up to this length are built together, with probabilities as they are, not as logarithms.
        self.short = min(48, int(600 / (power * math.log(n + 3))))
        self.trie = _Trie(pieces)
        self.max_edges = MAX_EDGES
        self.clear()

    def clear(self) -> None:
        self.base: dict[str, int] = {}
        # Of each edge: piece, next node (-1 at the end of the unit), log-probability given the node,
        # and the probability of the node's edges up to this one.
        self.piece, self.target, self.logp, self.upto = array("i"), array("i"), array("d"), array("d")
        self.first = array("i", [0])  # each node's first edge
        # Of each node of a short unit: the sum over all ways to the end.
        self.ways = array("d")
        # These nodes by what they are: the node one character on (plus 1; 0 at the end) and the character; sorted.
        self.known, self.number = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, unit: str) -> int:
        """Number of the unit's first node."""
        symbols: list[str | int] = []
        for c in unit:
            symbols += [c] if c in self.pieces else list(c.encode("utf-8", "surrogatepass"))
        n = len(symbols)
        below: list[list[tuple[int, int, float]]] = []
        beta = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            edges = []
            if isinstance(symbols[i], int):
                edges.append((self.byte_ids[symbols[i]], i + 1, self.byte_score))
            else:
                word = ""
                for j in range(i, min(n, i + self.longest)):
                    if isinstance(symbols[j], int):
                        break
                    word += symbols[j]
                    if word in self.pieces:
                        k, score = self.pieces[word]
                        edges.append((k, j + 1, score))
            total = [s + beta[j] for _, j, s in edges]
            top = max(total)
            beta[i] = top + math.log(sum(math.exp(t - top) for t in total))
            below.append(edges)
        start = len(self.first) - 1
        for i, edges in enumerate(reversed(below)):
            reach = 0.0
            for k, j, score in edges:
                logp = score + beta[j] - beta[i]
                reach += math.exp(logp)
                self.piece.append(k)
                self.target.append(start + j if j < n else -1)
                self.logp.append(min(logp, 0.0))
                self.upto.append(reach)
            self.upto[-1] = 1.0
            self.first.append(len(self.piece))
            # No other unit shares these.
            self.ways.append(math.nan)
        self.base[unit] = start
        return start

    def add_short(self, units: list[str]) -> None:
        """The same for many units of which every character is a piece, in arrays over all their new nodes."""
        sizes = np.array([len(u) for u in units])
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        start = len(self.first) - 1
        # The node at each place, from the ends backwards; those that are new, and a place where each stands.
        number = np.full(len(codes), -1, np.int64)
        rest, going = np.zeros(len(units), np.int64), np.arange(len(units))
        count, places, fresh_keys, fresh_numbers = start, [], [], []
        for d in range(1, int(sizes.max()) + 1):
            going = going[sizes[going] >= d]
            at = begin[going] + sizes[going] - d
            keys, one, of = np.unique(rest[going] << 21 | codes[at], return_index=True, return_inverse=True)
            found = np.searchsorted(self.known, keys)
            there = np.zeros(len(keys), bool)
            inside = found < len(self.known)
            there[inside] = self.known[found[inside]] == keys[inside]
            numbers = np.empty(len(keys), np.int64)
            numbers[there] = self.number[found[there]]
            made = int((~there).sum())
            numbers[~there] = np.arange(count, count + made)
            count += made
            places.append(at[one[~there]])
            fresh_keys.append(keys[~there])
            fresh_numbers.append(numbers[~there])
            number[at] = numbers[of]
            rest[going] = numbers[of] + 1
        self.base.update(zip(units, number[begin].tolist()))
        place = np.concatenate(places)
        if not len(place):
            return
        keys, numbers = np.concatenate(fresh_keys), np.concatenate(fresh_numbers)
        order = np.argsort(keys)
        into = np.searchsorted(self.known, keys[order])
        self.known = np.insert(self.known, into, keys[order])
        self.number = np.insert(self.number, into, numbers[order])
        ends = np.repeat(begin + sizes, sizes)[place]
        left = ends - place
        n = len(place)
        weight = np.zeros((n, self.longest))
        piece = np.zeros((n, self.longest), np.int32)
        state, at = np.zeros(n, np.int64), np.arange(n)
        for k in range(self.longest):
            state, alive = self.trie.step(state, codes[place[at] + k])
            at, state = at[alive], state[alive]
            found = self.trie.piece[state] >= 0
            piece[at[found], k] = self.trie.piece[state[found]]
            weight[at[found], k] = self.trie.weight[state[found]]
            more = left[at] > k + 1
            at, state = at[more], state[more]
            if not len(at):
                break
        # From the ends of the units backwards: the sum over all ways to the end.
        self.ways.frombytes(np.zeros(n).tobytes())
        ways = np.frombuffer(self.ways, np.float64)
        by_left = np.argsort(left, kind="stable")
        steps = np.searchsorted(left[by_left], np.arange(1, int(left.max()) + 2))
        for d, (a, b) in enumerate(zip(steps[:-1], steps[1:]), 1):
            nodes = by_left[a:b]
            total = weight[nodes, d - 1].copy() if d <= self.longest else np.zeros(len(nodes))
            for k in range(min(d - 1, self.longest)):
                total += weight[nodes, k] * ways[number[place[nodes] + k + 1]]
            ways[start + nodes] = total
        node, k = np.nonzero(weight)
        target = place[node] + k + 1
        last = target == ends[node]
        target = np.where(last, -1, number[np.where(last, 0, target)])
        share = weight[node, k] * np.where(last, 1.0, ways[target]) / ways[start + node]
        del ways
        # The likeliest edge of a node first: most walks look at one edge alone.
        order = np.lexsort((-share, node))
        node, k, target, share = (x[order] for x in (node, k, target, share))
        count = np.bincount(node, minlength=n)
        first = np.cumsum(count) - count
        reach = np.cumsum(share)
        reach -= np.repeat(reach[first] - share[first], count)
        reach[first + count - 1] = 1.0
        self.first.frombytes((len(self.piece) + np.cumsum(count)).astype(np.int32).tobytes())
        self.piece.frombytes(piece[node, k].tobytes())
        self.target.frombytes(target.astype(np.int32).tobytes())
        self.logp.frombytes(np.minimum(np.log(share), 0.0).tobytes())
        self.upto.frombytes(reach.tobytes())

    def nodes(self, units: list[str]) -> np.ndarray:
        """First node of each unit; new units are added."""
        base = self.base
        new = set(units).difference(base)
        short = [u for u in new if len(u) <= self.short and self.trie.spells(u)]
        for at in range(0, len(short), 20_000):
            self.add_short(short[at : at + 20_000])
        for u in new:
            if u not in base:
                self.add(u)
        return np.fromiter(map(base.__getitem__, units), np.int64, len(units))

    def views(self) -> tuple[np.ndarray, ...]:
        """The arrays, as they are now and without a copy: they can't grow while a view of them is held."""
        if not self.piece:
            return *(np.zeros(0, k) for k in (np.int32, np.int32, np.float64, np.float64)), np.zeros(1, np.int32)
        ints, floats = (self.piece, self.target), (self.logp, self.upto)
        return (
            *(np.frombuffer(a, np.int32) for a in ints),
            *(np.frombuffer(a, np.float64) for a in floats),
            np.frombuffer(self.first, np.int32),
        )

    def decode(self, ids: list[int]) -> str:
        """The text of a segmentation: without the blank that every text begins with here."""
        found = b"".join([self.bytes_of[i] for i in ids])
        return found.decode("utf-8", "surrogatepass")[1:]


@lru_cache(2)
def _lattices(model_path: str, power: float) -> Lattices:
    return Lattices(model_path, power)


def _seeds(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    return mixed(keys) + places.astype(np.uint64) * _U(0x9E3779B97F4A7C15)


def _uniform(seeds: np.ndarray, sample: int, purpose: int) -> np.ndarray:
    """Uniform in (0, 1), a function of its arguments."""
    x = mixed(seeds, 1_000_003 * purpose + sample)
    return ((x >> _U(12)).astype(np.float64) + 0.5) * 2.0**-52


def _walk(views, nodes: np.ndarray, seeds: np.ndarray, sample: int):
    """One segmentation of each unit: its edges in order, where each unit's begin, log-probabilities."""
    _, target, logp, upto, first = views
    at, active, steps = nodes, np.arange(len(nodes)), []
    count = np.zeros(len(nodes), np.int64)
    while len(active):
        u = _uniform(seeds[active], sample, 10 + len(steps))
        edge = first[at].astype(np.int64)
        beyond = np.flatnonzero(u >= upto[edge])
        while len(beyond):
            edge[beyond] += 1
            beyond = beyond[u[beyond] >= upto[edge[beyond]]]
        steps.append((active, edge))
        count[active] += 1
        at = target[edge].astype(np.int64)
        active, at = active[at >= 0], at[at >= 0]
    begin = np.concatenate([[0], np.cumsum(count)])
    edges = np.empty(begin[-1], np.int64)
    for k, (units, edge) in enumerate(steps):
        edges[begin[units] + k] = edge
    score = np.add.reduceat(logp[edges], begin[:-1]) if len(nodes) else np.zeros(0)
    return edges, begin, np.minimum(score, 0.0)


def _other(lattices: Lattices, node: int, taken: list[tuple[int, ...]], draw) -> tuple[int, ...]:
    """A segmentation of one unit that isn't among the taken ones, by its probability."""
    logp, target, first = lattices.logp, lattices.target, lattices.first
    path = []
    while node >= 0:
        weights = []
        for edge in range(first[node], first[node + 1]):
            gone = sum(math.exp(sum(logp[e] for e in t)) for t in taken if t[0] == edge)
            # A set that is taken whole is left out exactly, not up to rounding.
            ways = math.exp(logp[edge]) - gone
            weights.append(max(ways, 0.0) if ways > 1e-12 * math.exp(logp[edge]) else 0.0)
        u, edge = draw() * sum(weights), first[node]
        for k, w in enumerate(weights):
            if w > 0:
                edge = first[node] + k
                u -= w
                if u < 0:
                    break
        path.append(edge)
        taken = [t[1:] for t in taken if t[0] == edge and len(t) > 1]
        node = target[edge]
    return tuple(path)


def _cut_gumbel(location: np.ndarray, u: np.ndarray, cut: float) -> np.ndarray:
    """Gumbel values at the locations, given that they are below the cut."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        return np.where(np.isneginf(location), -np.inf, location - np.log(-np.log(u) + np.exp(location - cut)))


def _rest(logp: np.ndarray) -> np.ndarray:
    """log(1 - p)."""
    with np.errstate(divide="ignore"):
        rest = -np.expm1(logp)
        return np.where(rest > 1e-13, np.log(np.maximum(rest, 1e-300)), -np.inf)


class _Text:
    """The search in one text: found samples, and the sets that are left with their bounds."""

    def __init__(self, key: np.ndarray, nodes: np.ndarray, seeds: np.ndarray):
        self.key, self.nodes, self.seeds = key, nodes, seeds
        self.samples: list[tuple] = []  # edges, begins, log-probability of each unit, perturbed value
        self.sets: list[tuple] = []  # of a sample: first unit, bounds of the units from there on
        self.taken: dict[tuple[int, int], list] = {}  # segmentations excluded at (sample, unit)

    def found(self, unit: int, edges, begins, scores, value: float) -> None:
        """Add a sample that first differs from an earlier one at ``unit - 1``."""
        k = len(self.samples)
        self.samples.append((edges, begins, scores, value))
        ahead = np.concatenate([[0.0], np.cumsum(scores)])[:-1]
        u = _uniform(self.seeds[unit:], k, 2)
        self.sets.append((unit, _cut_gumbel(ahead[unit:] + _rest(scores[unit:]), u, value)))

    def best(self) -> tuple[float, int, int]:
        """Bound, sample and unit of the best set left."""
        tops = [(float(b.max()), k, first + int(b.argmax())) for k, (first, b) in enumerate(self.sets) if len(b)]
        return max(tops, default=(-math.inf, 0, 0))

    def open(self, lattices: Lattices, value: float, k: int, unit: int) -> tuple[int, ...]:
        """The segmentation of ``unit`` in the best segmentation of the set (k, unit); the set shrinks by it."""
        edges, begins, scores, _ = self.samples[k]
        taken = self.taken.setdefault((k, unit), [tuple(edges[begins[unit] : begins[unit + 1]].tolist())])
        count = iter(range(1 << 30))
        new = len(self.samples)
        place = self.seeds[unit : unit + 1]
        draw = lambda: float(_uniform(place, new, 100_000 + next(count))[0])
        path = _other(lattices, int(self.nodes[unit]), taken, draw)
        taken.append(path)
        gone = sum(math.exp(sum(lattices.logp[e] for e in t)) for t in taken)
        left = float(scores[:unit].sum()) + (math.log(1 - gone) if 1 - gone > 1e-12 else -math.inf)
        first, bounds = self.sets[k]
        u = _uniform(place, new, 3)
        bounds[unit - first] = _cut_gumbel(np.array([left]), u, value)[0]
        return path


def sample_texts(lattices: Lattices, keys: np.ndarray, texts: list[str], k: int):
    """For each text up to k tuples (ids, log_prob, inclusion), greatest perturbed value first."""
    if len(lattices.piece) > lattices.max_edges:
        lattices.clear()
    units = [_UNIT.findall(" " + t) if t else [] for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in units])])
    nodes = lattices.nodes([u for x in units for u in x])
    views = lattices.views()
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    places = np.arange(ends[-1]) - ends[owner]
    seeds = _seeds(keys[owner], places)
    edges, begins, scores = _walk(views, nodes, seeds, 0)
    searches = []
    for d in range(len(texts)):
        a, b = ends[d], ends[d + 1]
        s = _Text(keys[d : d + 1], nodes[a:b], seeds[a:b])
        value = -math.log(-math.log(float(_uniform(s.key, 0, 1)[0])))
        s.found(0, edges[begins[a] : begins[b]], begins[a : b + 1] - begins[a], scores[a:b], value)
        searches.append(s)
    for sample in range(1, k):
        # Open each text's best set, and walk the rest of all these texts together.
        opened = []
        for d, s in enumerate(searches):
            value, of, unit = s.best()
            if value > -math.inf:
                opened.append((d, of, unit, value, s.open(lattices, value, of, unit)))
        if not opened:
            break
        rest = [searches[d].nodes[unit + 1 :] for d, _, unit, _, _ in opened]
        rest_seeds = np.concatenate([searches[d].seeds[unit + 1 :] for d, _, unit, _, _ in opened])
        sizes = [len(x) for x in rest]
        tail, tail_begins, tail_scores = _walk(views, np.concatenate(rest), rest_seeds, sample)
        at = 0
        for (d, of, unit, value, path), size in zip(opened, sizes):
            e, b, sc, _ = searches[d].samples[of]
            a, z = tail_begins[at], tail_begins[at + size]
            own = np.array(path, np.int64)
            new_b = np.concatenate([b[: unit + 1], b[unit] + len(own) + tail_begins[at : at + size + 1] - a])
            own_score = min(float(views[2][own].sum()), 0.0)
            searches[d].found(
                unit + 1,
                np.concatenate([e[: b[unit]], own, tail[a:z]]),
                new_b,
                np.concatenate([sc[:unit], [own_score], tail_scores[at : at + size]]),
                value,
            )
            at += size
    for s in searches:
        threshold, out = s.best()[0], []
        for e, _, sc, _ in s.samples:
            logp = float(sc.sum())
            score = 1.0 if threshold == -math.inf else -math.expm1(-math.exp(min(logp - threshold, 700.0)))
            out.append((views[0][e], logp, score))
        yield out


def sample_segmentations(
    docs: DataFrame,
    model_path: str,
    k: int = 2,
    power: float = 0.5,
    seed: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    max_edges: int = MAX_EDGES,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(doc_id, sample from 1, ids, n_pieces, log_prob, inclusion, restored): up to k rows of each row.

    ``restored`` says that decoding the ids gives the text (null: empty).  ``max_edges`` bounds what a worker keeps of
    lattices and ``slice_bytes`` the text it works on at once: more saves time, the result is the same.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.lit(seed), doc_id), F.col(text))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, sample int, ids array<int>, n_pieces long, log_prob double, inclusion double, restored boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("pieces")
        lattices = _lattices(model_path, power)
        lattices.max_edges = max_edges
        keeps("pieces", lattices.clear)
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1).to_numpy().astype(np.int64).view(np.uint64)
            taken = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy()
            upto = np.concatenate([[0], np.cumsum(taken, dtype=np.int64)])
            start = 0
            while start < len(taken):
                end = max(start + 1, int(np.searchsorted(upto, upto[start] + slice_bytes, "right")) - 1)
                part = [t or "" for t in batch.column(2).slice(start, end - start).to_pylist()]
                found = list(sample_texts(lattices, keys[start:end], part, k))
                owner = [start + d for d, f in enumerate(found) for _ in f]
                flat = [x for f in found for x in f]
                size = np.array([len(x[0]) for x in flat])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()),
                    pa.array(np.concatenate([x[0] for x in flat]), pa.int32()),
                )
                restored = [(lattices.decode(x[0].tolist()) if len(x[0]) else "") == part[o - start] for x, o in zip(flat, owner)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(owner)),
                        pa.array([n + 1 for f in found for n in range(len(f))], pa.int32()),
                        lists,
                        pa.array(size, pa.int64()),
                        pa.array([x[1] for x in flat]),
                        pa.array([x[2] for x in flat]),
                        pa.array(restored),
                    ],
                    ["doc_id", "sample", "ids", "n_pieces", "log_prob", "inclusion", "restored"],
                )
                start = end

    return rows.mapInArrow(run, out)
