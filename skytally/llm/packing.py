"""Token ids in as few bits as the vocabulary needs, in blocks that can be read from any place.

The table of a corpus has one row per block: about ``BLOCK_IDS`` ids of consecutive texts in ascending
id order, as one binary value of its own format (little-endian):

    magic "TKB1" | u8 bits | u32 texts | u64 ids
    i64 id of each text | u64 end of each text's ids within the block
    ids, each in ``bits`` bits, lowest bit first

Beside it stand the file's number, the block's number in the file, its count of ids and its first and
last text, so that a reader finds a text's block by the columns' statistics, and the ids from i to j of
a block start at bit i * bits: numpy unpacks them without touching the rest.  Spark writes the table as
Parquet, so a lost executor leaves no half-written file behind.

A null text has no ids but the end id, like an empty one.  Rows with a null doc_id come first and are
numbered like others.  Rows with the same doc_id follow each other in the order of their texts.  A text
longer than a block makes a block of its own.  Only id and text are looked at, whatever other columns
there are; an empty table gives a table without blocks.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm.common import begin, keeps, stored
from skytally.llm.shingles import slices
from skytally.session import shared_dir

BLOCK_IDS = 1 << 19
MAGIC = b"TKB1"
#: Pieces of text whose ids a worker remembers before it starts anew.
MAX_KNOWN = 700_000
_PIECE = re.compile("\n| ?[^ \n]+")
#: White space but the blank and the line end, of any reading of \s.
_OTHER_SPACE = "[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_NULL_ID = np.iinfo(np.int64).min


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    shifts = np.arange(bits, dtype=np.uint32)
    return np.packbits((ids.astype(np.uint32)[:, None] >> shifts & 1).astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of packed data, as unsigned 32-bit integers."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", end - start, start * bits // 8).astype("<u4")
    first, last = start * bits, end * bits
    part = np.frombuffer(data, np.uint8, -(-last // 8) - first // 8, first // 8)
    flat = np.unpackbits(part, bitorder="little")[first % 8 : first % 8 + last - first]
    return (flat.reshape(-1, bits).astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype="<u4")


def write_block(texts: np.ndarray, ends: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    head = MAGIC + bytes([bits]) + len(texts).to_bytes(4, "little") + len(ids).to_bytes(8, "little")
    return b"".join([head, texts.astype("<i8").tobytes(), ends.astype("<u8").tobytes(), pack(ids, bits)])


class Block:
    """A block's header; ids are unpacked when asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        self.bits, n = data[4], int.from_bytes(data[5:9], "little")
        self.n_ids = int.from_bytes(data[9:17], "little")
        self.texts = np.frombuffer(data, "<i8", n, 17)
        self.ends = np.frombuffer(data, "<u8", n, 17 + 8 * n).astype(np.int64)
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self._packed = memoryview(data)[17 + 16 * n :]

    def ids(self, start: int, end: int) -> np.ndarray:
        return unpack(self._packed, self.bits, start, end)

    def text(self, k: int) -> np.ndarray:
        return self.ids(int(self.begins[k]), int(self.ends[k]))


class Encoder:
    """Encodes with the tokenizers library, each different piece of text once.

    Byte-level BPE never joins a word with the blank or the line end that follows it.  So where blanks and
    line ends stand alone between other characters, the pieces between them can be encoded one by
    one: Arrow finds the different pieces of many texts, and numpy puts their ids in the texts' order.  Texts with
    any other white space, or with the content of one of the vocabulary's added tokens, go to the library whole.
    So the ids are those of the library for whole texts.  ``plain_specials`` makes the contents of special tokens
    ordinary text instead.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        # A task has one core; threads of the library's own would only take others' time.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = plain_specials
        added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._odd = "|".join([*map(re.escape, added), r"[ \n][ \n]", r"\A[ \n]", r"[ \n]\z", _OTHER_SPACE])
        self._split = self._line_end = None
        self.clear()
        kind = type(self._tokenizer.pre_tokenizer).__name__
        self._split = kind == "ByteLevel" and self._tokenizer.normalizer is None and not self._merges_words()

    def clear(self) -> None:
        """Forget all pieces."""
        self._known: dict[str, int] = {}
        self._ids, self._begins, self._uses = array("I"), array("q", [0]), array("q")

    def _thin_out(self) -> None:
        """Forget the half of the pieces that was used least."""
        uses, words = np.frombuffer(self._uses, np.int64), list(self._known)
        kept = np.sort(np.argsort(-uses, kind="stable")[: len(uses) // 2]).tolist()
        data = [self._ids[self._begins[k] : self._begins[k + 1]].tobytes() for k in kept]
        uses = uses[kept]
        self.clear()
        self._add([words[k] for k in kept], data)
        # Old uses count less than new ones.
        self._uses.frombytes((uses // 2).tobytes())

    def _merges_words(self) -> bool:
        """Whether the library itself disagrees with encoding pieces one by one, on a probe."""
        probe = ["a", " b1,c", " 2's", " _x", "\n", "d", " e!"]
        return b"".join(self._whole(probe)) != self._whole(["".join(probe)])[0]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, pieces: list[str], found: list[bytes]) -> None:
        first = len(self._begins) - 1
        self._ids.frombytes(b"".join(found))
        ends = self._begins[-1] + np.cumsum([len(f) // 4 for f in found])
        self._begins.frombytes(ends.astype(np.int64).tobytes())
        self._known.update(zip(pieces, range(first, first + len(pieces))))

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces, many in one text with a line end after each."""
        if self._line_end is None:
            self._line_end = int(np.frombuffer(self._whole(["\n"])[0], "<u4")[0])
        groups = [pieces[k : k + 500] for k in range(0, len(pieces), 500)]
        for group, data in zip(groups, self._whole(["\n".join(g) for g in groups])):
            cuts = np.flatnonzero(np.frombuffer(data, "<u4") == self._line_end) * 4
            if "\n" not in group and len(cuts) == len(group) - 1:
                begins, ends = [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)]
                self._add(group, [data[a:b] for a, b in zip(begins, ends)])
            else:
                self._add(group, self._whole(group))

    def _pieces(self, text: str) -> list[str] | None:
        """The pieces of one text; None where it has to be encoded whole."""
        return None if pc.match_substring_regex(pa.array([text]), self._odd)[0].as_py() else _PIECE.findall(text)

    def _in_pieces(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the texts, one after the other, and the end of each text's."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        # A blank opens a piece; a line end is one.
        line_end = data == 10
        opens = (data == 32) | line_end
        opens[1:] |= line_end[:-1]
        opens[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(opens)
        cuts = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        found = pa.Array.from_buffers(pa.binary(), len(starts), [None, cuts, pa.py_buffer(data)]).dictionary_encode()
        words = found.dictionary.cast(pa.string()).to_pylist()
        if len(self._known) > MAX_KNOWN:
            self._thin_out()
        known, index = self._known, found.indices.to_numpy()
        self._learn([w for w in words if w not in known])
        number = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        self._uses.frombytes(bytes(8 * (len(known) - len(self._uses))))
        np.frombuffer(self._uses, np.int64)[number] += np.bincount(index, minlength=len(words))
        number = number[index]
        ids, begins = np.frombuffer(self._ids, np.uint32), np.frombuffer(self._begins, np.int64)
        begin, size = begins[number], begins[number + 1] - begins[number]
        ends = np.cumsum(size)
        flat = ids[np.repeat(begin - (ends - size), size) + np.arange(ends[-1])]
        return flat, np.concatenate([[0], ends])[np.searchsorted(starts, offsets[1:])]

    def encode_array(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids, as bytes of unsigned 32-bit integers; null texts are empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        odd = np.ones(len(texts), bool)
        if self._split:
            odd = pc.match_substring_regex(texts, self._odd).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        places = np.flatnonzero(~odd)
        for a, b, offsets, data in slices(texts.take(pa.array(places)) if odd.any() else texts):
            ids, ends = self._in_pieces(offsets, data)
            for k, (x, y) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
                out[places[a + k]] = ids[x:y].tobytes()
        whole = np.flatnonzero(odd)
        for at in range(0, len(whole), 256):
            part = whole[at : at + 256]
            for k, data in zip(part.tolist(), self._whole(texts.take(pa.array(part)).to_pylist())):
                out[k] = data
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.large_string()))


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


_BLOCK = "file int, block int, file_start long, n_ids long, n_texts long, first_id long, last_id long, data binary"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    vocabulary: int = 50257,
    end_id: int | None = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every text, append ``end_id``, and write the blocks in ascending id order to a new table."""
    bits = bits_for(max(vocabulary, (end_id or 0) + 1))
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        begin("packing")
        file, encoder = TaskContext.get().partitionId(), _encoder(tokenizer_path)
        keeps("packing", encoder.clear)
        number = written = 0
        names: list[int] = []
        parts: list[bytes] = []
        held = 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            if len(ids) and int(ids.max()) >> bits:
                raise ValueError(f"id {ids.max()} doesn't fit in {bits} bits")
            ends = np.cumsum([len(p) // 4 for p in parts])
            data = write_block(np.array(names, np.int64), ends, ids, bits)
            row = (file, number, written, len(ids), len(names), names[0], names[-1], data)
            kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds)], [c.split()[0] for c in _BLOCK.split(", ")]
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                ids = [_NULL_ID if i is None else i for i in rows.column(0).to_pylist()]
                for name, data in zip(ids, encoder.encode_array(rows.column(1))):
                    names.append(name)
                    parts.append(data + end)
                    held += len(parts[-1]) // 4
                    if held >= BLOCK_IDS:
                        yield block()
                        number, written = number + 1, written + held
                        names, parts, held = [], [], 0
        if names:
            yield block()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, _BLOCK).write.option("compression", "zstd").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the number of all ids before each."""
    blocks = spark.read.schema(_BLOCK).parquet(path)
    # One row per file, not per block: its own place in the file is written in the block.
    files = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # Stored, so that Spark knows its size and, where it is small, leaves the blocks where they are.
    starts = stored(starts, "token-starts")
    return blocks.join(starts, "file").withColumn("start", F.col("base") + F.col("file_start")).drop("base")


def map_texts(blocks: DataFrame, columns: str, per_text: Callable[[np.ndarray], tuple]) -> DataFrame:
    """(doc_id, start, n_tokens, further columns) of each text in the blocks, from its ids as read back."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(data.as_py())
                ids = block.ids(0, block.n_ids)
                made = [per_text(ids[a:b]) for a, b in zip(block.begins, block.ends)]
                texts = pa.array(block.texts, mask=block.texts == _NULL_ID)
                yield pa.RecordBatch.from_arrays(
                    [
                        texts,
                        pa.array(start + block.begins),
                        pa.array(block.ends - block.begins),
                        *[pa.array(list(c)) for c in zip(*made)],
                    ],
                    ["doc_id", "start", "n_tokens", *names],
                )

    return blocks.select("start", "data").mapInArrow(run, f"doc_id long, start long, n_tokens long, {columns}")


def crc32(ids: np.ndarray) -> tuple[int]:
    """Checksum of the ids as little-endian unsigned 32-bit integers."""
    return (zlib.crc32(ids.astype("<u4").tobytes()),)


def tokens_of(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one text, from the blocks that can hold it alone: Parquet's statistics skip the others."""
    blocks = spark.read.schema(_BLOCK).parquet(path)
    near = blocks.filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).select("data").collect()
    found = []
    for row in near:
        block = Block(row["data"])
        found += [block.text(k) for k in np.flatnonzero(block.texts == doc_id)]
    return found


def new_path(spark: SparkSession) -> str:
    return shared_dir(spark, "token-blocks")
