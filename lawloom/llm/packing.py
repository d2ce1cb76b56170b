"""Best-fit packing of token sequences with large-item matching.

Tokens are made where the documents lie; of each piece only its number, length and checksum go on to the packing. The
pieces, which are counted after cutting, are dealt evenly, row by row, into lots of bounded size, however many pieces a
document has, and each lot is packed in one task: pieces above a third of the capacity (at most two fit a sequence) are
matched greedily, the longest with the longest that still fits; smaller ones go, longest first, where they leave the
least room. A lot leaves at most one sequence poorly filled, so lots cost next to nothing. Ids, if they are wanted, meet
their places in a join afterwards.

Defined results: a null text is empty and gives the end id alone; an empty table gives no piece; texts of any length are
cut, never shortened; pieces of equal length go in the order they come; repeated documents are packed each time; other
columns are left alone.
"""

from __future__ import annotations

import zlib
from collections import deque

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import cut
from lawloom.llm.tokens import Encoder

CAPACITY = 2048
#: Pieces that one task packs, at most; dealing them row by row may add one from each task before.
LOT = 200_000
#: Tokens that a task holds before it passes their pieces on.
HELD = 4_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all but the first are full."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents; with_ids adds ids, the tokens as little-endian unsigned 32-bit numbers."""
    tail = end_id.to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches):
        encode = Encoder.of(tokenizer)
        rows, held = [[] for _ in names], 0
        for b in batches:
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                ids = encode.many([text])[0] + tail
                for n, (at, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                    own = ids[4 * at : 4 * (at + length)]
                    for column, x in zip(rows, (doc, n, at, length, zlib.crc32(own), own)):
                        column.append(x)
                held += len(ids) // 4
                if held >= HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds)], names)
                    rows, held = [[] for _ in names], 0
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES + ", ids binary" * with_ids)


class _Gaps:
    """Bins by the room they have left; the least room that is enough is the lowest set bit at or above it."""

    def __init__(self, capacity: int):
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def put(self, room: int, b: int) -> None:
        self.bins[room].append(b)
        self.mask |= 1 << room

    def take(self, need: int) -> tuple[int, int] | None:
        """A bin with the least room of at least ``need``, and that room."""
        above = self.mask >> need
        if not above:
            return None
        room = need + (above & -above).bit_length() - 1
        b = self.bins[room].pop()
        if not self.bins[room]:
            self.mask &= ~(1 << room)
        return b, room


def pack(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    large = [i for i in order if 3 * lengths[i] > capacity]
    of, offset, used = [0] * len(lengths), [0] * len(lengths), []
    gaps = _Gaps(capacity)
    waiting: dict[int, deque[int]] = {}  # large pieces by length; the bits of ``there`` are the lengths that are left
    for i in large:
        waiting.setdefault(lengths[i], deque()).append(i)
    there = sum(1 << n for n in waiting)
    for n in sorted(waiting, reverse=True):
        while waiting[n]:
            i = waiting[n].popleft()
            if not waiting[n]:
                there &= ~(1 << n)
            of[i], b, full = len(used), len(used), n
            fits = there & ((1 << (capacity - n + 1)) - 1)
            if fits:
                m = fits.bit_length() - 1
                j = waiting[m].pop()
                if not waiting[m]:
                    there &= ~(1 << m)
                of[j], offset[j], full = b, n, n + m
            used.append(full)
            if full < capacity:
                gaps.put(capacity - full, b)
    for i in order[len(large) :]:
        n = lengths[i]
        got = gaps.take(n)
        b, room = got if got else (len(used), capacity)
        if not got:
            used.append(0)
        of[i], offset[i] = b, used[b]
        used[b] += n
        if room > n:
            gaps.put(room - n, b)
    return of, offset


def pack_pieces(pieces: DataFrame, *, capacity: int = CAPACITY, lot: int = LOT) -> DataFrame:
    """The rows, each with a ``length``, with sequence_id and offset. They are read twice, so they should be at rest."""
    lots = max(1, -(-pieces.count() // lot))

    def run(batches):
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        got = pa.Table.from_batches(own)
        of, offset = pack(got["length"].to_pylist(), capacity)
        base = TaskContext.get().partitionId() << 40
        got = got.append_column("sequence_id", pa.array([base + b for b in of], pa.int64())).append_column("offset", pa.array(offset, pa.int64()))
        yield from got.to_batches(max_chunksize=20_000)

    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes)
    return pieces.repartition(lots).mapInArrow(run, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = 0, lot: int = LOT, with_ids: bool = False) -> DataFrame:
    """Pieces with their tokens' checksum, sequence and offset; with_ids adds ids."""
    made = pieces(docs, tokenizer, capacity=capacity, end_id=end_id, with_ids=with_ids)
    if not with_ids:
        return pack_pieces(cut(made), capacity=capacity, lot=lot)
    made = cut(made.withColumn("row", F.monotonically_increasing_id()))  # numbers at rest: they stay as they are
    placed = pack_pieces(made.select("row", "length"), capacity=capacity, lot=lot).drop("length")
    return made.join(placed, "row").drop("row")
