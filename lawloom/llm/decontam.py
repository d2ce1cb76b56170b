"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A text's symbols are its words. Every window of ``window`` consecutive benchmark words is a pattern (an item of fewer
words is one pattern), and patterns of equal length share one Wu-Manber table: shifts keyed by blocks of two words skip
positions where no pattern can end, buckets keyed by a pattern's last block select the patterns to test, and a direct
comparison of the words confirms each occurrence.

The documents are never shuffled with their texts. The benchmark's windows go to the executors as a broadcast of bounded
size: items are cut into chunks that overlap by a window, so that one item can be of any size, and a benchmark of more
than ``part_bytes`` is dealt into parts. Each part reads the documents again and leaves only what it finds, by a hash of
the text; these finds meet the documents' hashes in a join.

Defined results: a null text has no words; texts of any length are searched whole; an empty benchmark hits nothing, an
empty table gives no rows; benchmark rows without an id or without words take no part; rows that repeat an item id count
as one item; a repeated document gives a row each time; other columns of either table are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import cut, fresh, utf8

#: Bytes of benchmark text that are searched at once.
PART_BYTES = 2_000_000
#: Words of an item that are one chunk, without what overlaps.
CHUNK = 20_000

_BLANK = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

FOUND = "doc_id long, n_words long, hits array<int>, items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and characters beyond ASCII."""
    return text.translate(_BLANK).split() if text else []


@dataclass
class _Length:
    """The Wu-Manber table of all patterns of one length. A pattern is (item, start)."""

    length: int
    shift: dict = field(default_factory=dict)
    bucket: dict = field(default_factory=dict)


class WuManber:
    """Patterns are all windows of the items' words; items are (id, words)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.items = items
        self.tables: dict[int, _Length] = {}
        for n, (_, words) in enumerate(items):
            length = min(window, len(words))
            if length:
                for start in range(len(words) - length + 1):
                    self._add(n, start, length)

    def _add(self, item: int, start: int, length: int) -> None:
        t = self.tables.setdefault(length, _Length(length))
        block = min(2, length)
        words = self.items[item][1]
        for end in range(block, length + 1):
            key = tuple(words[start + end - block : start + end])
            away = length - end
            if t.shift.get(key, length) > away:
                t.shift[key] = away
        last = tuple(words[start + length - block : start + length])
        t.bucket.setdefault(last, {}).setdefault(words[start], []).append((item, start))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
        """(start, length, items) of every position where windows occur; starts rise within a length."""
        for length, t in self.tables.items():
            block, shift, bucket = min(2, length), t.shift, t.bucket
            most, end, n = length - block + 1, length - 1, len(words)
            while end < n:
                key = (words[end - 1], words[end]) if block == 2 else (words[end],)
                away = shift.get(key, most)
                if away:
                    end += away
                    continue
                start = end - length + 1
                tests = bucket[key].get(words[start])
                if tests:
                    here = words[start : end + 1]
                    found = [i for i, at in tests if self.items[i][1][at : at + length] == here]
                    if found:
                        yield start, length, found
                end += 1


def _search(tables: WuManber, text: bytes | None, hits: list[int], items: set[str]) -> tuple[int, list[int], list[str]]:
    """Words, merged hit spans as [start, end, start, end, ...] and item ids, added to what earlier parts found."""
    words = words_of(text)
    spans = [[a, b] for a, b in zip(hits[::2], hits[1::2])]
    for start, length, found in tables.find(words):
        items.update(tables.items[i][0] for i in found)
        if spans and spans[-1][0] <= start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], start + length)
        else:
            spans.append([start, start + length])
    merged: list[int] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1]:
            merged[-1] = max(merged[-1], b)
        else:
            merged += [a, b]
    return len(words), merged, sorted(items)


def _chunks(benchmark: DataFrame, window: int) -> DataFrame:
    """id, t: the items' words in chunks. Every window lies in one of them."""

    def run(batches):
        for b in batches:
            out = [(i, b" ".join(w[at : at + CHUNK + window - 1])) for i, t in zip(b["id"].to_pylist(), utf8(b["t"])) for w in [words_of(t)] for at in range(0, max(1, len(w) - window + 1), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.string()), pa.array([t for _, t in out], pa.binary()).cast(pa.string())], ["id", "t"])

    b = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("t")).where("id is not null and t is not null")
    return b.mapInArrow(run, "id string, t string").where("t <> ''")


def _parts(benchmark: DataFrame, window: int, part_bytes: int) -> tuple[int, Iterator[WuManber]]:
    """How many parts there are, and their tables, one at a time."""
    b = _chunks(benchmark, window)
    size = b.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // part_bytes))
    some = (b.where(F.pmod(F.xxhash64("id", "t"), F.lit(parts)) == k) if parts > 1 else b for k in range(parts))
    return parts, (WuManber([(r["id"], words_of(r["t"].encode())) for r in rows.collect()], window) for rows in some)


def _search_rows(rows: DataFrame, tables: WuManber, keep: list[str]) -> DataFrame:
    """The columns kept, n_words, hits and items of rows with a text."""
    shared = rows.sparkSession.sparkContext.broadcast(tables)

    def search(batches):
        t = shared.value
        for b in batches:
            found = [_search(t, x, [], set()) for x in utf8(b["text"])]
            n, hits, items = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(n, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], [*keep, "n_words", "hits", "items"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(search, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", n_words long, hits array<int>, items array<string>")


def _hashes(text="text") -> list[F.Column]:
    """128 bits of a text."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def _found(docs: DataFrame, parts: Iterator[WuManber]) -> DataFrame:
    """h, g (hashes of a text), hits and items of the texts in which a part of the benchmark occurs."""
    h, g = _hashes()
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null").select("text", h.alias("h"), g.alias("g"))
    each = [cut(_search_rows(texts, tables, ["h", "g"]).where("size(hits) > 0").drop("n_words").distinct()) for tables in parts]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    # hit words and not spans: parts may have found some of them twice
    spans = F.transform(F.sequence(F.lit(0), F.size("hits") - 2, F.lit(2)), lambda i: F.sequence(F.get("hits", i), F.get("hits", i + 1) - 1))
    words = out.select("h", "g", F.flatten(spans).alias("words"), "items")
    return words.groupBy("h", "g").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("words")))).alias("words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, hits (word spans [start, end, ...), merged and rising) and items (ids, sorted as strings)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n, parts = _parts(benchmark, window, part_bytes)
    if n == 1:
        return _search_rows(base, next(parts), ["doc_id"])
    found = cut(_found(docs, parts))
    h, g = _hashes()
    counted = _search_rows(base.withColumns({"h": h, "g": g}), WuManber([], window), ["doc_id", "h", "g"]).drop("hits", "items")
    joined = counted.join(found, ["h", "g"], "left")
    none = lambda kind: F.array().cast(f"array<{kind}>")
    words = F.coalesce("words", none("int"))
    joined = joined.withColumn("words", words)
    starts = F.filter("words", lambda x, i: (i == 0) | (F.get("words", i - 1) != x - 1))
    ends = F.transform(F.filter("words", lambda x, i: (i == F.size("words") - 1) | (F.get("words", i + 1) != x + 1)), lambda x: x + 1)
    return joined.select("doc_id", "n_words", F.flatten(F.zip_with(starts, ends, lambda a, b: F.array(a, b))).alias("hits"), F.coalesce("items", none("string")).alias("items"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents, all columns as they were, in which no window of the benchmark occurs."""
    n, parts = _parts(benchmark, window, part_bytes)
    if n > 1:
        found = cut(_found(docs, parts).select("h", "g"))
        names = fresh(docs, "h", "g")
        keyed = docs.withColumns(dict(zip(names, _hashes(F.col("text").cast("string")))))
        return keyed.join(found.toDF(*names), names, "left_anti").select(*docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(next(parts))

    def clean(batches):
        t = shared.value
        for b in batches:
            yield b.filter(pa.array([next(t.find(words_of(x)), None) is None for x in utf8(b["text"])], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def report(found: DataFrame) -> DataFrame:
    """The digest of find_leaks: counts, the hash of the item ids and the verdict."""
    starts = F.filter("hits", lambda x, i: i % 2 == 0)
    ends = F.filter("hits", lambda x, i: i % 2 == 1)
    n_hit = F.aggregate(F.zip_with(starts, ends, lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
