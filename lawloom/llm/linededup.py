"""Line dedup by pairwise alignment: rare line hashes find the documents, patience diff aligns them, the later one loses
the aligned blocks.

Lines are compared after trimming, and blank ones do not count. A line alone is often common, so for every line of a
document the shortest runs of lines that begin or end there and come to ``min_words`` words or more are hashed; a line of
so many words is a run of its own. Any block of so many words that two documents have in common consists of such runs.
Each document that holds a run is paired with the first holder of that run (the least doc_id) alone: a run in n documents
gives n - 1 links, however many share it, and a document may have as many partners as it has runs.

The runs that a pair has met by are aligned with a patience diff: runs that occur once in both documents are anchors, of
which the longest rising chain is kept, and equal neighbours extend a match. Between anchors it starts over; where no
run occurs once in both, the first places of each stand for it. What stays unaligned, as blocks that changed their order
do, is aligned again with the whole earlier document, so that in the end every shared run is. The later document loses
the aligned lines: these are exactly the lines in blocks of ``min_words`` words or more that an earlier document has.

Defined results: null texts stay null and have no lines; an empty table gives none; a text of any length is read whole;
of several holders the least doc_id is the first; a document whose lines all go keeps its row with an empty text; rows
that repeat a doc_id are one document, which loses nothing to itself, and a run goes from each of them that has it in
that place; rows with a null doc_id are left alone; all columns stay as they were but ``text`` and, where there is one,
``n_chars`` (``n_lines`` and ``n_deleted`` too, where counts are asked for); no name of a column can clash.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.llm.common import cut, fresh, slices, utf8

MIN_WORDS = 8
#: Alignments of a pair with a patience diff; runs that are out of order even then are aligned one by one.
PASSES = 16


def _hash(lines: list[bytes]) -> tuple[int, int]:
    """96 bits of a run: a signed long and a signed int."""
    h = xxhash.xxh3_128_intdigest(b"\n".join(lines))
    return (h & (1 << 64) - 1) - (1 << 63), (h >> 64 & (1 << 32) - 1) - (1 << 31)


def _not_blank(text: bytes) -> list[bytes]:
    return [x for line in text.split(b"\n") if (x := line.strip())]


def spans(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(start, end) of the shortest runs of enough words from each line and up to each line."""
    out: set[tuple[int, int]] = set()
    end = total = 0
    for start, n in enumerate(words):
        while total < min_words and end < len(words):
            total += words[end]
            end += 1
        if total < min_words:
            break
        out.add((start, end))
        total -= n
    start, total = len(words), 0
    for end in range(len(words), 0, -1):
        while total < min_words and start:
            start -= 1
            total += words[start]
        if total < min_words:
            break
        out.add((start, end))
        total -= words[end - 1]
    return sorted(out)


def runs(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """h, c (hash of a run), doc_id, n (its lines), at (places of its first line): a row for each distinct run."""

    def run(batches):
        for b in slices(batches):
            out = ([], [], [], [], [])
            for doc, text in zip(b["doc_id"].to_pylist(), utf8(b["text"])):
                own = _not_blank(text)
                found: dict[tuple, list[int]] = {}
                for at, end in spans([len(x.split()) for x in own], min_words):
                    found.setdefault((*_hash(own[at:end]), end - at), []).append(at)
                for (h, c, n), at in found.items():
                    for column, x in zip(out, (h, c, doc, n, at)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32())))], ["h", "c", "doc_id", "n", "at"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.where("doc_id is not null and text is not null").mapInArrow(run, "h long, c int, doc_id long, n int, at array<int>")


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of (a, b), ordered by a, in which b rises."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        back[i] = piles[k - 1] if k else -1
        if k == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[k], piles[k] = b, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of two sequences; at least one pair if they have anything in common."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            out.append((k, m))
        if i == k or j == m:
            continue
        in_a, in_b = _places(a, i, k), _places(b, j, m)
        both = [(p, in_b[x]) for x, p in in_a.items() if x in in_b]
        once = [(p[0], q[0]) for p, q in both if p[1] == q[1] == 1]
        anchors = _rising(sorted(once or [(p[0], q[0]) for p, q in both]))
        out += anchors
        for p, q in [*anchors, (k, m)] if anchors else ():
            todo.append((i, p, j, q))
            i, j = p + 1, q + 1
    return sorted(out)


def _places(of: list, start: int, end: int) -> dict:
    """First place and number of each thing."""
    out: dict = {}
    for p in range(start, end):
        was = out.get(of[p])
        out[of[p]] = (was[0], was[1] + 1) if was else (p, 1)
    return out


def align(shared: list[dict], passes: int = PASSES) -> list[tuple[int, int]]:
    """(place, number in ``shared``) of the later document's runs that are aligned. shared: later and first, lists of places."""
    b = [i for _, _, i in sorted((p, s["n"], i) for i, s in enumerate(shared) for p in s["first"])]
    left = [(p, i) for p, _, i in sorted((p, s["n"], i) for i, s in enumerate(shared) for p in s["later"])]
    out: list[tuple[int, int]] = []
    for _ in range(passes):
        met = {p for p, _ in patience([i for _, i in left], b)}
        out += [x for n, x in enumerate(left) if n in met]
        left = [x for n, x in enumerate(left) if n not in met]
        if not left:
            break
    return out + left


def deletions(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, gone: the runs (at, n, h, c) that a document loses."""
    every = cut(runs(docs, min_words=min_words))
    shared = cut(every.groupBy("h", "c", "n").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last").drop("last"))
    repeated = cut(every.join(shared, ["h", "c", "n"]))
    # a table of its own, so that a run many documents hold can be dealt over many tasks in the join
    firsts = cut(repeated.where("doc_id = first").groupBy("h", "c", "n").agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("first_at")))
    pairs = repeated.where("doc_id <> first").join(firsts, ["h", "c", "n"])
    met = pairs.groupBy("doc_id", "first").agg(F.collect_list(F.struct("h", "c", "n", F.col("at").alias("later"), F.col("first_at").alias("first"))).alias("shared"))
    place = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("h", pa.int64()), ("c", pa.int32())])

    def run(batches):
        for b in slices(batches):
            gone = [[{"at": p, **{k: s[i][k] for k in ("n", "h", "c")}} for p, i in align(s)] for s in b["shared"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(gone, pa.list_(place))], ["doc_id", "gone"])

    found = met.mapInArrow(run, "doc_id long, gone array<struct<at:int,n:int,h:bigint,c:int>>")
    return found.groupBy("doc_id").agg(F.flatten(F.collect_list("gone")).alias("gone"))


def without(own: list[bytes], gone: list[dict]) -> list[bytes]:
    """The lines but those of the runs given, which are looked for in their places; none if only blank ones are left."""
    at = [i for i, x in enumerate(own) if x.strip()]
    drop: set[int] = set()
    for g in gone:
        lines = at[g["at"] : g["at"] + g["n"]]
        if len(lines) == g["n"] and _hash([own[i].strip() for i in lines]) == (g["h"], g["c"]):
            drop.update(lines)
    if not drop:
        return own
    return [x for i, x in enumerate(own) if i not in drop] if len(drop) < len(at) else []


def dedup_lines(docs: DataFrame, *, min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """The documents without the blocks that earlier ones have; counts adds n_lines and n_deleted."""
    key, other, gone = fresh(docs, "key", "other", "gone")
    lost = deletions(docs, min_words=min_words).toDF(other, gone)
    joined = docs.withColumn(key, F.col("doc_id").cast("long")).join(lost, F.col(key) == F.col(other), "left").drop(key, other)
    joined = joined.withColumn("text", F.col("text").cast("string"))
    fields = {f.name: T.StructField(f.name, f.dataType) for f in joined.schema if f.name != gone}
    if counts:
        fields |= {n: T.StructField(n, T.LongType()) for n in ("n_lines", "n_deleted")}
    whole = isinstance(fields["n_chars"].dataType, T.IntegralType) if "n_chars" in fields else False

    def run(batches):
        for b in slices(batches):
            texts, n_lines, n_deleted = [], [], []
            for text, lost in zip(utf8(b["text"]), b[gone].to_pylist()):
                own = text.split(b"\n") if text is not None else []
                kept = without(own, lost) if lost else own
                texts.append(text if len(kept) == len(own) else b"\n".join(kept))
                n_lines.append(len(own))
                n_deleted.append(len(own) - len(kept))
            columns = dict(zip(b.schema.names, b.columns))
            columns["text"] = pa.array(texts, pa.binary()).cast(pa.string())
            if whole:
                changed = [len(t.decode()) if d else n for t, d, n in zip(texts, n_deleted, columns["n_chars"].to_pylist())]
                columns["n_chars"] = pa.array(changed, columns["n_chars"].type)
            if counts:
                columns |= {"n_lines": pa.array(n_lines, pa.int64()), "n_deleted": pa.array(n_deleted, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in fields], list(fields))

    return joined.mapInArrow(run, T.StructType(list(fields.values())))
