"""LM scoring by masked pseudo-likelihood.

A bidirectional window network, written in numpy, predicts every token from the two tokens before and the two after it:
position-wise embeddings of the window are added, squashed by tanh and mapped to a two-level softmax (class, then member
of the class), whose biases start from the counts of words. A document's score is the sum over its tokens of log P(token | both sides).

The network's outputs are the most frequent words of the whole corpus (a shuffle of partial counts) and hashed buckets
for all others; a word in a bucket adds log P(word | bucket), by the counts of all words of the corpus, to the network's
log P(bucket | both sides). Those counts are as many as the corpus has words; they meet the words of the texts in a
shuffle and are never gathered.

Texts are divided into words once. They rest in lots of about LOT words: the lot's different words, and for each text
where its words stand among them. What later steps ask of a word they ask once a lot.

Training covers every document once. Documents are dealt by the hash of id and text into shards of about SHARD words,
and each into one of a number of rounds that grows with the logarithm of the shards. In a round each shard trains its
own copy of the network on its documents, in the order of their hashes; the copies meet in a tree of sums in whole
numbers, weighted by tokens, and the next round starts from their mean. So neither partitions nor the order of tasks
change a score. No task holds more than one network, one sum and one group of documents.

Defined results: null and empty texts have no tokens, a log-probability of 0 and a mean of 0; texts of any length are
scored whole; words of equal counts take places in the order of their bytes; with an empty corpus there is nothing to
score; repeated rows are scored each time; other columns are left alone.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import cut, slices, utf8

CLASSES = MEMBERS = 32
BUCKETS = 128
WIDTH = 24
SIDES = (-2, -1, 1, 2)
BATCH = 4096
RATE = 4.0
#: Words that one copy of the network is trained on in all rounds, about.
SHARD = 4_000_000
#: Tokens of a group of documents that are mixed with each other.
GROUP = 400_000
#: Steps of a weight in sums, as a fraction of 1.
STEP = 1 << 20
#: Different words of a lot of texts, and all of its words, about.
LOT_WORDS = 400_000
LOT = 4_000_000

_V = CLASSES * MEMBERS
_PAD = _V  # the place before a text and after it
_ONES = np.ones((CLASSES, 1), np.float32)


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def _packed(raw: bytes | np.ndarray) -> bytes:
    """Compressed; of numbers their lowest bytes first, then the next."""
    if isinstance(raw, np.ndarray):
        raw = raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def _unpacked(blob: bytes) -> bytes:
    return pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def _numbers(blob: bytes, of: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unpacked(blob), np.uint8).reshape(np.dtype(of).itemsize, -1).T).view(of).ravel()


LOTS = "lot long, doc_id array<long>, h array<long>, size array<int>, ids binary, words binary"


def lots(docs: DataFrame) -> DataFrame:
    """Texts in lots, read once, at rest: the lot's words, each once, and of each text its id, the hash of id and text, its size in words and where its words stand in the lot's (ids)."""

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        places: defaultdict[bytes, int] = defaultdict()
        places.default_factory = places.__len__
        texts: list[tuple] = []
        held = 0

        def out():
            nonlocal made, held
            doc_ids, hs, ids = zip(*texts)
            row = ((task << 32) + made, doc_ids, hs, [len(x) for x in ids], _packed(np.concatenate(ids).astype("<i4")), _packed(b" ".join(places)))
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())
            texts.clear()
            places.clear()
            made, held = made + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], [x.split()[0] for x in LOTS.split(", ")])

        for b in slices(batches):
            for doc_id, h, text in zip(b["doc_id"].to_pylist(), b["h"].to_pylist(), utf8(b["text"])):
                words = words_of(text)
                texts.append((doc_id, h, np.fromiter(map(places.__getitem__, words), np.int32, len(words))))
                held += len(words) + 1
                if len(places) > LOT_WORDS or held > LOT:
                    yield out()
        if texts:
            yield out()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut(texts.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h")).mapInArrow(run, LOTS))


def counts(docs: DataFrame) -> DataFrame:
    """word, n: how often each word occurs in all texts."""
    return counts_of(lots(docs))


def counts_of(made: DataFrame) -> DataFrame:
    """As ``counts``, from lots."""

    def run(batches):
        for b in batches:
            for blob, ids in zip(b["words"].to_pylist(), b["ids"].to_pylist()):
                words = _unpacked(blob).split()
                n = np.bincount(_numbers(ids, "<i4"), minlength=len(words))
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], ["word", "n"])

    return cut(made.select("words", "ids").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))


@dataclass
class Vocabulary:
    """Places of the most frequent words, how often each place occurs, and the words in buckets: h, n, bucket."""

    ids: dict[bytes, int]
    counts: np.ndarray
    others: DataFrame


def vocabulary(counted: DataFrame) -> Vocabulary:
    """Ties go to the smaller word."""
    top = counted.orderBy(F.desc("n"), "word").limit(_V - BUCKETS).collect()
    ids = {bytes(r["word"]): i for i, r in enumerate(top)}
    known = F.broadcast(counted.sparkSession.createDataFrame([(bytearray(w),) for w in ids], "word binary"))
    others = counted.join(known, "word", "left_anti").select(F.xxhash64("word").alias("h"), "n", (F.crc32("word") % BUCKETS).cast("int").alias("bucket"))
    counts = np.zeros(_V, np.int64)
    counts[: len(top)] = [r["n"] for r in top]
    for r in others.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[_V - BUCKETS + r["bucket"]] = r["n"]
    return Vocabulary(ids, counts, others)


def in_buckets(made: DataFrame, vocab: Vocabulary) -> DataFrame:
    """lot, at, n: how often each word of a lot that is in a bucket occurs in the corpus."""
    known = made.sparkSession.sparkContext.broadcast(vocab.ids)

    def run(batches):
        seen = known.value
        for b in batches:
            for lot, blob in zip(b["lot"].to_pylist(), b["words"].to_pylist()):
                words = _unpacked(blob).split()
                at = np.array([i for i, w in enumerate(words) if w not in seen], np.int32)
                h = np.fromiter((xxhash.xxh64_intdigest(words[i], 42) for i in at), np.uint64, len(at)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), lot, np.int64)), pa.array(at), pa.array(h)], ["lot", "at", "h"])

    return made.select("lot", "words").mapInArrow(run, "lot long, at int, h long").join(vocab.others, "h").select("lot", "at", "n")


def places_of(words: list[bytes], vocab: dict[bytes, int]) -> np.ndarray:
    get, first = vocab.get, _V - BUCKETS
    return np.array([i if (i := get(w, -1)) >= 0 else first + zlib.crc32(w) % BUCKETS for w in words], "<i2")


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Centres, and their neighbours on both sides; texts do not see each other."""
    pad = np.full(2, _PAD, np.int16)
    flat = np.concatenate([pad, *(x for t in texts for x in (t, pad))])
    at = flat[2:-2] != _PAD
    return flat[2:-2][at], np.stack([flat[2 + s : len(flat) - 2 + s][at] for s in SIDES])


@dataclass
class Net:
    """Class and member of word i are i // MEMBERS and i % MEMBERS."""

    e: np.ndarray  # side, word, width
    c: np.ndarray  # width + 1, class
    m: np.ndarray  # class, width + 1, member

    @classmethod
    def new(cls, counts: np.ndarray | None = None) -> Net:
        """counts: how often each place occurs; without a context's help that is what the network says."""
        r = np.random.RandomState(0)
        net = cls(r.normal(0, 0.1, (len(SIDES), _V + 1, WIDTH)).astype(np.float32), np.zeros((WIDTH + 1, CLASSES), np.float32), np.zeros((CLASSES, WIDTH + 1, MEMBERS), np.float32))
        if counts is not None:
            n = counts.reshape(CLASSES, MEMBERS) + 0.5
            net.c[-1] = np.log(n.sum(axis=1) / n.sum())
            net.m[:, -1] = np.log(n / n.sum(axis=1, keepdims=True))
        return net

    def flat(self) -> np.ndarray:
        return np.concatenate([self.e.ravel(), self.c.ravel(), self.m.ravel()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Net:
        n, k = len(SIDES) * (_V + 1) * WIDTH, (WIDTH + 1) * CLASSES
        f = flat.astype(np.float32)
        return cls(f[:n].reshape(len(SIDES), _V + 1, WIDTH).copy(), f[n : n + k].reshape(WIDTH + 1, CLASSES).copy(), f[n + k :].reshape(CLASSES, WIDTH + 1, MEMBERS).copy())

    def hidden(self, sides: np.ndarray) -> np.ndarray:
        total = self.e[0].take(sides[0], axis=0)
        for s in range(1, len(SIDES)):
            total += self.e[s].take(sides[s], axis=0)
        h = np.ones((len(total), WIDTH + 1), np.float32)
        np.tanh(total, out=h[:, :-1])
        return h

    @staticmethod
    def softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exponentials, and what each row is to be divided by."""
        if len(z) and z.max() > 60:
            z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        return z, z @ _ONES + np.float32(1e-30)

    def log_p(self, centres: np.ndarray, sides: np.ndarray) -> np.ndarray:
        out = np.empty(len(centres), np.float64)
        for at in range(0, len(centres), BATCH):
            w = centres[at : at + BATCH]
            out[at : at + BATCH] = self._step(w, sides[:, at : at + BATCH], 0.0)
        return out

    def train(self, centres: np.ndarray, sides: np.ndarray, rate: float) -> None:
        for at in range(0, len(centres), BATCH):
            self._step(centres[at : at + BATCH], sides[:, at : at + BATCH], rate)

    def _step(self, w: np.ndarray, sides: np.ndarray, rate: float) -> np.ndarray:
        """Log-probabilities; with a rate, a step of gradient descent on their mean as well."""
        order = np.argsort(w, kind="stable")
        w, sides = w[order], sides[:, order].astype(np.intp)
        h = self.hidden(sides)
        cls, mem, row = w // MEMBERS, w % MEMBERS, np.arange(len(w))
        pc, of = self.softmax(h @ self.c)
        place = row * CLASSES + cls
        p = pc.ravel()[place] / of.ravel()
        back = None
        if rate:
            pc /= of
            pc.ravel()[place] -= 1
            back = pc @ self.c[:-1].T
            gc = h.T @ pc
        ends = np.searchsorted(cls, np.arange(CLASSES + 1))
        for k in range(CLASSES):
            a, b = ends[k], ends[k + 1]
            if a == b:
                continue
            pm, of = self.softmax(h[a:b] @ self.m[k])
            place = row[: b - a] * MEMBERS + mem[a:b]
            p[a:b] *= pm.ravel()[place] / of.ravel()
            if rate:
                pm /= of
                pm.ravel()[place] -= 1
                back[a:b] += pm @ self.m[k][:-1].T
                self.m[k] -= np.float32(rate * np.sqrt((b - a) / len(w)) / (b - a)) * (h[a:b].T @ pm)
        if rate:
            self.c -= np.float32(rate / len(w)) * gc
            back *= 1 - h[:, :-1] ** 2
            for s in range(len(SIDES)):
                by = np.argsort(sides[s].astype(np.int16), kind="stable")
                words = sides[s].take(by)
                first = np.concatenate([[0], np.flatnonzero(words[1:] != words[:-1]) + 1])
                n = np.concatenate([first[1:], [len(words)]]) - first
                # pairs of columns are added as complex numbers: half as many sums
                total = np.add.reduceat(back.take(by, axis=0).view(np.complex64), first, axis=0).view(np.float32)
                # a rare word's row moves by more than its share of the batch
                self.e[s][words[first]] -= total * (rate / np.sqrt(n * len(w))).astype(np.float32)[:, None]
        out = np.empty(len(w), np.float64)
        out[order] = np.log(np.maximum(p, np.float32(1e-30)))
        return out


def _groups(texts, most: int = GROUP):
    """Neighbouring texts, about so many tokens at a time."""
    own, size = [], 0
    for t in texts:
        own.append(t)
        size += len(t)
        if size >= most:
            yield own
            own, size = [], 0
    if own:
        yield own


def encode(docs: DataFrame, vocab: Vocabulary, shards: int, rounds: int) -> DataFrame:
    """doc_id, within (log P(word | bucket), summed over the text's words in buckets), shard, round, ids: at rest, a shard in one partition, in the order of hashes."""
    return encode_lots(lots(docs), vocab, shards, rounds)


def encode_lots(made: DataFrame, vocab: Vocabulary, shards: int, rounds: int) -> DataFrame:
    """As ``encode``, from lots."""
    sc = made.sparkSession.sparkContext
    known, totals = sc.broadcast(vocab.ids), sc.broadcast(vocab.counts)

    def placed(batches):
        for b in batches:
            places = [_packed(places_of(_unpacked(w).split(), known.value)) for w in b["words"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b[x] for x in b.schema.names if x != "words"), pa.array(places, pa.binary())], [*(x for x in b.schema.names if x != "words"), "places"])

    def run(lot: pa.Table, found: pa.Table) -> pa.Table:
        row = {name: lot[name][0] for name in lot.column_names}
        places = _numbers(row["places"].as_py(), "<i2")
        log_p, at = np.zeros(len(places)), found["at"].to_numpy()
        log_p[at] = np.log(found["n"].to_numpy() / totals.value[places[at]])
        size = row["size"].values.to_numpy()
        flat = _numbers(row["ids"].as_py(), "<i4")
        # a text's own sum, whatever else is in the lot
        within = np.bincount(np.repeat(np.arange(len(size)), size), log_p[flat], len(size)).astype(np.float64)
        ids, ends = places[flat], np.cumsum(size)
        own = pa.array([_packed(ids[b - n : b]) for n, b in zip(size.tolist(), ends.tolist())], pa.binary())
        return pa.Table.from_arrays([row["doc_id"].values, row["h"].values, pa.array(within), own], ["doc_id", "h", "within", "ids"])

    texts = made.mapInArrow(placed, LOTS.replace("words", "places")).groupBy("lot")
    named = texts.cogroup(in_buckets(made, vocab).groupBy("lot")).applyInArrow(run, "doc_id long, h long, within double, ids binary")
    dealt = named.withColumns({"round": F.pmod("h", F.lit(rounds)).cast("int"), "shard": F.pmod(F.shiftright("h", 20), F.lit(shards)).cast("int")})
    return cut(dealt.repartition(shards, "shard").sortWithinPartitions("shard", "h", "doc_id"))


def _ids(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [_numbers(x, "<i2") for x in batch["ids"].to_pylist()]


def train(encoded: DataFrame, counts: np.ndarray, rounds: int) -> Net:
    """The mean of the shards' networks after the last round."""
    sc = encoded.sparkSession.sparkContext
    net = Net.new(counts)
    for r in range(rounds):
        start = sc.broadcast(net.flat())
        rate = RATE / (1 + r) ** 0.5

        def run(batches, start=start, rate=rate):
            total, tokens = None, 0
            for _, texts in groupby(((s, t) for b in batches for s, t in zip(b["shard"].to_pylist(), _ids(b))), key=lambda x: x[0]):
                own, seen = Net.of(start.value), 0
                for group in _groups(t for _, t in texts):
                    centres, sides = windows(group)
                    # tokens of all texts of the group in every step, in a fixed order
                    mix = np.random.RandomState(len(centres) % 2**31).permutation(len(centres))
                    own.train(centres[mix], sides[:, mix], rate)
                    seen += len(centres)
                if seen:
                    whole = np.rint(own.flat().astype(np.float64) * STEP).astype(np.int64) * (seen // 64 + 1)
                    total, tokens = whole if total is None else total + whole, tokens + seen // 64 + 1
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["n", "net"])

        made = encoded.where(F.col("round") == r).select("shard", "ids").mapInArrow(run, "n long, net binary")
        parts = made.rdd.map(lambda x: (x["n"], np.frombuffer(bytes(x["net"]), np.int64)))
        # few networks reach the driver at once, however many tasks there are
        depth = max(2, math.ceil(math.log(max(parts.getNumPartitions(), 2), 8)))
        n, total = parts.treeAggregate((0, None), _add, _add, depth=depth)
        start.destroy()
        if n:
            net = Net.of(total / n / STEP)
    return net


def _add(a, b):
    return a[0] + b[0], b[1] if a[1] is None else a[1] if b[1] is None else a[1] + b[1]


def score(encoded: DataFrame, net: Net) -> DataFrame:
    """doc_id, within, n_tokens and log_prob, the network's sum."""
    flat = encoded.sparkSession.sparkContext.broadcast(net.flat())

    def run(batches):
        own = Net.of(flat.value)
        for b in batches:
            n, total = [], []
            for group in _groups(_ids(b)):
                sizes = np.array([len(t) for t in group])
                log_p = np.r_[0.0, np.cumsum(own.log_p(*windows(group)))]
                ends = np.cumsum(sizes)
                n += sizes.tolist()
                total += (log_p[ends] - log_p[ends - sizes]).tolist()
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["within"], pa.array(n, pa.int64()), pa.array(total, pa.float64())], ["doc_id", "within", "n_tokens", "log_prob"])

    return encoded.select("doc_id", "within", "ids").mapInArrow(run, "doc_id long, within double, n_tokens long, log_prob double")


def rounds_for(shards: int) -> int:
    return 2 + int(math.log2(shards)) // 2


def score_corpus(docs: DataFrame, *, shard: int = SHARD) -> DataFrame:
    """doc_id, n_tokens, log_prob (summed) and mean_log_prob."""
    made = lots(docs)
    counted = counts_of(made)
    vocab = vocabulary(counted)
    shards = max(1, -(-(counted.agg(F.sum("n").alias("n")).first()["n"] or 0) // shard))
    encoded = encode_lots(made, vocab, shards, rounds_for(shards))
    scored = score(encoded, train(encoded, vocab.counts, rounds_for(shards)))
    whole = scored.select("doc_id", "n_tokens", (F.col("log_prob") + F.col("within")).alias("log_prob"))
    return whole.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).otherwise(0.0))
