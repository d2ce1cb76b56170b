"""Byte-level BPE, encoded by speculating and verifying, and decoded again.

Words are proposed as the longest tokens from left to right, which is fast and mostly right. A proposal is what the
merges give if and only if every two neighbours in it are compatible, that is, no merge over the border between them
comes before the merges that made them; and that is a question of two tokens alone. So all adjacent pairs of all
new words of a group of texts are checked at once in numpy, and only the words with a pair that fails are merged exactly.

Why two tokens suffice: a merge needs parts that were made before it, so merges happen in rising rank, equal ones from
the left. At a border the piece on its left is, at any time, one on the right edge of the left token's tree, and
likewise on the other side. A merge over the border happens if its rank is below that by which the left piece is merged
with what is left of it, and not above that by which the right piece is merged (a tie goes to the border, which is further left).

Text is divided into words by the tokenizer's own pattern. Characters that this machine's Unicode tables class
otherwise than the tokenizer's do are found by asking it; a text that holds one is divided by the tokenizer itself.

Defined results: a null text is empty and has no ids; strings of special tokens in a text become those tokens, as in
the tokenizer; texts and words of any length are encoded whole (long texts word by word); repeated rows are encoded each
time, a null id stays null; an empty table gives an empty one; other columns are left alone. ``decode`` takes any list
of ids: null gives null, bytes that are no UTF-8 become U+FFFD, ids that the vocabulary lacks are passed over.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, islice
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import fresh, slices
from lawloom.llm.tokens import PATTERN

FAR = 1 << 40
#: The words of a text that is all ASCII.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
#: Bytes by which it is known how long a token that begins with them may be.
START = 4
#: Characters of text whose words are known at a time; a longer text is taken in runs of so many words.
GROUP, RUN = 1_000_000, 100_000
#: What a task remembers of words, in entries and in bytes of words and ids.
KNOWN, KNOWN_BYTES = 500_000, 32_000_000
#: Ids that a task holds before it passes them on.
HELD = 2_000_000


class Merges:
    """Byte-pair merges by number: bytes are 0 to 255, the product of the n-th merge is 256 + n."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.bytes_of = [bytes([b]) for b in range(256)]
        number = {b: n for n, b in enumerate(self.bytes_of)}
        left, right = [*range(256)], [*range(256)]
        self.checkable = True  # each token has one merge, and parts come before it
        for a, b in merges:
            if a not in number or b not in number or a + b in number:
                self.checkable = False
            number.setdefault(a + b, len(left))
            left.append(number.get(a, -1))
            right.append(number.get(b, -1))
            self.bytes_of.append(a + b)
        self.left, self.right = np.array(left), np.array(right)
        self.size = len(left)
        self.product: dict[int, int] = {}
        for n in range(256, self.size):
            if left[n] >= 0 and right[n] >= 0:
                self.product.setdefault(left[n] * self.size + right[n], n)
        self._keys = np.array(sorted(self.product))
        self._made = np.array([self.product[k] for k in self._keys.tolist()])
        self.number = number
        self.whole = [number[b] for b in self.bytes_of]  # of products with equal bytes, the first one
        whole = np.arange(256, self.size)
        good = np.ones(self.size, bool)
        if self.checkable and len(whole):
            # a token is what its bytes give if both parts are and nothing crosses their border before
            good[256:] = self.compatible(self.left[256:], self.right[256:], whole)
            for n in range(256, self.size):
                good[n] &= good[left[n]] & good[right[n]]
        self.proposed = {b: n for n, b in enumerate(self.bytes_of) if good[n] and number[b] == n}
        self.longest: dict[bytes, int] = {}
        for b in self.proposed:
            if len(b) >= START:
                self.longest[b[:START]] = max(self.longest.get(b[:START], START), len(b))

    def _merged(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The number of the product of each pair, FAR if they do not merge."""
        if not len(self._keys):
            return np.full(len(x), FAR)
        key = x * self.size + y
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._made[at], FAR)

    def compatible(self, x: np.ndarray, y: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge over the border of x and y happens (before the given ones), for all pairs at once.

        Time goes backwards: the later of the two pieces' own merges is undone first, and on a tie the right one's.
        """
        ok = np.ones(len(x), bool)
        at = np.arange(len(x))
        x_until = np.full(len(x), FAR) if before is None else before.copy()
        y_until = x_until.copy()
        while len(at):
            over = self._merged(x, y)
            bad = (over < x_until) & (over <= y_until)
            ok[at[bad]] = False
            undo_y = (y >= x) & (y >= 256)
            undo_x = ~undo_y & (x >= 256)
            x_until, y_until = np.where(undo_x, x, x_until), np.where(undo_y, y, y_until)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_y, self.left[y], y)
            go = ~bad & (undo_x | undo_y)
            at, x, y, x_until, y_until = at[go], x[go], y[go], x_until[go], y_until[go]
        return ok

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        if (n := self.proposed.get(word)) is not None:
            return [n]
        out, at, get, longest = [], 0, self.proposed.get, self.longest
        while at < len(word):
            for end in range(min(len(word), at + longest.get(word[at : at + START], START - 1)), at, -1):
                if (n := get(word[at:end])) is not None:
                    out.append(n)
                    at = end
                    break
        return out

    def exact(self, word: bytes) -> list[int]:
        """The merges in their order: least rank first, from the left."""
        parts, product, size = list(word), self.product, self.size
        if len(parts) <= 40:
            get = product.get
            made = [get(a * size + b, FAR) for a, b in zip(parts, parts[1:])]
            while made and (best := min(made)) != FAR:
                i = made.index(best)
                parts[i : i + 2] = [n] = [self.whole[best]]
                del made[i]
                if i:
                    made[i - 1] = get(parts[i - 1] * size + n, FAR)
                if i < len(made):
                    made[i] = get(n * size + parts[i + 1], FAR)
            return parts
        after, before = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)]
        heap = [(m, i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (m := product.get(a * size + b)) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or product.get(parts[i] * size + parts[j]) != m:
                continue  # one of the two went into another merge
            parts[i], parts[j], after[i] = self.whole[m], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (n := product.get(parts[a] * size + parts[b])) is not None:
                    heapq.heappush(heap, (n, a))
        return [n for n in parts if n >= 0]

    def words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """The tokens of each word, and how many words were merged exactly."""
        if not self.checkable:
            return [self.exact(w) for w in words], len(words)
        got = [self.propose(w) for w in words]
        n = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter(chain.from_iterable(got), np.int64, int(n.sum()))
        inside = np.ones(max(0, len(flat) - 1), bool)
        inside[np.cumsum(n[n > 0])[:-1] - 1] = False
        pairs, which = np.unique((flat[:-1] * self.size + flat[1:])[inside], return_inverse=True)
        ok = self.compatible(pairs // self.size, pairs % self.size)[which]
        failing = np.unique(np.repeat(np.arange(len(got)), np.maximum(n - 1, 0))[~ok]).tolist()
        for w in failing:
            got[w] = self.exact(words[w])
        return got, len(failing)


class Coder:
    """A tokenizer's file as words, merges and ids."""

    _made: ClassVar[dict[str, Coder]] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens", [])
        if model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or any(model.get(k) for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges")) or any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} is no plain byte-level BPE")
        # bytes that byte-level vocabularies show as they are; the others are shown by the characters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(x for x in range(256) if x not in shown)}
        plain = lambda w: bytes(byte_of[c] for c in w)
        self.merges = Merges([tuple(map(plain, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]])
        self.special = {x["content"]: x["id"] for x in added}
        id_of = {plain(w): i for w, i in model["vocab"].items() if w not in self.special}
        self.ids = np.array([id_of[b] for b in self.merges.bytes_of], np.uint32)
        self.text_of = [b""] * (1 + max([*id_of.values(), *self.special.values()]))
        for b, i in (*id_of.items(), *((w.encode(), i) for w, i in self.special.items())):
            self.text_of[i] = b
        self._lengths = np.fromiter(map(len, self.text_of), np.int64)
        self._tokens = pa.array(self.text_of, pa.large_binary())
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=lambda s: (-len(s), s))))) if self.special else None
        self._words = regex.compile(PATTERN)
        self._path, self._asked = path, None
        self._same, self._other = set(map(chr, range(128))), set()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.held = self.exact = 0

    @classmethod
    def of(cls, path: str) -> Coder:
        """One for each Python worker, kept for later tasks."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _odd(self, text: str) -> bool:
        """Whether the tokenizer classes a character of the text otherwise than the pattern does here."""
        if text.isascii():
            return False
        for c in set(text) - self._same - self._other:
            probe = f"a{c}1{c}.{c}"
            same = [a for _, a in self._own().pre_tokenize_str(probe)] == [m.span() for m in self._words.finditer(probe)]
            (self._same if same else self._other).add(c)
        return bool(self._other) and not self._other.isdisjoint(text)

    def _own(self):
        if self._asked is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._asked = Tokenizer.from_file(self._path).pre_tokenizer
        return self._asked

    def _parts(self, text: str) -> Iterator[list[str] | int]:
        """Runs of words, and the ids of special tokens between them."""
        at = 0
        for m in self._special.finditer(text) if self._special and any(s in text for s in self.special) else ():
            yield from self._runs(text[at : m.start()])
            yield self.special[m[0]]
            at = m.end()
        yield from self._runs(text[at:])

    def _runs(self, text: str) -> Iterator[list[str]]:
        if self._odd(text):
            yield [text[a:b] for _, (a, b) in self._own().pre_tokenize_str(text)]
        elif len(text) <= GROUP:
            yield (_ASCII if text.isascii() else self._words).findall(text)
        else:
            found = self._words.finditer(text)
            while run := [m[0] for m in islice(found, RUN)]:
                yield run

    def _learn(self, words: set[str]) -> None:
        new = sorted(words)  # so that equal texts are worked on alike
        got, failed = self.merges.words([w.encode() for w in new])
        self.exact += failed
        ids = self.ids[np.fromiter(chain.from_iterable(got), np.int64)].astype("<u4").tobytes()
        at = 0
        for w, g in zip(new, got):
            self.known[w] = ids[at : at + 4 * len(g)]
            at += 4 * len(g)
            self.held += len(w) + 4 * len(g)

    def _join(self, parts: list[list[str] | int]) -> bytes:
        known = self.known.__getitem__
        return b"".join(p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(known, p)) for p in parts)

    def _ready(self, parts) -> None:
        if len(self.known) > KNOWN // 2 or self.held > KNOWN_BYTES // 2:
            self.known, self.before, self.held = {}, self.known, 0  # words in use come over, others go the next time
        unknown = {w for p in parts if not isinstance(p, int) for w in p} - self.known.keys()
        for w in unknown & self.before.keys():
            self.known[w] = self.before[w]
            self.held += len(w) + len(self.before[w])
        if unknown := unknown - self.before.keys():
            self._learn(unknown)

    def encode_many(self, texts: list[str | None]) -> Iterator[bytes]:
        """Each text's ids, as little-endian unsigned 32-bit numbers."""
        group, chars = [], 0
        for text in texts:
            text = text or ""
            if len(text) > GROUP or chars + len(text) > GROUP:
                yield from self._group(group)
                group, chars = [], 0
            if len(text) > GROUP:
                yield self._long(text)
            else:
                group.append(text)
                chars += len(text)
        yield from self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        split = [list(self._parts(t)) for t in texts]
        self._ready([p for parts in split for p in parts])
        return [self._join(parts) for parts in split]

    def _long(self, text: str) -> bytes:
        out = bytearray()
        for part in self._parts(text):
            self._ready([part])
            out += self._join([part])
        return bytes(out)

    def decode(self, ids: list[int]) -> str:
        return self.decode_many(pa.array([ids], pa.list_(pa.int64())))[0]

    def decode_many(self, lists: pa.ListArray) -> list[str | None]:
        """The text of each list of ids: all tokens' bytes are taken at once, end to end, and cut where lists end."""
        ids = pc.fill_null(lists.flatten().cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
        known = (ids >= 0) & (ids < len(self.text_of))
        ends = np.concatenate([[0], np.cumsum(np.where(known, self._lengths[np.where(known, ids, 0)], 0))])
        taken = self._tokens.take(pa.array(ids[known]))
        data = taken.buffers()[2] if len(taken) else None
        data = memoryview(data) if data is not None else memoryview(b"")
        bounds = ends[np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])].tolist()
        return [str(data[a:z], "utf-8", "replace") if valid else None for a, z, valid in zip(bounds, bounds[1:], lists.is_valid().to_pylist())]


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids of every document's text."""

    def run(batches):
        coder = Coder.of(tokenizer)
        names, docs, made, held = ["doc_id", "ids"], [], [], 0

        def batch():
            ends = np.cumsum([0, *(len(x) // 4 for x in made)]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(made), "<i4"), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(ends, ids)], names)

        for b in slices(batches):
            for doc, ids in zip(b["doc_id"].to_pylist(), coder.encode_many(b["text"].to_pylist())):
                docs.append(doc)
                made.append(ids)
                held += len(ids) // 4
                if held >= HELD:
                    yield batch()
                    docs, made, held = [], [], 0
        yield batch()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, *, ids: str = "ids", name: str = "text") -> DataFrame:
    """The rows with the text of their ids in a further column, under a name that is free."""
    name = fresh(encoded, name)[0]
    kinds = encoded.schema

    def run(batches):
        coder = Coder.of(tokenizer)
        for b in slices(batches):
            said = pa.array(coder.decode_many(b[ids]), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, said], [*b.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds.fields)
    return encoded.mapInArrow(run, f"{schema}, `{name}` string")
