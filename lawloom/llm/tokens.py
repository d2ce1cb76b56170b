"""Byte-level BPE ids of whole texts, equal to the tokenizer's own.

The tokenizer's file is the only vocabulary. Where the order of its ids is that of its merges, plain Latin text is
merged by a faster byte-pair merger over that same vocabulary; all other text, and text that holds the strings of
special tokens, goes to the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from typing import ClassVar

#: The pattern by which byte-level vocabularies of this kind divide text, and one that divides text
#: without neighbouring white space likewise and needs no look-ahead.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""

_RUN = re.compile(r"\s\s").search
_LATIN = re.compile("[\\x00-\u024f]*").fullmatch


class Encoder:
    _made: ClassVar[dict[str, Encoder]] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        self.merge, self.merge_plain = _mergers(spec)

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One encoder for a Python worker, kept for later tasks."""
        if path not in cls._made:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            cls._made[path] = cls(path)
        return cls._made[path]

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.merge and _LATIN(text) and not any(s in text for s in self.special):
            return (self.merge if _RUN(text) else self.merge_plain)(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def decode(self, ids: bytes) -> str:
        """The text of ids as many() gives them."""
        return self.tokenizer.decode(array("I", ids).tolist(), skip_special_tokens=False)

    def many(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers; none for a null text."""
        return [array("I", self.ids(t)).tobytes() for t in texts]


def _mergers(spec: dict):
    """Byte-pair mergers over the tokenizer's own vocabulary, for any text and for plain text; None unless the order of its ids is that of its merges."""
    import tiktoken

    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or any(model.get(k) for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges")):
        return None, None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level vocabularies show as they are
    byte_of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(x for x in range(256) if x not in shown)}
    special = {x["content"] for x in spec.get("added_tokens", [])}
    vocab = {w: i for w, i in model["vocab"].items() if w not in special}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    made = [vocab.get(m, -1) for m in merged]
    if len(vocab) != 256 + len(merged) or made != sorted(made) or made[0] < 256:
        return None, None
    ranks = {bytes(byte_of[c] for c in w): i for w, i in vocab.items()}
    return [tiktoken.Encoding("bytes", pat_str=p, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary for p in (PATTERN, PLAIN)]
