"""Fill-in-the-middle: texts are cut at two ranks of their units and put together for a model that fills gaps.

A unit is a run of ASCII letters or any other single code point. A matcher goes over a text twice and keeps nothing: the
first pass counts the units, the second advances a fresh match iterator to the two ranks and notes where they end. So a
text needs its own length of memory and no more, whatever its number of units. All choices are by hashes of seed and
id, so a document is cut alike on any machine, in any order of rows.

Forms: ``plain`` is the text; ``psm`` has prefix, suffix, middle behind their marks; ``spm`` suffix, prefix, middle. A
text that holds a mark stays plain, so that ``restore`` is exact for every row.

Defined results: a null text is empty, and an empty text plain; a null id is hashed as no digits; rows that repeat an id
are cut each by its own text, with the same hashes; an empty table gives an empty one; other columns are left alone.
"""

from __future__ import annotations

import re
from collections import deque
from itertools import count, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
#: Of 100 texts, those that are transformed, and of 100 of these, those with the suffix first.
RATE, SPM_RATE = 90, 20
#: Characters of output that a task holds before it passes them on.
HELD = 4_000_000

OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def units(text: str) -> int:
    """First pass: how many units there are."""
    seen = count()
    deque(zip(UNIT.finditer(text), seen), maxlen=0)  # nothing is kept
    return next(seen)


def cuts(text: str, low: int, high: int) -> tuple[int, int]:
    """Second pass: where the units of two ranks (low <= high) end; one iterator goes on from the first to the second."""
    found = UNIT.finditer(text)

    def after(steps: int, at: int) -> int:
        return next(islice(found, steps - 1, None)).end() if steps else at

    first = after(low, 0)
    return first, after(high - low, first)


def _choices(seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(digest.substr(8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, *, seed: int = 1, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (units), form, the code points of prefix and middle (null where plain) and the output of each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *_choices(seed))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    names = [c.split()[0] for c in OUT.split(", ")]

    def one(text: str, h1: int, h2: int, h3: int, h4: int) -> tuple:
        n = units(text)
        if not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
            return n, "plain", None, None, text
        a, b = cuts(text, *sorted((h1 % (n + 1), h2 % (n + 1))))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_rate:
            return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"

    def run(batches):
        out, held = [[] for _ in names], 0
        for b in slices(batches):
            for doc, text, *h in zip(*(b[c].to_pylist() for c in ("doc_id", "text", "h1", "h2", "h3", "h4"))):
                row = (doc, *one(text, *h))
                for column, x in zip(out, row):
                    column.append(x)
                held += len(row[-1])
                if held >= HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
                    out, held = [[] for _ in names], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return rows.mapInArrow(run, OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. Texts hold no mark, so a mark's first place is where it was put."""

    def between(left: str, right: str | None) -> Column:
        start = F.instr(output, left) + F.lit(len(left))
        return output.substr(start, F.instr(output, right) - start if right else F.char_length(output))

    prefix = F.when(form == "psm", between(PREFIX, SUFFIX)).otherwise(between(PREFIX, MIDDLE))
    suffix = F.when(form == "psm", between(SUFFIX, MIDDLE)).otherwise(between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, between(MIDDLE, None), suffix))
