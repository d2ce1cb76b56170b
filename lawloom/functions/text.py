"""Text expressions with the Unicode behaviour of the data's producers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Every character with the Unicode property White_Space.
WHITE_SPACE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Without leading and trailing Unicode white space."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def norm(c: Column) -> Column:
    """Stripped and lower-cased; null, empty and 'nan' become the empty string."""
    s = F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.when(s == "nan", "").otherwise(s)


def any_contains(c: Column, needles) -> Column:
    """Whether the lower-cased text holds one of the needles; False for null."""
    low = F.lower(F.coalesce(c, F.lit("")))
    out = F.lit(False)
    for n in needles:
        out = out | low.contains(n.lower())
    return out


def first_match(c: Column, families, otherwise: str) -> Column:
    """Name of the first family one of whose needles the text holds."""
    cases = [F.when(any_contains(c, needles), F.lit(name)) for name, needles in families]
    return F.coalesce(*cases, F.lit(otherwise))


def canonical_map(m: Column) -> Column:
    """JSON of a map with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""
