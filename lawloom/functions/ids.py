"""Law identifiers: derivation, two canonical forms, numbers, repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawloom.functions.text import strip

# What identifiers look like. The dashes are hyphen, en dash and em dash.
PAIR = r"(\d+)\s*[–—\-]\s*(\d+)"
WHOLE = r"^(?:Public Law\s+)?(\d+)\s*[-–—]\s*(\d+)$"
CANONICAL = r"Public Law \d+[-–—]\d+"
VALID = r"\d+[-–—]\d+"
OLD_STYLE = r"\bPublic Law\s+\d+(?:-\d+)?\b"
OLD_ABBREVIATED = r"[Pp]ub[l]?i[c]?[e]?\s*,?\.?\s*No\.?\s*\d+.+"
OLD_PRIVATE = r"\bPrivate Law\s+\d+(?:-\d+)?\b"


def normalize(c: Column) -> Column:
    """``congress-number`` with an ASCII hyphen; unchanged without such a pair; empty for null."""
    c = F.coalesce(c, F.lit(""))
    return F.when(c.rlike(PAIR), F.concat_ws("-", F.regexp_extract(c, PAIR, 1), F.regexp_extract(c, PAIR, 2))).otherwise(c)


def published(c: Column) -> Column:
    """``Public Law congress–number`` with an en dash if the whole text is an identifier; else unchanged."""
    return F.regexp_replace(c, WHOLE, "Public Law $1–$2")


def number(c: Column) -> Column:
    """The digits at the end; null without any."""
    return F.regexp_extract(c, r"(\d+)$", 1).try_cast("bigint")


def pair(c: Column, which: int) -> Column:
    """Congress (1) or law number (2) as three or more digits; 000 without a pair."""
    digits = F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d+)[–-](\d+)", which)
    return F.format_string("%03d", F.coalesce(digits.try_cast("int"), F.lit(0)))


def derive(vol: Column, citable_as: Column, sidenote: Column, congress: Column, doc_number: Column) -> Column:
    """An identifier from a law's metadata. Volumes up to 63 name their laws in side notes.

    Null marks a private law of those volumes.
    """
    congress, doc_number = F.coalesce(congress, F.lit("")), F.coalesce(doc_number, F.lit(""))
    rebuilt = F.concat(F.lit("Public Law "), congress, F.lit("-"), doc_number)
    cited = F.when(vol == 70, rebuilt).otherwise(F.coalesce(strip(citable_as), F.lit("")))
    cited = F.when(cited.contains("v"), F.concat(F.lit("Public Law "), doc_number)).otherwise(cited)
    modern = F.when(F.lower(cited).contains("public law"), cited).otherwise(rebuilt)
    note = F.coalesce(sidenote, F.lit(""))
    found = F.coalesce(F.nullif(F.regexp_extract(note, OLD_STYLE, 0), F.lit("")), F.nullif(F.regexp_extract(note, OLD_ABBREVIATED, 0), F.lit("")))
    old = F.when(found.isNotNull(), F.concat_ws("-", congress, F.regexp_extract(found, r"\d+", 0))).when(note.rlike(OLD_PRIVATE), F.lit(None).cast("string")).otherwise("")
    return F.when(vol > 63, modern).otherwise(old)


def repair(law_id: Column, congress: Column, doc_number: Column) -> Column:
    """A malformed identifier rebuilt from congress and number, if that gives a canonical one."""
    rebuilt = F.concat(F.lit("Public Law "), F.coalesce(congress, F.lit("")), F.lit("-"), F.coalesce(doc_number, F.lit("")))
    bad = ~F.coalesce(law_id, F.lit("")).rlike(CANONICAL)
    return F.when(bad & rebuilt.rlike(CANONICAL), rebuilt).otherwise(law_id)


def volume_of(path: Column) -> Column:
    return F.regexp_extract(path, r"STATUTE-(\d+)\.xml$", 1).try_cast("int")


def parse_volumes(spec: str, *, least: int = 37) -> list[int]:
    """'37-40,42' as a rising list of distinct volumes."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in spec.split(","))):
        a, _, b = part.partition("-")
        low, high = int(a), int(b or a)
        if low > high:
            raise ValueError(f"{part}: the range falls")
        out.update(range(low, high + 1))
    if bad := [v for v in out if v < least]:
        raise ValueError(f"no volume before {least}: {min(bad)}")
    return sorted(out)
