"""The parts of a row's hierarchical key, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawloom.functions import ids
from lawloom.functions.text import strip

# Roman numerals, pairs first.
ROMAN = {"CM": 900, "CD": 400, "XC": 90, "XL": 40, "IX": 9, "IV": 4, "M": 1000, "D": 500, "C": 100, "L": 50, "X": 10, "V": 5, "I": 1}
BLANK_SECTION = "000000000000001"
BLANK = "(blank)"


def _let(value: Column, use) -> Column:
    """An expression of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _digits(n: Column, width: int) -> Column:
    """As format_string("%0<width>d") writes a number, which it does in many times the time."""

    def padded(x: Column) -> Column:
        t = x.cast("string")
        return F.when(x < 0, F.format_string(f"%0{width}d", x)).when(x < 10**width, F.lpad(t, width, "0")).otherwise(F.coalesce(t, F.lit("null")))

    return _let(n, padded)


def _upper(c: Column) -> Column:
    return F.upper(strip(F.coalesce(c, F.lit(""))))


def letters_value(c: Column) -> Column:
    """A=1, Z=26, AA=27 and so on, for text of A-Z alone."""
    several = F.aggregate(F.split(c, ""), F.lit(0).cast("bigint"), lambda s, ch: F.when(ch == "", s).otherwise(s * 26 + F.ascii(ch) - 64))
    return F.when(F.length(c) == 1, (F.ascii(c) - 64).cast("bigint")).otherwise(several)


def alpha_code(c: Column, prefix: str) -> Column:
    """Letters after the prefix as a number; 000 for anything else. No code is cut off."""

    def code(letters: Column) -> Column:
        return F.when(letters.rlike("^[A-Z]+$"), _digits(letters_value(letters), 3)).otherwise("000")

    value = _let(_upper(c), lambda up: _let(F.coalesce(F.nullif(F.regexp_extract(up, rf"^{prefix}\s+([A-Z]+)", 1), F.lit("")), up), code))
    return F.when(c.isNull(), "000").otherwise(value)


def first_letter_code(c: Column, prefix: str) -> Column:
    """The older form: the one letter after the prefix, or the first letter of other text, as a number; 000 for none."""
    up = _upper(c)
    after = F.regexp_extract(up, rf"^{prefix}\s+([A-Z])", 1)
    letter = F.when(after != "", after).otherwise(F.regexp_extract(up, "^([A-Z])", 1))
    return F.when(letter != "", F.format_string("%03d", F.ascii(letter) - 64)).otherwise("000")


def _roman(up: Column) -> Column:
    """The value of upper-case text; it names the text twice."""
    values = F.create_map(*(F.lit(x) for kv in ROMAN.items() for x in kv))
    total = F.aggregate(F.regexp_extract_all(up, F.lit("(CM|CD|XC|XL|IX|IV|[MDCLXVI])"), F.lit(1)), F.lit(0), lambda s, x: s + F.element_at(values, x))
    return F.when(up.rlike("^[MDCLXVI]+$"), total).otherwise(0)


def roman_value(c: Column) -> Column:
    """Numerals added up from the left, pairs as one; irregular ones are added as they come. 0 for other text."""
    return _let(_upper(c), _roman)


def numeral_code(c: Column, prefix: str) -> Column:
    """Digits or Roman numerals after the prefix; 000 for anything else."""

    def code(v: Column) -> Column:
        return F.when(v.rlike(r"^\d+$"), _digits(v.try_cast("bigint"), 3)).when(v.rlike("^[IVXLCDM]+$"), _digits(_roman(v), 3)).otherwise("000")

    value = _let(_upper(c), lambda up: _let(F.coalesce(F.nullif(F.regexp_extract(up, rf"^{prefix}\s+([A-Z0-9]+)", 1), F.lit("")), up), code))
    return F.when(c.isNull(), "000").otherwise(value)


def _section_text(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.upper(strip(c)), r"^(SECTION|SEC\.?)\s*", ""), r"[^\p{L}\p{N}]", "")


def section_code(c: Column) -> Column:
    """15 characters for a number with letters after it; six for other text; a fixed code for none."""

    def numbered(t: Column, tail: Column) -> Column:
        digits = F.substring(t, F.lit(1), F.length(t) - F.length(tail))
        width = F.greatest(F.lit(15) - F.length(tail), F.lit(0))
        padded = F.substring(F.concat(F.repeat(F.lit("0"), F.greatest(width - F.length(digits), F.lit(0))), digits), F.lit(1), width)
        return F.substring(F.concat(padded, tail), 1, 15)

    def code(t: Column) -> Column:
        tail = F.regexp_extract(t, r"^\d+([A-Z]*)$", 1)
        return F.when(t.rlike(r"^\d+[A-Z]*$"), _let(tail, lambda x: numbered(t, x))).otherwise(F.lpad(F.substring(t, 1, 6), 6, "0"))

    return F.when(c.isNull() | (c == BLANK), BLANK_SECTION).otherwise(_let(_section_text(c), code))


def is_first_section(c: Column) -> Column:
    """Whether a section number has the code of a missing one."""
    return c.isNull() | (_section_text(c) == "1")


def heading_code(mapping_id: Column, heading: Column) -> Column:
    """Five digits of a heading's dictionary id; 00001 without a heading, 00000 where the dictionary lacks it."""
    return F.when(heading.isNull(), "00001").otherwise(_digits(F.coalesce(mapping_id, F.lit(0)), 5))


def unique_key(*, law_id: Column, division: Column, title: Column, subtitle: Column, chapter: Column, subchapter: Column, entry_type: Column, section_number: Column, heading_codes: list[Column]) -> Column:
    is_section = F.lower(strip(F.coalesce(entry_type, F.lit("")))) == "section"
    last = F.when(is_section, section_code(section_number)).otherwise(F.concat_ws("-", *heading_codes))
    return F.concat_ws("-", ids.pair(law_id, 1), ids.pair(law_id, 2), alpha_code(division, "DIVISION"), numeral_code(title, "TITLE"), alpha_code(subtitle, "SUBTITLE"), numeral_code(chapter, "CHAPTER"), alpha_code(subchapter, "SUBCHAPTER"), F.when(is_section, "S").otherwise("D"), last)


def alpha_marker(n: Column) -> Column:
    """1 is B, 25 is Z, 26 is AA: the letters for the second and later blocks."""
    one = lambda x: F.char(F.lit(65) + x)
    x = n
    return F.when(x < 26, one(x)).when(x < 26 + 26 * 26, F.concat(one(F.floor((x - 26) / 26)), one((x - 26) % 26))).otherwise(F.concat(one(F.floor((x - 702) / 676)), one(F.floor((x - 702) / 26) % 26), one((x - 702) % 26)))
