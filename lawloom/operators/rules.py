"""Correction rules as ordered expressions. Rules are tens of rows; tables are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers that print wrongly. (part of the identifier, part of the title, right identifier)
LAW_IDS = (
    ("81-175", "social security", "81-174"),
    ("81-208", "federal crop insurance", "81-268"),
    ("81-208", "preference act of 1944 with respect to certain mothers of veterans", "81-269"),
    ("81-285", "republic of finland on the principal or interest", "81-265"),
    ("104–9", "federal election campaign act of 1971 to improve", "104-79"),
    ("79-496", "to amend the act approved july 3, 1943, entitled “an act to provide for the settlement of claims for damage to or loss or destruction of property or personal injury or death caused by military personnel or civilian employees, or otherwise incident to activities, of the war department or of the army", "79-466"),
    ("79-673", "to authorize the return of the grand river dam project to the grand river dam authority and the adjustment and settlement of accounts between the authority and the united states, and for other purposes", "79-573"),
    ("79-679", "to authorize the use by industry of silver held or owned by the united states, and for other purposes", "79-579"),
    ("84-274", "to modify the project for the saint mary river, michigan, south canal, in order to repeal the authorization for the alteration of the international bridge as part of such project, and to authorize the secretary of the army to accomplish such alteration.", "84-663"),
)
# Fixed values: (part of the identifier, part of the heading, part of the text or None, right section number)
SECTION_NUMBERS = (
    ("106–382", "USE OF PICK-SLOAN POWER", None, "SEC. 6."),
    ("106–259", "transfer of funds", "Funds appropriated in title III of this Act for the Department of Defense Pilot Mentor-Protege Program may be transferred to any other appropriation contained in this Act solely for the purpose of implementing a Mentor-Protege Program developmental assistance agreement pursuant to section 831 of the National Defense Authorization Act for Fiscal Year 1991 (Public Law 101–510; 10 U.S.C. 2301 note), as amended, under the authority of this provision or any other transfer authority contained in this Act.", "SEC. 8015."),
    ("106–259", "transfer of funds", "During the current fiscal year, amounts contained in the Department of Defense Overseas Military Facility Investment Recovery Account established by section 2921(c)(1) of the National Defense Authorization Act of 1991 (Public Law 101–510; 10 U.S.C. 2687 note) shall be available until expended for the payments specified by section 2921(c)(2) of that Act:", "SEC. 8041."),
    ("106–181", "GRANTS FROM SMALL AIRPORT FUND", None, "SEC. 128."),
    ("98–369", "VALUE OF USED COMPONENTS FURNISHED BY FIRST USER NOT TAKEN INTO ACCOUNT IN DETERMINING PRICE", None, "SEC. 734."),
)
# Kinds of proposals by the words in them.
FAMILIES = (
    ("null-num", ("sectionnumber is null", "outer <section>", "unnumbered opening", "null <num>", "no <num>", "without appropriate num", "lacking <num>", "lacks the <num>", 'section class="inline"', "enacting paragraph")),
    ("top-level-container", ("<main> contains <part>", "<main> contains <title>", "<main> contains <chapter>", "<main> contains <quotedcontent>", "no top-level <section>", "zero top-level <section>", "bare <subsection>", "<main> has zero top-level", "<main> has no top-level")),
    ("sibling-appropriations", ("sibling <appropriations>", "<appropriations> elements sharing")),
    ("sibling-level", ("sibling <level>", "<level> elements within a single <title>")),
)


def _low(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def cumulative(c: Column, title: Column, rules, *, title_regex: bool = False) -> Column:
    """Identifiers after all rules in turn; each sees what the ones before it left."""
    low = _low(title)
    for part, words, to in rules:
        words = words.lower()
        hit = low.rlike(words.replace("(", r"\(").replace(")", r"\)")) if title_regex else low.contains(words)
        c = F.when(c.contains(part) & hit, F.lit(to)).otherwise(c)
    return c


def _section_hit(law_id: Column, heading: Column, text: Column, rule) -> Column:
    part, words, more, _ = rule
    hit = law_id.contains(part) & _low(heading).contains(words.lower())
    return hit if more is None else hit & _low(text).contains(more.lower())


def first_wins(c: Column, law_id: Column, heading: Column, text: Column, rules) -> Column:
    return F.coalesce(*(F.when(_section_hit(law_id, heading, text, r), F.lit(r[3])) for r in rules), c)


def last_wins(c: Column, law_id: Column, heading: Column, text: Column, rules) -> Column:
    return first_wins(c, law_id, heading, text, list(reversed(list(rules))))


def apply(df: DataFrame, *, law_ids=(), section_numbers=()) -> DataFrame:
    """Identifier rules, then number rules that see the new identifiers. Keys stay as they are."""
    df = df.withColumn("LawIdentifier", cumulative(F.col("LawIdentifier"), F.col("LawTitle"), law_ids, title_regex=True))
    if not section_numbers:
        return df
    return df.withColumn("SectionNumber", last_wins(F.col("SectionNumber"), F.col("LawIdentifier"), F.col("SectionName"), F.col("Text"), section_numbers))


def mutations(before: Column, after: Column) -> Column:
    """How many rows a rule set changed."""
    return F.sum((~before.eqNullSafe(after)).cast("long"))
