"""The rule registry as tables: proposals in, states, views of active rules."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.functions import text
from lawloom.operators import rules
from lawloom.schemas import ENTRY

KINDS = ("law_id", "section_number", "other")
DONE = ("not_required", "implemented", "manual_override")
# What a rule's pattern may say, and what the reports of volumes then say that it would mend.
SAID = (
    (("sectionnumber is null", "outer <section>", "unnumbered opening", "no <num>", "without appropriate num", "lacking <num>"), ("share a uniquekey",)),
    (("no top-level <section>", "<main> contains <part>", "<main> contains <title>", "<main> contains <chapter>", "<main> contains <quotedcontent>", "zero top-level <section>", "bare <subsection>"), ("laws in the table",)),
    (("sibling <appropriations>",), ("share a uniquekey",)),
    (("sibling <level>",), ("share a uniquekey",)),
)


def proposal_key() -> Column:
    """What makes two proposals the same: kind, trigger and correction."""
    return F.sha2(F.concat_ws("\u0000", "type", text.canonical_map(F.col("trigger")), text.canonical_map(F.col("correction"))), 256)


def append_pending(entries: DataFrame, proposals: DataFrame, *, next_id: int) -> DataFrame:
    """The registry with new proposals, and one more sighting for those it has; ids rise from next_id in order of proposal."""
    keyed = entries.withColumn("__k", proposal_key())
    valid = proposals.where(F.col("type").isin(*KINDS)).withColumn("__k", proposal_key())
    seen = valid.groupBy("__k").agg(F.count("*").alias("__n"))
    old = keyed.join(seen, "__k", "left").withColumn("seen_again_count", F.coalesce("seen_again_count", F.lit(0).cast("long")) + F.coalesce("__n", F.lit(0).cast("long"))).drop("__n")
    first = Window.partitionBy("__k").orderBy("proposed_at", "__k")
    new = valid.join(keyed.select("__k"), "__k", "left_anti").withColumns({"__r": F.row_number().over(first), "__n": F.count("*").over(Window.partitionBy("__k"))}).where("__r = 1")
    # proposals of one run are a handful of rows
    new = new.withColumns({"id": (F.row_number().over(Window.orderBy("proposed_at", "__k")) + next_id - 1).cast("long"), "seen_again_count": (F.col("__n") - 1).cast("long"), "status": F.lit("pending")}).drop("__r", "__n")
    return old.unionByName(new, allowMissingColumns=True).select(*ENTRY.fieldNames())


def move(entries: DataFrame, ids: list[int], *, to: str, reviewer: str = "", note: str = "", at: str = "", from_: tuple[str, ...] = ("pending",)) -> DataFrame:
    """Entries with these ids in a new state, if they are in one that leads there."""
    hit = F.col("id").isin(*ids) & F.col("status").isin(*from_)
    new = {"status": to, "reviewer": reviewer, "review_note": note, "reviewed_at": at}
    return entries.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in new.items()})


def mark(entries: DataFrame, ids: list[int], **values) -> DataFrame:
    """Fields of entries with these ids, such as implementation_status."""
    return entries.withColumns({c: F.when(F.col("id").isin(*ids), F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def backfill(entries: DataFrame) -> DataFrame:
    """Entries from before implementation was tracked: rules need none, others wait for it."""
    return entries.withColumn("implementation_status", F.coalesce("implementation_status", F.when(F.col("type") == "other", "pending").otherwise("not_required")))


def override_union(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All keys of two tables; the first one's row where both have it."""
    both = first.withColumn("__from", F.lit(0)).unionByName(second.withColumn("__from", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy("__from"))).where("__n = 1").drop("__from", "__n")


def family() -> Column:
    pattern = F.coalesce(F.nullif(F.element_at("trigger", "pattern"), F.lit("")), F.element_at("correction", "description"))
    return F.when(F.col("type") == "other", text.first_match(pattern, rules.FAMILIES, "none")).otherwise("none")


def law_id_rules(entries: DataFrame) -> list[tuple]:
    """Active identifier rules in order of id. Rule tables are tens of rows."""
    rows = entries.where("type = 'law_id'").orderBy("id").collect()
    return [(r["trigger"]["law_id_substring"], r["trigger"]["title_substring"], r["correction"]["replace_with_law_id"]) for r in rows]


def section_rules(entries: DataFrame) -> list[tuple]:
    rows = entries.where("type = 'section_number'").orderBy("id").collect()
    return [(r["trigger"]["law_id_substring"], r["trigger"]["heading_substring"], r["trigger"].get("text_substring"), r["correction"]["replace_with_section_number"]) for r in rows]


def fingerprint(rule_rows: list[tuple]) -> str:
    """A hash of a rule set, whatever its order."""
    return hashlib.sha256(json.dumps(sorted(json.dumps(r, ensure_ascii=False) for r in rule_rows)).encode()).hexdigest()


def applied(entries: DataFrame) -> DataFrame:
    """Entries that may be called applied: approved ones that need no implementation or have it."""
    return entries.where((F.col("status") == "approved") & F.coalesce("implementation_status", F.lit("not_required")).isin(*DONE))


def affected_volumes(reports: DataFrame, needles: list[str]) -> DataFrame:
    """Volumes whose warnings or failures hold one of the needles."""
    said = F.lower(F.concat_ws("\n", "warnings", "failed"))
    return reports.where(F.exists(F.array(*(F.lit(n.lower()) for n in needles)), lambda n: F.contains(said, n))).select("vol").distinct() if needles else reports.select("vol").limit(0)


def needles(pattern: str | None) -> list[str]:
    """What reports say about volumes that a rule with this pattern concerns."""
    low = (pattern or "").lower()
    return sorted({n for keys, said in SAID if any(k in low for k in keys) for n in said})


def volumes_of(entry: DataFrame, reports: DataFrame) -> DataFrame:
    """The volumes that one entry concerns: where it was found, and those whose reports say so."""
    pattern = F.coalesce(F.nullif(F.element_at("trigger", "pattern"), F.lit("")), F.element_at("correction", "description"))
    row = entry.select(pattern.alias("pattern"), "discovered_in_vol").first()
    found = entry.select(F.col("discovered_in_vol").alias("vol")).where("vol is not null")
    return found.unionByName(affected_volumes(reports, needles(row["pattern"] if row else None)).select(F.col("vol").cast("int"))).distinct()


def append_new(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` whose key (letter case and outer space aside) the table lacks, each once."""
    norm = lambda df: df.withColumn("__k", F.concat_ws("\u0000", *(text.norm(F.col(c).cast("string")) for c in key)))
    blank = F.col("__k") == "\u0000" * (len(key) - 1)
    return norm(new).where(~blank).join(norm(existing).select("__k"), "__k", "left_anti").dropDuplicates(["__k"]).drop("__k")
