"""All checks of a table in one pass, and the report made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.functions import ids, text
from lawloom.schemas import FINAL_COLUMNS

# Fixed values: (part of the title, right identifier, wrong one), (volume, part of the identifier, part of the heading, right number)
LAW_ID_CHECKS = (
    ("social security", "81-174", "81-175"),
    ("federal crop insurance", "81-268", "81-208"),
    ("preference act of 1944 with respect to certain mothers of veterans", "81-269", "81-208"),
    ("republic of finland on the principal or interest", "81-265", "81-285"),
    ("federal election campaign act of 1971 to improve", "104-79", "104–9"),
    ("amend the act approved july 3, 1943", "79-466", "79-496"),
    ("return of the grand river dam project", "79-573", "79-673"),
    ("use by industry of silver", "79-579", "79-679"),
    ("saint mary river, michigan, south canal", "84-663", "84-274"),
)
SECTION_CHECKS = (
    (114, "106–382", "use of pick-sloan power", "SEC. 6."),
    (114, "106–181", "grants from small airport fund", "SEC. 128."),
    (114, "106–259", "transfer of funds", "SEC. 8015."),
    (114, "106–259", "including transfer of funds", "SEC. 8041."),
    (98, "98–369", "value of used components furnished by first user", "SEC. 734."),
)
ENTRY_TYPES = ("Section", "Division")
COVERAGE = 0.8
SELECTED = 600


def missing_columns(columns: list[str]) -> tuple[list[str], list[str]]:
    """Columns that a table lacks, and those it has besides."""
    return [c for c in FINAL_COLUMNS if c not in columns], [c for c in columns if c not in FINAL_COLUMNS]


def _n(condition: Column) -> Column:
    return F.coalesce(F.sum(F.coalesce(condition, F.lit(False)).cast("long")), F.lit(0).cast("long"))


def measures(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every count that a check needs, by key, from one aggregation (keys that repeat take one more)."""
    low = F.lower(F.coalesce("LawTitle", F.lit("")))
    heading = F.lower(F.coalesce("SectionName", F.lit("")))
    law_checks = [_n(low.contains(t) & F.col("LawIdentifier").contains(bad)).alias(f"law_{i}") for i, (t, _, bad) in enumerate(LAW_ID_CHECKS)]
    section_checks = []
    for i, (vol, part, words, to) in enumerate(SECTION_CHECKS):
        hit = (F.col("vol") == vol) & F.col("LawIdentifier").contains(part) & heading.contains(words)
        section_checks += [_n(hit).alias(f"sec_{i}_rows"), _n(hit & (F.col("SectionNumber") == to)).alias(f"sec_{i}_right"), F.slice(F.array_sort(F.collect_set(F.when(hit, F.col("SectionNumber")))), 1, 3).alias(f"sec_{i}_numbers")]
    per_key = df.groupBy(*keys, "UniqueKey").agg(F.count("*").alias("__c")).groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("UniqueKey").isNotNull() & (F.col("__c") > 1), F.col("__c"))), F.lit(0).cast("long")).alias("duplicate_keys"))
    whole = df.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.countDistinct("LawIdentifier").alias("law_count"),
        F.array_sort(F.collect_set(F.when(~F.coalesce(F.col("EntryType"), F.lit("")).isin(*ENTRY_TYPES), F.coalesce(F.col("EntryType"), F.lit("(null)"))))).alias("bad_types"),
        _n(~F.coalesce("LawIdentifier", F.lit("")).rlike(ids.VALID)).alias("bad_ids"),
        F.min(F.when(~F.coalesce("LawIdentifier", F.lit("")).rlike(ids.VALID), F.col("LawIdentifier"))).alias("bad_id"),
        _n(~text.is_blank(F.col("Text"))).alias("with_text"),
        _n(F.col("Selection") == 1).alias("selected"),
        *law_checks,
        *section_checks,
    )
    return whole.join(per_key, keys)


def status(failed: Column, warnings: Column) -> Column:
    return F.when(F.size(failed) > 0, "failed").when(F.size(warnings) > 0, "warning").otherwise("passed")


def report(measured: DataFrame, public_laws: DataFrame | None = None, *, columns: list[str] | None = None) -> DataFrame:
    """vol, passed, failed, warnings, row_count, law_count, status. public_laws: vol, public_count; columns: those of the table."""
    if public_laws is not None:
        measured = measured.join(public_laws, "vol", "left")
    share = F.col("with_text") / F.col("row_count")
    checks: list[tuple[str, str, Column, Column]] = [
        ("failed", "entry_types", F.size("bad_types") > 0, F.concat(F.lit("EntryType outside its domain: "), F.array_join("bad_types", ", "))),
        ("failed", "law_ids", F.col("bad_ids") > 0, F.format_string("%d rows with a malformed LawIdentifier, such as %s", "bad_ids", F.coalesce("bad_id", F.lit("(null)")))),
        ("warnings", "unique_keys", F.col("duplicate_keys") > 0, F.format_string("%d rows share a UniqueKey", "duplicate_keys")),
        ("warnings", "text_coverage", share < COVERAGE, F.format_string("text coverage %.3f", share)),
        ("warnings", "selection", F.col("selected") != SELECTED, F.format_string("%d rows selected", "selected")),
    ]
    if columns is not None:
        missing, extra = missing_columns(columns)
        checks += [("failed", "missing_columns", F.lit(bool(missing)), F.lit(f"missing columns: {', '.join(missing)}")), ("warnings", "extra_columns", F.lit(bool(extra)), F.lit(f"extra columns: {', '.join(extra)}"))]
    checks += [("failed", f"law_rule_{i}", F.col(f"law_{i}") > 0, F.lit(f"{bad} should be {good}")) for i, (_, good, bad) in enumerate(LAW_ID_CHECKS)]
    checks += [("failed", f"section_rule_{i}", (F.col(f"sec_{i}_rows") > 0) & (F.col(f"sec_{i}_right") == 0), F.concat(F.lit(f"{part}: {words} should be {to}, not "), F.array_join(F.col(f"sec_{i}_numbers"), ", ", "(null)"))) for i, (_, part, words, to) in enumerate(SECTION_CHECKS)]
    if public_laws is not None:
        checks.append(("warnings", "law_count", F.coalesce("public_count", F.lit(0)) != F.col("law_count"), F.format_string("%d laws in the table, %d in the source", "law_count", F.coalesce("public_count", F.lit(0)))))
    some = lambda kind: F.filter(F.array(*(F.when(bad, said) for k, _, bad, said in checks if k == kind)), lambda x: x.isNotNull())
    passed = F.filter(F.array(*(F.when(~F.coalesce(bad, F.lit(False)), F.lit(name)) for _, name, bad, _ in checks)), lambda x: x.isNotNull())
    out = measured.select("vol", passed.alias("passed"), some("failed").alias("failed"), some("warnings").alias("warnings"), "row_count", "law_count")
    return out.withColumn("status", status(F.col("failed"), F.col("warnings")))
