"""Explicit schemas: rows of the walk, of the published table, of registries and reports."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_FIELDS = ["counter", "LawIdentifier", "approvedDate", "LawTitle", "LawType", "Division", "Title", "SubTitle", "Chapter", "SubChapter", "SectionNumber", "SectionName", "Text", "DivisionHeadingLevel1", "DivisionHeadingLevel2", "DivisionHeadingLevel3"]

RAW = T.StructType([T.StructField("vol", T.IntegerType()), T.StructField("xml_index", T.IntegerType()), T.StructField("EntryType", T.StringType()), *(T.StructField(n, T.LongType() if n == "counter" else T.StringType()) for n in RAW_FIELDS), T.StructField("error", T.StringType())])

FINAL_COLUMNS = ["UniqueKey", "KeyVersion", "ContentHash", "OriginalOrder", "EntryType", "Selection", "Order", "LawIdentifier", "LawType", "LawTitle", "approvedDate", "IsAppropriation", "Division", "Title", "SubTitle", "Chapter", "SubChapter", "SectionNumber", "SectionName", "DivisionHeadingLevel1", "DivisionHeadingLevel2", "DivisionHeadingLevel3", "Text", "Agencies_Row", "Agencies_Law", "ReviewStatus"]

_KIND = {"OriginalOrder": T.LongType(), "Selection": T.IntegerType(), "Order": T.IntegerType(), "IsAppropriation": T.BooleanType(), "Agencies_Row": T.ArrayType(T.StringType()), "Agencies_Law": T.ArrayType(T.StringType())}

PUBLISHED = T.StructType([T.StructField(n, _KIND.get(n, T.StringType())) for n in FINAL_COLUMNS])

ENTRY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("type", T.StringType()),
        *(T.StructField(n, T.MapType(T.StringType(), T.StringType())) for n in ("trigger", "correction", "evidence")),
        T.StructField("proposed_at", T.StringType()),
        T.StructField("discovered_in_vol", T.IntegerType()),
        T.StructField("agent_version", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("status", T.StringType()),
        *(T.StructField(n, T.StringType()) for n in ("reviewer", "review_note", "reviewed_at")),
        T.StructField("applied_in_runs", T.ArrayType(T.StructType([T.StructField("vol", T.IntegerType()), T.StructField("run_ts", T.StringType())]))),
        T.StructField("seen_again_count", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in ("implementation_status", "implementation_commit_sha", "implementation_attempted_at", "implementation_notes")),
    ]
)

ISSUE_COLUMNS = ["Citable As", "Volume", "Congress", "issue", "Should_say", "text_says", "location_in_xml", "line_numbers"]

#: Columns of the two older forms of a published table.
OLDER = ["OriginalOrder", "EntryType", "Selection", "Order", "LawIdentifier", "LawType", "LawTitle", "approvedDate", "Division", "Title", "SubTitle", "Chapter", "SubChapter", "SectionNumber", "SectionName", *(f"DivisionHeadingLevel{n}" for n in (1, 2, 3)), "Text"]
OLDER_KEYED = [*OLDER[:4], "UniqueKey", "KeyVersion", *OLDER[4:], "Agencies_Row", "Agencies_Law"]
