"""The review workflow around the rule registry as tables: proposals and issues in, gates, families, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.operators import registry
from lawloom.schemas import ENTRY, ISSUE_COLUMNS

_MAP = T.MapType(T.StringType(), T.StringType())
#: What a reviewer's answer may hold. Keys that are not named here are dropped as it is read.
ANSWER = T.StructType(
    [
        T.StructField("proposals", T.ArrayType(T.StructType([T.StructField("type", T.StringType()), *(T.StructField(n, _MAP) for n in ("trigger", "correction", "evidence")), T.StructField("confidence", T.DoubleType())]))),
        T.StructField("issues", T.ArrayType(T.StructType([T.StructField("volume", T.IntegerType()), *(T.StructField(n, T.StringType()) for n in ("citable_as", "congress", "issue", "should_say", "text_says", "location_in_xml", "line_numbers"))]))),
        T.StructField("notes", T.StringType()),
    ]
)
#: The longest text of an issue's cell, and what stands behind one that was longer.
CELL, CUT = 32_000, "…<TRUNCATED>"
# Where a coder's changes may lie, and files that they may not touch.
ALLOWED = ("parser/", "pipeline/", "tests/")
FORBIDDEN = ("pipeline/corrections_registry.py", "apply_corrections_and_publish.py", "approve_corrections.py")


def answers(blobs: Column) -> Column:
    return F.from_json(blobs, ANSWER)


def entries(proposals: DataFrame, *, agent_version: str, at: str) -> DataFrame:
    """Pending entries of proposals (vol, and the fields of ANSWER.proposals). Unknown types are left out; a missing one is other."""
    empty = F.create_map().cast(_MAP)
    kind = F.coalesce("type", F.lit("other"))
    known = {
        "id": F.lit(0).cast("long"),
        "type": kind,
        **{c: F.coalesce(c, empty) for c in ("trigger", "correction", "evidence")},
        "proposed_at": F.lit(at),
        "discovered_in_vol": F.col("vol").cast("int"),
        "agent_version": F.lit(agent_version),
        "confidence": F.col("confidence").cast("double"),
        "applied_in_runs": F.array(F.struct(F.col("vol").cast("int").alias("vol"), F.lit(at).alias("run_ts"))),
        "seen_again_count": F.lit(0).cast("long"),
        "status": F.lit("pending"),
    }
    column = lambda f: known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
    return proposals.where(kind.isin(*registry.KINDS)).select(*(column(f) for f in ENTRY))


def issue_rows(issues: DataFrame) -> DataFrame:
    """The eight columns of the issue log of issues (vol, and the fields of ANSWER.issues)."""
    said = F.coalesce("text_says", F.lit(""))
    said = F.when(F.length(said) > CELL, F.concat(F.substring(said, 1, CELL), F.lit(CUT))).otherwise(said)
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    values = [blank("citable_as"), F.coalesce("volume", "vol").cast("int"), blank("congress"), blank("issue"), blank("should_say"), said, blank("location_in_xml"), blank("line_numbers")]
    return issues.select(*(v.alias(n) for v, n in zip(values, ISSUE_COLUMNS)))


def new_issues(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows that the log lacks, each once, by volume, citation, lines and issue."""
    return registry.append_new(log, rows, ["Volume", "Citable As", "line_numbers", "issue"])


def coverage(anomalies: DataFrame, issues: DataFrame) -> DataFrame:
    """vol, expected, returned, under: volumes for which fewer issues came back than anomalies were found."""
    count = lambda df, n: df.groupBy("vol").agg(F.count("*").alias(n))
    both = count(anomalies, "expected").join(count(issues, "returned"), "vol", "left")
    returned = F.coalesce("returned", F.lit(0).cast("long"))
    return both.select("vol", "expected", returned.alias("returned"), (returned < F.col("expected")).alias("under"))


def gate(status: Column, files: Column, tests_added: Column) -> Column:
    """Why a coder's answer is refused, null if it is not: its status, the files it changed, no new test."""
    bad = F.filter(files, lambda f: f.isin(*FORBIDDEN) | ~F.coalesce(F.exists(F.array(*(F.lit(p) for p in ALLOWED)), lambda p: F.startswith(f, p)), F.lit(False)))
    first = F.get(bad, F.lit(0))
    return (
        F.when(F.coalesce(status, F.lit("")) != "success", F.concat(F.lit("status: "), F.coalesce(status, F.lit("none"))))
        .when(first.isin(*FORBIDDEN), F.concat(F.lit("forbidden file modified: "), first))
        .when(first.isNotNull(), F.concat(F.lit("out-of-scope file: "), first))
        .when(F.coalesce(F.size(tests_added), F.lit(0)) <= 0, F.lit("no new tests"))
    )


def family_members(table: DataFrame, *, pending_only: bool = False) -> DataFrame:
    """family, ids (rising) of the entries in each family but none."""
    some = table.where("implementation_status = 'pending'") if pending_only else table
    return some.select(registry.family().alias("family"), "id").where("family <> 'none'").groupBy("family").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def task(family: DataFrame) -> DataFrame:
    """task_id (the largest id), entry_ids and family of each batch that a coder gets."""
    return family.select(F.array_max("ids").alias("task_id"), F.col("ids").alias("entry_ids"), "family")


def last_runs(runs: Column, n: int = 5) -> Column:
    """The last n runs of an entry."""
    return F.when(F.size(runs) > n, F.slice(runs, -n, n)).otherwise(runs)


def fan_out(tables: dict[str, DataFrame], ids: list[int], status: str, *, sha: str | None = None, notes: str | None = None) -> dict[str, DataFrame]:
    """An implementation status for these entries in every table that has them; sha and notes only where given."""
    values = {"implementation_status": status, **{k: v for k, v in (("implementation_commit_sha", sha), ("implementation_notes", notes)) if v is not None}}
    return {name: registry.mark(t, ids, **values) for name, t in tables.items()}
