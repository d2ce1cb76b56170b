"""The corrections workflow on the command line: record, review, apply, publish anew.

A workspace holds the registry's two files, the checkpoint and the published tables that ``plans.pipeline`` writes.
"""

from __future__ import annotations

import argparse
import datetime
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from lawloom.functions.jsonblob import extract
from lawloom.operators import anomalies, enrich, registry, workflow
from lawloom.plans import pipeline
from lawloom.schemas import ISSUE_COLUMNS
from lawloom.sources import publish, volumes, workspace

MISSING, FROZEN = 2, 3


def now() -> str:
    return datetime.datetime.now(datetime.UTC).strftime("%Y%m%d_%H%M%S")


def _append(new: DataFrame, path: str) -> int:
    """Appends rows to a table of Parquet files; how many."""
    rows = new.collect()  # what a review brings in is tens of rows
    if rows:
        new.sparkSession.createDataFrame(rows, new.schema).write.mode("append").parquet(path)
    return len(rows)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if Path(path).exists() else spark.createDataFrame([], schema)


def add_agencies(spark: SparkSession, output: str, rows: DataFrame) -> int:
    """Appends agencies (Agency, Bureau) that the list lacks, letter case aside; how many were new."""
    path = f"{output}/agencies"
    return _append(registry.append_new(_table(spark, path, "Agency string, Bureau string"), rows.select("Agency", "Bureau"), ["Agency", "Bureau"]), path)


def candidates(spark: SparkSession, source: str, output: str, vol: int, path: str, *, public_only: bool = True) -> dict:
    """Writes what a reviewer needs of a volume: anomalies of its law numbers, repeated keys with their laws, excerpts."""
    table = spark.read.parquet(f"{output}/checkpoint").where(F.col("vol") == vol)
    laws = volumes.read_laws(volumes.volume_files(spark, source, [vol])).where("error is null")
    order = volumes.sequence(laws)
    suspects = anomalies.sequence_anomalies(order.where("is_public") if public_only else order, group=["vol"], position="xml_index", number="law_number")
    known = laws.select(F.col("citable_as").alias("LawIdentifier"), "citable_as", "statutes_citation", F.col("first_line").alias("sourceline"), F.col("last_line").alias("line_end"), "tag_path")
    groups = anomalies.duplicate_context(table, known.where("citable_as is not null"), fields=["LawIdentifier", "SectionNumber", "SectionName"])
    counts = {"vol": vol, "total_rows": table.count(), "total_laws": laws.count(), "anomalies": suspects.count(), "groups": groups.count()}
    workspace.write_candidates(path, anomalies=suspects.drop("xml_excerpt"), duplicates=groups, excerpts=order, counts=counts)
    return counts


def record(spark: SparkSession, output: str, vol: int, answer: str, *, agent_version: str = "unknown", at: str | None = None, expected: int | None = None) -> dict:
    """A reviewer's answer into the pending entries and the issue log; what cannot be read records nothing."""
    blob = extract(answer)
    done = {"proposals": 0, "seen_again": 0, "issues": 0, "under": False}
    if blob is None:
        return done
    said = spark.createDataFrame([(vol, blob)], "vol int, blob string").select("vol", workflow.answers(F.col("blob")).alias("a"))
    proposals = workflow.entries(said.select("vol", F.inline("a.proposals")), agent_version=agent_version, at=at or now())
    reg = workspace.Registry(spark, output)
    old = len(reg.pending)
    active = reg.table(reg.active)
    fresh = proposals.withColumn("__k", registry.proposal_key()).join(active.where(F.col("status") == "approved").select(registry.proposal_key().alias("__k")), "__k", "left_anti").drop("__k")
    before = sum(e.get("seen_again_count") or 0 for e in reg.pending)
    reg.set("pending", registry.append_pending(reg.table(reg.pending), fresh, next_id=reg.next_id))
    reg.save()
    done |= {"proposals": len(reg.pending) - old, "seen_again": sum(e.get("seen_again_count") or 0 for e in reg.pending) - before}
    found = workflow.issue_rows(said.select("vol", F.inline("a.issues")))
    schema = ", ".join(f"`{c}` {'int' if c == 'Volume' else 'string'}" for c in ISSUE_COLUMNS)
    n = found.count()
    done["issues"] = _append(workflow.new_issues(_table(spark, f"{output}/issues", schema), found), f"{output}/issues")
    done["under"] = expected is not None and n < expected
    return done


def review(spark: SparkSession, output: str, ids_: list[int], *, approve: bool, reviewer: str, note: str = "", at: str | None = None) -> list[int]:
    """Moves pending entries to the active ones, or to the rejected; families of others become tasks. The ids that moved."""
    reg = workspace.Registry(spark, output)
    to = "approved" if approve else "rejected"
    moved = registry.backfill(registry.move(reg.table(reg.pending), ids_, to=to, reviewer=reviewer, note=note, at=at or now()))
    left, gone = moved.where(F.col("status") != to), moved.where(F.col("status") == to)
    done = [r["id"] for r in gone.select("id").orderBy("id").collect()]
    both = registry.override_union(gone, reg.table(reg.active if approve else reg.rejected), "id")
    reg.set("active" if approve else "rejected", both)
    reg.set("pending", left)
    reg.save()
    if approve:
        rows = {e["id"]: e for e in reg.active}
        waiting = reg.table(reg.active).where(F.col("id").isin(*done) & (F.col("type") == "other"))
        for r in workflow.task(workflow.family_members(waiting, pending_only=True)).collect():
            workspace.write_task(output, [rows[i] for i in r["entry_ids"]], r["family"], approver=reviewer, at=at or now())
            reg = mark(spark, output, r["entry_ids"], "in_progress")
    return done


def mark(spark: SparkSession, output: str, ids_: list[int], status: str, *, sha: str | None = None, notes: str | None = None) -> workspace.Registry:
    """An implementation status in every file that has these entries."""
    reg = workspace.Registry(spark, output)
    tables = {n: reg.table(getattr(reg, n)) for n in ("active", "pending", "rejected")}
    for name, t in workflow.fan_out(tables, ids_, status, sha=sha, notes=notes).items():
        reg.set(name, t)
    reg.save()
    return reg


def finalize(spark: SparkSession, output: str, ids_: list[int], answer: dict, *, tests_pass: bool, sha: str | None = None) -> str | None:
    """The gates that a coder's answer must pass; why it is refused, null if it is not. The entries get the outcome."""
    row = spark.createDataFrame([(answer.get("status"), list(answer.get("files_modified") or []), list(answer.get("tests_added") or []))], "status string, files array<string>, tests array<string>")
    why = row.select(workflow.gate(F.col("status"), F.col("files"), F.col("tests")).alias("why")).first()["why"]
    why = why or (None if tests_pass else "tests fail")
    mark(spark, output, ids_, "failed" if why else "implemented", sha=None if why else sha, notes=why)
    return why


def apply_and_publish(spark: SparkSession, output: str, vol: int, *, include_pending: bool = False, force: bool = False, keep_scratch: bool = False, at: str | None = None) -> int:
    """Publishes a volume's checkpoint after the registry's rules."""
    try:
        table = spark.read.parquet(f"{output}/checkpoint").where(F.col("vol") == vol)
        there = not table.isEmpty()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        there = False
    if not there:
        print(f"volume {vol} has no checkpoint", file=sys.stderr)
        return MISSING
    reg = workspace.Registry(spark, output)
    active, pending = reg.table(reg.active), reg.table(reg.pending if include_pending else [])
    entries = active.unionByName(pending)
    applied = [r["id"] for r in registry.applied(active).orderBy("id").collect()]
    used = [r["id"] for r in pending.where("status = 'pending' and type in ('law_id', 'section_number')").orderBy("id").collect()]
    manifest = publish.Manifest(f"{output}/manifest.json")
    stamp = at or now()
    rule_rows = [*registry.law_id_rules(active.where("status = 'approved'")), *registry.section_rules(active.where("status = 'approved'"))]
    try:
        publish.publish(pipeline.correct(table, entries), f"{output}/published", volumes=[vol], manifest=manifest, run_ts=stamp, force=force, provenance={"corrections_active": applied, "corrections_pending": used, "registry_hash": registry.fingerprint(rule_rows)})
    except publish.FrozenError as e:
        print(e, file=sys.stderr)
        return FROZEN
    runs = F.array_append("applied_in_runs", F.struct(F.lit(vol).cast("int").alias("vol"), F.lit(stamp).alias("run_ts")))
    kept = F.coalesce("applied_in_runs", F.array().cast("array<struct<vol:int,run_ts:string>>"))
    reg.set("active", active.withColumn("applied_in_runs", kept).withColumn("applied_in_runs", F.when(F.col("id").isin(*applied), runs).otherwise(F.col("applied_in_runs"))))
    reg.save()
    if not keep_scratch:
        workspace.cleanup(output, f"candidates_{vol}.json")
    return 0


def republish(spark: SparkSession, source: str, output: str, entry: int, *, dry_run: bool = False, n: int = 600, **more) -> list[int]:
    """Runs the volumes that an entry concerns again, from the markup to publication; which they are."""
    reg = workspace.Registry(spark, output)
    one = reg.table([e for e in reg.active if e["id"] == entry])
    if one.isEmpty():
        raise KeyError(f"no active entry {entry}")
    reports = spark.read.schema("vol int, warnings array<string>, failed array<string>").option("recursiveFileLookup", True).json(f"{output}/reports") if Path(f"{output}/reports").exists() else spark.createDataFrame([], "vol int, warnings array<string>, failed array<string>")
    vols = sorted(r["vol"] for r in registry.volumes_of(one, reports).collect())
    if dry_run:
        return vols
    manifest = publish.Manifest(f"{output}/manifest.json")
    for v in vols:
        publish.unpublish(spark, f"{output}/published", v, manifest)
    pipeline.run_volumes(spark, source, output, vols, force=True, stop_before_publish=True, n=n, **more)
    for v in vols:
        apply_and_publish(spark, output, v, force=True)
    return vols


def refresh_keys(table: DataFrame, dictionary: DataFrame, *, version: str) -> DataFrame:
    """A published table with keys made anew, first among its columns."""
    return workspace.keys_first(enrich.suffix_keys(enrich.unique_keys(table.drop("UniqueKey", "KeyVersion"), dictionary, version=version), key="UniqueKey", order=["OriginalOrder"], scope=["vol"]))


def listing(spark: SparkSession, output: str, status: str | None = None) -> list[str]:
    """A line for each entry."""
    reg = workspace.Registry(spark, output)
    every = reg.table(reg.pending + reg.active + reg.rejected)
    some = every.where(F.col("status") == status) if status else every
    said = F.format_string("#%4d [%s] [%s] vol%s seen %d %s -> %s", "id", "type", "status", F.coalesce(F.col("discovered_in_vol").cast("string"), F.lit("?")), F.coalesce("seen_again_count", F.lit(0).cast("long")), F.to_json("trigger"), F.to_json("correction"))
    return [r["line"] for r in some.orderBy("status", "id").select(said.alias("line")).collect()]


def show(spark: SparkSession, output: str, entry: int) -> dict | None:
    """One entry, with its last runs."""
    reg = workspace.Registry(spark, output)
    got = reg.table([e for e in reg.pending + reg.active + reg.rejected if e["id"] == entry]).withColumn("applied_in_runs", workflow.last_runs(F.col("applied_in_runs"))).first()
    return got.asDict(recursive=True) if got else None


def diff(spark: SparkSession, output: str, entry: int) -> list[tuple]:
    """The rules that approving an entry would add."""
    reg = workspace.Registry(spark, output)
    one = reg.table([e for e in reg.pending if e["id"] == entry])
    return [*registry.law_id_rules(one), *registry.section_rules(one)]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--output", required=True)
    sub = p.add_subparsers(dest="what", required=True)
    make = lambda name, *flags: [c := sub.add_parser(name), [c.add_argument(f, action="store_true") for f in flags]][0]
    make("list").add_argument("--status", choices=("pending", "approved", "rejected"))
    for name in ("show", "diff"):
        make(name).add_argument("id", type=int)
    for name in ("approve", "reject"):
        c = make(name)
        c.add_argument("id", type=int, nargs="+")
        c.add_argument("--reviewer", required=True)
        c.add_argument("--note", default="")
    make("apply", "--include-pending", "--force-republish", "--keep-scratch").add_argument("--volume", type=int, required=True)
    c = make("republish", "--dry-run", "--yes")
    c.add_argument("--entry", type=int, required=True)
    c.add_argument("--input", required=True)
    c = make("prefilter", "--include-private")
    c.add_argument("--volume", type=int, required=True)
    c.add_argument("--input", required=True)
    c = make("record")
    c.add_argument("--volume", type=int, required=True)
    c.add_argument("--response", required=True)
    make("agencies").add_argument("--csv", required=True)
    c = make("seed")
    c.add_argument("--input", required=True)
    c.add_argument("files", nargs="+")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.what == "list":
        print(*listing(spark, a.output, a.status), sep="\n")
    elif a.what == "show":
        got = show(spark, a.output, a.id)
        if got is None:
            return 1
        print(*(f"{k}: {v}" for k, v in got.items()), sep="\n")
    elif a.what == "diff":
        print(*diff(spark, a.output, a.id), sep="\n")
    elif a.what in ("approve", "reject"):
        return 0 if review(spark, a.output, a.id, approve=a.what == "approve", reviewer=a.reviewer, note=a.note) else 1
    elif a.what == "apply":
        return apply_and_publish(spark, a.output, a.volume, include_pending=a.include_pending, force=a.force_republish, keep_scratch=a.keep_scratch)
    elif a.what == "republish":
        try:
            print(republish(spark, a.input, a.output, a.entry, dry_run=a.dry_run or not a.yes))
        except KeyError as e:
            print(e, file=sys.stderr)
            return MISSING
    elif a.what == "prefilter":
        print(candidates(spark, a.input, a.output, a.volume, f"{a.output}/scratch/candidates_{a.volume}.json", public_only=not a.include_private))
    elif a.what == "record":
        if not Path(a.response).exists():
            return 0
        print(record(spark, a.output, a.volume, Path(a.response).read_text(encoding="utf-8")))
    elif a.what == "agencies":
        print(add_agencies(spark, a.output, volumes.read_csv_lookup(spark, a.csv, ["Agency", "Bureau"])))
    elif a.what == "seed":
        print(workspace.bootstrap(a.output, a.input, tuple(a.files)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
