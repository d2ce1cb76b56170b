"""From volumes of markup to published tables: parse, repair, segment, enrich, validate, correct, publish.

All volumes of a run are one set of jobs; a volume's failure is a row, not an exception. The markup is parsed once: laws
and then the enriched table are written to the scratch folder, and every later step starts from there.
"""

from __future__ import annotations

import argparse
import datetime
import sys
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.functions import ids
from lawloom.operators import enrich, passes, registry, rules, segment, validate
from lawloom.sources import publish, volumes, workspace

FAILED = frozenset({"missing_xml", "parse_failed", "enrich_failed", "validate_failed", "publish_failed"})


@dataclass
class Run:
    """What a run leaves: status of each volume, the tables, the reports, the grown dictionary."""

    status: dict[int, str] = field(default_factory=dict)
    table: DataFrame | None = None
    reports: DataFrame | None = None
    dictionary: DataFrame | None = None

    def ready(self) -> list[int]:
        return [v for v, s in self.status.items() if s == "ready_for_publish"]

    def exit_code(self) -> int:
        return 1 if FAILED & set(self.status.values()) else 0


def _at_rest(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of(laws: DataFrame, *, strict: bool = False, compat: bool = False) -> DataFrame:
    """The rows of public laws, after the law-id rules; failures last."""
    public = volumes.identified(laws.where("error is null"))
    ruled = rules.cumulative(F.col("law_id"), F.col("official_title"), rules.LAW_IDS)
    public = public.withColumn("law_id", ruled)
    public = public.withColumn("law_id", F.when(F.col("vol") > 63, ids.repair(F.col("law_id"), F.col("congress"), F.col("doc_number"))).otherwise(F.col("law_id")))
    return volumes.law_rows(public, strict=strict, compat=compat, number_rules=list(rules.SECTION_NUMBERS))


def parse(spark: SparkSession, folder: str, vols: list[int] | None = None, *, strict: bool = False, scratch: str) -> tuple[DataFrame, DataFrame]:
    """Laws, and the rows of public ones with repaired identifiers; both are written to the scratch folder first."""
    laws = _at_rest(volumes.read_laws(volumes.volume_files(spark, folder, vols)), f"{scratch}/laws")
    return laws, _at_rest(rows_of(laws, strict=strict), f"{scratch}/rows")


def segmented(rows: DataFrame, *, n: int = segment.SAMPLE, by_place: bool = False, scratch: str) -> DataFrame:
    """The repaired rows as a segment table with its sample, drawn by hash or, as earlier tables were, by place."""
    table = segment.build(passes.repair(rows.where("error is null")).withColumn("error", F.lit(None).cast("string")))
    if by_place:
        drawn = segment.sample_like_numpy(table, keys=["vol"], order=[F.col("OriginalOrder")], n=n, where=segment.eligible())
        return _at_rest(drawn, f"{scratch}/segmented")
    return _at_rest(segment.sample(table, keys=["vol"], id_column="OriginalOrder", n=n, where=segment.eligible()), f"{scratch}/segmented")


def enriched(table: DataFrame, *, agencies: list[str], dictionary: DataFrame, version: str) -> DataFrame:
    """The segment table with all enrichments and keys made distinct."""
    table = enrich.enrich(table, agencies=agencies, dictionary=dictionary, version=version)
    return enrich.suffix_keys(table, key="UniqueKey", order=["OriginalOrder"], scope=["vol"])


def process(spark: SparkSession, folder: str, vols: list[int], *, agencies: list[str] = (), dictionary: DataFrame | None = None, version: str = "BaseRun", n: int = segment.SAMPLE, scratch: str) -> Run:
    """All steps up to publication, each from what the one before wrote to the scratch folder."""
    run = Run({v: "missing_xml" for v in vols})
    dictionary = workspace.empty_dictionary(spark) if dictionary is None else dictionary
    laws, rows = parse(spark, folder, vols, scratch=scratch)
    errors = laws.where("error is not null").select("vol", "error").unionByName(rows.where("error is not null").select("vol", "error"))
    for r in laws.groupBy("vol").count().collect():
        run.status[r["vol"]] = "ready_for_publish"
    for r in errors.groupBy("vol").agg(F.min("error").alias("error")).collect():
        run.status[r["vol"]] = "parse_failed"
    try:
        table = segmented(rows, n=n, scratch=scratch)
        run.dictionary = _at_rest(enrich.grow_dictionary(dictionary, enrich.headings(table)), f"{scratch}/dictionary")
        run.table = _at_rest(enriched(table, agencies=list(agencies), dictionary=run.dictionary, version=version), f"{scratch}/enriched")
        counts = laws.where("lower(trim(public_private)) = 'public'").groupBy("vol").agg(F.count("*").alias("public_count"))
        columns = publish.output_columns(run.table)
        run.reports = _at_rest(validate.report(validate.measures(run.table, ["vol"]), counts, columns=columns), f"{scratch}/reports")
        found = run.reports.select("vol", "status").collect()
    except Exception as e:
        print(f"enrichment failed: {e}", file=sys.stderr)
        run.status |= dict.fromkeys(run.ready(), "enrich_failed")
        return run
    run.status |= {r["vol"]: "validate_failed" for r in found if r["status"] == "failed" and run.status[r["vol"]] == "ready_for_publish"}
    return run


def correct(table: DataFrame, entries: DataFrame) -> DataFrame:
    """A table after its registry's rules; keys stay, those that now repeat get suffixes."""
    approved, pending = entries.where("status = 'approved'"), entries.where("status = 'pending'")
    law_ids = [*registry.law_id_rules(approved), *registry.law_id_rules(pending)]
    numbers = [*registry.section_rules(approved), *registry.section_rules(pending)]
    return enrich.suffix_keys(rules.apply(table, law_ids=law_ids, section_numbers=numbers), key="UniqueKey", order=["OriginalOrder"], scope=["vol"])


def run_volumes(spark: SparkSession, source: str, output: str, wanted: list[int], *, agencies: list[str] = (), force: bool = False, stop_before_publish: bool = False, keep_scratch: bool = False, stamp: str | None = None, n: int = segment.SAMPLE) -> Run:
    """A whole run: what is published from the same input is skipped; the dictionary is read, grown and written back."""
    stamp = stamp or datetime.datetime.now(datetime.UTC).strftime("%Y%m%d_%H%M%S")
    workspace.bootstrap(output, source)
    manifest = publish.Manifest(f"{output}/manifest.json")
    manifest.refresh(volumes.volume_files(spark, source, wanted))
    todo = manifest.to_do(wanted, force=force)
    if not todo:
        return Run(dict.fromkeys(wanted, "skipped"))
    scratch = f"{output}/scratch/{stamp}"
    run = process(spark, source, todo, agencies=agencies, dictionary=workspace.read_dictionary(spark, f"{output}/dictionary"), version=stamp, n=n, scratch=scratch)
    run.status |= {v: "skipped" for v in wanted if v not in todo}
    if run.reports is not None:
        workspace.write_dictionary(run.dictionary, f"{output}/dictionary")
        publish.write_reports(run.reports, f"{output}/reports/{stamp}")
    ready = run.ready()
    if stop_before_publish and ready:
        run.table.where(F.col("vol").isin(ready)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("vol").parquet(f"{output}/checkpoint")
    elif ready:
        try:
            publish.publish(run.table, f"{output}/published", volumes=ready, manifest=manifest, run_ts=stamp, force=force)
            run.status |= dict.fromkeys(ready, "success")
        except publish.FrozenError as e:
            print(e, file=sys.stderr)
            run.status |= dict.fromkeys(ready, "publish_failed")
    for v in todo:
        if run.status[v] != "success":
            manifest.update(v, status=run.status[v])
    manifest.stamp(todo, stamp)
    manifest.save()
    if not keep_scratch:
        workspace.cleanup(output, stamp)
    return run


def known_agencies(spark: SparkSession, path: str) -> list[str]:
    lookup = volumes.read_csv_lookup(spark, path, ["Agency", "Bureau"])
    return [r["term"] for r in enrich.terms(lookup, ["Agency", "Bureau"]).collect()]


def main(argv: list[str] | None = None) -> int:
    """0: all is well; 1: a volume failed; 2: the volumes asked for make no sense."""
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--volumes", required=True)
    p.add_argument("--agencies", default="")
    for flag in ("--force", "--stop-before-publish", "--keep-scratch", "--dry-run"):
        p.add_argument(flag, action="store_true")
    a = p.parse_args(argv)
    try:
        wanted = ids.parse_volumes(a.volumes)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    spark = SparkSession.builder.getOrCreate()
    if a.dry_run:
        manifest = publish.Manifest(f"{a.output}/manifest.json")
        manifest.refresh(volumes.volume_files(spark, a.input, wanted))
        print(manifest.to_do(wanted, force=a.force))
        return 0
    run = run_volumes(spark, a.input, a.output, wanted, agencies=known_agencies(spark, a.agencies) if a.agencies else [], force=a.force, stop_before_publish=a.stop_before_publish, keep_scratch=a.keep_scratch)
    print(dict(sorted(run.status.items())))
    return run.exit_code()


if __name__ == "__main__":
    raise SystemExit(main())
