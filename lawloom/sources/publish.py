"""Sinks: frozen, partitioned publication with a manifest; reports, side tables and workbooks."""

from __future__ import annotations

import json
import os
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.functions import ids
from lawloom.schemas import FINAL_COLUMNS, PUBLISHED


class FrozenError(RuntimeError):
    """A volume is published already."""


def check_output(path: str, denied: list[str]) -> None:
    """Refuse to write below a protected folder, links followed."""
    real = os.path.realpath(path)
    for d in map(os.path.realpath, denied):
        if real == d or real.startswith(d.rstrip("/") + "/"):
            raise ValueError(f"{path} lies in {d}, which is not to be written")


def final(df: DataFrame) -> DataFrame:
    """The published columns in their order, identifiers in their published form; missing columns are null."""
    selected = F.col("Selection") if "Selection" in df.columns else F.lit(0)
    df = df.withColumn("ReviewStatus", F.when(selected == 1, "Pending").otherwise("N/A"))
    kinds = {f.name: f.dataType for f in PUBLISHED}
    column = lambda n: F.col(n).cast(kinds[n]) if n in df.columns else F.lit(None).cast(kinds[n])
    return df.select("vol", *((ids.published(column(n)) if n == "LawIdentifier" else column(n)).alias(n) for n in FINAL_COLUMNS))


def save_json(path: str, value) -> None:
    """Written beside and then renamed, so a crash leaves the old file."""
    tmp = f"{path}.tmp"
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(tmp, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=1, sort_keys=True)
    os.replace(tmp, path)


class Manifest:
    """State of each volume. Volumes are hundreds; the file is read and written by the driver."""

    def __init__(self, path: str):
        self.path = path
        self.volumes: dict[str, dict] = {}
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                self.volumes = json.load(f)["volumes"]

    def save(self) -> None:
        save_json(self.path, {"volumes": self.volumes})

    def refresh(self, files: DataFrame) -> None:
        """Input hashes of all files; a volume whose input changed after its publication is stale."""
        for r in files.select("vol", "sha256").collect():
            v = self.volumes.setdefault(str(r["vol"]), {"status": "new"})
            if v.get("input_sha256") not in (None, r["sha256"]) and v["status"] == "published":
                v["status"] = "stale"
            v["input_sha256"] = r["sha256"]

    def to_do(self, volumes: list[int], *, force: bool = False) -> list[int]:
        return [v for v in volumes if force or self.volumes.get(str(v), {}).get("status") != "published"]

    def stamp(self, volumes: list[int], run_ts: str) -> None:
        for v in volumes:
            self.update(v, last_run=run_ts)

    def update(self, vol: int, **values) -> None:
        self.volumes.setdefault(str(vol), {}).update(values)

    def clear(self, vol: int) -> None:
        self.volumes.pop(str(vol), None)

    def summary(self) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for v, x in self.volumes.items():
            out.setdefault(x.get("status", "new"), []).append(int(v))
        return {k: sorted(v) for k, v in sorted(out.items())}


def published_volumes(spark: SparkSession, path: str) -> set[int]:
    try:
        return {r["vol"] for r in spark.read.parquet(path).select("vol").distinct().collect()}
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return set()
        raise


def publish(df: DataFrame, path: str, *, volumes: list[int], manifest: Manifest, run_ts: str, force: bool = False, provenance: dict | None = None, denied: list[str] = ()) -> None:
    """Write the volumes' partitions; those that exist are frozen unless forced. The manifest is written last."""
    check_output(path, list(denied))
    spark = df.sparkSession
    if not force and (there := published_volumes(spark, path) & set(volumes)):
        raise FrozenError(f"published already: {sorted(there)}")
    out = final(df.where(F.col("vol").isin(volumes)))
    out.repartition("vol").sortWithinPartitions("vol", "OriginalOrder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("vol").parquet(path)
    for r in spark.read.parquet(path).where(F.col("vol").isin(volumes)).groupBy("vol").agg(F.count("*").alias("n"), F.countDistinct("LawIdentifier").alias("laws")).collect():
        manifest.update(r["vol"], status="published", rows=r["n"], laws=r["laws"], published_at=run_ts, output_sha256=fingerprint(spark, f"{path}/vol={r['vol']}"), **(provenance or {}))
    manifest.save()


def fingerprint(spark: SparkSession, path: str) -> str:
    """A hash of the files below a path, whatever their names."""
    each = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(F.sha2("content", 256).alias("h"))
    return each.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h")).first()["h"]


def unpublish(spark: SparkSession, path: str, vol: int, manifest: Manifest) -> None:
    """Drop a volume's partition and its entry."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/vol={vol}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    manifest.clear(vol)
    manifest.save()


def review_view(df: DataFrame) -> DataFrame:
    """The drawn rows in their order of presentation."""
    return df.where("Selection = 1").orderBy("Order")


def merge_reviews(table: DataFrame, reviews: DataFrame) -> DataFrame:
    """The table with the reviewers' ReviewStatus by UniqueKey, where they gave one; of several the greatest."""
    said = reviews.where("UniqueKey is not null and ReviewStatus is not null").groupBy("UniqueKey").agg(F.max("ReviewStatus").alias("__said"))
    return table.join(said, "UniqueKey", "left").withColumn("ReviewStatus", F.coalesce("__said", "ReviewStatus")).drop("__said")


def write_reports(reports: DataFrame, path: str) -> None:
    reports.write.mode("overwrite").json(path)


def output_columns(df: DataFrame) -> list[str]:
    """The columns of a table as a report sees them: ReviewStatus comes with publication, a run's own columns stay behind."""
    return [*(c for c in df.columns if c not in ("vol", "xml_index", "counter", "error", "ReviewStatus")), "ReviewStatus"]


def filled(df: DataFrame) -> DataFrame:
    """Text columns with '(blank)' for null."""
    return df.fillna("(blank)", subset=[c for c, t in df.dtypes if t == "string"])


def as_text(df: DataFrame) -> DataFrame:
    """List columns as text, parts divided by a bar."""
    return df.withColumns({c: F.array_join(c, "|") for c, t in df.dtypes if t == "array<string>"})


_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006"


def write_workbook(path: str, header: list[str], rows) -> None:
    """One sheet of text cells. Meant for one volume's table, whose size a workbook bounds.

    A cell holds 32,000 characters; a longer text goes on in the same column of further rows, empty but for such texts."""
    def cells(row) -> str:
        return "".join("<c/>" if x is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(x)}</t></is></c>' for x in row)

    def parts(row):
        text = [None if x is None else str(x) for x in row]
        for at in range(0, max((len(x) for x in text if x), default=1), 32000):
            yield [x if x is None or not at and not x else x[at : at + 32000] or None for x in text]

    tmp = f"{path}.tmp"
    with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PKG}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PKG}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PKG}/relationships"><Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            for row in (header, *rows):
                for part in parts(row):
                    f.write(f"<row>{cells(part)}</row>".encode())
            f.write(b"</sheetData></worksheet>")
    os.replace(tmp, path)
