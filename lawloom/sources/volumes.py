"""Sources: volumes of markup, lookups, registries, reports, workbooks."""

from __future__ import annotations

import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.functions import ids
from lawloom.schemas import ENTRY, RAW
from lawloom.sources import markup

LAWS = T.StructType(
    [
        T.StructField("vol", T.IntegerType()),
        T.StructField("xml_index", T.IntegerType()),
        *(T.StructField(n, T.StringType()) for n in ("public_private", "citable_as", "statutes_citation", "sidenote", "congress", "session", "doc_number", "approved_date", "official_title", "doc_title")),
        *(T.StructField(n, T.IntegerType()) for n in ("first_line", "last_line")),
        T.StructField("tag_path", T.StringType()),
        T.StructField("xml", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def volume_files(spark: SparkSession, path: str, volumes: list[int] | None = None) -> DataFrame:
    """vol, path, content, sha256 of the volumes in a folder. Only the wanted files are listed and read."""
    names = "*" if volumes is None else "{" + ",".join(map(str, volumes or ["none"])) + "}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"STATUTE-{names}.xml").load(path)
    files = files.select(ids.volume_of(F.col("path")).alias("vol"), "path", "content").where("vol is not null")
    return files.withColumn("sha256", F.sha2("content", 256))


def _arrow(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _in_batches(rows: Iterator[dict], arrow: pa.Schema, size: int = 2000, chars: int = 1 << 25) -> Iterator[pa.RecordBatch]:
    """Rows of any number of volumes or laws as batches of up to ``size`` rows, fewer where texts are long."""
    held: list[dict] = []
    n = 0
    for r in rows:
        held.append(r)
        n += len(r.get("xml") or r.get("Text") or "")
        if len(held) == size or n >= chars:
            yield pa.RecordBatch.from_pylist(held, arrow)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, arrow)


def read_laws(files: DataFrame) -> DataFrame:
    """A row for each law of each volume; a volume that cannot be read gives one row with the error.

    Volumes are dealt to all tasks first: a table of them can be one small file, while parsing is most of the work.
    """
    arrow = _arrow(LAWS)

    def of(vol: int, content: bytes) -> Iterator[dict]:
        try:
            where = markup.places(content)
            for n, e in markup.laws(content):
                yield {"vol": vol, "xml_index": n, **markup.metadata(e), "first_line": where[n].first_line, "last_line": where[n].last_line, "tag_path": where[n].path, "xml": ET.tostring(e, encoding="unicode")}
        except (ET.ParseError, markup.expat.ExpatError) as x:
            yield {"vol": vol, "error": f"parse_failed: {x}"}

    def run(batches):
        yield from _in_batches((r for b in batches for v, c in zip(b["vol"].to_pylist(), b["content"]) for r in of(v, c.as_py())), arrow)

    return files.select("vol", "content").repartition("vol").mapInArrow(run, LAWS)


def identified(laws: DataFrame) -> DataFrame:
    """Public laws with their derived identifier; a volume ends where an old private law is met."""
    public = laws.where(F.lower(F.trim("public_private")) == "public")
    law_id = ids.derive(*(F.col(c) for c in ("vol", "citable_as", "sidenote", "congress", "doc_number")))
    return public.withColumn("law_id", law_id).where("law_id is not null")


def law_rows(laws: DataFrame, *, strict: bool = False, compat: bool = False, trim: bool = True, number_rules: list[tuple] = ()) -> DataFrame:
    """The sections and divisions of identified laws. A law that fails gives one row with the error."""
    arrow = _arrow(RAW)
    rules = list(number_rules)

    def number(law_id: str, heading: str, text: str) -> str | None:
        for match_id, match_heading, match_text, to in rules:
            if match_id in law_id and match_heading.lower() in heading.lower() and (match_text is None or match_text.lower() in (text or "").lower()):
                return to
        return None

    def of(walker: markup.Walker, r: dict) -> list[dict]:
        own = {"vol": r["vol"], "xml_index": r["xml_index"]}
        try:
            if r["approved_date"] is None:
                raise ValueError("no approvedDate")
            return [x | own for x in walker.law(ET.fromstring(r["xml"]), r["vol"], r["xml_index"], r).rows]
        except (ValueError, ET.ParseError) as x:
            return [own | {"LawIdentifier": r["law_id"], "error": str(x)}]

    def run(batches):
        walker = markup.Walker(strict=strict, compat=compat, trim=trim, number_rules=number if rules else None)
        yield from _in_batches((x for b in batches for r in b.to_pylist() for x in of(walker, r)), arrow)

    columns = ["vol", "xml_index", "law_id", "approved_date", "official_title", "doc_title", "xml"]
    return laws.select(*columns).mapInArrow(run, RAW)


def sequence(laws: DataFrame) -> DataFrame:
    """Laws in document order as the anomaly detector reads them."""
    cited = F.coalesce("citable_as", F.lit(""))
    canonical = ids.normalize(ids.derive(*(F.col(c) for c in ("vol", "citable_as", "sidenote", "congress", "doc_number"))))
    return laws.where("error is null").select("vol", "xml_index", cited.alias("citable_as"), F.coalesce("sidenote", F.lit("")).alias("sidenote"), canonical.alias("canonical_law_id"), ids.number(canonical).alias("law_number"), (F.lower(F.trim("public_private")) == "public").alias("is_public"), F.concat_ws(" Session ", "congress", "session").alias("congress_session"), F.substring("official_title", 1, 300).alias("official_title"), F.col("first_line").alias("sourceline"), F.col("last_line").alias("line_end"), "tag_path", F.substring("xml", 1, 3000).alias("xml_excerpt"))


def read_csv_lookup(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file whose headers match in any letter case; columns it lacks are null."""
    raw = spark.read.option("header", True).csv(path)
    by = {c.strip().lower(): c for c in raw.columns}
    return raw.select(*(F.col(f"`{by[c.lower()]}`").alias(c) if c.lower() in by else F.lit(None).cast("string").alias(c) for c in columns))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a registry file, one row each."""
    schema = T.StructType([T.StructField("schema_version", T.IntegerType()), T.StructField("next_id", T.LongType()), T.StructField("entries", T.ArrayType(ENTRY)), T.StructField("rejected", T.ArrayType(ENTRY))])
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode(F.concat(F.coalesce("entries", F.array()), F.coalesce("rejected", F.array()))).alias("e")).select("e.*")


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Validation reports of a folder; files that are no JSON are left out."""
    lists = [T.StructField(n, T.ArrayType(T.StringType())) for n in ("passed", "failed", "warnings")]
    schema = T.StructType([T.StructField("vol", T.IntegerType()), *lists, T.StructField("status", T.StringType()), T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path).where("_corrupt_record is null").drop("_corrupt_record")


def read_workbook(path: str) -> tuple[list[str], list[list[str | None]]]:
    """Header and rows of a workbook's first sheet, as text, with the standard library alone."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        sheet = ET.fromstring(z.read("xl/worksheets/sheet1.xml"))
    rows = []
    for r in sheet.iterfind(".//m:row", ns):
        row: dict[int, str | None] = {}
        at = 0
        for c in r.iterfind("m:c", ns):
            if name := re.match("[A-Z]+", c.get("r", "")):
                at = 0
                for ch in name[0]:
                    at = at * 26 + ord(ch) - 64
            else:
                at += 1
            value = c.find("m:v", ns)
            inline = "".join(t.text or "" for t in c.iterfind(".//m:t", ns))
            row[at - 1] = shared[int(value.text)] if c.get("t") == "s" else inline if c.get("t") == "inlineStr" else None if value is None else value.text
        rows.append([row.get(i) for i in range(max(row, default=-1) + 1)])
    head = rows[0] if rows else []
    return head, [r + [None] * (len(head) - len(r)) for r in rows[1:]]


def workbook_lookup(spark: SparkSession, path: str) -> DataFrame:
    head, rows = read_workbook(path)
    return spark.createDataFrame([tuple(r) for r in rows], T.StructType([T.StructField(h, T.StringType()) for h in head]))


def load_json(path: str, default):
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return default
