"""Files around a run: settings, lookups, dictionary, registry, tasks and candidates, side tables, older outputs."""

from __future__ import annotations

import configparser
import json
import os
import shutil
import uuid
from dataclasses import dataclass
from pathlib import Path
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.schemas import ENTRY, OLDER, OLDER_KEYED
from lawloom.sources.publish import save_json

#: The registry's two files. Entries that were turned down stay in the second one, under "rejected".
ACTIVE, PENDING = "active_corrections.json", "pending_corrections.json"


def bootstrap(folder: str, source: str, lookups: tuple[str, ...] = ()) -> list[str]:
    """Makes a workspace; lookups are copied from the source once, and what is there already stays."""
    os.makedirs(f"{folder}/scratch", exist_ok=True)
    copied = []
    for name in lookups:
        if os.path.exists(f"{folder}/{name}"):
            continue
        if not os.path.exists(f"{source}/{name}"):
            raise FileNotFoundError(f"{name} is not in {source}")
        shutil.copy2(f"{source}/{name}", f"{folder}/{name}")
        copied.append(name)
    return copied


def cleanup(folder: str, name: str) -> None:
    """Removes a checkpoint of a run, a file or a folder."""
    path = Path(folder, "scratch", name)
    if path.is_dir():
        shutil.rmtree(path)
    elif path.exists():
        path.unlink()


@dataclass
class Settings:
    """Volumes and folders of an INI file."""

    volumes: list[int]
    source: str
    output: str

    @classmethod
    def read(cls, path: str, section: str = "Appropriations") -> Settings:
        """Mode Range has VolumeRange a-b; any other mode has VolumeNumber a,b,c."""
        c = configparser.ConfigParser()
        with open(path, encoding="utf-8") as f:
            c.read_file(f)
        own = c["Dataset"]
        if own["Mode"] == "Range":
            first, last = own["VolumeRange"].split("-")
            volumes = list(range(int(first), int(last) + 1))
        else:
            volumes = [int(x) for x in own["VolumeNumber"].split(",")]
        return cls(volumes, c[section]["datapath"], c[section]["outputdir"])


def index_rows(listing: bytes) -> list[tuple[int, str]]:
    """(volume, last modified) of the volume folders that a bulk-data listing names, highest first, each once."""
    rows = set()
    for f in ET.fromstring(listing).iter("file"):
        name = f.findtext("displayLabel") or ""
        if f.findtext("folder") == "true" and name.isdigit():
            rows.add((int(name), f.findtext("formattedLastModifiedTime") or ""))
    return sorted(rows, reverse=True)


def to_fetch(index: DataFrame, there: DataFrame) -> DataFrame:
    """The volumes of an index (vol) that a folder's files (vol) lack, highest first."""
    return index.join(there.select("vol"), "vol", "left_anti").orderBy(F.desc("vol"))


def empty_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "term string, id long")


def read_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """term, id of the version that the pointer names; nothing before the first one."""
    try:
        with open(f"{folder}/current", encoding="utf-8") as f:
            version = f.read().strip()
    except FileNotFoundError:
        return empty_dictionary(spark)
    return spark.read.schema("term string, id long").parquet(f"{folder}/{version}")


def write_dictionary(dictionary: DataFrame, folder: str) -> None:
    """A new version beside the old ones, then the pointer, in one step; readers of the old version go on."""
    version = f"v-{uuid.uuid4().hex}"
    dictionary.select("term", "id").coalesce(1).write.parquet(f"{folder}/{version}")
    with open(f"{folder}/current.tmp", "w", encoding="utf-8") as f:
        f.write(version)
    os.replace(f"{folder}/current.tmp", f"{folder}/current")


class Registry:
    """The registry's files as two tables. Entries are tens of rows; files are written whole, beside, then renamed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.active, self.pending, self.rejected, self.next_id = [], [], [], 1
        for name in (ACTIVE, PENDING):
            if os.path.exists(f"{folder}/{name}"):
                with open(f"{folder}/{name}", encoding="utf-8") as f:
                    got = json.load(f)
                if name == ACTIVE:
                    self.active = got.get("entries") or []
                else:
                    self.pending, self.rejected = got.get("entries") or [], got.get("rejected") or []
                self.next_id = max(self.next_id, got.get("next_id") or 1, *(e["id"] + 1 for e in (got.get("entries") or []) + (got.get("rejected") or [])), 1)

    def table(self, entries: list[dict]) -> DataFrame:
        flat = lambda v: {k: x if x is None or isinstance(x, str) else json.dumps(x, ensure_ascii=False) for k, x in (v or {}).items()}
        rows = [{f.name: e.get(f.name) for f in ENTRY} | {c: flat(e.get(c)) for c in ("trigger", "correction", "evidence")} for e in entries]
        for r in rows:
            r["confidence"] = None if r["confidence"] is None else float(r["confidence"])
        return self.spark.createDataFrame(rows, ENTRY)

    def set(self, name: str, df: DataFrame) -> None:
        setattr(self, name, [r.asDict(recursive=True) for r in df.orderBy("id").collect()])

    def save(self) -> None:
        ids = [e["id"] for e in self.active + self.pending + self.rejected]
        self.next_id = max([self.next_id, *(i + 1 for i in ids)])
        save_json(f"{self.folder}/{PENDING}", {"schema_version": 1, "next_id": self.next_id, "entries": self.pending, "rejected": self.rejected})
        save_json(f"{self.folder}/{ACTIVE}", {"schema_version": 1, "next_id": self.next_id, "entries": self.active, "rejected": []})


def write_task(folder: str, entries: list[dict], family: str, *, approver: str, at: str) -> str:
    """The task of a batch of entries for a coder, named by the largest id."""
    ids = sorted(e["id"] for e in entries)
    path = f"{folder}/scratch/coder_task_{ids[-1]}.json"
    save_json(path, {"task_id": ids[-1], "entry_ids": ids, "family": family, "queued_at": at, "approver": approver, "registry_entries": sorted(entries, key=lambda e: e["id"])})
    return path


def write_candidates(path: str, *, anomalies: DataFrame, duplicates: DataFrame, excerpts: DataFrame, counts: dict, most: int = 80) -> None:
    """What a reviewer is shown of one volume: at most so many anomalies and groups, and the excerpts of those (xml_index, xml_excerpt)."""
    found = [r.asDict(recursive=True) for r in anomalies.orderBy("xml_index").limit(most).collect()]
    groups = [r.asDict(recursive=True) for r in duplicates.orderBy("UniqueKey").limit(most).collect()]
    wanted = {a.get(k) for a in found for k in ("xml_index", "duplicate_of")} - {None}
    shown = {str(r["xml_index"]): r["xml_excerpt"] for r in excerpts.where(F.col("xml_index").isin(*wanted)).collect()} if wanted else {}
    save_json(path, {**counts, "law_number_anomalies": found, "unique_key_duplicates": groups, "xml_excerpts_by_xml_index": shown})


def older_columns(df: DataFrame, *, keyed: bool = True) -> DataFrame:
    """The columns of the two older forms, in their order."""
    return df.select(*(OLDER_KEYED if keyed else OLDER))


def keys_first(df: DataFrame) -> DataFrame:
    first = [c for c in ("UniqueKey", "KeyVersion") if c in df.columns]
    return df.select(*first, *(c for c in df.columns if c not in first))


def write_older(df: DataFrame, folder: str, *, keyed: bool = True) -> None:
    """One folder a volume, replaced whole."""
    df.select("vol", *(OLDER_KEYED if keyed else OLDER)).repartition("vol").sortWithinPartitions("vol", "OriginalOrder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("vol").parquet(folder)


def appropriation_laws(df: DataFrame) -> DataFrame:
    """The laws with sections, and whether they have divisions too: vol, LawIdentifier, LawTitle, isAppropriation."""
    laws = df.where("EntryType = 'Section'").select("vol", "LawIdentifier", "LawTitle").distinct()
    with_divisions = df.where("EntryType = 'Division'").select("vol", "LawIdentifier", F.lit(True).alias("hit")).distinct()
    return laws.join(with_divisions, ["vol", "LawIdentifier"], "left").select("vol", "LawIdentifier", "LawTitle", F.coalesce("hit", F.lit(False)).alias("isAppropriation"))
