"""Tables kept in versions: new partitions are written beside the old ones, and one manifest names what counts.

A run writes the partitions it touches to folders of its own and then publishes a manifest, one small file with a
number, that lists for every table its partitions, their folders and their extent, together with the high-water marks.
Publishing renames the file into place and fails if the number is taken, so a version is seen whole or not at all, two
runs cannot both succeed from the same state, and a run that fails leaves the last version as it was. Partitions that a
run doesn't touch keep their folders: nothing is copied.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlake.operators.change import file_system, path_exists

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Manifest:
    """One version of the store.

    ``tables``: name -> {"schema": JSON, "by": partition columns, "parts": {partition: {"values", "folders", extent}}}.
    """

    version: int = 0
    run_id: str | None = None
    marks: dict[str, str] = field(default_factory=dict)
    tables: dict[str, dict] = field(default_factory=dict)


@dataclass
class Change:
    """What a run does to a table: partitions written, and partitions that end."""

    schema: str
    by: list[str]
    written: dict[str, dict]
    gone: set[str]
    whole: bool


class VersionedStore:
    """Partitioned tables below a folder, published by manifests."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # Manifests

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:012d}.json"

    def versions(self) -> list[int]:
        folder = f"{self.root}/manifests"
        if not path_exists(self.spark, folder):
            return []
        target, system = file_system(self.spark, folder)
        names = [status.getPath().getName() for status in system.listStatus(target)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def current(self, version: int | None = None) -> Manifest:
        """The last version, or an earlier one; an empty manifest before the first run."""
        version = version or max(self.versions(), default=0)
        if not version:
            return Manifest()
        text = self.spark.read.text(self._manifest_path(version), wholetext=True).first()[0]
        return Manifest(**json.loads(text))

    def publish(self, base: Manifest, run_id: str, changes: Mapping[str, Change], marks: Mapping[str, str]) -> Manifest:
        """Make the changes the next version after ``base``; fails if another run has published since."""
        later = self.changed(base, changes)
        later = Manifest(base.version + 1, run_id, {**base.marks, **marks}, later.tables)
        self._put(self._manifest_path(later.version), json.dumps(vars(later)))
        return later

    @staticmethod
    def changed(base: Manifest, changes: Mapping[str, Change]) -> Manifest:
        """The base version with changes that aren't published."""
        tables = dict(base.tables)
        for name, change in changes.items():
            parts = {} if change.whole or name not in tables else dict(tables[name]["parts"])
            parts = {k: p for k, p in parts.items() if k not in change.gone} | change.written
            tables[name] = {"schema": change.schema, "by": change.by, "parts": parts}
        return Manifest(base.version, base.run_id, base.marks, tables)

    def _put(self, path: str, text: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        target, system = file_system(self.spark, path)
        draft, _ = file_system(self.spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.json")
        out = system.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(system.makeQualified(draft), system.makeQualified(target), options)
        except Exception as error:
            system.delete(draft, False)
            raise RuntimeError(f"version {path.rsplit('/', 1)[1]} was published by another run") from error

    # Tables

    def table(self, name: str, parts: Iterable[str] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """A table of a version, or some of its partitions; only their folders are read."""
        entry = (manifest or self.current()).tables[name]
        chosen = entry["parts"] if parts is None else {k: entry["parts"][k] for k in parts if k in entry["parts"]}
        schema = StructType.fromJson(json.loads(entry["schema"]))
        folders = [f"{self.root}/{folder}" for part in chosen.values() for folder in part["folders"]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def extents(self, name: str, manifest: Manifest) -> DataFrame:
        """One row a partition of a table: ``_part``, the partition's values and its extent."""
        entry = manifest.tables[name]
        rows = [json.dumps({"_part": k, **p["values"], **p["extent"]}) for k, p in entry["parts"].items()]
        fields = ", ".join(["_part string", *(f"{c} bigint" for c in entry["by"])])
        names = sorted({e for p in entry["parts"].values() for e in p["extent"]})
        schema = ", ".join([fields, *(f"{n} bigint" for n in names)])
        return self.spark.createDataFrame([(r,) for r in rows], "row string").select(F.from_json("row", schema).alias("r")).select("r.*")

    def write(self, name: str, rows: DataFrame, by: list[str] | None = None, extent: Mapping[str, Column] | None = None,
              replaces: Iterable[str] | None = None) -> Change:
        """Write rows to new folders, one for each partition in them, without publishing.

        ``by`` are whole-number columns; ``extent`` names aggregates kept for each partition, as bigint. The rows take
        the place of the partitions in ``replaces`` (of the whole table if None); those that get no row are gone.
        """
        by = by or []
        folder = f"data/{name}/{uuid.uuid4().hex}"
        path = f"{self.root}/{folder}"
        if not by:
            rows.write.parquet(path)
            written = {"": {"values": {}, "folders": [folder], "extent": {}}}
            return Change(rows.schema.json(), [], written, set(), True)
        marked = rows.hint("rebalance", *by).withColumns({f"_{c}": F.col(c) for c in by})
        marked.write.partitionBy(*[f"_{c}" for c in by]).parquet(path)
        stored = self.spark.read.schema(rows.schema).parquet(path)
        measures = [F.count(F.lit(1)).alias("rows"), *[c.cast("bigint").alias(n) for n, c in (extent or {}).items()]]
        written = {}
        # One row a partition.
        for row in stored.groupBy(*by).agg(*measures).collect():
            values = {c: row[c] for c in by}
            part = "/".join(f"_{c}={NO_VALUE if v is None else v}" for c, v in values.items())
            kept = {n: row[n] for n in ["rows", *(extent or {})]}
            written[part] = {"values": values, "folders": [f"{folder}/{part}"], "extent": kept}
        gone = set(replaces or ()) - set(written)
        return Change(rows.schema.json(), by, written, gone, replaces is None)

    def append(self, name: str, rows: DataFrame, base: Manifest, by: list[str], most_folders: int = 20) -> Change:
        """Add rows to their partitions, without publishing; one that has come to many folders is written anew."""
        change = self.write(name, rows, by, replaces=[])
        if name not in base.tables:
            return change
        old = base.tables[name]["parts"]
        full = [k for k in change.written if k in old and len(old[k]["folders"]) >= most_folders]
        for part, entry in change.written.items():
            if part in old:
                entry["folders"] = [*old[part]["folders"], *entry["folders"]]
                entry["extent"] = {"rows": old[part]["extent"]["rows"] + entry["extent"]["rows"]}
        if full:
            entry = {"schema": change.schema, "by": by, "parts": change.written}
            gathered = self.table(name, full, Manifest(tables={name: entry}))
            change.written |= self.write(name, gathered, by).written
        return change

    def expire(self, keep: int = 2) -> int:
        """Delete all but the last versions, and every folder that none of the kept ones names; returns the folders.

        Only for times when no run is under way: what a run has written is named by no version until it publishes.
        """
        versions = self.versions()
        kept, old = versions[-keep:], versions[:-keep]
        used = {
            folder
            for v in kept
            for table in self.current(v).tables.values()
            for part in table["parts"].values()
            for folder in part["folders"]
        }
        for version in old:
            target, system = file_system(self.spark, self._manifest_path(version))
            system.delete(target, False)
        removed = 0
        for folder in self._data_folders():
            if not any(u == folder or u.startswith(folder + "/") for u in used):
                target, system = file_system(self.spark, f"{self.root}/{folder}")
                system.delete(target, True)
                removed += 1
        return removed

    def _data_folders(self) -> list[str]:
        found = []
        if not path_exists(self.spark, f"{self.root}/data"):
            return found
        target, system = file_system(self.spark, f"{self.root}/data")
        for table in system.listStatus(target):
            for run in system.listStatus(table.getPath()):
                found.append(f"data/{table.getPath().getName()}/{run.getPath().getName()}")
        return found
