"""Tables that change together: versions of several tables under one path, published by one pointer.

A table's rows are partitioned by a hash of their key. A version is a small file
``_versions/<n>.json`` that lists, for each table and partition, the folders
that hold its rows; folders are never changed. A writer

1. writes the new rows of all tables into folders of its own,
2. writes what stays of the partitions that it touches (the rows of other keys),
3. creates the next version's file, which fails if that version is there.

Until the third step nothing can be seen; a writer that dies before leaves files
that no version names. If another writer was first, only partitions that both
touched are done again on its version, so no writer's rows are lost; a writer
that must not build on another's may say which version it read (``base``).
Readers take the newest version once and see all tables as it lists them.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import StorageError

VERSIONS = "_versions"


class Conflict(StorageError):
    """Another writer published what this one has touched."""


class Files:
    """A few operations on the store under a path, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(path).getFileSystem(self.conf)
        self.local = self.fs.getScheme() == "file"

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        at = self._path(path)
        return [x.getPath().getName() for x in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def text(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """A whole file, or none: false if it is there already. The text is written beside it and then renamed.

        The rename must refuse an existing target, as HDFS does; on a local
        disk, where it doesn't, a hard link is made instead.
        """
        beside = self._path(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(beside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if self.local:
                os.link(beside.toUri().getPath(), self._path(path).toUri().getPath())
                return True
            return not self.fs.exists(self._path(path)) and self.fs.rename(beside, self._path(path))
        except FileExistsError:
            return False
        finally:
            self.fs.delete(beside, False)

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


class VersionedTables:
    """Tables under ``path``; ``keys`` names the key column of each (``doc_id`` by default)."""

    def __init__(self, spark: SparkSession, path: str, keys: Mapping[str, str] | None = None, buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), dict(keys or {}), buckets
        self.files = Files(spark, self.path)

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/{VERSIONS}") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """A version (the newest by default): ``version`` and, by table, ``schema`` and the folders of each part; 0 is empty."""
        version = max(self.versions(), default=0) if version is None else version
        if not version:
            return {"version": 0, "tables": {}}
        return json.loads(self.files.text(f"{self.path}/{VERSIONS}/{version}.json"))

    def _rows(self, table: dict, parts: Sequence[str] | None = None) -> DataFrame:
        folders = [f"{self.path}/{f}" for p, fs in table["parts"].items() if parts is None or p in parts for f in fs]
        schema = StructType.fromJson(table["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        """The rows of a table; none if no version has it."""
        table = self.manifest(version)["tables"].get(name)
        return None if table is None else self._rows(table)

    def _written(self, rows: DataFrame, name: str) -> dict[str, str]:
        """Write rows with a ``part`` into a folder of their own; the folder of each part."""
        folder = f"{name}/{uuid.uuid4().hex}"
        rows.write.partitionBy("part").parquet(f"{self.path}/{folder}")
        return {n.removeprefix("part="): f"{folder}/{n}" for n in self.files.names(f"{self.path}/{folder}") if n.startswith("part=")}

    def publish(self, tables: Mapping[str, DataFrame], replaced: DataFrame | None = None, base: int | None = None, tries: int = 10) -> int:
        """Replace the rows of all keys in ``tables`` at once; the version that holds them.

        Rows of the keys in ``replaced`` (one column) go from all these tables,
        also where they have no new ones. A null key is a key like others. What
        a repeated call writes is the same. With ``base``, the version that the
        caller read, touching a part that changed since is a ``Conflict``.
        """
        new, keyed, schemas = {}, {}, {}
        for name, rows in tables.items():
            key = self.keys.get(name, "doc_id")
            schemas[name] = rows.schema.jsonValue()
            new[name] = self._written(rows.select("*", self._part(key)), name)
            own = self._rows({"schema": schemas[name], "parts": {p: [f] for p, f in new[name].items()}}).select(key)
            gone = own if replaced is None else own.union(replaced.select(F.col(replaced.columns[0]).cast(rows.schema[key].dataType)))
            gone = gone.distinct().select(key, self._part(key))
            # the keys are written, too: they are read for each part and each try
            keyed[name] = (key, self._written(gone, f"{name}/keys"))
        start = self.manifest(base)
        seen, kept = start, {name: {} for name in tables}
        for _ in range(tries):
            for name in tables:
                self._keep(name, *keyed[name], seen, kept[name])
            after = {"version": seen["version"] + 1, "tables": dict(seen["tables"])}
            for name in tables:
                parts = dict(seen["tables"].get(name, {"parts": {}})["parts"])
                for p in keyed[name][1]:
                    folders = [*kept[name][p][1], *([new[name][p]] if p in new[name] else [])]
                    parts = {**parts, p: folders} if folders else {k: v for k, v in parts.items() if k != p}
                after["tables"][name] = {"schema": self._merged(schemas[name], seen["tables"].get(name)), "parts": parts}
            if self._commit(after):
                return after["version"]
            seen = self.manifest()
            if base is not None and any(self._changed(name, p, start, seen) for name in tables for p in keyed[name][1]):
                raise Conflict(f"version {seen['version']} changed what version {base} had")
        raise Conflict(f"other writers were first {tries} times")

    def _part(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int").alias("part")

    @staticmethod
    def _merged(schema: dict, table: dict | None) -> dict:
        """The new columns, and then those that only older rows have."""
        own = {f["name"] for f in schema["fields"]}
        return {**schema, "fields": [{**f, "nullable": True} for f in (*schema["fields"], *(f for f in (table or {"schema": {"fields": []}})["schema"]["fields"] if f["name"] not in own))]}

    @staticmethod
    def _changed(name: str, part: str, a: dict, b: dict) -> bool:
        parts = lambda m: m["tables"].get(name, {"parts": {}})["parts"].get(part)
        return parts(a) != parts(b)

    def _keep(self, name: str, key: str, keyed: dict[str, str], seen: dict, kept: dict) -> None:
        """For each touched part, the folders it had and those of its rows that stay; what hasn't changed since the last try stays as it is."""
        table = seen["tables"].get(name, {"parts": {}})
        todo = [p for p in keyed if p not in kept or kept[p][0] != table["parts"].get(p, [])]
        for p in todo:
            kept[p] = (table["parts"].get(p, []), [])
        if not any(kept[p][0] for p in todo):
            return
        old = self._rows(table, todo)
        gone = self.spark.read.schema(old.select(key).schema).parquet(*[f"{self.path}/{keyed[p]}" for p in todo]).withColumnRenamed(key, "_gone")
        stays = self._written(old.join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti").select("*", self._part(key)), name)
        for p in todo:
            kept[p] = (kept[p][0], [stays[p]] if p in stays else [])

    def _commit(self, manifest: dict) -> bool:
        return self.files.create(f"{self.path}/{VERSIONS}/{manifest['version']}.json", json.dumps(manifest))

    def vacuum(self, keep: int = 10) -> int:
        """Remove the older versions and all folders that none of the last ``keep`` names; how many folders went.

        Nobody may be writing: a writer's folders are named by no version yet.
        """
        versions = self.versions()
        for v in versions[:-keep]:
            self.files.delete(f"{self.path}/{VERSIONS}/{v}.json")
        named = {f.rpartition("/")[0] for v in versions[-keep:] for t in self.manifest(v)["tables"].values() for fs in t["parts"].values() for f in fs}
        gone = 0
        for table in self.files.names(self.path):
            for folder in [] if table.startswith("_") else self.files.names(f"{self.path}/{table}"):
                if f"{table}/{folder}" not in named:
                    self.files.delete(f"{self.path}/{table}/{folder}")
                    gone += 1
        return gone
