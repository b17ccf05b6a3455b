"""Tables that runs change together: buckets, copy on write, one commit.

On plain parquet there is no MERGE, no overwrite in place, and no commit over
several tables.  A ``Store`` keeps each table as folders, one for each bucket of
its keys, and a manifest per version that names the folders of all tables.

* A run opens a ``Change``, reads tables (whole, or only the buckets that its rows
  touch), merges or appends, and commits once.  A merge writes new folders for the
  touched buckets only; the folders of the others are named again.
* A version exists when its manifest does.  It is created under a name that must
  not exist, so of two runs that started from one version only one commits.
  Whatever a failed run wrote is named by no manifest.
* After a commit the manifests beyond the last ``keep`` go, with the folders that
  no kept manifest names.

A bucket is a hash of the ``spread`` column (for example the account) and, within
it, one of ``fine`` parts by the other keys: the rows of one account touch ``fine``
buckets, and a hot account is not one bucket.  What reaches the driver is bounded
by the number of buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.state import file_system, merge_by_key

BUCKET = "_bucket"


@dataclass(frozen=True)
class Layout:
    """How a table's rows fall into buckets."""

    spread: str
    fine_by: tuple[str, ...] = ()
    coarse: int = 16
    fine: int = 2
    #: folders of a bucket beyond which an append writes the bucket anew
    most_folders: int = 8

    def bucket(self) -> Column:
        out = F.pmod(F.xxhash64(self.spread), F.lit(self.coarse)) * self.fine
        if self.fine_by:
            out = out + F.pmod(F.xxhash64(*self.fine_by), F.lit(self.fine))
        return out.cast("int")

    def of(self, rows: DataFrame) -> set[int]:
        """All buckets in which rows with these values of ``spread`` can be."""
        coarse = rows.select(F.pmod(F.xxhash64(self.spread), F.lit(self.coarse)).cast("int").alias("c")).distinct()
        return {r["c"] * self.fine + k for r in coarse.collect() for k in range(self.fine)}


@dataclass
class Store:
    spark: SparkSession
    root: str
    layouts: dict[str, Layout]
    keep: int = 2

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/{version:010d}.json"

    def versions(self) -> list[int]:
        fs, folder, _ = file_system(self.spark, f"{self.root}/manifest")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def tables(self, version: int | None = None) -> dict:
        """The manifest of a version (the latest): table -> schema and folders by bucket."""
        if version is None:
            version = (self.versions() or [0])[-1]
        if version == 0:
            return {}
        fs, path, jvm = file_system(self.spark, self._manifest(version))
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def begin(self) -> Change:
        version = (self.versions() or [0])[-1]
        return Change(self, version, self.tables(version))

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        return _read(self.spark, self.root, self.tables(version).get(table))

    def _forget(self) -> None:
        """Drop the manifests beyond the last ``keep`` and the folders that only they name."""
        versions = self.versions()
        old, kept = versions[: -self.keep], versions[-self.keep :]
        if not old:
            return
        named = {f for v in kept for f in _folders(self.tables(v))}
        gone = {f for v in old for f in _folders(self.tables(v))} - named
        fs, _, jvm = file_system(self.spark, self.root)
        for folder in sorted(gone):
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}"), True)
        for v in old:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._manifest(v)), False)


def _folders(tables: dict) -> Iterable[str]:
    return (f for t in tables.values() for folders in t["buckets"].values() for f in folders)


def _read(spark: SparkSession, root: str, table: dict | None, buckets: set[int] | None = None) -> DataFrame | None:
    if table is None:
        return None
    schema = StructType.fromJson(table["schema"])
    folders = [f"{root}/{f}" for b, held in table["buckets"].items() if buckets is None or int(b) in buckets for f in held]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


@dataclass
class Change:
    """The tables as a run sees and changes them; nothing is visible to others before ``commit``."""

    store: Store
    base: int
    tables: dict
    #: folders of merged rows, which the merge has written once more with the held ones
    spare: list[str] = field(default_factory=list)

    def read(self, table: str, buckets: set[int] | None = None) -> DataFrame | None:
        return _read(self.store.spark, self.store.root, self.tables.get(table), buckets)

    def rows_of(self, table: str, rows: DataFrame) -> DataFrame | None:
        """The rows of ``table`` with a ``spread`` value that ``rows`` has, read from those buckets only."""
        layout = self.store.layouts[table]
        held = self.read(table, layout.of(rows))
        return None if held is None else held.join(rows.select(layout.spread).distinct(), layout.spread, "left_semi").select(held.columns)

    def _write(self, table: str, rows: DataFrame) -> dict[int, str]:
        """Rows as new folders, one per bucket that has any."""
        folder = f"data/{table}/{uuid.uuid4().hex[:12]}"
        path = f"{self.store.root}/{folder}"
        spread = rows.withColumn(BUCKET, self.store.layouts[table].bucket()).hint("rebalance", BUCKET)
        spread.write.partitionBy(BUCKET).parquet(path)
        fs, place, _ = file_system(self.store.spark, path)
        names = [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()]
        return {int(n.split("=")[1]): f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}

    def _entry(self, table: str, schema: StructType) -> dict:
        held = self.tables.get(table)
        return {"schema": schema.jsonValue(), "buckets": dict(held["buckets"]) if held else {}}

    def append(self, table: str, rows: DataFrame) -> DataFrame:
        """New rows beside the held ones; returns them as written."""
        new, entry = self._write(table, rows), self._entry(table, rows.schema)
        limit = self.store.layouts[table].most_folders
        full = {b for b in new if len(entry["buckets"].get(str(b), ())) >= limit}
        for b, folder in new.items():
            entry["buckets"][str(b)] = [*entry["buckets"].get(str(b), ()), folder]
        self.tables = {**self.tables, table: entry}
        if full:
            whole = self._write(table, self.read(table, full))
            entry["buckets"].update({str(b): [whole[b]] for b in full})
        return _read(self.store.spark, self.store.root, {"schema": entry["schema"], "buckets": {str(b): [f] for b, f in new.items()}})

    def merge(self, table: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Rows take the place of held rows with their keys; returns them as written.

        They are computed once, into folders by bucket, which also tell the touched buckets."""
        new, schema = self._write(table, rows), rows.schema
        entry = self._entry(table, schema)
        fresh = _read(self.store.spark, self.store.root, {"schema": schema.jsonValue(), "buckets": {str(b): [f] for b, f in new.items()}})
        touched = {b for b in new if entry["buckets"].get(str(b))}
        merged = new
        if touched:
            part = {"schema": schema.jsonValue(), "buckets": {str(b): [new[b]] for b in touched}}
            self.spare += [new[b] for b in touched]
            merged = new | self._write(table, merge_by_key(self.read(table, touched), _read(self.store.spark, self.store.root, part), keys))
        entry["buckets"].update({str(b): [f] for b, f in merged.items()})
        self.tables = {**self.tables, table: entry}
        return fresh

    def commit(self) -> int:
        """Make all changes one new version; fails if another run has committed since ``begin``."""
        version = self.base + 1
        fs, path, _ = file_system(self.store.spark, self.store._manifest(version))
        stream = fs.create(path, False)  # must not exist
        try:
            stream.write(bytearray(json.dumps(self.tables).encode()))
        finally:
            stream.close()
        for folder in self.spare:
            fs.delete(file_system(self.store.spark, f"{self.store.root}/{folder}")[1], True)
        self.store._forget()
        return version
