"""Several tables that readers see change together.

A publication writes its tables under a new version's folder and then moves one pointer
file into place.  The pointer names the folder of every table, so a table that was not
written anew is carried on from an earlier version.  Readers resolve the newest pointer
once and then read folders that nothing writes to; a failure before the move leaves the
old tables in force.  Folders that no pointer inside the grace names are deleted by
:func:`sweep`.

    folder/pointers/00000007.json      {"tables": {"docs": {"paths": ["versions/00000007-ab12/docs"], "schema": ...}}}
    folder/versions/00000007-ab12/docs/part-...
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another publication came first."""


@dataclass(frozen=True)
class Table:
    """A table to publish: one row for each key (the first of ``order``; all rows without keys), written as ``laid_out`` says."""

    rows: DataFrame
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    laid_out: Callable[[DataFrame], DataFrameWriter] = lambda df: df.write

    def first_of_keys(self) -> DataFrame:
        """Rows of repeated keys after the first are left out, as an insert that ignores known keys would; null equals null."""
        if not self.keys:
            return self.rows
        if not self.order:
            return self.rows.dropDuplicates([*self.keys])
        rest = [c for c in self.rows.columns if c not in self.keys]
        first = self.rows.groupBy(*self.keys).agg(F.min_by(F.struct(*rest), F.struct(*self.order)).alias("_row"))
        return first.select(*self.keys, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(self.rows.columns)


@dataclass(frozen=True)
class Version:
    """What one pointer names; number 0 is the state before any publication."""

    spark: SparkSession
    folder: str
    number: int
    tables: dict[str, dict]
    note: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.read(name, self.tables[name]["paths"])

    def read(self, name: str, paths: list[str]) -> DataFrame:
        """Some of the folders of a table."""
        schema = StructType.fromJson(self.tables[name]["schema"])
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/{p}" for p in paths)) if paths else self.spark.createDataFrame([], schema)


class _Files:
    """The folder in whatever file system it is."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self._fs = self.path("").getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def listed(self, name: str) -> dict[str, float]:
        """Names in a folder with the seconds of their last change."""
        at = self.path(name)
        return {f.getPath().getName(): f.getModificationTime() / 1000 for f in self._fs.listStatus(at)} if self._fs.exists(at) else {}

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, content: str) -> None:
        stream = self._fs.create(self.path(name), False)
        try:
            stream.write(bytearray(content.encode()))
        finally:
            stream.close()

    def move(self, source: str, target: str) -> None:
        """Rename in one step; fails where ``target`` is there."""
        if self._fs.exists(self.path(target)) or not self._fs.rename(self.path(source), self.path(target)):
            raise Conflict(f"{target} is there already")

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


def _pointers(files: _Files) -> dict[int, float]:
    return {int(name[:8]): at for name, at in files.listed("pointers").items() if name.endswith(".json") and name[:8].isdigit()}


def _load(spark: SparkSession, files: _Files, number: int) -> Version:
    held = json.loads(files.read(f"pointers/{number:08d}.json"))
    return Version(spark, files.folder, number, held["tables"], held.get("note", {}))


def current(spark: SparkSession, folder: str) -> Version:
    """The newest version; its tables stay readable for the grace, whatever is published meanwhile."""
    files = _Files(spark, folder)
    found = _pointers(files)
    return _load(spark, files, max(found)) if found else Version(spark, files.folder, 0, {})


def draft(before: Version) -> str:
    """A folder, relative to the publication's, for the tables of the version after ``before``."""
    return f"versions/{before.number + 1:08d}-{uuid.uuid4().hex}"


def point(before: Version, home: str, tables: dict[str, dict], note: dict | None = None) -> Version:
    """Make ``tables`` (paths relative to the folder, and schemas) the version after ``before``; Conflict if there is one."""
    files = _Files(before.spark, before.folder)
    number = before.number + 1
    files.write(f"{home}/pointer.json", json.dumps({"tables": tables, "note": note or {}}))
    if not files.listed("pointers"):
        files._fs.mkdirs(files.path("pointers"))
    files.move(f"{home}/pointer.json", f"pointers/{number:08d}.json")
    return Version(before.spark, before.folder, number, tables, note or {})


def publish(spark: SparkSession, folder: str, tables: dict[str, Table], after: Version | None = None, carry: bool = True) -> Version:
    """Write all ``tables`` and then make them the current version, with (``carry``) the other tables of the version before.

    ``after`` is the version that the caller read from; if another one has been published since, or is published
    meanwhile, nothing changes and Conflict is raised.
    """
    before = current(spark, folder)
    if after is not None and after.number != before.number:
        raise Conflict(f"version {before.number} has been published after {after.number}")
    home, named = draft(before), dict(before.tables) if carry else {}
    for name, table in tables.items():
        rows = table.first_of_keys()
        table.laid_out(rows).parquet(f"{before.folder}/{home}/{name}")
        named[name] = {"paths": [f"{home}/{name}"], "schema": rows.schema.jsonValue()}
    return point(before, home, named)


def sweep(spark: SparkSession, folder: str, grace: float = 3600.0, now: float | None = None) -> list[str]:
    """Delete pointers that have not been the newest for ``grace`` seconds, and table folders that no pointer left names.

    Versions without a pointer that changed within the grace stay, as a publication may be writing them.
    """
    files, now = _Files(spark, folder), time.time() if now is None else now
    found = _pointers(files)
    order = sorted(found)
    old = [n for n, following in zip(order, [*order[1:], None], strict=True) if following is not None and now - found[following] >= grace]
    paths = {n: {p for t in _load(spark, files, n).tables.values() for p in t["paths"]} for n in order}
    named = set().union(*(paths[n] for n in order if n not in old))
    gone = set().union(*(paths[n] for n in old)) - named
    for n in old:
        files.delete(f"pointers/{n:08d}.json")
    for path in gone:
        files.delete(path)
    for version, at in files.listed("versions").items():
        home = f"versions/{version}"
        if not any(p.startswith(f"{home}/") for p in named) and now - max([at, *files.listed(home).values()]) >= grace:
            gone |= {f"{home}/{part}" for part in files.listed(home)}
            files.delete(home)
    return sorted(gone)
