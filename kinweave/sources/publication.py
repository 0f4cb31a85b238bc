"""Publishing the tables of a run as one step.

A run writes every table to folders of its own, which nobody reads yet. Its last act is a manifest that names, for every
table, the folders of which it now consists: those of this run and those of earlier ones that still hold. Readers start from
the manifest, so a run that dies after any write has published nothing, and the date before it still reads as it was. A
repeated date starts from the manifest of the date before and replaces nothing in place.

A table with history has a slot for each closing date, with the versions closed then, and a slot of current versions. A run
writes the current slot anew and adds the versions it has closed; closed slots are never read for the join and never written
again. The current slot is bucketed and sorted by the join key, so the next day's join needs no exchange on its side.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.schemas import OPEN_END
from kinweave.session import shared_folder

#: Slot of a table without history, and of the current versions of one with it.
WHOLE = "whole"
CURRENT = OPEN_END
_NAME = re.compile(r"(\d{4}-\d{2}-\d{2})\.(\d{6})\.json")


@dataclasses.dataclass(frozen=True)
class Manifest:
    """``tables``: for each table, its folders by slot, relative to the root."""

    run_date: dt.date
    sequence: int = 0
    buckets: int = 0
    tables: dict[str, dict[str, list[str]]] = dataclasses.field(default_factory=dict)

    def folders(self, table: str, since: str = "", until: str = "~") -> list[str]:
        return [f for slot, own in sorted(self.tables.get(table, {}).items()) if since <= slot < until for f in own]


@dataclasses.dataclass(frozen=True)
class Versions:
    """A table with history by its slices: ``current()``, and ``closed(since)`` with the versions closed on or after a date, or all."""

    current: Callable[[], DataFrame]
    closed: Callable[[dt.date | None], DataFrame]

    @classmethod
    def of(cls, table: Callable[[], DataFrame]) -> Versions:
        """The slices of a table that is in one piece."""
        def closed(since: dt.date | None) -> DataFrame:
            old = table().filter(~F.coalesce("current_record_indicator", F.lit(False)))
            return old if since is None else old.filter(F.col("valid_to_ts") >= F.lit(since).cast("timestamp_ntz"))

        return cls(lambda: table().filter("current_record_indicator"), closed)


class _Files:
    """The file system that holds a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._of = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._of.listStatus(path)) if self._of.exists(path) else []

    def exists(self, path: str) -> bool:
        return self._of.exists(self._path(path))

    def read(self, path: str) -> str:
        stream = self._of.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> bool:
        """Whole or not at all, and only where nothing is yet."""
        draft = f"{path}.{uuid.uuid4().hex}.draft"
        stream = self._of.create(self._path(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.exists(path) and self._of.rename(self._path(draft), self._path(path)):
            return True
        self._of.delete(self._path(draft), False)
        return False

    def remove(self, path: str) -> None:
        self._of.delete(self._path(path), True)


def _manifests(root: str) -> str:
    return f"{root}/_manifests"


def manifests(spark: SparkSession, root: str) -> list[tuple[dt.date, int]]:
    """Date and sequence number of everything published, in order; of a date the last one holds."""
    names = _Files(spark, root).names(_manifests(root))
    return sorted((dt.date.fromisoformat(m[1]), int(m[2])) for m in map(_NAME.fullmatch, names) if m)


def published(spark: SparkSession, root: str, run_date: dt.date | None = None, before: dt.date | None = None) -> Manifest | None:
    """What is published: for ``run_date``, or last of all, or last ``before`` a date."""
    known = [(d, n) for d, n in manifests(spark, root) if (run_date is None or d == run_date) and (before is None or d < before)]
    if not known:
        return None
    day, number = known[-1]
    content = json.loads(_Files(spark, root).read(f"{_manifests(root)}/{day}.{number:06d}.json"))
    return Manifest(day, number, content["buckets"], content["tables"])


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_folders(spark: SparkSession, root: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return _empty(spark, schema)
    return spark.read.schema(_nullable(schema)).parquet(*[f"{root}/{f}" for f in folders])


def _nullable(schema: T.StructType) -> T.StructType:
    """Files promise nothing about nulls."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def read_versions(spark: SparkSession, root: str, manifest: Manifest | None, table: str, schema: T.StructType, keys: Sequence[str]) -> Versions:
    """The slices of a table with history. The flag is a constant of its slice, so a filter on it costs no reading."""
    def flagged(df: DataFrame, value: bool) -> DataFrame:
        return df.select(*[F.lit(value).alias(n) if n == "current_record_indicator" else F.col(n) for n in schema.names])

    def current() -> DataFrame:
        folders = manifest.folders(table, CURRENT) if manifest else []
        if not folders:
            return _empty(spark, schema)
        return flagged(_bucketed(spark, f"{root}/{folders[0]}", schema, keys, manifest.buckets), True)

    def closed(since: dt.date | None) -> DataFrame:
        folders = manifest.folders(table, since.isoformat() if since else "", CURRENT) if manifest else []
        return flagged(read_folders(spark, root, folders, schema), False)

    return Versions(current, closed)


def _bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """A folder of bucketed files as an external table of the session: only a catalog entry tells Spark of the buckets."""
    name = f"kinweave_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # The plan at hand has all it needs of the entry; the files stay.
    return found


class Attempt:
    """The folders of one run. ``versions`` and ``whole`` write a table once, to where it stays if the run gets to publish."""

    def __init__(self, spark: SparkSession, root: str, run_date: dt.date, previous: Manifest | None, buckets: int):
        self.spark, self.root, self.run_date, self.previous = spark, root.rstrip("/"), run_date, previous
        self.buckets = previous.buckets if previous else buckets
        self.id = f"{run_date}-{uuid.uuid4().hex[:8]}"
        self.tables = {t: {s: list(f) for s, f in slots.items()} for t, slots in (previous.tables if previous else {}).items()}
        self._scratch = f"{shared_folder(spark)}/kinweave/{self.id}"
        self._files = _Files(spark, self.root)

    def scratch(self, name: str, df: DataFrame) -> DataFrame:
        """Cuts lineage with a table in the shared folder, which goes when the run ends."""
        path = f"{self._scratch}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def whole(self, table: str, df: DataFrame, slot: str = WHOLE) -> DataFrame:
        """A table, or a slot of it, that this run replaces."""
        folder = f"state/{table}/{self.id}" + (f"/{slot}" if slot != WHOLE else "")
        df.write.parquet(f"{self.root}/{folder}")
        self.tables.setdefault(table, {})[slot] = [folder]
        return read_folders(self.spark, self.root, [folder], df.schema)

    def by_day(self, table: str, df: DataFrame, day: str) -> None:
        """Adds rows to the slots of their dates. Rows are not shuffled by day, which would give one to a task."""
        folder = f"state/{table}/{self.id}"
        df.withColumn("_slot", F.col(day).cast("string")).hint("rebalance").write.partitionBy("_slot").parquet(f"{self.root}/{folder}")
        for name in self._files.names(f"{self.root}/{folder}"):
            if name.startswith("_slot="):
                self.tables.setdefault(table, {}).setdefault(name.removeprefix("_slot="), []).append(f"{folder}/{name}")

    def versions(self, table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Current versions, in place of those before, and versions closed since then, beside those closed earlier.

        Returns what was written, current and closed.
        """
        folder, schema = f"state/{table}/{self.id}", df.schema
        is_current = F.coalesce("current_record_indicator", F.lit(False))
        closed_on = F.coalesce(F.col("valid_to_ts").cast("date"), F.lit(self.run_date)).cast("string")
        rows = df.withColumn("_slot", F.when(is_current, CURRENT).otherwise(closed_on))
        if not (self.previous and self.previous.folders(table, CURRENT)):
            rows = rows.repartition(self.buckets, *keys)  # Later on the join with the bucketed slot has dealt rows out already.
        name = f"kinweave_{uuid.uuid4().hex}"
        rows.write.partitionBy("_slot").bucketBy(self.buckets, *keys).sortBy(*keys).option("path", f"{self.root}/{folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        slots = self.tables.setdefault(table, {})
        slots.pop(CURRENT, None)
        own = {}
        for part in self._files.names(f"{self.root}/{folder}"):
            if part.startswith("_slot="):
                slot = part.removeprefix("_slot=")
                own[slot] = [f"{folder}/{part}"]
                slots[slot] = slots.get(slot, []) + own[slot]
        written = Manifest(self.run_date, buckets=self.buckets, tables={table: own})
        slices = read_versions(self.spark, self.root, written, table, schema, keys)
        return slices.current().unionByName(slices.closed(None))

    def publish(self) -> Manifest:
        """Makes this run the published state of its date, in one rename."""
        known = manifests(self.spark, self.root)
        number = max((n for _, n in known), default=0) + 1
        content = json.dumps({"buckets": self.buckets, "tables": self.tables}, indent=1, sort_keys=True)
        if not self._files.put(f"{_manifests(self.root)}/{self.run_date}.{number:06d}.json", content):
            raise RuntimeError(f"another run published number {number} meanwhile; run {self.run_date} again")
        return Manifest(self.run_date, number, self.buckets, self.tables)

    def close(self) -> None:
        """Deletes the intermediate tables."""
        self._files.remove(self._scratch)


def unreferenced(spark: SparkSession, root: str, last: int = 30) -> list[str]:
    """Folders of runs that none of the last ``last`` manifests names: leftovers of failed and replaced runs.

    A run under way shows up here as well, so remove nothing while one is.
    """
    files = _Files(spark, root)
    used = set()
    for day, number in manifests(spark, root)[-last:]:
        tables = json.loads(files.read(f"{_manifests(root)}/{day}.{number:06d}.json"))["tables"]
        used |= {"/".join(f.split("/")[:3]) for slots in tables.values() for own in slots.values() for f in own}
    found = [f"state/{t}/{run}" for t in files.names(f"{root}/state") for run in files.names(f"{root}/state/{t}")]
    return [f for f in found if f not in used]


def remove(spark: SparkSession, root: str, folders: Sequence[str]) -> None:
    for folder in folders:
        _Files(spark, root).remove(f"{root}/{folder}")
