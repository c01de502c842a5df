"""Versions of a lake's relations, of which one becomes visible at a time.

Rows are written to new folders, which nobody reads yet. A manifest then names
the folder of each partition; it appears by one rename, and readers take the
last one there is. A run that fails before it leaves all as it was, and a
refresh of some partitions leaves the folders of all others as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class CommitConflict(RuntimeError):
    """Another run has committed since this one began."""


@dataclass(frozen=True)
class Snapshot:
    """``folders``: per relation and partition the run that has its rows; None for a partition without rows.

    ``notes`` is whatever the runs want to find again.
    """

    number: int = 0
    folders: Mapping[str, Mapping[str, str | None]] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)


class SnapshotLog:
    """The versions below ``root``: ``data/{run}/{relation}/{column}={value}``, and ``manifests``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self._conf)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        files = self._files()
        return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []

    def numbers(self) -> list[int]:
        """The committed versions, the first one first."""
        names = self._names("manifests")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def snapshot(self, number: int) -> Snapshot:
        path = f"{self.root}/manifests/{number:010d}.json"
        return Snapshot(**json.loads(self.spark.read.text(path, wholetext=True).first().value))

    def latest(self) -> Snapshot:
        """What is visible now; an empty snapshot before the first commit."""
        numbers = self.numbers()
        return self.snapshot(numbers[-1]) if numbers else Snapshot()

    def begin(self) -> Run:
        return Run(self, self.latest())

    def read(
        self,
        relation: str,
        schema: StructType | str,
        snapshot: Snapshot | None = None,
        only: Iterable[str] | None = None,
    ) -> DataFrame:
        """A relation as a snapshot has it, the latest one unless another is given.

        ``only`` names the partitions that are read. There is one scan for each
        run that has rows in it, at most one for each partition.
        """
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        folders = (snapshot or self.latest()).folders.get(relation, {})
        chosen = set(folders) if only is None else set(folders) & set(only)
        by_run: dict[str, list[str]] = {}
        for partition in sorted(chosen):
            if folders[partition] is not None:
                by_run.setdefault(folders[partition], []).append(partition)
        parts = []
        for run, partitions in sorted(by_run.items()):
            base = f"{self.root}/data/{run}/{relation}"
            reader = self.spark.read.schema(schema).option("basePath", base)
            parts.append(reader.parquet(*[f"{base}/{p}" for p in partitions]))
        if not parts:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionAll, parts).select(*schema.fieldNames())

    def expire(self, keep: int = 2) -> list[str]:
        """Remove all but the last ``keep`` versions, and the folders that only they name; returns these.

        Folders of runs that have not committed yet are left alone: their
        number lies beyond the latest one.
        """
        numbers = self.numbers()
        kept, gone = numbers[-keep:], numbers[:-keep]
        if not gone:
            return []
        named = {
            run
            for number in kept
            for runs in self.snapshot(number).folders.values()
            for run in runs.values()
        }
        old = [r for r in self._names("data") if r not in named and int(r[:10]) <= numbers[-1]]
        files = self._files()
        for number in gone:
            files.delete(self._path(f"manifests/{number:010d}.json"), False)
        for run in old:
            files.delete(self._path(f"data/{run}"), True)
        return old

    def _publish(self, snapshot: Snapshot) -> None:
        """Let a manifest appear whole, unless its number is taken."""
        name = f"manifests/{snapshot.number:010d}.json"
        hidden = self._path(f"manifests/.{snapshot.number:010d}-{uuid4().hex}")
        out = self._files().create(hidden, False)
        try:
            out.write(bytearray(json.dumps(vars(snapshot)).encode()))
        finally:
            out.close()
        context = self._hadoop.FileContext.getFileContext(hidden.toUri(), self._conf)
        options = getattr(self._hadoop, "Options$Rename")
        rename = self.spark._sc._gateway.new_array(options, 1)
        rename[0] = options.NONE  # fails if the name is there
        try:
            context.rename(hidden, self._path(name), rename)
        except Exception as error:
            self._files().delete(hidden, False)
            if "FileAlreadyExists" in str(error):
                raise CommitConflict(f"version {snapshot.number} is there already") from error
            raise


class Run:
    """Rows on their way into the next version."""

    def __init__(self, log: SnapshotLog, base: Snapshot):
        self.log, self.base = log, base
        self.name = f"{base.number + 1:010d}-{uuid4().hex}"
        self._folders = {name: dict(parts) for name, parts in base.folders.items()}
        self._notes = dict(base.notes)

    def write(
        self,
        relation: str,
        df: DataFrame,
        by: str,
        values: Iterable[object] | None = None,
        compact: bool = True,
    ) -> None:
        """Write a relation, by the column ``by``.

        ``values`` names the partitions it replaces: each will hold exactly the
        rows of ``df``, none if there are none, and a row of another is an
        error. Without them the relation is replaced whole.
        """
        owned = F.col(by)
        if values is not None:
            values = list(values)
            found = F.coalesce(owned.cast("string"), F.lit("none"))
            stray = F.raise_error(F.concat(F.lit(f"not one of {values}: "), found))
            owned = F.when(owned.isin(*values), owned).otherwise(stray) if values else stray
        df = df.withColumn(by, owned)
        if compact:
            df = df.hint("rebalance", by)
        seen = Observation()
        noted = df.observe(seen, F.collect_set(_folder(by)).alias("parts"), F.count("*").alias("rows"))
        noted.write.partitionBy(by).parquet(f"{self.log.root}/data/{self.name}/{relation}")
        written = {part: self.name for part in seen.get["parts"]}
        if values is None:
            self._folders[relation] = written
        else:
            replaced = {f"{by}={value}": None for value in values}
            self._folders[relation] = self._folders.get(relation, {}) | replaced | written
        self.note(f"rows of {relation}", seen.get["rows"])

    def note(self, name: str, value: object) -> None:
        self._notes[name] = value

    def read(self, relation: str, schema: StructType | str, only: Iterable[str] | None = None) -> DataFrame:
        """A relation as it will be once the run commits."""
        return self.log.read(relation, schema, Snapshot(0, self._folders), only)

    def commit(self) -> Snapshot:
        """Make all that was written visible at once.

        If another run has committed since this one began, nothing changes and
        that is an error: its partitions would be lost.
        """
        snapshot = Snapshot(self.base.number + 1, self._folders, self._notes)
        self.log._publish(snapshot)
        return snapshot


def _folder(by: str) -> Column:
    """The name of a row's partition folder, for numbers and plain words."""
    default = F.lit("__HIVE_DEFAULT_PARTITION__")
    return F.concat(F.lit(f"{by}="), F.coalesce(F.col(by).cast("string"), default))


def publish_view(
    log: SnapshotLog, view: str, relation: str, schema: StructType | str, snapshot: Snapshot | None = None
) -> None:
    """Let a catalogue view show a relation as a snapshot has it, in one statement.

    The statement replaces the view for all partitions at once. The view reads
    folders that stay as they are, so it shows one version until it is replaced
    again, and must be before that version expires.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    folders = (snapshot or log.latest()).folders.get(relation, {})
    by_run: dict[str, list[str]] = {}
    for partition, run in sorted(folders.items()):
        if run is not None:
            by_run.setdefault(run, []).append(partition)
    selects = []
    for run, partitions in sorted(by_run.items()):
        by = partitions[0].split("=", 1)[0]
        # The column a run was written by comes from the folders; the rest stays as the files have it.
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        chosen = ", ".join(f"'{p.split('=', 1)[1]}'" for p in partitions)
        selects.append(
            f"SELECT {columns} FROM parquet.`{log.root}/data/{run}/{relation}` "
            f"WHERE CAST(`{by}` AS STRING) IN ({chosen})"
        )
    if not selects:
        empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        selects = [f"SELECT {empty} WHERE false"]
    log.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {' UNION ALL '.join(selects)}")
