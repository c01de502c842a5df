"""The lake in versions: a run reads what has changed and shows all its relations at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.config import CURATED_SCHEMA, FARE_KEYS, FARE_SCHEMA, MEAN_SCHEMA, OPERATION_SCHEMA, LakeConfig
from farelake.operators import weighted_mean
from farelake.plans import jobs
from farelake.plans.curate import curate_means
from farelake.sinks import write_curated_csv
from farelake.sinks.snapshots import Run, Snapshot, SnapshotLog, publish_view
from farelake.sources import file_part, month_paths, read_zone

#: Relations of the log, with the columns they are written by.
FARES, MEANS, CURATED = jobs.FARES, jobs.MEANS, jobs.CURATED
PERIOD_SCHEMA = f"{FARE_SCHEMA}, period int"


def versions(spark: SparkSession, cfg: LakeConfig) -> SnapshotLog:
    return SnapshotLog(spark, cfg.processing_path("versions"))


def month_files(spark: SparkSession, cfg: LakeConfig) -> dict[int, dict[str, list[int]]]:
    """Per month of the run, as year * 100 + month, the length and time of each of its files.

    Files are listed, not opened.
    """
    paths = month_paths(cfg.landing, cfg.years, cfg.months, cfg.month_file)
    listed = spark.read.format("binaryFile").load(paths).select(
        (file_part(cfg.month_file, "year") * 100 + file_part(cfg.month_file, "month")).alias("period"),
        "path",
        "length",
        F.unix_micros("modificationTime").alias("time"),
    )
    found = {year * 100 + month: {} for year in cfg.years for month in cfg.months}
    for r in listed.collect():
        found[r.period][r.path] = [r.length, r.time]
    return found


def _changed(run: Run, files: dict[int, dict[str, list[int]]]) -> list[int]:
    before = run.base.notes.get("files", {})
    return sorted(p for p, now in files.items() if before.get(str(p)) != now)


def _read_fares(spark: SparkSession, cfg: LakeConfig, run: Run, periods: list[int]) -> None:
    """Read the files of some months, and let the relation of fares hold exactly their rows there."""
    paths = [
        path
        for p in periods
        for path in month_paths(cfg.landing, [p // 100], [p % 100], cfg.month_file)
    ]
    fares = jobs.read_fares(spark, cfg, paths, period=True)
    run.write(FARES, fares, "period", periods, compact=True)


def refresh(spark: SparkSession, cfg: LakeConfig) -> Snapshot:
    """Bring fares, means and the curated relation up to the files that are there now, in one commit.

    Only month files are read that are new or differ in length or time from
    those the last version was made from; means and curated rows are computed
    for the years these belong to, or for all years of the run if the
    operations or the airports have been written since. Other partitions keep
    their folders. Whoever reads through the log sees the version before until
    the commit, and all of the new one after it; if the run fails, nothing
    changes and what it has written is removed with a later ``expire``.

    Operations and airports come from their zones. The catalogue view and the
    curated files, which follow the commit, can be made again from the log.
    """
    log = versions(spark, cfg)
    run = log.begin()
    files = month_files(spark, cfg)
    periods = _changed(run, files)
    sides = _sides(spark, cfg)
    if periods:
        _read_fares(spark, cfg, run, periods)
        run.note("files", run.base.notes.get("files", {}) | {str(p): files[p] for p in periods})
    same_sides = run.base.notes.get("sides") == sides
    touched = sorted({p // 100 for p in periods}) if same_sides else sorted(cfg.years)
    if not touched:
        return run.base
    run.note("sides", sides)
    run.note("read", periods)

    of_years = [f"period={year * 100 + month}" for year in touched for month in range(1, 13)]
    fares = run.read(FARES, PERIOD_SCHEMA, only=of_years).drop("period")
    run.write(MEANS, weighted_mean(fares, FARE_KEYS), "year", touched)
    means = run.read(MEANS, MEAN_SCHEMA, only=[f"year={y}" for y in touched])
    ops = read_zone(spark, cfg.processing_path(jobs.OPERATIONS), schema=OPERATION_SCHEMA)
    airports = read_zone(spark, cfg.processing_path(jobs.AIRPORTS))
    curated = curate_means(means, ops.where(F.col("year").isin(*touched)), airports)
    run.write(CURATED, curated, "year", touched)
    snapshot = run.commit()
    publish(spark, cfg, snapshot, touched)
    return snapshot


def _sides(spark: SparkSession, cfg: LakeConfig) -> list[list]:
    """Name, length and time of the files that operations and airports consist of."""
    paths = [cfg.processing_path(name) for name in (jobs.OPERATIONS, jobs.AIRPORTS)]
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    rows = listed.select("path", "length", F.unix_micros("modificationTime")).collect()
    return sorted(list(r) for r in rows)


def publish(
    spark: SparkSession, cfg: LakeConfig, snapshot: Snapshot | None = None, years: list[int] | None = None
) -> None:
    """Show a version in the catalogue, under the name of the single table, and as curated files.

    Without a version the latest one; of the files, those of ``years`` only.
    """
    log = versions(spark, cfg)
    snapshot = snapshot or log.latest()
    if "{year}" not in cfg.table and cfg.warehouse_format is None:
        publish_view(log, cfg.table, CURATED, CURATED_SCHEMA, snapshot)
    for year in years if years is not None else cfg.years:
        rows = log.read(CURATED, CURATED_SCHEMA, snapshot, [f"year={year}"])
        write_curated_csv(rows, cfg.curated_path(f"{year}.csv"))


def read(spark: SparkSession, cfg: LakeConfig, relation: str = CURATED) -> DataFrame:
    """A relation of the latest version."""
    schema = {FARES: FARE_SCHEMA, MEANS: MEAN_SCHEMA, CURATED: CURATED_SCHEMA}[relation]
    return versions(spark, cfg).read(relation, schema)
