"""The jobs of a run side by side, each of which is done once however often the run is started."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.config import CURATED_SCHEMA, LakeConfig
from farelake.plans import jobs
from farelake.sources import read_zone

Step = tuple[str, Callable[[], object]]


class Markers:
    """Empty files that say which steps of a run are done; any executor or driver can see them."""

    def __init__(self, spark: SparkSession, folder: str):
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self.folder = folder

    def _file(self, step: str):
        path = self._new(f"{self.folder}/{step}")
        return path.getFileSystem(self._conf), path

    def done(self, step: str) -> bool:
        files, path = self._file(step)
        return files.exists(path)

    def mark(self, step: str) -> None:
        files, path = self._file(step)
        files.create(path, True).close()

    def do(self, step: str, work: Callable[[], object]) -> None:
        """Do a step and mark it, unless that has happened before."""
        if not self.done(step):
            work()
            self.mark(step)


def run(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    """Fares, airports and statistics at the same time, then the curated relation; see ``jobs.run``.

    ``name`` names the run. A branch that fails does not stop the others; when
    they have ended its error is raised, and starting the run again under its
    name does only what is left. The fares of a year are a step of their own. A
    step that was cut off starts anew: it replaces what it writes whole.
    """
    markers = Markers(spark, cfg.processing_path(f"_runs/{name}"))
    fares: list[Step] = [
        (
            f"fares-{year}",
            lambda year=year: jobs.process_fares(spark, replace(cfg, years=(year,), replace="years")),
        )
        for year in cfg.years
    ]
    if cfg.replace == "all":
        # A run that replaces all years first leaves none of others.
        fares.insert(0, ("fares", lambda: jobs.clear_fares(spark, cfg)))
    branches: list[list[Step]] = [
        fares,
        [("airports", lambda: jobs.process_airports(spark, cfg))],
        [("operations", lambda: jobs.process_operations(spark, cfg))],
    ]

    def follow(steps: list[Step]) -> None:
        for step, work in steps:
            markers.do(step, work)

    with ThreadPoolExecutor(len(branches)) as threads:
        ends = [threads.submit(follow, steps) for steps in branches]
    for end in ends:
        end.result()
    markers.do("curated", lambda: jobs.curate_and_publish(spark, cfg))
    curated = read_zone(spark, cfg.processing_path(jobs.CURATED), schema=CURATED_SCHEMA)
    return curated.where(F.col("year").isin(*cfg.years))
