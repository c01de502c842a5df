"""Fare and flight-operation lakehouse jobs on PySpark.

Every operator takes DataFrames and returns a DataFrame; only the sinks and
the jobs in :mod:`farelake.plans.jobs` run anything.
"""

from farelake.config import LakeConfig

__all__ = ["LakeConfig"]
