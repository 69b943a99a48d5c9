"""Every query of the library by name, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import quality
from .linkage import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "entry"]


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flagship(spark, sf_dir)
