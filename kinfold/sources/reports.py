"""Evaluation reports: grids as CSV, rows as TSV, metrics as JSON, a text summary."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def write_csv(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json(metrics: DataFrame, path: str) -> None:
    """One JSON object per row."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def write_rows(spark: SparkSession, rows: list[dict], path: str) -> None:
    """Metrics of the driver as one JSON object per line, nested ones kept."""
    spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1).write.mode("overwrite").text(path)


def summary(metrics: DataFrame) -> str:
    """The first row as lines "name: value"."""
    row = metrics.first()
    return "\n".join(f"{k}: {v:.6f}" if isinstance(v, float) else f"{k}: {v}" for k, v in row.asDict().items()) if row else ""


def write_summary(spark: SparkSession, metrics: DataFrame, path: str) -> None:
    spark.createDataFrame([(x,) for x in summary(metrics).split("\n")], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    """The first object of a metrics file."""
    row = spark.read.text(path).first()
    return json.loads(row["value"]) if row else {}
