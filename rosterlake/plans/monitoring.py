"""Drift report: one row per run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import drift


def drift_report(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None, report_date: Column,
                 auc: DataFrame | None = None, alert: float = drift.ALERT_SHARE) -> DataFrame:
    """(report_date, status, dataset_drift, drift_share, number_of_drifted_columns, roc_auc, alert).

    ``skipped`` without drift if either side is empty. ``auc`` is a one-row table with ``roc_auc``.
    """
    if reference.isEmpty() or current.isEmpty():
        summary = reference.sparkSession.range(1).select(
            F.lit("skipped").alias("status"), F.lit(False).alias("dataset_drift"), F.lit(0.0).alias("drift_share"),
            F.lit(0).cast("bigint").alias("number_of_drifted_columns"), F.lit(False).alias("alert"))
    else:
        summary = drift.dataset_drift(drift.column_drift(reference, current, columns), alert=alert).select(
            F.lit("ok").alias("status"), "dataset_drift", "drift_share", "number_of_drifted_columns", "alert")
    measured = auc.select(F.col("roc_auc")).scalar() if auc is not None else F.lit(None).cast("double")
    return summary.select(report_date.alias("report_date"), "status", "dataset_drift", "drift_share",
                          "number_of_drifted_columns", measured.alias("roc_auc"), "alert")


def append_report(report: DataFrame, path: str) -> None:
    """Append to the report table, partitioned by date."""
    report.write.mode("append").partitionBy("report_date").parquet(path)
