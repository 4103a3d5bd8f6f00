"""Sinks: final rows, role subsets, review tables, run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from twinledger.operators import flatten as X


def write_final(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The 33 columns in order, partitioned by province; only provinces present in ``rows`` are rewritten."""
    out = X.final_columns(rows)
    renamed = X.rename_out(out).withColumn("province", F.col("省份"))
    (renamed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
     .partitionBy("province").format(fmt).save(path))


def export_role(rows: DataFrame, role: str, path: str, names: DataFrame | None = None, fmt: str = "parquet") -> None:
    X.rename_out(X.final_columns(X.role_subset(rows, role, names))).write.mode("overwrite").option("header", True).format(fmt).save(path)


def write_review(review: DataFrame, path: str, fmt: str = "parquet") -> None:
    review.write.mode("overwrite").option("header", True).format(fmt).save(path)


def write_report(summary: DataFrame, path: str) -> bool:
    """Write a run or failure report as JSON; nothing is written when there is nothing to report."""
    if summary.isEmpty():
        return False
    summary.write.mode("overwrite").json(path)
    return True
