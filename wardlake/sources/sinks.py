"""Report and findings writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_report(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Report rows as CSV part files with a header, written in parallel."""
    if fmt != "csv":
        raise ValueError("reports are written as csv")
    df.write.mode(mode).option("header", True).csv(path)


def classification_report(findings: DataFrame) -> DataFrame:
    """The full result of a job: one row per column and classifier with its score."""
    return findings.select(
        "job_id", "database_name", "schema_name", "table_name", "column_name",
        F.col("classifier_name").alias("classifier"), "score",
    )


def write_classification_report(findings: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Findings as JSON lines in one folder per job.

    Rows are rebalanced by job: adaptive execution splits a large job over as many
    tasks as its bytes ask for, and a small one does not leave a file per task.
    """
    classification_report(findings).hint("rebalance", "job_id").write.mode(mode).partitionBy("job_id").json(path)
