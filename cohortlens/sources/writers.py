from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.ranking import top_ranked


def write_table(df: DataFrame, path: str) -> None:
    """Replace the parquet table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace the CSV directory at ``path``; every part carries the header, and text keeps its white space.

    Readers split files at line ends, so text that holds them belongs into a parquet table.
    """
    options = dict(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df.write.mode("overwrite").options(**options).csv(path)


def write_ranked(importance: DataFrame, path: str, k: int) -> None:
    """Store the k most important features, best first, with their rank."""
    write_csv(top_ranked(importance, "mean_abs_shap", "feature", k), path)
