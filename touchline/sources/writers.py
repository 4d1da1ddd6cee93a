"""Sinks: dataset snapshots, state commits and JSON models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_snapshot(datasets: dict[str, DataFrame], path: str) -> None:
    """One Parquet folder per dataset."""
    for name, df in datasets.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def commit_state(df: DataFrame, path: str, version: int) -> None:
    """A state table as a new version; readers take the last one, so a failed write changes nothing."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def change_summary(scope: DataFrame) -> DataFrame:
    """Whether anything changed, and how much of each kind."""
    return scope.groupBy("kind").agg(F.count("*").alias("n")).groupBy().agg(F.coalesce(F.sum("n") > 0, F.lit(False)).alias("changed"), F.map_from_entries(F.collect_list(F.struct("kind", "n"))).alias("counts"))


def translations_json(texts: DataFrame) -> DataFrame:
    """One row: {lang: {key: text}} as JSON."""
    per = texts.groupBy("lang").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "text")))).alias("m"))
    return per.groupBy().agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("lang"), F.to_json("m")))))).alias("json"))


def point_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.filter(F.col(key) == value)
