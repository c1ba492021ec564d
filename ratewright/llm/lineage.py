"""Cutting lineage in the folder that every executor shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratewright.sources.io import shared_folder


def cut(df: DataFrame) -> DataFrame:
    """`df.checkpoint()` in the folder that every executor shares."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
