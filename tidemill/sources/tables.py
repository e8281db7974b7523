"""The supplied Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan over all cores when it has fewer input splits than cores.

    A file written as one row group is read by one task however it is split;
    everything up to the first shuffle would then run on one core. On a
    cluster reading many files the input already has enough splits and this
    adds nothing to the plan.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a remote session): leave the plan alone
        return df
    return df.repartition(cores) if splits < cores else df


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet``; column pruning and filters reach the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
