"""Written tables in the shared checkpoint folder.

A table written here is read back as Parquet: columnar, with column pruning
and filter pushdown, and with its lineage cut, so losing an executor later
never recomputes the load. The folder is the one the cluster names in
``spark.checkpoint.dir`` (see ``session.ensure_checkpoint_dir``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cardspark.session import ensure_checkpoint_dir

# Written tables hold every line several times over: zstd takes less disk than the
# default and is read as fast.
CODEC = "zstd"


def table_path(spark: SparkSession, name: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tables/{spark.sparkContext.applicationId}/{name}"


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    spark = df.sparkSession
    path = table_path(spark, name)
    w = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under a new path of the shared folder and read it back: for
    a frame that is counted and then read again. Nothing stays persisted, and
    a lost executor takes no part of it along."""
    path = table_path(df.sparkSession, f"scratch/{uuid.uuid4().hex}/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
