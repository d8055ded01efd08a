"""Global positions over a sort order without a single-partition window.

A window with an ORDER BY and no PARTITION BY moves every row into one task.
Here the frame is range-partitioned by the sort keys (``orderBy``), written
to the shared checkpoint folder so the partition contents are fixed, and each
row's position is its partition's offset (a prefix sum over per-partition
counts: one small row per partition, broadcast) plus its index inside the
partition, which ``monotonically_increasing_id`` already carries in its low
33 bits. One sort, one checkpoint, no per-row window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardspark.session import ensure_checkpoint_dir
from cardspark.sources.store import scratch_table


def global_position(df: DataFrame, order_cols: list, name: str = "pos",
                    start: int = 1) -> DataFrame:
    """Add ``name`` = start + rank of the row in ``order_cols`` order (0-based
    rank, so the first row gets ``start``). Ties are broken arbitrarily; pass a
    unique sort key for a deterministic result."""
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order_cols).checkpoint(eager=True)
    counts = (ordered.groupBy(F.spark_partition_id().alias("_pid"))
                     .agg(F.count(F.lit(1)).alias("_n")))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per non-empty partition: bounded by the partition count.
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0))
                            .cast("long").alias("_off"))
    tagged = (ordered.withColumn("_pid", F.spark_partition_id())
                     .withColumn("_mid", F.monotonically_increasing_id()))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, (F.lit(start).cast("long") + F.col("_off") + local))
                  .drop("_pid", "_mid", "_off"))


# Below this many rows (checked with a count) a single-task window is cheaper
# than the distributed ranking and its size is bounded.
SMALL_ROWS = 200_000


def surrogate_keys(df: DataFrame, bk_cols: list, key: str, start: int = 1,
                   small_rows: int | None = None) -> DataFrame:
    """H2: dense surrogate keys in business-key order, starting at ``start``
    (max existing key + 1 for an incremental load). Equal to
    ``row_number() OVER (ORDER BY bk) + start - 1``.

    A count first: a small dimension (at most ``small_rows`` rows, so one
    task holds a bounded amount) is ranked with a plain window; a large one
    with ``global_position``."""
    if small_rows is None:
        small_rows = SMALL_ROWS
    # written for the size check and the ranking after it
    df = scratch_table(df, "keys")
    if df.count() <= small_rows:
        rank = F.row_number().over(Window.orderBy(*bk_cols))
        out = df.withColumn(key, (F.lit(start - 1).cast("long") + rank).cast("long"))
    else:
        out = global_position(df, bk_cols, key, start)
    return out.select(key, *[c for c in df.columns])
