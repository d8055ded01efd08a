"""Card velocity — transactions per card in sliding one-hour windows every
five minutes, on a stream with late rows dropped by a watermark, and in batch.

Rows are counted once, per card and five-minute pane; windows are then made of
pane counts. In batch a pane goes to the two hours whose windows can hold it and
one aggregate per hour sums all twelve windows that begin there, so no row is
copied per window and the shuffle carries two rows a pane. On a stream the pane
counts, once final, feed a second windowed aggregate; state is kept per (pane,
card) and (window, card) and evicted as the watermark passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.plans.registry import register
from cardspark.session import ensure_checkpoint_dir
from cardspark.sources.tables import TRANSACTIONS_SCHEMA, Sources, raw, spread_parts

PANES = 12  # of a window
PANE_SECONDS = 300
WINDOW = f"{PANES * PANE_SECONDS} seconds"
SLIDE = f"{PANE_SECONDS} seconds"
WATERMARK = "1 hour"


def velocity_windows(txns: DataFrame, time_col: str = "date", parts: int | None = None) -> DataFrame:
    """Count of transactions per card in each sliding window containing them;
    window bounds are wall-clock (timestamp_ntz) like the transaction time. A
    row without a time is in no window. ``parts``: partitions of the panes, and of
    the hours that are summed (twelve sums each); the session's by default."""
    pane = F.floor(F.unix_seconds(F.col(time_col).cast("timestamp")) / PANE_SECONDS)
    times = txns.filter(F.col(time_col).isNotNull()).select("card_id", pane.alias("pane"))
    panes = ((times.repartition(parts, "card_id", "pane") if parts else times)
             .groupBy("card_id", "pane").agg(F.count(F.lit(1)).alias("n")))
    block = F.floor(F.col("pane") / PANES)
    at = F.col("pane") - PANES * F.col("block")
    sums = [F.sum(F.when(at.between(i, i + PANES - 1), F.col("n")).otherwise(0))
            for i in range(PANES)]
    hours = panes.withColumn("block", F.explode(F.array(block, block - 1)))
    blocks = ((hours.repartition(parts, "card_id", "block") if parts else hours)
              .groupBy("card_id", "block").agg(F.array(*sums).alias("sums")))
    windows = blocks.select("card_id", "block", F.posexplode("sums").alias("i", "n_txn")) \
        .filter(F.col("n_txn") > 0)
    start = (PANES * F.col("block") + F.col("i")) * PANE_SECONDS
    return windows.select(F.timestamp_seconds(start).cast("timestamp_ntz").alias("window_start"),
                          F.timestamp_seconds(start + PANES * PANE_SECONDS).cast("timestamp_ntz")
                          .alias("window_end"), "card_id", "n_txn")


def velocity_stream(txns: DataFrame, time_col: str) -> DataFrame:
    """The same on a stream with a watermark on ``time_col``."""
    panes = (txns.groupBy(F.window(time_col, SLIDE).alias("pane"), "card_id")
             .agg(F.count(F.lit(1)).alias("n")))
    windows = (panes.groupBy(F.window(F.window_time("pane"), WINDOW, SLIDE).alias("w"), "card_id")
               .agg(F.sum("n").alias("n_txn")))
    return windows.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("w.end").cast("timestamp_ntz").alias("window_end"), "card_id", "n_txn")


def start_velocity_stream(spark: SparkSession, source_dir: str, sink, name: str = "velocity",
                          watermark: str = WATERMARK, trigger_once: bool = False):
    """Start the streaming job over parquet files arriving in ``source_dir``.

    ``sink(batch_df, batch_id)`` receives each micro-batch of finished
    windows (append mode: a window is emitted once the watermark passes its
    end). State and progress live under the shared checkpoint folder, so a
    restarted driver resumes where it stopped.
    """
    # Watermarks need TIMESTAMP event time; with the session in UTC the cast
    # keeps the wall-clock value of the timestamp_ntz column.
    stream = (spark.readStream.schema(TRANSACTIONS_SCHEMA).parquet(source_dir)
                   .withColumn("event_time", F.col("date").cast("timestamp"))
                   .withWatermark("event_time", watermark))
    agg = velocity_stream(stream, "event_time")
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    writer = (agg.writeStream.outputMode("append").foreachBatch(sink)
                 .option("checkpointLocation", ckpt))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


@register("velocity_windows", """
WITH b AS (SELECT card_id, time_bucket(INTERVAL 5 MINUTE, date) AS bucket FROM transactions),
w AS (SELECT card_id, bucket - i * INTERVAL 5 MINUTE AS window_start
      FROM b, range(12) r(i))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, card_id, COUNT(*) AS n_txn
FROM w GROUP BY window_start, card_id""")
def velocity_windows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    # two rows a transaction at most: twice the partitions of its lines
    parts = 2 * spread_parts(raw(spark, sf_dir, "lineitem"))
    return velocity_windows(Sources(spark, sf_dir).transactions(), parts=parts)
