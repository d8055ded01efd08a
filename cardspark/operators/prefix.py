"""H1: running totals over a global sort order, and exact quantiles.

A running sum over the whole table with ``Window.orderBy`` (no partition)
pulls every row into one task. Here:

1. the frame is range-partitioned and sorted (``orderBy``) and written to the
   shared checkpoint folder, so partition contents and order are fixed;
2. per-partition totals are one row per partition; their exclusive prefix
   sum (a window over at most #partitions rows) gives each partition's offset,
   broadcast back;
3. inside each partition the running sum is a window partitioned by the
   stored partition id (each window group is one range partition, so no
   group is larger than a task's share; JVM-side, no Python workers).

Callers aggregate first where they can (e.g. one row per distinct score), so
a value shared by a third of all rows is a single row here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardspark.session import ensure_checkpoint_dir
from cardspark.sources.store import scratch_table

# Inputs up to this many rows (checked with a count) are cumulated in one task.
SMALL_ROWS = 200_000


def running_totals(df: DataFrame, order_cols: list, value_cols: list[str],
                   prefix: str = "cum_", small_rows: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over all rows up to and including this
    row in ``order_cols`` order (ties broken by the sort; pass a unique order
    for a deterministic result). Values are summed as doubles, exact for
    integer counts below 2**53. Inputs of at most ``small_rows`` rows (a
    count proves it) take a plain cumulative window."""
    if small_rows is None:
        small_rows = SMALL_ROWS
    # written for the size check and the pass after it
    df = scratch_table(df, "totals")
    if df.count() <= small_rows:
        # bounded by the count: one ordered task is cheaper than the
        # distributed path for e.g. the distinct hours or scores
        upto = Window.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({f"{prefix}{c}": F.sum(F.col(c).cast("double")).over(upto)
                               for c in value_cols})
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order_cols).withColumn("_pid", F.spark_partition_id()) \
        .checkpoint(eager=True)
    totals = ordered.groupBy("_pid").agg(*[F.sum(F.col(c).cast("double")).alias(f"_t_{c}")
                                           for c in value_cols])
    # one row per partition: bounded by the partition count
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0.0))
                                      .alias(f"_off_{c}") for c in value_cols])
    inside = (Window.partitionBy("_pid").orderBy(*order_cols)
              .rowsBetween(Window.unboundedPreceding, 0))
    local = ordered.withColumns({f"_loc_{c}": F.sum(F.col(c).cast("double")).over(inside)
                                 for c in value_cols})
    out = local.join(F.broadcast(offsets), "_pid")
    for c in value_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_off_{c}") + F.col(f"_loc_{c}"))
    return out.drop("_pid", *[f"_loc_{c}" for c in value_cols],
                    *[f"_off_{c}" for c in value_cols])


# Rank error of the sketches: a share of the rows of 1 / ACCURACY at most. A
# bracket reaches MARGIN beyond its quantile, so the exact one lies inside.
ACCURACY = 1000
MARGIN = 5 / ACCURACY
# Groups of up to this many rows are a single bracket.
WHOLE_ROWS = 10 * ACCURACY


def order_statistics(pairs: DataFrame, probs: list[float]) -> DataFrame:
    """(grp, q_0 ... q_{k-1}, n): per group of ``pairs`` (grp, v), the exact
    linear-interpolated quantiles of v at ``probs``.

    Three passes, none of which sorts all values: a quantile sketch per group
    gives each quantile a narrow bracket; one aggregate counts the rows below it
    and, per distinct value, inside it; and only values inside are put in order.
    An aggregate that finds a quantile outside its bracket is an error, never a
    wrong value."""
    at = {q: i for i, q in enumerate(sorted({min(max(p + side, 0.0), 1.0)
                                             for p in probs for side in (-MARGIN, MARGIN)}))}
    sketch = pairs.groupBy("grp").agg(
        F.percentile_approx("v", list(at), ACCURACY).alias("s"), F.min("v").alias("least"),
        F.max("v").alias("most"), F.count("v").alias("n"))

    def bracket(i: int, p: float):
        h = (F.col("n") - 1) * F.lit(float(p))
        whole = F.col("n") <= WHOLE_ROWS
        low = F.col("least") if p <= MARGIN else F.when(whole, F.col("least")).otherwise(
            F.col("s")[at[p - MARGIN]])
        high = F.col("most") if p >= 1 - MARGIN else F.when(whole, F.col("most")).otherwise(
            F.col("s")[at[p + MARGIN]])
        return F.struct(F.lit(i).alias("i"), low.alias("low"), high.alias("high"),
                        (F.floor(h) + 1).alias("lo_pos"),
                        F.least(F.ceil(h) + 1, F.col("n")).alias("hi_pos"),
                        (h - F.floor(h)).alias("d"))

    # one row per group and quantile, read by the passes that follow
    brackets = scratch_table(sketch.select("grp", "n", F.explode(F.array(
        *[bracket(i, p) for i, p in enumerate(probs)])).alias("b")).select("grp", "n", "b.*"), "brackets")
    inside = F.col("v").between(F.col("low"), F.col("high"))
    counts = scratch_table(
        pairs.join(brackets.select("grp", "i", "low", "high"), "grp")
        .filter(F.col("v") <= F.col("high"))
        .groupBy("grp", "i", F.when(inside, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n")),
        "bracket_counts")
    per = counts.groupBy("grp", "i").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("below"),
        F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("within"))
    values = counts.filter("v IS NOT NULL").select("grp", "i", "v", "n")
    if counts.count() <= SMALL_ROWS:
        upto = Window.partitionBy("grp", "i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        cum = values.withColumn("upto", F.sum("n").over(upto))
    else:
        starts = running_totals(per, ["grp", "i"], ["within"]).select(
            "grp", "i", (F.col("cum_within") - F.col("within")).alias("start"))
        cum = running_totals(values, ["grp", "i", "v"], ["n"]).join(starts, ["grp", "i"]) \
            .withColumn("upto", F.col("cum_n") - F.col("start"))
    j = (cum.select("grp", "i", "v", "upto").join(per, ["grp", "i"])
         .join(brackets.withColumnRenamed("n", "total"), ["grp", "i"])
         .withColumn("pos", F.col("below") + F.col("upto")))
    found = j.groupBy("grp", "i").agg(
        F.min(F.when(F.col("pos") >= F.col("lo_pos"), F.col("v"))).alias("lo"),
        F.min(F.when(F.col("pos") >= F.col("hi_pos"), F.col("v"))).alias("hi"),
        F.first("d").alias("d"), F.first("total").alias("n"),
        F.first((F.col("below") < F.col("lo_pos"))
                & (F.col("hi_pos") <= F.col("below") + F.col("within"))).alias("ok"))
    exact = F.when(F.col("ok"), F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("d")) \
        .otherwise(F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))
    return found.groupBy("grp").agg(*[F.max(F.when(F.col("i") == i, exact)).alias(f"q_{i}")
                                      for i in range(len(probs))], F.first("n").alias("n"))


def exact_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column of ``cols``: (column_name, median), the interpolated
    median with NULLs ignored, as pandas' ``median`` (the middle value, or
    lo + (hi - lo) / 2 of the two middle values). A column without values has no
    row."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("grp"), F.col(c).cast("double").alias("v"))
        for i, c in enumerate(cols)])).alias("p")).select("p.*").filter(F.col("v").isNotNull())
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("grp") + 1)
    return order_statistics(pairs, [0.5]).select(names.alias("column_name"), F.col("q_0").alias("median"))


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """One-row frame with the interpolated median of ``col``."""
    return exact_medians(df, [col]).select("median")


def exact_quantiles(df: DataFrame, value: str, group: str, probs: list[float]) -> DataFrame:
    """Per group: linear-interpolated quantiles (pandas ``quantile``, SQL
    ``quantile_cont``) of ``value`` at each of ``probs``; NULLs ignored.

    Output columns: group, q_0 ... q_{k-1} (in ``probs`` order) and n."""
    pairs = (df.select(F.col(group).alias("grp"), F.col(value).cast("double").alias("v"))
             .filter(F.col("v").isNotNull()))
    return order_statistics(pairs, probs).withColumnRenamed("grp", group)
