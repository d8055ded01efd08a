"""Mixing sources to target weights along a time-varying curriculum, in
DataFrame functions alone.

Targets. Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ...
and share all words of all sources; a target stops at ``MAX_REPEATS`` times its
source's words, and what is left over goes to the others by weight. That is
water-filling: with sources in order of cap over weight, those below the level
``lambda`` are capped and the others get ``weight * lambda``.

What is taken. Each source's documents stand in a pseudo-random, reproducible
order (by the md5 of the id). Its stream is that order, over and over; the
first ``target`` words of the stream are taken, so all copies but the last are
whole documents, the last is a prefix of words, and a source's taken words are
its target, rounded.

When. At time t of the run (0 to 1) a source is drawn at the rate
``target * (1 + a * (2t - 1))``. ``a`` grows with the weight and averages 0 over
the targets, so heavy sources come late and the total rate stays level. The
integral of the rate is the source's cumulative demand; the time at which it
reaches a copy's place in the stream is that copy's training position, and
copies are range-sorted by position.

Scale. A running sum over a source that holds a third of all rows would be one
task, so documents fall into buckets by their md5: bucket sums are made map-side
first, a window over one row per bucket gives each bucket's start, and the sum
inside a bucket is a window over (source, bucket). One row per source meets in
one task.

Defined results: null text has no words; null source is a source of its own;
documents without words are never taken; repeated rows are taken one by one
(equal rows may swap places). A table without words gives targets of 0. Helper
columns start with ``_mix_``; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardspark.llm.common import words, written

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
RAMP = 0.8  # how far the rate of the lightest and heaviest source may tilt
BUCKET_ROWS = 20_000
LEAST_BUCKETS = 256


def source_targets(sizes: DataFrame) -> DataFrame:
    """From (_mix_src, _mix_null, _mix_total): one row per source with
    _mix_weight, _mix_target (double) and _mix_tilt."""
    named = Window.orderBy("_mix_null", "_mix_src")
    w = sizes.withColumn("_mix_weight", F.element_at(
        F.array(*[F.lit(x) for x in WEIGHTS]),
        (F.pmod(F.row_number().over(named) - 1, F.lit(len(WEIGHTS))) + 1).cast("int")))
    cap = (F.lit(MAX_REPEATS) * F.col("_mix_total")).cast("long")
    w = w.withColumns({"_mix_cap": cap, "_mix_ratio": cap / F.col("_mix_weight")})
    by_ratio = Window.orderBy("_mix_ratio", "_mix_null", "_mix_src")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    w = w.withColumn("_mix_level", (
        F.sum("_mix_total").over(everything) - F.coalesce(F.sum("_mix_cap").over(before), F.lit(0)))
        / F.sum("_mix_weight").over(after))
    # the first source whose cap lies above its level has the highest such level
    w = w.withColumn("_mix_level", F.coalesce(F.max(F.when(
        F.col("_mix_ratio") > F.col("_mix_level"), F.col("_mix_level"))).over(everything), F.lit(0.0)))
    w = w.withColumn("_mix_target", F.least(
        F.col("_mix_cap").cast("double"), F.col("_mix_weight") * F.col("_mix_level")))
    mean = F.coalesce(F.sum(F.col("_mix_target") * F.col("_mix_weight")).over(everything)
                      / F.nullif(F.sum("_mix_target").over(everything), F.lit(0.0)), F.lit(0.0))
    return w.withColumn("_mix_tilt", F.lit(RAMP) * (F.col("_mix_weight") - mean)
                        / F.lit(max(WEIGHTS) - min(WEIGHTS))) \
        .select("_mix_src", "_mix_total", "_mix_target", "_mix_tilt")


def position(x: Column, tilt: Column) -> Column:
    """The time at which the demand ``t + tilt * (t * t - t)`` reaches ``x``."""
    b = 1 - tilt
    return 2 * x / (b + F.sqrt(F.greatest(b * b + 4 * tilt * x, F.lit(0.0))))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """``docs`` with, per row: _mix_size, _mix_total and _mix_target (of its
    source), _mix_tilt, _mix_offset (its place in the source's stream),
    _mix_taken (words taken, repeats counted)."""
    n_buckets = max(LEAST_BUCKETS, docs.select(id_col).count() // BUCKET_ROWS)
    # rows without an id are told apart by their text
    named = F.coalesce(F.col(id_col).cast("string"), F.concat(
        F.lit("text:"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    key = F.substring(F.md5(named.cast("binary")), 1, 16)
    rows = docs.withColumns({
        "_mix_null": F.col(source_col).isNull(),
        "_mix_src": F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")),
        "_mix_size": F.size(words(F.col(text_col))).cast("long"),
        "_mix_key": key,
        "_mix_bucket": F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
                               / 4294967296.0 * n_buckets).cast("int"),
    })
    sums = written(rows.groupBy("_mix_src", "_mix_null", "_mix_bucket")
                   .agg(F.sum("_mix_size").alias("_mix_words")), "mix_buckets")
    totals = sums.groupBy("_mix_src", "_mix_null").agg(F.sum("_mix_words").alias("_mix_total"))
    earlier = (Window.partitionBy("_mix_src").orderBy("_mix_bucket")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = (sums.withColumn("_mix_start", F.coalesce(F.sum("_mix_words").over(earlier), F.lit(0)))
              .select("_mix_src", "_mix_bucket", "_mix_start")
              .join(source_targets(totals), "_mix_src"))
    inside = (Window.partitionBy("_mix_src", "_mix_bucket")
              .orderBy("_mix_key", id_col, "_mix_size").rowsBetween(Window.unboundedPreceding, 0))
    d = rows.join(starts, ["_mix_src", "_mix_bucket"])
    d = d.withColumn("_mix_offset", F.col("_mix_start") + F.sum("_mix_size").over(inside)
                     - F.col("_mix_size"))
    return d.withColumn("_mix_taken", sum(_words_of_copy(r) for r in range(MAX_REPEATS)))


def _words_of_copy(r: int) -> Column:
    goal = F.floor(F.col("_mix_target") + 0.5).cast("long")
    left = goal - F.lit(r) * F.col("_mix_total") - F.col("_mix_offset")
    return F.greatest(F.lit(0).cast("long"), F.least(left, F.col("_mix_size")))


def _position_of_copy(r: int) -> Column:
    place = F.lit(r) * F.col("_mix_total") + F.col("_mix_offset")
    return F.when(_words_of_copy(r) > 0,
                  position(place / F.nullif(F.col("_mix_target"), F.lit(0.0)), F.col("_mix_tilt")))


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken
    and the position of its first copy, range-sorted by position (documents
    that are not taken last, without a position)."""
    slim = docs.select("doc_id", "text", "source")
    d = plan(slim).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_total").alias("source_size"),
        F.col("_mix_target").alias("target"), F.col("_mix_taken").alias("taken"),
        _position_of_copy(0).alias("position"), "_mix_key")
    first = [F.col("position").asc_nulls_last(), F.col("_mix_key"), F.col("doc_id")]
    return d.repartitionByRange(*first).sortWithinPartitions(*first).drop("_mix_key")


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """The mixed corpus: one row per copy taken with the columns of ``docs``
    plus _mix_copy (from 0) and _mix_position, range-sorted by position. The
    text of a copy that is cut short ends after its last taken word."""
    d = plan(docs, id_col, text_col, source_col)
    copies = F.filter(F.array(*[
        F.struct(F.lit(r).alias("copy"), _words_of_copy(r).alias("words"),
                 _position_of_copy(r).alias("position")) for r in range(MAX_REPEATS)]),
        lambda c: c["words"] > 0)
    d = d.withColumn("_mix_c", F.explode(copies)).withColumns({
        "_mix_copy": F.col("_mix_c.copy"), "_mix_position": F.col("_mix_c.position"),
        text_col: F.when(F.col("_mix_c.words") == F.col("_mix_size"), F.col(text_col)).otherwise(
            F.array_join(F.slice(words(F.col(text_col)), F.lit(1),
                                 F.col("_mix_c.words").cast("int")), " ")),
    })
    order = ["_mix_position", "_mix_key", "_mix_copy"]
    return (d.repartitionByRange(*order).sortWithinPartitions(*order)
            .select(*docs.columns, "_mix_copy", "_mix_position"))
