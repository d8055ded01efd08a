"""Slowly changing dimensions: type-2 versioning with type-1 overwrite, and
the as-of lookup of a versioned key.

The merge is one left join of the existing rows with the incoming snapshot
on the business key (a hash shuffle on BK) plus one anti/compare join that
selects the versions to open; new versions get dense keys above the current
maximum from ``operators.keys``. No row is read into the driver except the
current maximum key.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardspark.functions.timeutil import ntz
from cardspark.operators.keys import surrogate_keys
from cardspark.sources.store import scratch_table

HIGH_DATE = dt.datetime(9999, 12, 31)


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def _differs(a: str, b: str) -> Column:
    return ~F.col(a).eqNullSafe(F.col(b))


def scd2_merge(dim: DataFrame, incoming: DataFrame, bk: str, key: str, type1: list[str],
               type2: list[str], as_of: dt.datetime, audit_key: int) -> DataFrame:
    """Merge a snapshot into a type-2 dimension.

    - unchanged type-2 columns: the current row stays current;
    - changed type-2 columns (null-safe): the current row is closed
      (RowIsCurrent 'N', RowEndDate = as_of) and a new version opens at
      as_of with reason 'Changed: <columns>';
    - new business key: a new row with reason 'New';
    - business key missing from the snapshot: left as it is;
    - type-1 columns are overwritten in every version of the key;
    - the unknown member (key -1) is never touched.
    """
    ts = ntz(as_of)
    audit = F.lit(audit_key).cast("int")
    unknown = dim.filter(F.col(key) == -1)
    existing = dim.filter(F.col(key) > 0)
    inc = incoming.select(bk, *type1, *type2)
    n = {c: f"_n_{c}" for c in inc.columns}
    inc_n = inc.select(*[F.col(c).alias(n[c]) for c in inc.columns])

    j = existing.join(inc_n, existing[bk] == inc_n[n[bk]], "left")
    matched = F.col(n[bk]).isNotNull()
    current = F.col("RowIsCurrent") == "Y"
    changed = matched & current & _any([_differs(c, n[c]) for c in type2])
    t1_changed = matched & _any([_differs(c, n[c]) for c in type1])
    cols = []
    for f in existing.schema.fields:
        c = f.name
        if c in type1:
            e = F.when(matched, F.col(n[c])).otherwise(F.col(c))
        elif c == "RowIsCurrent":
            e = F.when(changed, F.lit("N")).otherwise(F.col(c))
        elif c == "RowEndDate":
            e = F.when(changed, ts).otherwise(F.col(c))
        elif c == "UpdateAuditKey":
            e = F.when(changed | t1_changed, audit).otherwise(F.col(c))
        else:
            e = F.col(c)
        cols.append(e.cast(f.dataType).alias(c))
    updated = j.select(*cols)

    cur = existing.filter(current).select(*[F.col(c).alias(f"_c_{c}") for c in [bk, *type2]])
    k = inc.join(cur, inc[bk] == cur[f"_c_{bk}"], "left")
    is_new = F.col(f"_c_{bk}").isNull()
    diffs = [F.when(_differs(c, f"_c_{c}"), F.lit(c)) for c in type2]
    opened = (k.filter(is_new | _any([_differs(c, f"_c_{c}") for c in type2]))
               .withColumn("RowChangeReason",
                           F.when(is_new, F.lit("New"))
                            .otherwise(F.concat(F.lit("Changed: "), F.concat_ws(", ", *diffs)))))
    max_key = existing.agg(F.max(key)).first()[0] or 0
    fresh = opened.select(
        *[F.col(c) for c in existing.columns if c in inc.columns],
        F.lit("Y").alias("RowIsCurrent"), ts.alias("RowStartDate"),
        ntz(HIGH_DATE).alias("RowEndDate"), "RowChangeReason",
        audit.alias("InsertAuditKey"), audit.alias("UpdateAuditKey"))
    keyed = surrogate_keys(fresh, [bk], key, start=max_key + 1)
    keyed = keyed.select(*[F.col(f.name).cast(f.dataType) for f in existing.schema.fields])
    return unknown.unionByName(updated).unionByName(keyed)


def scd2_feed(dim: DataFrame, feed: DataFrame, bk: str, key: str, type1: list[str],
              type2: list[str], audit_key: int, at: str = "EffectiveAt",
              seq: str = "Seq") -> DataFrame:
    """Merge a feed of changes: any number for a key, in any order, late ones too.

    A feed row says what a key's attributes are from ``at`` on; of rows of one
    key and moment the one with the greatest ``seq`` counts. Versions and changes
    of a key are put in order of time as one list, so a late change splits the
    closed interval that it falls into, and a change before the first version
    opens one before it. A change that alters no type-2 column is dropped; one at
    the very start of a version corrects that version in place. Every version
    ends where the next begins, and the last at the high date: intervals of a key
    neither overlap nor leave a gap. Type-1 columns take the values of the key's
    latest feed row in every version. Keys that the feed lacks, and the unknown
    member, stay as they are; existing versions keep their keys."""
    audit = F.lit(audit_key).cast("int")
    high = ntz(HIGH_DATE)
    cols = [*type1, *type2]
    said = (feed.groupBy(bk, F.col(at).alias("_at"))
            .agg(F.max_by(F.struct(*cols), F.col(seq)).alias("_f"), F.max(seq).alias("_seq")))
    latest = said.groupBy(F.col(bk).alias("_bk")).agg(
        F.max_by("_f", F.struct("_at", "_seq")).alias("_t1"))
    known = dim.filter(F.col(key) > 0)
    touched = known.join(latest.select(F.col("_bk").alias(bk)), bk, "left_semi")
    rest = dim.join(latest.select(F.col("_bk").alias(bk)), bk, "left_anti") \
        .unionByName(dim.filter((F.col(key) <= 0)).join(
            latest.select(F.col("_bk").alias(bk)), bk, "left_semi"))
    e = touched.select(F.col(bk).alias("_ebk"), F.col("RowStartDate").alias("_eat"),
                       F.struct(*[F.col(c) for c in dim.columns]).alias("_e"))
    both = e.join(said, (F.col("_ebk") == F.col(bk)) & (F.col("_eat") == F.col("_at")), "full")
    now = F.struct(*[F.when(F.col("_f").isNotNull(), F.col(f"_f.{c}")).otherwise(F.col(f"_e.{c}"))
                     .alias(c) for c in type2])
    listed = both.select(F.coalesce(bk, "_ebk").alias("_bk"), F.coalesce("_at", "_eat").alias("_start"),
                         "_e", "_f", now.alias("_now"))
    by_time = Window.partitionBy("_bk").orderBy("_start")
    listed = listed.withColumns({"_before": F.lag("_now").over(by_time)})
    kept = listed.filter(F.col("_e").isNotNull() | ~F.col("_now").eqNullSafe(F.col("_before")))
    kept = kept.withColumn("_end", F.coalesce(F.lead("_start").over(by_time), high)) \
        .join(latest, "_bk")
    old, first = F.col("_e").isNotNull(), F.col("_before").isNull()
    diffs = F.concat_ws(", ", *[F.when(~F.col(f"_now.{c}").eqNullSafe(F.col(f"_before.{c}")), F.lit(c))
                                for c in type2])
    fixed = old & _any([~F.col(f"_now.{c}").eqNullSafe(F.col(f"_e.{c}")) for c in type2])
    altered = fixed | ~F.col("_end").eqNullSafe(F.col("_e.RowEndDate")) | _any(
        [~F.col(f"_t1.{c}").eqNullSafe(F.col(f"_e.{c}")) for c in type1])
    made = {bk: F.col("_bk"), key: F.col(f"_e.{key}"),
            **{c: F.col(f"_t1.{c}") for c in type1}, **{c: F.col(f"_now.{c}") for c in type2},
            "RowIsCurrent": F.when(F.col("_end") == high, "Y").otherwise("N"),
            "RowStartDate": F.col("_start"), "RowEndDate": F.col("_end"),
            "RowChangeReason": F.when(fixed, "Corrected").when(old, F.col("_e.RowChangeReason"))
            .when(first, "New").otherwise(F.concat(F.lit("Changed: "), diffs)),
            "InsertAuditKey": F.coalesce(F.col("_e.InsertAuditKey"), audit),
            "UpdateAuditKey": F.when(old & ~altered, F.col("_e.UpdateAuditKey")).otherwise(audit)}
    out = kept.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in dim.schema.fields])
    out = scratch_table(out, "scd2_feed")  # read for the old versions and the new
    max_key = known.agg(F.max(key)).first()[0] or 0
    fresh = surrogate_keys(out.filter(F.col(key).isNull()).drop(key), [bk, "RowStartDate"], key,
                           start=max_key + 1)
    fresh = fresh.select(*[F.col(f.name).cast(f.dataType) for f in dim.schema.fields])
    return rest.select(*dim.columns).unionByName(out.filter(F.col(key).isNotNull())).unionByName(fresh)


def scd1_overwrite(dim: DataFrame, incoming: DataFrame, bk: str, key: str, type1: list[str],
                   audit_key: int) -> DataFrame:
    """Overwrite type-1 columns in every version of each key present in
    the snapshot; no new versions."""
    audit = F.lit(audit_key).cast("int")
    inc = incoming.select(bk, *type1)
    n = {c: f"_n_{c}" for c in [bk, *type1]}
    inc_n = inc.select(*[F.col(c).alias(n[c]) for c in inc.columns])
    existing = dim.filter(F.col(key) > 0)
    j = existing.join(inc_n, existing[bk] == inc_n[n[bk]], "left")
    matched = F.col(n[bk]).isNotNull()
    t1_changed = matched & _any([_differs(c, n[c]) for c in type1])
    cols = []
    for f in existing.schema.fields:
        c = f.name
        if c in type1:
            e = F.when(matched, F.col(n[c])).otherwise(F.col(c))
        elif c == "UpdateAuditKey":
            e = F.when(t1_changed, audit).otherwise(F.col(c))
        else:
            e = F.col(c)
        cols.append(e.cast(f.dataType).alias(c))
    return dim.filter(F.col(key) == -1).unionByName(j.select(*cols))


def asof_lookup(facts: DataFrame, fact_bk: str, ts: str, dim: DataFrame, dim_bk: str,
                key: str) -> DataFrame:
    """The version of ``dim`` whose [RowStartDate, RowEndDate) holds the
    fact's time. Facts with no such version get -1.

    Versions and facts are sorted as one table by business key and time, a
    version before the facts of its moment, and every fact takes the last version
    before it. The sort parts a busy key by time, so neither its versions nor its
    facts meet in one task; what a partition carries into the next is its last
    version, one row a partition. Versions of a key must not overlap (see
    ``scd2_merge``): the last one to start is then the only one that can hold."""
    version = F.struct(F.col("RowStartDate").alias("start"), F.col("RowEndDate").alias("end"),
                       F.col(key).cast("long").alias("key"))
    d = dim.filter((F.col(key) > 0) & F.col(dim_bk).isNotNull()).select(
        F.col(dim_bk).alias("_bk"), F.col("RowStartDate").alias("_at"), F.lit(0).alias("_kind"),
        version.alias("_version"))
    names = facts.columns
    f = facts.select(F.col(fact_bk).alias("_bk"), F.col(ts).alias("_at"), F.lit(1).alias("_kind"),
                     F.struct(*[F.col(c) for c in names]).alias("_fact"))
    both = d.unionByName(f, allowMissingColumns=True)
    # facts of one moment are parted by a hash of the row
    order = ["_bk", "_at", "_kind"]
    ordered = scratch_table(both.orderBy(*order, F.xxhash64("_fact"))
                            .withColumn("_pid", F.spark_partition_id()), "asof")
    upto = Window.partitionBy("_pid", "_bk").orderBy("_at", "_kind") \
        .rowsBetween(Window.unboundedPreceding, 0)
    local = ordered.withColumn("_last", F.last("_version", ignorenulls=True).over(upto))
    # per partition: its first key (asks), and its last key with the last version (gives)
    gives = ordered.groupBy("_pid", "_bk").agg(
        F.max("_version").alias("_carried")).groupBy("_pid").agg(
        F.min("_bk").alias("_first"), F.max_by(F.struct("_bk", "_carried"), "_bk").alias("_end"))
    ends = gives.select("_pid", F.col("_end._bk").alias("_bk"), F.col("_end._carried").alias("_carried"),
                        F.lit(1).alias("_gives"))
    asks = gives.select("_pid", F.col("_first").alias("_bk"),
                        F.lit(None).cast(ends.schema["_carried"].dataType).alias("_carried"),
                        F.lit(0).alias("_gives"))
    # two rows a partition
    before = Window.partitionBy("_bk").orderBy("_pid", "_gives").rowsBetween(Window.unboundedPreceding, 0)
    carried = (asks.unionByName(ends)
               .withColumn("_carried", F.last("_carried", ignorenulls=True).over(before))
               .filter("_gives = 0 AND _carried IS NOT NULL AND _bk IS NOT NULL")
               .select("_pid", "_bk", "_carried"))
    found = local.filter("_kind = 1").join(F.broadcast(carried), ["_pid", "_bk"], "left") \
        .withColumn("_last", F.coalesce("_last", "_carried"))
    held = F.when(F.col("_at") < F.col("_last.end"), F.col("_last.key"))
    return found.select("_fact.*", F.coalesce(held, F.lit(-1).cast("long")).alias(key))
