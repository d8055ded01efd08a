"""Warehouse reconciliation: the 40 checks of the reference plus contracts.

Every check compares one measured figure with an expected one. The expected
figures are not hard-coded: by default they come from staging (distinct
business keys, staged row count and amount). All measures are one-row
aggregates (one pass per table; anti-joins for orphans), joined side by side
into one wide row and unpivoted into one row per check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.functions import rules
from cardspark.functions.timeutil import ntz
from cardspark.plans.warehouse import (DIM_BKS, DIM_KEYS, DIM_NAMES, DIM_TABLES, HIGH_DATE,
                                       Warehouse, sized_broadcast, sized_join)

# Fixed values from the reference's DDL: NOT NULL columns and nvarchar widths.
HK_COLS = ["RowIsCurrent", "RowStartDate", "RowEndDate", "RowChangeReason", "InsertAuditKey",
           "UpdateAuditKey"]
NOT_NULL = {
    "date": ["DateKey", "FullDate", "Year", "Quarter", "QuarterName", "MonthNumber", "MonthName",
             "MonthYear", "DayOfMonth", "DayName", "IsWeekend"],
    "customer": ["CustomerKey", "BKCustomerID", "Gender", "CurrentAge", "AgeGroup", "BirthYear",
                 "IncomeBand", "CreditScore", "CreditBand", "NumCreditCards"] + HK_COLS,
    "card": ["CardKey", "BKCardID", "CardBrand", "CardType", "CreditLimitBand", "HasChip",
             "NumCardsIssued"] + HK_COLS,
    "geography": ["GeographyKey", "BKGeoCode", "City", "IsOnline"] + HK_COLS,
    "mcc": ["MccKey", "BKMccID", "MccDescription"] + HK_COLS,
    "transaction_type": ["TransactionTypeKey", "BKTransTypeCode", "EntryMode", "IsSuccess",
                         "ErrorType", "IsOnlineEntry"] + HK_COLS,
}
WIDTHS = {
    "date": {"QuarterName": 10, "MonthName": 12, "MonthYear": 7, "DayName": 10},
    "customer": {"Gender": 10, "AgeGroup": 20, "IncomeBand": 20, "CreditBand": 15,
                 "RowChangeReason": 200},
    "card": {"CardBrand": 20, "CardType": 20, "CreditLimitBand": 15, "RowChangeReason": 200},
    "geography": {"BKGeoCode": 120, "City": 50, "State": 50, "Zip": 10},
    "mcc": {"MccDescription": 100},
    "transaction_type": {"BKTransTypeCode": 120, "EntryMode": 10, "ErrorType": 60},
}

ORDER = ["date", "customer", "card", "geography", "mcc", "transaction_type"]
SCD_DIMS = ["customer", "card", "geography", "mcc", "transaction_type"]
COUNT_ORDER = ["date", "mcc", "geography", "transaction_type", "customer", "card"]


def check_specs() -> list[tuple]:
    """(id, group, name, actual metric, expected metric or int, kind on miss)."""
    specs = []
    n = 0

    def add(group, name, actual, expected, kind="FAIL"):
        nonlocal n
        n += 1
        specs.append((f"V{n:02d}", group, name, actual, expected, kind))

    for d in COUNT_ORDER:
        add("dimension rows", f"{DIM_TABLES[d]} rows", f"n_{d}", f"exp_{d}")
    add("fact totals", "FactTransaction rows", "n_fact", "n_stg_txn")
    add("fact totals", "FactTransaction SUM(Amount)", "sum_fact", "sum_stg")
    add("fact totals", "valid spend", "valid_fact", "valid_stg")
    for d in ORDER:
        add("orphan keys", f"{DIM_KEYS[d]} orphans", f"orphan_{d}", 0)
    for d in ORDER:
        add("unknown member use", f"{DIM_KEYS[d]} = -1", f"funk_{d}", 0, "WARN")
    for d in SCD_DIMS:
        add("duplicate current BK", f"{DIM_TABLES[d]} duplicates", f"dup_{d}", 0)
    for d in ORDER:
        add("unknown member seed", f"{DIM_TABLES[d]}(-1)", f"unk_{d}", 1)
    add("unknown member seed", "DimAudit(-1)", "unk_audit", 1)
    for d in SCD_DIMS:
        add("SCD housekeeping", f"{DIM_TABLES[d]} current with closed end date", f"open_{d}", 0)
    add("audit trail", "non-success runs", "nonsuccess_audit", 0, "WARN")
    add("cross-check", "staging rows = fact rows", "n_fact", "n_stg_txn")
    add("contracts", "NULL in NOT NULL dimension columns", "nulls_all", 0)
    add("contracts", "text longer than its declared width", "wide_all", 0)
    return specs


# ------------------------------------------------------------- Spark side ----
def _one_row(frames: list[DataFrame]) -> DataFrame:
    """Side by side join of one-row aggregates (each a single broadcast row)."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), frames)


def audit_log(wh: Warehouse) -> DataFrame:
    """The audit dimension of one load: the -1 row and one row per step,
    with row counts measured by Spark."""
    stg = wh.stg
    n_stg = reduce(lambda a, b: a.crossJoin(b), [
        df.agg(F.count(F.lit(1)).alias(f"c_{k}")) for k, df in stg.items()])
    n_stg = n_stg.select((F.col("c_users") + F.col("c_cards") + F.col("c_transactions")
                          + F.col("c_mcc_codes")).alias("rows_stg"),
                         F.col("c_transactions").alias("rows_stg_txn"))
    dims = reduce(lambda a, b: a.unionByName(b), [
        wh.dim(d).select(F.col(DIM_KEYS[d]).cast("long").alias("k")) for d in DIM_NAMES])
    n_dims = dims.agg(F.count_if(F.col("k") > 0).alias("rows_dims"))
    n_fact = wh.fact().agg(F.count(F.lit(1)).alias("rows_fact"))
    m = _one_row([n_stg, n_dims, n_fact])
    as_of = ntz(wh.ctx.as_of)
    fact_status = F.when(F.col("rows_fact") == F.col("rows_stg_txn"), "Success") \
        .otherwise("Warning")

    def row(key, name, status, rows, start=as_of, end=as_of, version="1.0", parent=-1):
        return F.struct(F.lit(key).cast("int").alias("AuditKey"),
                        F.lit(parent).cast("int").alias("ParentAuditKey"),
                        F.lit(name).alias("PackageName"), F.lit(version).alias("PackageVersion"),
                        start.alias("ExecutionStartTime"), end.alias("ExecutionEndTime"),
                        (status if not isinstance(status, str) else F.lit(status))
                        .alias("ExecutionStatus"),
                        rows.cast("long").alias("RowsInserted"),
                        F.lit(0).cast("long").alias("RowsUpdated"),
                        F.lit(0).cast("long").alias("RowsDeleted"))

    ctx = wh.ctx
    rows = [
        row(-1, "Unknown", "Unknown", F.lit(0),
            F.lit("1899-12-31 00:00:00").cast("timestamp_ntz"),
            F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"), "Unknown"),
        row(ctx.extract_audit, "extract", "Success", F.col("rows_stg")),
        row(ctx.dims_audit, "load_dimensions", "Success", F.col("rows_dims")),
        row(ctx.fact_audit, "load_fact", fact_status, F.col("rows_fact")),
    ]
    return m.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _calendar_days(ctx):
    """Days that the calendar must hold: those of the staged years, or of the
    calendar given."""
    if ctx.calendar:
        return F.datediff(F.lit(ctx.calendar[1]).cast("date"),
                          F.lit(ctx.calendar[0]).cast("date")).cast("long") + 1
    return F.datediff(F.make_date("_y1", F.lit(12), F.lit(31)),
                      F.make_date("_y0", F.lit(1), F.lit(1))).cast("long") + 1


def verify_metrics(wh: Warehouse) -> DataFrame:
    fact = wh.fact(materialize=True)
    dims = wh.dims()
    st = wh.stg["transactions"]
    frames = []
    high = ntz(HIGH_DATE)

    # fact totals, unknown-member use and valid spend in one pass: the
    # success flag comes from a size-checked broadcast of the type dimension
    tt_ok = sized_broadcast(dims["transaction_type"].select(
        "TransactionTypeKey", F.col("IsSuccess").alias("_ok")), wh.ctx.broadcast_max_rows,
        wh.dim_rows("transaction_type"))
    valid = F.coalesce(F.col("_ok"), F.lit(False)) & (F.col("Amount") > 0)
    frames.append(fact.join(tt_ok, "TransactionTypeKey", "left").agg(
        F.count(F.lit(1)).alias("n_fact"), F.sum("Amount").cast("decimal(38,2)").alias("sum_fact"),
        F.sum(F.when(valid, F.col("Amount"))).cast("decimal(38,2)").alias("valid_fact"),
        *[F.count_if(F.col(DIM_KEYS[d]) == -1).alias(f"funk_{d}") for d in ORDER]))
    # orphan keys of all six dimensions in one pass over the fact: rows per
    # (dimension, key) combined map-side, so the shuffle carries at most one
    # row per key and partition, then the keys absent from their dimension
    fact_keys = fact.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_dim"), F.col(DIM_KEYS[d]).cast("long").alias("_k"))
        for i, d in enumerate(ORDER)])).alias("p")).select("p.*")
    per_key = fact_keys.groupBy("_dim", "_k").agg(F.count(F.lit(1)).alias("_n"))
    dim_keys = reduce(lambda a, b: a.unionByName(b), [
        dims[d].select(F.lit(i).alias("_dim"), F.col(DIM_KEYS[d]).cast("long").alias("_k"))
        for i, d in enumerate(ORDER)]).distinct()
    orphans = per_key.join(sized_join(dim_keys, sum(wh.dim_rows(d) for d in ORDER)),
                           ["_dim", "_k"], "left_anti")
    frames.append(orphans.agg(*[
        F.coalesce(F.sum(F.when(F.col("_dim") == i, F.col("_n"))), F.lit(0)).cast("long")
        .alias(f"orphan_{d}") for i, d in enumerate(ORDER)]))
    for d in ORDER:
        dim, key = dims[d], DIM_KEYS[d]
        aggs = [F.count_if(F.col(key) > 0).alias(f"n_{d}"),
                F.count_if(F.col(key) == -1).alias(f"unk_{d}"),
                reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in NOT_NULL[d]])
                .alias(f"nulls_{d}"),
                reduce(lambda a, b: a + b, [F.count_if(F.length(c) > w)
                                            for c, w in WIDTHS[d].items()]).alias(f"wide_{d}")]
        if d in SCD_DIMS:
            aggs.append(F.count_if((F.col(key) > 0) & (F.col("RowIsCurrent") == "Y")
                                   & (F.col("RowEndDate") != high)).alias(f"open_{d}"))
            frames.append(dim.filter((F.col("RowIsCurrent") == "Y") & (F.col(key) > 0))
                          .groupBy(DIM_BKS[d]).count().filter(F.col("count") > 1)
                          .agg(F.count(F.lit(1)).alias(f"dup_{d}")))
        frames.append(dim.agg(*aggs))
    frames.append(st.agg(
        F.count(F.lit(1)).alias("n_stg_txn"),
        F.sum("amount").cast("decimal(38,2)").alias("sum_stg"),
        F.sum(F.when(rules.valid_spend(), F.col("amount"))).cast("decimal(38,2)")
         .alias("valid_stg"),
        F.min(F.year("date")).alias("_y0"), F.max(F.year("date")).alias("_y1"))
        .withColumn("exp_date", _calendar_days(wh.ctx)).drop("_y0", "_y1"))
    # the staged keys are counted as groups, not beside the sums (which would
    # expand every staged row once per distinct aggregate)
    for name, key in (("geography", rules.geo_code()), ("transaction_type", rules.trans_type_code())):
        frames.append(st.select(key.alias("k")).distinct()
                      .agg(F.count(F.lit(1)).alias(f"exp_{name}")))
    frames.append(wh.stg["users"].agg(F.count_distinct("id").alias("exp_customer")))
    frames.append(wh.stg["cards"].agg(F.count_distinct("id").alias("exp_card")))
    frames.append(wh.stg["mcc_codes"].agg(F.count_distinct("mcc_id").alias("exp_mcc")))
    audit = audit_log(wh)
    frames.append(audit.agg(
        F.count_if(F.col("AuditKey") == -1).alias("unk_audit"),
        F.count_if((F.col("AuditKey") > 0) & ~F.col("ExecutionStatus").isin("Success"))
         .alias("nonsuccess_audit")))
    m = _one_row(frames)
    return m.withColumns({
        "nulls_all": reduce(lambda a, b: a + b, [F.col(f"nulls_{d}") for d in ORDER]),
        "wide_all": reduce(lambda a, b: a + b, [F.col(f"wide_{d}") for d in ORDER])})


def verify_report(wh: Warehouse, expected_values: dict | None = None) -> DataFrame:
    """One row per check, unpivoted from the single wide metrics row with one
    explode (the metrics plan appears once, not once per check).

    ``expected_values`` ({check id: figure}) takes the place of the figures
    measured in staging, e.g. ``{"V07": 1_000_000}`` for known fact rows."""
    given = expected_values or {}
    unknown = set(given) - {c[0] for c in check_specs()}
    if unknown:
        raise ValueError(f"no such checks: {sorted(unknown)}")
    m = verify_metrics(wh)
    checks = []
    for cid, group, name, actual, expected, kind in check_specs():
        expected = given.get(cid, expected)
        exp = (F.col(expected) if isinstance(expected, str) else F.lit(expected)) \
            .cast("decimal(38,2)")
        act = F.col(actual).cast("decimal(38,2)")
        checks.append(F.struct(F.lit(cid).alias("check_id"), F.lit(group).alias("check_group"),
                               F.lit(name).alias("check_name"), act.alias("actual"),
                               exp.alias("expected"),
                               F.when(act == exp, "PASS").otherwise(kind).alias("status")))
    return m.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def verify_summary(report: DataFrame) -> DataFrame:
    """Pass / fail / warn counts and the overall result."""
    return report.agg(F.count_if(F.col("status") == "PASS").alias("n_pass"),
                      F.count_if(F.col("status") == "FAIL").alias("n_fail"),
                      F.count_if(F.col("status") == "WARN").alias("n_warn")).withColumn(
        "result", F.when((F.col("n_fail") == 0) & (F.col("n_warn") == 0), "ALL CHECKS PASSED")
                   .when(F.col("n_fail") == 0, "PASSED with warnings")
                   .otherwise("FAILED"))


def contract_nulls(wh: Warehouse) -> DataFrame:
    """NULLs in columns the DDL declares NOT NULL, per table and column."""
    parts = []
    for d in ORDER:
        cols = NOT_NULL[d]
        agg = wh.dim(d).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(agg.unpivot([], cols, "column_name", "null_count")
                     .select(F.lit(DIM_TABLES[d]).alias("table_name"), "column_name",
                             "null_count"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def contract_widths(wh: Warehouse) -> DataFrame:
    """Longest text per column against its declared nvarchar width
    (one aggregate pass per dimension)."""
    parts = []
    for d in ORDER:
        widths = WIDTHS[d]
        aggs = []
        for c, w in widths.items():
            aggs += [F.max(F.length(c)).cast("int").alias(f"len_{c}"),
                     F.count_if(F.length(c) > w).alias(f"over_{c}")]
        m = wh.dim(d).agg(*aggs)
        rows = [F.struct(F.lit(DIM_TABLES[d]).alias("table_name"), F.lit(c).alias("column_name"),
                         F.lit(w).cast("int").alias("declared_width"),
                         F.col(f"len_{c}").alias("max_length"), F.col(f"over_{c}").alias("n_over"))
                for c, w in widths.items()]
        parts.append(m.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# --------------------------------------------------------------- SQL side ----
SQL_DIM = {"date": "dim_date", "mcc": "dim_mcc", "geography": "dim_geography",
           "transaction_type": "dim_transaction_type", "customer": "dim_customer",
           "card": "dim_card"}


def metrics_sql() -> str:
    cols = ["(SELECT COUNT(*) FROM fact) AS n_fact",
            "(SELECT CAST(SUM(Amount) AS DECIMAL(38,2)) FROM fact) AS sum_fact",
            "(SELECT CAST(SUM(f.Amount) AS DECIMAL(38,2)) FROM fact f JOIN dim_transaction_type d "
            "ON d.TransactionTypeKey = f.TransactionTypeKey WHERE d.IsSuccess AND f.Amount > 0) "
            "AS valid_fact",
            "(SELECT COUNT(*) FROM stg_transactions) AS n_stg_txn",
            "(SELECT CAST(SUM(amount) AS DECIMAL(38,2)) FROM stg_transactions) AS sum_stg",
            "(SELECT CAST(SUM(amount) AS DECIMAL(38,2)) FROM stg_transactions "
            "WHERE errors IS NULL AND amount > 0) AS valid_stg",
            "(SELECT COUNT(*) FROM geo_src) AS exp_geography",
            "(SELECT COUNT(*) FROM tt_src) AS exp_transaction_type",
            "(SELECT COUNT(DISTINCT id) FROM stg_users) AS exp_customer",
            "(SELECT COUNT(DISTINCT id) FROM stg_cards) AS exp_card",
            "(SELECT COUNT(DISTINCT mcc_id) FROM stg_mcc) AS exp_mcc",
            "(SELECT COUNT(*) FROM cal_days) AS exp_date",
            "(SELECT COUNT(*) FROM audit_log WHERE AuditKey = -1) AS unk_audit",
            "(SELECT COUNT(*) FROM audit_log WHERE AuditKey > 0 AND ExecutionStatus NOT IN "
            "('Success')) AS nonsuccess_audit"]
    nulls, wides = [], []
    for d in ORDER:
        t, key = SQL_DIM[d], DIM_KEYS[d]
        cols.append(f"(SELECT COUNT(*) FROM {t} WHERE {key} > 0) AS n_{d}")
        cols.append(f"(SELECT COUNT(*) FROM {t} WHERE {key} = -1) AS unk_{d}")
        cols.append(f"(SELECT COUNT(*) FROM fact WHERE {key} = -1) AS funk_{d}")
        cols.append(f"(SELECT COUNT(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {t} d "
                    f"WHERE d.{key} = f.{key})) AS orphan_{d}")
        nulls += [f"(SELECT COUNT(*) FROM {t} WHERE {c} IS NULL)" for c in NOT_NULL[d]]
        wides += [f"(SELECT COUNT(*) FROM {t} WHERE length({c}) > {w})"
                  for c, w in WIDTHS[d].items()]
        if d in SCD_DIMS:
            cols.append(f"(SELECT COUNT(*) FROM {t} WHERE {key} > 0 AND RowIsCurrent = 'Y' AND "
                        f"RowEndDate <> TIMESTAMP '9999-12-31 00:00:00') AS open_{d}")
            cols.append(f"(SELECT COUNT(*) FROM (SELECT {DIM_BKS[d]} FROM {t} WHERE "
                        f"RowIsCurrent = 'Y' AND {key} > 0 GROUP BY {DIM_BKS[d]} "
                        f"HAVING COUNT(*) > 1) x) AS dup_{d}")
    cols.append("(" + " + ".join(nulls) + ") AS nulls_all")
    cols.append("(" + " + ".join(wides) + ") AS wide_all")
    return "SELECT " + ",\n  ".join(cols)


def audit_log_sql(ctx) -> str:
    t = f"TIMESTAMP '{ctx.as_of:%Y-%m-%d %H:%M:%S}'"
    step = ("SELECT CAST({k} AS INT) AS AuditKey, CAST(-1 AS INT) AS ParentAuditKey, "
            "'{name}' AS PackageName, '1.0' AS PackageVersion, {t} AS ExecutionStartTime, "
            "{t} AS ExecutionEndTime, {status} AS ExecutionStatus, CAST({rows} AS BIGINT) AS "
            "RowsInserted, CAST(0 AS BIGINT) AS RowsUpdated, CAST(0 AS BIGINT) AS RowsDeleted")
    stg_rows = ("(SELECT COUNT(*) FROM stg_users) + (SELECT COUNT(*) FROM stg_cards) + "
                "(SELECT COUNT(*) FROM stg_transactions) + (SELECT COUNT(*) FROM stg_mcc)")
    dim_rows = " + ".join(f"(SELECT COUNT(*) FROM {SQL_DIM[d]} WHERE {DIM_KEYS[d]} > 0)"
                          for d in DIM_NAMES)
    fact_status = ("CASE WHEN (SELECT COUNT(*) FROM fact) = (SELECT COUNT(*) FROM "
                   "stg_transactions) THEN 'Success' ELSE 'Warning' END")
    return "\nUNION ALL\n".join([
        "SELECT CAST(-1 AS INT) AS AuditKey, CAST(-1 AS INT) AS ParentAuditKey, 'Unknown' AS "
        "PackageName, 'Unknown' AS PackageVersion, TIMESTAMP '1899-12-31 00:00:00' AS "
        "ExecutionStartTime, TIMESTAMP '9999-12-31 00:00:00' AS ExecutionEndTime, 'Unknown' AS "
        "ExecutionStatus, CAST(0 AS BIGINT) AS RowsInserted, CAST(0 AS BIGINT) AS RowsUpdated, "
        "CAST(0 AS BIGINT) AS RowsDeleted",
        step.format(k=ctx.extract_audit, name="extract", t=t, status="'Success'", rows=stg_rows),
        step.format(k=ctx.dims_audit, name="load_dimensions", t=t, status="'Success'",
                    rows=dim_rows),
        step.format(k=ctx.fact_audit, name="load_fact", t=t, status=fact_status,
                    rows="(SELECT COUNT(*) FROM fact)"),
    ])


def report_sql() -> str:
    rows = []
    for cid, group, name, actual, expected, kind in check_specs():
        exp = expected if isinstance(expected, str) else str(expected)
        rows.append(
            f"SELECT '{cid}' AS check_id, '{group}' AS check_group, '{name}' AS check_name, "
            f"CAST({actual} AS DECIMAL(38,2)) AS actual, CAST({exp} AS DECIMAL(38,2)) AS expected, "
            f"CASE WHEN CAST({actual} AS DECIMAL(38,2)) = CAST({exp} AS DECIMAL(38,2)) "
            f"THEN 'PASS' ELSE '{kind}' END AS status FROM m")
    return "\nUNION ALL\n".join(rows)


def summary_sql() -> str:
    return ("SELECT COUNT(*) FILTER (WHERE status = 'PASS') AS n_pass, "
            "COUNT(*) FILTER (WHERE status = 'FAIL') AS n_fail, "
            "COUNT(*) FILTER (WHERE status = 'WARN') AS n_warn, "
            "CASE WHEN COUNT(*) FILTER (WHERE status = 'FAIL') = 0 AND "
            "COUNT(*) FILTER (WHERE status = 'WARN') = 0 THEN 'ALL CHECKS PASSED' "
            "WHEN COUNT(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASSED with warnings' "
            "ELSE 'FAILED' END AS result FROM report")


def contract_nulls_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{DIM_TABLES[d]}' AS table_name, '{c}' AS column_name, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {SQL_DIM[d]}"
        for d in ORDER for c in NOT_NULL[d])


def contract_widths_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{DIM_TABLES[d]}' AS table_name, '{c}' AS column_name, "
        f"CAST({w} AS INT) AS declared_width, CAST(MAX(length({c})) AS INT) AS max_length, "
        f"COUNT(*) FILTER (WHERE length({c}) > {w}) AS n_over FROM {SQL_DIM[d]}"
        for d in ORDER for c, w in WIDTHS[d].items())
