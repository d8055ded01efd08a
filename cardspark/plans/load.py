"""The warehouse load as one job (stage -> dimensions -> fact -> verify),
written to a new folder per run, and the small checks that go with it
(S4, Q7, V44, M28).

Each run writes under a folder of its own, ``<out_root>/run=<as_of>``, and never
over one: a failed run leaves earlier runs whole, and readers switch to a run only
once its ``_manifest`` (written last) is there. Staging row counts come from the
written files' footers (no second pass over the rows).
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardspark.functions.numeric import money, pct_label, pct_label_sql, share
from cardspark.plans import verify
from cardspark.plans.registry import register
from cardspark.plans.star import CTES, FLAT_SQL, _wh
from cardspark.plans.warehouse import (DEFAULT_CTX, DIM_KEYS, DIM_NAMES, DIM_TABLES, LoadContext,
                                       Warehouse, dim_card, dim_customer, dim_date, dim_geography,
                                       dim_mcc, dim_transaction_type, fact_transaction, staged,
                                       write_fact)
from cardspark.session import run_concurrently
from cardspark.sources.tables import Sources, parts_of

STAGE_TABLES = ["users", "cards", "transactions", "mcc_codes"]


AUDIT = ("AuditKey int, PackageName string, RunFolder string, ExecutionTime timestamp_ntz,"
         " ExecutionStatus string, RowsInserted long")
PACKAGES = ("extract", "load_dimensions", "load_fact")


def read_audit(spark: SparkSession, out_root: str) -> DataFrame:
    """Every status that a load under ``out_root`` has written."""
    path = f"{out_root.rstrip('/')}/_audit"
    try:
        return spark.read.schema(AUDIT).parquet(path)
    except AnalysisException:  # the first load: no folder yet
        return spark.createDataFrame([], AUDIT)


def _note(spark: SparkSession, out_root: str, rows: list) -> None:
    """Append statuses: each is a new small file, nothing is overwritten."""
    spark.createDataFrame(rows, AUDIT).coalesce(1).write.mode("append").parquet(
        f"{out_root.rstrip('/')}/_audit")


def audit_runs(spark: SparkSession, out_root: str) -> DataFrame:
    """One row per package run, newest first: start, end, last status
    (Running if it never ended) and rows."""
    first = F.min_by("ExecutionTime", "ExecutionTime")
    done = F.col("ExecutionStatus") != "Running"
    return (read_audit(spark, out_root).groupBy("AuditKey", "PackageName", "RunFolder").agg(
        first.alias("ExecutionStartTime"),
        F.max(F.when(done, F.col("ExecutionTime"))).alias("ExecutionEndTime"),
        F.coalesce(F.max(F.when(done, F.col("ExecutionStatus"))), F.lit("Running"))
        .alias("ExecutionStatus"),
        F.coalesce(F.max("RowsInserted"), F.lit(0)).alias("RowsInserted"))
        .orderBy(F.desc("AuditKey")))


def _clock() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def build_warehouse(spark: SparkSession, sf_dir: str, out_root: str,
                    ctx: LoadContext | None = None) -> dict:
    """Run the full load; returns the run folder, its context and the counts.

    Without ``ctx`` the load time is now and the audit keys follow the largest
    one of earlier loads. Each package is noted as Running when it starts and
    as Success, Warning (the fact's rows differ from staging) or Failed when it
    ends. The run folder must be new: nothing is ever overwritten."""
    if ctx is None:
        last = read_audit(spark, out_root).agg(F.max("AuditKey").alias("k")).first()["k"] or 0
        ctx = LoadContext(as_of=_clock(), extract_audit=last + 1, dims_audit=last + 2,
                          fact_audit=last + 3)
    run = f"{out_root.rstrip('/')}/run={ctx.as_of:%Y%m%dT%H%M%S%f}"
    keys = dict(zip(PACKAGES, (ctx.extract_audit, ctx.dims_audit, ctx.fact_audit)))

    def package(name: str, work):
        _note(spark, out_root, [(keys[name], name, run, _clock(), "Running", None)])
        try:
            out, rows, status = work()
        except BaseException:
            _note(spark, out_root, [(keys[name], name, run, _clock(), "Failed", None)])
            raise
        _note(spark, out_root, [(keys[name], name, run, _clock(), status, rows)])
        return out

    def write(df: DataFrame, path: str) -> DataFrame:
        df.write.mode("errorifexists").parquet(path)
        return spark.read.parquet(path)

    def extract():
        # staging writes are independent: submitted together
        stg = run_concurrently({n: (lambda n=n, df=df: write(df, f"{run}/stg/{n}"))
                                for n, df in staged(spark, sf_dir, ctx).items()})
        # answered from the Parquet footers, without reading the rows
        counts.update({n: df.count() for n, df in stg.items()})
        return stg, sum(counts.values()), "Success"

    def load_dimensions():
        build = {"date": lambda: dim_date(stg["transactions"], ctx),
                 "mcc": lambda: dim_mcc(stg["mcc_codes"], ctx),
                 "geography": lambda: dim_geography(stg["transactions"], ctx),
                 "transaction_type": lambda: dim_transaction_type(stg["transactions"], ctx),
                 "customer": lambda: dim_customer(stg["users"], ctx),
                 "card": lambda: dim_card(stg["cards"], ctx)}
        dims = run_concurrently({d: (lambda d=d: write(build[d](), f"{run}/dims/{DIM_TABLES[d]}"))
                                 for d in DIM_NAMES})
        # all but the unknown member of each
        return dims, sum(df.count() - 1 for df in dims.values()), "Success"

    def load_fact():
        parts = parts_of(spark, counts["transactions"])
        write_fact(fact_transaction(stg, dims, ctx, parts=parts), f"{run}/fact/FactTransaction",
                   ctx, parts)
        fact = spark.read.parquet(f"{run}/fact/FactTransaction").drop("Year")
        n = fact.count()
        return fact, n, "Success" if n == counts["transactions"] else "Warning"

    counts: dict = {}
    stg = package("extract", extract)
    dims = package("load_dimensions", load_dimensions)
    fact = package("load_fact", load_fact)
    wh = Warehouse.from_tables(spark, sf_dir, ctx, stg, dims, fact)
    write(verify.audit_log(wh), f"{run}/dims/DimAudit")
    write(verify.verify_report(wh), f"{run}/verify")
    # written last: its presence marks the run complete
    manifest = spark.createDataFrame([(k, int(v)) for k, v in counts.items()],
                                     "table string, staged_rows long")
    manifest.coalesce(1).write.mode("errorifexists").json(f"{run}/_manifest")
    return {"run": run, "ctx": ctx, "staged_rows": counts}


# ------------------------------------------------------------------- S4 ----
@register("stage_counts", """
SELECT 'users' AS tbl, COUNT(*) AS n FROM users
UNION ALL SELECT 'cards', COUNT(*) FROM cards
UNION ALL SELECT 'transactions', COUNT(*) FROM transactions
UNION ALL SELECT 'mcc_codes', COUNT(*) FROM mcc_codes
UNION ALL SELECT 'total', (SELECT COUNT(*) FROM users) + (SELECT COUNT(*) FROM cards)
  + (SELECT COUNT(*) FROM transactions) + (SELECT COUNT(*) FROM mcc_codes)""")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per staged table and their total."""
    stg = staged(spark, sf_dir, DEFAULT_CTX)
    parts = [stg[t].agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tbl"), "n")
             for t in STAGE_TABLES]
    per = parts[0]
    for p in parts[1:]:
        per = per.unionByName(p)
    total = per.agg(F.sum("n").cast("long").alias("n")).select(F.lit("total").alias("tbl"), "n")
    return per.unionByName(total)


# ------------------------------------------------------------------- Q7 ----
@register("result_distribution", f"""
WITH g AS (SELECT COALESCE(errors, '(success)') AS result, COUNT(*) AS n FROM transactions
           GROUP BY errors)
SELECT result, n, {pct_label_sql('n', 'SUM(n) OVER ()', 2)} AS pct FROM g ORDER BY n DESC""")
def result_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ5: outcome counts with a two-place percent label."""
    t = Sources(spark, sf_dir).transactions()
    g = (t.groupBy("errors").agg(F.count(F.lit(1)).alias("n"))
          .select(F.coalesce("errors", F.lit("(success)")).alias("result"), "n"))
    total = F.sum("n").over(Window.partitionBy())
    return (g.withColumn("_t", total).withColumn("pct", pct_label("n", "_t", 2)).drop("_t")
             .orderBy(F.desc("n")))


# ------------------------------------------------------------------ V44 ----
@register("load_check", """
SELECT (SELECT COUNT(*) FROM fact) AS n_fact,
       (SELECT CAST(SUM(Amount) AS DECIMAL(38,2)) FROM fact) AS sum_amount,
       (SELECT COUNT(*) FROM stg_transactions) AS expected_rows,
       (SELECT CAST(SUM(amount) AS DECIMAL(38,2)) FROM stg_transactions) AS expected_sum,
       """ + ",\n       ".join(
    f"(SELECT COUNT(*) FROM fact WHERE {DIM_KEYS[d]} = -1) AS unknown_{d}"
    for d in verify.ORDER) + """,
       CASE WHEN (SELECT COUNT(*) FROM fact) = (SELECT COUNT(*) FROM stg_transactions)
                 AND (SELECT SUM(Amount) FROM fact) = (SELECT SUM(amount) FROM stg_transactions)
            THEN 'OK' ELSE 'MISMATCH' END AS status""", CTES)
def load_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact load's own check: count and sum against the staged figures,
    and the unknown-member use per key, in one pass over each table."""
    wh = _wh(spark, sf_dir)
    f = wh.fact().agg(F.count(F.lit(1)).alias("n_fact"),
                      money(F.sum("Amount")).alias("sum_amount"),
                      *[F.count_if(F.col(DIM_KEYS[d]) == -1).alias(f"unknown_{d}")
                        for d in verify.ORDER])
    s = wh.stg["transactions"].agg(F.count(F.lit(1)).alias("expected_rows"),
                                   money(F.sum("amount")).alias("expected_sum"))
    j = f.crossJoin(s)
    ok = (F.col("n_fact") == F.col("expected_rows")) & (F.col("sum_amount") == F.col("expected_sum"))
    return j.withColumn("status", F.when(ok, "OK").otherwise("MISMATCH"))


# ------------------------------------------------------------------ M28 ----

@register("read_check", f"""
WITH flat AS ({FLAT_SQL})
SELECT COUNT(*) AS n_rows, 29 AS n_columns, CAST(SUM(is_error) AS BIGINT) AS n_errors,
       CAST(SUM(is_error) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS error_rate,
       MIN(date_key) AS min_date_key, MAX(date_key) AS max_date_key
FROM flat""", CTES)
def read_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, columns, error count and rate, date-key range of the flat frame
    (the leakage columns error_type / is_success are never selected)."""
    from cardspark.plans.star import flat_frame
    flat = flat_frame(_wh(spark, sf_dir))
    assert not ({"error_type", "is_success"} & set(flat.columns))
    g = flat.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("is_error").cast("long").alias("n_errors"),
                 F.min("date_key").alias("min_date_key"), F.max("date_key").alias("max_date_key"))
    return g.select("n_rows", F.lit(len(flat.columns)).alias("n_columns"), "n_errors",
                    share("n_errors", "n_rows").alias("error_rate"), "min_date_key",
                    "max_date_key")
