"""KPIs on the star (K1-K6), the flat ML frame (J6/S8) and time features
(S9, M2, M3).

Scale notes:
- KPIs aggregate the fact per key first (per CardKey, per transaction type)
  and join dimensions to those aggregates, not to the fact rows;
- the flat frame joins the two large dimensions through one (CardKey,
  CustomerKey) attribute table: the pairs are taken from the fact with a
  map-side-combined aggregate (at most one row per card), both dimensions are
  joined to that, and the fact is shuffled once instead of twice;
- velocity (transactions per card per day) is a grouped count joined back,
  not a window: the count is combined map-side, and a hot card-day is one row
  on the build side (AQE splits the skewed stream side).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardspark.functions.numeric import money, share
from cardspark.operators.prefix import exact_medians
from cardspark.plans.registry import register
from cardspark.plans.warehouse import (DEFAULT_CTX, DIM_KEYS, Warehouse, sized_broadcast,
                                       sized_join)
from cardspark.plans.warehouse_sql import warehouse_ctes
from cardspark.sources.tables import Sources, spread_parts

CTES = warehouse_ctes(DEFAULT_CTX)
UTIL_DAYS = 30


def _wh(spark, sf_dir):
    return Warehouse.get(spark, sf_dir, DEFAULT_CTX)


def _success_types(wh: Warehouse) -> DataFrame:
    tt = wh.dim("transaction_type").select("TransactionTypeKey", "IsSuccess")
    return sized_broadcast(tt, wh.ctx.broadcast_max_rows, wh.dim_rows("transaction_type"))


def _valid_fact(wh: Warehouse) -> DataFrame:
    """Fact rows of valid spend: successful type and a positive amount."""
    return _valid(wh, wh.fact())


def _valid(wh: Warehouse, fact: DataFrame) -> DataFrame:
    return (fact.filter(F.col("Amount") > 0)
            .join(_success_types(wh).filter("IsSuccess").drop("IsSuccess"),
                  "TransactionTypeKey"))


# ------------------------------------------------------------------ K1-K6 ----
@register("kpi_valid_spend", """
SELECT CAST(SUM(f.Amount) AS DECIMAL(38,2)) AS valid_spend
FROM fact f JOIN dim_transaction_type d ON d.TransactionTypeKey = f.TransactionTypeKey
WHERE d.IsSuccess AND f.Amount > 0""", CTES)
def kpi_valid_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid_fact(_wh(spark, sf_dir)).agg(money(F.sum("Amount")).alias("valid_spend"))


@register("kpi_success_rate", """
SELECT COUNT(*) FILTER (WHERE d.IsSuccess) AS n_success, COUNT(*) AS n_txn,
       CAST(COUNT(*) FILTER (WHERE d.IsSuccess) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS success_rate
FROM fact f JOIN dim_transaction_type d ON d.TransactionTypeKey = f.TransactionTypeKey""", CTES)
def kpi_success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    per_type = wh.fact().groupBy("TransactionTypeKey").agg(F.count(F.lit(1)).alias("n"))
    j = per_type.join(_success_types(wh), "TransactionTypeKey")
    return (j.agg(F.sum(F.when(F.col("IsSuccess"), F.col("n")).otherwise(0)).alias("n_success"),
                  F.sum("n").alias("n_txn"))
             .withColumn("success_rate", share("n_success", "n_txn")))


@register("kpi_utilization", f"""
WITH dated AS (
  SELECT f.CardKey, f.Amount, dd.FullDate FROM fact f
  JOIN dim_transaction_type t ON t.TransactionTypeKey = f.TransactionTypeKey
  JOIN dim_date dd ON dd.DateKey = f.DateKey
  WHERE t.IsSuccess AND f.Amount > 0),
recent AS (
  SELECT CardKey, SUM(Amount) AS spend FROM dated
  WHERE FullDate >= (SELECT MAX(FullDate) FROM dated) - INTERVAL {UTIL_DAYS} DAY
  GROUP BY CardKey),
credit AS (
  SELECT r.spend, c.CreditLimit FROM recent r JOIN dim_card c ON c.CardKey = r.CardKey
  WHERE c.CardType = 'Credit')
SELECT CAST(SUM(spend) AS DECIMAL(38,2)) AS spend_30d,
       CAST(SUM(CreditLimit) AS DECIMAL(38,2)) AS credit_limit_total,
       CAST(SUM(spend) AS DOUBLE) / NULLIF(CAST(SUM(CreditLimit) AS DOUBLE), 0) AS utilization
FROM credit""", CTES)
def kpi_utilization(spark: SparkSession, sf_dir: str, days: int = UTIL_DAYS) -> DataFrame:
    """K3: valid spend of the last ``days`` days on credit cards over their
    limits (cards with spend in the window), at day grain as the star holds.

    The window is found first (one pass over the day key of valid rows) and
    becomes a bound on the year folders and the day key, so the second pass
    opens the last one or two years alone."""
    wh = _wh(spark, sf_dir)
    last = _valid_fact(wh).filter(F.col("DateKey") > 0).agg(F.max("DateKey").alias("d")).first()["d"]
    first_day = dt.datetime.strptime(str(last), "%Y%m%d") - dt.timedelta(days=days) if last \
        else dt.datetime(1, 1, 1)
    recent = (_valid(wh, wh.fact_by_year().filter(
        (F.col("Year") >= first_day.year)
        & (F.col("DateKey") >= int(first_day.strftime("%Y%m%d")))))
        .groupBy("CardKey").agg(F.sum("Amount").alias("spend")))
    credit = wh.dim("card").filter(F.col("CardType") == "Credit").select("CardKey", "CreditLimit")
    j = recent.join(credit, "CardKey")
    return (j.agg(money(F.sum("spend")).alias("spend_30d"),
                  money(F.sum("CreditLimit")).alias("credit_limit_total"))
             .withColumn("utilization", share(F.col("spend_30d"), F.col("credit_limit_total"))))


@register("kpi_active_customers", """
SELECT COUNT(DISTINCT f.CustomerKey) AS active_customers
FROM fact f JOIN dim_transaction_type d ON d.TransactionTypeKey = f.TransactionTypeKey
WHERE d.IsSuccess AND f.CustomerKey > 0""", CTES)
def kpi_active_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: customers with at least one successful transaction (A10)."""
    wh = _wh(spark, sf_dir)
    ok = _success_types(wh).filter("IsSuccess").drop("IsSuccess")
    return (wh.fact().filter(F.col("CustomerKey") > 0).join(ok, "TransactionTypeKey")
              .agg(F.count_distinct("CustomerKey").alias("active_customers")))


# Twelve bits of buckets: a standard error of 1.04 / 64, some 1.6 %.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def active_sketches(wh: Warehouse) -> DataFrame:
    """A10: per day a mergeable sketch of the customers with a successful
    transaction, written beside the fact once per load. Any period's distinct
    count is a union of its days' sketches, without the fact."""
    if getattr(wh, "_active_sketches", None) is None:
        ok = _success_types(wh).filter("IsSuccess").drop("IsSuccess")
        daily = (wh.fact().filter((F.col("CustomerKey") > 0) & (F.col("DateKey") > 0))
                 .join(ok, "TransactionTypeKey").groupBy("DateKey")
                 .agg(F.hll_sketch_agg("CustomerKey", SKETCH_BITS).alias("customers")))
        from cardspark.sources.store import write_table
        wh._active_sketches = write_table(daily, f"{wh.scope}/active_sketches")
    return wh._active_sketches


@register("kpi_active_by_month", """
SELECT CAST(f.DateKey // 100 AS BIGINT) AS month_key, COUNT(DISTINCT f.CustomerKey) AS active_customers,
       true AS sketch_within_bound
FROM fact f JOIN dim_transaction_type d ON d.TransactionTypeKey = f.TransactionTypeKey
WHERE d.IsSuccess AND f.CustomerKey > 0 AND f.DateKey > 0 GROUP BY 1""", CTES)
def kpi_active_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10/K4: active customers a month, counted exactly, and whether the union of
    the days' sketches is within four standard errors of it."""
    wh = _wh(spark, sf_dir)
    ok = _success_types(wh).filter("IsSuccess").drop("IsSuccess")
    month = F.expr("CAST(DateKey div 100 AS BIGINT)").alias("month_key")
    exact = (wh.fact().filter((F.col("CustomerKey") > 0) & (F.col("DateKey") > 0))
             .join(ok, "TransactionTypeKey").groupBy(month)
             .agg(F.count_distinct("CustomerKey").alias("active_customers")))
    sketched = active_sketches(wh).groupBy(month).agg(
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("estimate"))
    within = F.abs(F.col("estimate") - F.col("active_customers")) \
        <= 4 * SKETCH_ERROR * F.col("active_customers") + 1
    return (exact.join(sketched, "month_key", "left")
            .select("month_key", "active_customers",
                    F.coalesce(within, F.lit(False)).alias("sketch_within_bound")))


# A span of days inside the test data's years.
SPAN = (19960415, 19970214)


@register("kpi_spend_of_span", f"""
SELECT c.Quarter AS quarter, CAST(SUM(f.Amount) AS DECIMAL(38,2)) AS valid_spend, COUNT(*) AS n_valid
FROM fact f JOIN dim_transaction_type d ON d.TransactionTypeKey = f.TransactionTypeKey
JOIN dim_date c ON c.DateKey = f.DateKey
WHERE d.IsSuccess AND f.Amount > 0 AND c.DateKey BETWEEN {SPAN[0]} AND {SPAN[1]} AND c.IsWeekend
GROUP BY c.Quarter""", CTES)
def kpi_spend_of_span(spark: SparkSession, sf_dir: str, span: tuple = SPAN) -> DataFrame:
    """Weekend spend of a span of days by quarter. The days are chosen in
    DimDate; their years prune the fact's year folders at run time."""
    wh = _wh(spark, sf_dir)
    days = wh.dim("date").filter(F.col("DateKey").between(*span) & F.col("IsWeekend")) \
        .select("DateKey", F.col("Year").alias("_year"), F.col("Quarter").alias("quarter"))
    f = _valid(wh, wh.fact_by_year())
    j = f.join(F.broadcast(days),  # a calendar: 366 rows a year
               (f["DateKey"] == days["DateKey"]) & (f["Year"] == days["_year"]))
    return j.groupBy("quarter").agg(money(F.sum("Amount")).alias("valid_spend"),
                                    F.count(F.lit(1)).alias("n_valid"))


@register("kpi_avg_ticket", """
SELECT CAST(SUM(f.Amount) AS DECIMAL(38,2)) AS valid_spend, COUNT(*) AS n_valid,
       CAST(SUM(f.Amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_ticket
FROM fact f JOIN dim_transaction_type d ON d.TransactionTypeKey = f.TransactionTypeKey
WHERE d.IsSuccess AND f.Amount > 0""", CTES)
def kpi_avg_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: valid spend over valid transaction count."""
    g = _valid_fact(_wh(spark, sf_dir)).agg(money(F.sum("Amount")).alias("valid_spend"),
                                            F.count(F.lit(1)).alias("n_valid"))
    return g.withColumn("avg_ticket", share(F.col("valid_spend"), F.col("n_valid")))


@register("kpi_spend_by_type", """
WITH g AS (
  SELECT c.CardType AS card_type, CAST(SUM(f.Amount) AS DECIMAL(38,2)) AS valid_spend
  FROM fact f JOIN dim_transaction_type d ON d.TransactionTypeKey = f.TransactionTypeKey
  JOIN dim_card c ON c.CardKey = f.CardKey
  WHERE d.IsSuccess AND f.Amount > 0 GROUP BY c.CardType)
SELECT card_type, valid_spend,
       CAST(valid_spend AS DOUBLE) / CAST(SUM(valid_spend) OVER () AS DOUBLE) AS share
FROM g ORDER BY valid_spend DESC""", CTES)
def kpi_spend_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: valid spend per card type with its share; aggregated per card
    before the card dimension is joined."""
    wh = _wh(spark, sf_dir)
    per_card = _valid_fact(wh).groupBy("CardKey").agg(F.sum("Amount").alias("s"))
    g = (per_card.join(wh.dim("card").select("CardKey", F.col("CardType").alias("card_type")),
                       "CardKey")
                 .groupBy("card_type").agg(money(F.sum("s")).alias("valid_spend")))
    total = F.sum("valid_spend").over(Window.partitionBy())
    return g.withColumn("share", share(F.col("valid_spend"), total)).orderBy(F.desc("valid_spend"))


# -------------------------------------------------------------------- S12 ----
@register("fact_by_year", """
SELECT CAST(DateKey // 10000 AS INT) AS year, COUNT(*) AS n_rows, MIN(DateKey) AS first_day,
       MAX(DateKey) AS last_day, CAST(SUM(Amount) AS DECIMAL(38,2)) AS amount
FROM fact WHERE DateKey // 10000 >= 1996 GROUP BY 1""", CTES)
def fact_by_year(spark: SparkSession, sf_dir: str, since: int = 1996) -> DataFrame:
    """The year-partitioned fact from a year on: the filter picks folders."""
    f = _wh(spark, sf_dir).fact_by_year().filter(F.col("Year") >= since)
    return f.groupBy(F.col("Year").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("DateKey").alias("first_day"),
        F.max("DateKey").alias("last_day"), money(F.sum("Amount")).alias("amount"))


# ------------------------------------------------------------------ J6/S8 ----
# The frame's columns by where they come from: {dimension: {output: column}}.
FACT_PART = {"transaction_id": "BKTransactionID", "date_key": "DateKey", "amount": "Amount",
             "merchant_id": "BKMerchantID"}
FLAT_PARTS = {
    "date": {"year": "Year", "month_number": "MonthNumber", "quarter": "Quarter",
             "day_name": "DayName", "is_weekend": "IsWeekend"},
    "card": {"card_brand": "CardBrand", "card_type": "CardType", "credit_limit": "CreditLimit",
             "credit_limit_band": "CreditLimitBand", "has_chip": "HasChip"},
    "customer": {"current_age": "CurrentAge", "age_group": "AgeGroup", "gender": "Gender",
                 "yearly_income": "YearlyIncome", "income_band": "IncomeBand",
                 "credit_score": "CreditScore", "credit_band": "CreditBand",
                 "debt_to_income": "DebtToIncome", "num_credit_cards": "NumCreditCards"},
    "geography": {"state": "State", "is_online": "IsOnline"},
    "mcc": {"mcc_description": "MccDescription"},
    "transaction_type": {"entry_mode": "EntryMode", "is_online_entry": "IsOnlineEntry"},
}
FLAT_COLS = [*FACT_PART, "is_error", *(c for part in FLAT_PARTS.values() for c in part)]


def _part(wh: Warehouse, name: str) -> DataFrame:
    cols = [F.col(c).alias(out) for out, c in FLAT_PARTS[name].items()]
    if name == "transaction_type":
        cols.append((~F.col("IsSuccess")).cast("int").alias("is_error"))
    return wh.dim(name).select(DIM_KEYS[name], *cols)


def flat_frame(wh: Warehouse, times: DataFrame | None = None) -> DataFrame:
    """Fact with its six dimensions as one frame (29 columns); the target is
    ``is_error`` = NOT IsSuccess, and no error text is carried (leakage).
    ``times`` (transaction_id and more columns) is left-joined and its columns
    follow.

    Rows are shuffled while they hold keys and measures alone: the broadcast
    dimensions' texts are added after the last shuffle join."""
    f = wh.fact()
    pairs = f.groupBy("CardKey", "CustomerKey").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    people = pairs
    for name in ("card", "customer"):
        people = people.join(sized_join(_part(wh, name), wh.dim_rows(name)), DIM_KEYS[name])
    written = wh.materialize or wh.scope is None  # a scan, whose size is known
    parts = spread_parts(f) if written else None
    j, more = f, []
    if times is not None:
        more = [c for c in times.columns if c != "transaction_id"]
        j = (j.repartition(parts, "BKTransactionID") if parts else j).join(
            times.withColumnRenamed("transaction_id", "_tid"),
            F.col("BKTransactionID") == F.col("_tid"), "left")
    if parts:
        j = j.repartition(parts, "CardKey", "CustomerKey")
    j = j.join(people, ["CardKey", "CustomerKey"])
    for name in ("date", "geography", "mcc", "transaction_type"):
        j = j.join(sized_broadcast(_part(wh, name), wh.ctx.broadcast_max_rows, wh.dim_rows(name)),
                   DIM_KEYS[name])
    return j.select(*[F.col(c).alias(out) for out, c in FACT_PART.items()],
                    *FLAT_COLS[len(FACT_PART):], *more)


def _flat_sql() -> str:
    """The twin, from the same map: each dimension cut to its part, all joined
    to the fact by the names of their keys."""
    parts = []
    for name, cols in FLAT_PARTS.items():
        extra = ", CAST(NOT IsSuccess AS INT) AS is_error" if name == "transaction_type" else ""
        listed = ", ".join(f"{c} AS {out}" for out, c in cols.items())
        parts.append(f"(SELECT {DIM_KEYS[name]}, {listed}{extra} FROM dim_{name})")
    keys = list(DIM_KEYS[name] for name in FLAT_PARTS)
    fact = ", ".join([*keys, *(f"{c} AS {out}" for out, c in FACT_PART.items())])
    joins = " ".join(f"JOIN {part} USING ({key})" for part, key in zip(parts, keys))
    return f"SELECT {', '.join(FLAT_COLS)} FROM (SELECT {fact} FROM fact) {joins}"


FLAT_SQL = _flat_sql()


@register("ml_flat", FLAT_SQL, CTES)
def ml_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_frame(_wh(spark, sf_dir))


# ---------------------------------------------------------------- S9 / M2 ----
def _time_parts(transactions: DataFrame) -> DataFrame:
    return transactions.select(F.col("id").alias("transaction_id"), "card_id",
                               F.hour("date").alias("txn_hour"),
                               F.dayofweek("date").alias("txn_weekday"),
                               F.to_date("date").alias("txn_date"))


def _is_night():
    return F.when((F.col("txn_hour") >= 0) & (F.col("txn_hour") < 6), 1).otherwise(0)


def time_features(transactions: DataFrame) -> DataFrame:
    """Hour, weekday (Sunday = 1), night flag (hour < 6) and velocity (the
    number of transactions of the same card on the same day; a missing date
    is a group of its own, as in a window, so no row is lost)."""
    t = _time_parts(transactions)
    # card-days of one transaction need not be joined back
    per_day = (t.groupBy("card_id", "txn_date").agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > 1)
                .select(F.col("card_id").alias("_c"), F.col("txn_date").alias("_d"), "_n"))
    same = t.card_id.eqNullSafe(per_day._c) & t.txn_date.eqNullSafe(per_day._d)
    return (t.join(per_day, same, "left")
             .select("transaction_id", "txn_hour", "txn_weekday", _is_night().alias("is_night"),
                     F.coalesce("_n", F.lit(1)).cast("long").alias("txn_per_card_day")))


TIME_SQL = """
SELECT id AS transaction_id, CAST(hour(date) AS INT) AS txn_hour,
       CAST(dayofweek(date) + 1 AS INT) AS txn_weekday,
       CASE WHEN hour(date) >= 0 AND hour(date) < 6 THEN 1 ELSE 0 END AS is_night,
       COUNT(*) OVER (PARTITION BY card_id, CAST(date AS DATE)) AS txn_per_card_day
FROM transactions"""


@register("time_features", TIME_SQL)
def time_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_features(Sources(spark, sf_dir).transactions())


def prior_velocity(transactions: DataFrame) -> DataFrame:
    """Per transaction, how many of the same card came earlier on its day
    (ties by id): what was known when it happened. Times are counted per card
    and second before the window, so a busy card-day is as many rows as it has
    different seconds (86,400 at most)."""
    t = transactions.select("id", "card_id", F.col("date").alias("at"),
                            F.to_date("date").alias("day"))
    per_second = t.groupBy("card_id", "day", "at").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("card_id", "day").orderBy("at") \
        .rowsBetween(Window.unboundedPreceding, -1)
    per_second = per_second.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))) \
        .select(F.col("card_id").alias("_c"), F.col("at").alias("_a"), "before")
    # within one second: the rank by id
    same = Window.partitionBy("card_id", "at").orderBy("id")
    ranked = t.withColumn("rank", F.row_number().over(same) - 1)
    return (ranked.join(per_second, ranked.card_id.eqNullSafe(per_second._c)
                        & ranked["at"].eqNullSafe(per_second._a))
            .select(F.col("id").alias("transaction_id"),
                    (F.col("before") + F.col("rank")).cast("long").alias("txn_before_on_card_day")))


@register("velocity_prior", """
SELECT id AS transaction_id,
       row_number() OVER (PARTITION BY card_id, CAST(date AS DATE) ORDER BY date, id) - 1
         AS txn_before_on_card_day
FROM transactions""")
def velocity_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prior_velocity(Sources(spark, sf_dir).transactions())


def flat_with_time(wh: Warehouse) -> DataFrame:
    """J14 + M3: flat frame left-joined to time features by transaction id;
    unmatched rows get the median hour and weekday, night 0, velocity 1."""
    # the night flag follows from the hour
    j = flat_frame(wh, time_features(wh.stg["transactions"]).drop("is_night"))
    # medians over every transaction's hour and weekday: a projection of the
    # staged table, without the velocity aggregate and join
    parts = _time_parts(wh.stg["transactions"])
    med = (exact_medians(parts, ["txn_hour", "txn_weekday"]).groupBy()
           .pivot("column_name", ["txn_hour", "txn_weekday"]).agg(F.first("median"))
           .select(F.col("txn_hour").alias("_mh"), F.col("txn_weekday").alias("_mw")))
    j = j.crossJoin(F.broadcast(med))
    return j.select(
        *FLAT_COLS,
        F.coalesce(F.col("txn_hour").cast("double"), F.col("_mh")).alias("txn_hour"),
        F.coalesce(F.col("txn_weekday").cast("double"), F.col("_mw")).alias("txn_weekday"),
        _is_night().alias("is_night"),
        F.coalesce("txn_per_card_day", F.lit(1)).cast("long").alias("txn_per_card_day"))


def ml_frame(wh: Warehouse) -> DataFrame:
    """The flat frame with time features, materialised once per load (it is
    read by the medians, encoders, feature build and EDA)."""
    if getattr(wh, "_ml_frame", None) is None:
        from cardspark.sources.store import write_table
        wh._ml_frame = write_table(flat_with_time(wh), f"{wh.scope}/ml_frame")
    return wh._ml_frame


Warehouse.ml_frame = ml_frame


@register("ml_flat_with_time", f"""
WITH tf AS ({TIME_SQL}),
flat AS ({FLAT_SQL}),
j AS (SELECT flat.*, tf.txn_hour AS h, tf.txn_weekday AS w, tf.is_night AS nt,
             tf.txn_per_card_day AS v
      FROM flat LEFT JOIN tf ON tf.transaction_id = flat.transaction_id)
SELECT {', '.join(FLAT_COLS)},
       COALESCE(CAST(h AS DOUBLE), (SELECT median(CAST(txn_hour AS DOUBLE)) FROM tf)) AS txn_hour,
       COALESCE(CAST(w AS DOUBLE), (SELECT median(CAST(txn_weekday AS DOUBLE)) FROM tf)) AS txn_weekday,
       CAST(COALESCE(nt, 0) AS INT) AS is_night, CAST(COALESCE(v, 1) AS BIGINT) AS txn_per_card_day
FROM j""", CTES)
def ml_flat_with_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wh(spark, sf_dir).ml_frame()
