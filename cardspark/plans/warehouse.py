"""Star-schema warehouse: staging, six dimensions, the fact, display views.

Load parameters (``LoadContext``) carry the run's load time and audit keys,
so a run is reproducible and the oracle can compare housekeeping columns too.
In production ``as_of`` is taken once per run (F9) and the audit keys come
from the audit table.

Scale notes:
- surrogate keys come from ``operators.keys`` (one sort + checkpoint, no
  single-partition window); dimension frames are checkpointed there, so every
  later use reads them back instead of recomputing;
- the card and customer lookups of the fact are merged into one lookup table
  keyed by card_id (J8 pre-joined), so the fact pays one join for both;
- small dimensions (date, mcc, transaction type, usually geography) are
  broadcast only after their row count is checked against a bound; beyond it
  the join is a shuffle join, with AQE splitting skewed keys such as the
  one 'ONLINE' geography that carries a third of the rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.functions import rules
from cardspark.functions.timeutil import ntz
from cardspark.operators.keys import surrogate_keys
from cardspark.session import run_concurrently
from cardspark.sources.store import CODEC
from cardspark.sources.tables import Sources, parts_of

# Fixed values of the reference's housekeeping columns.
HIGH_DATE = dt.datetime(9999, 12, 31)
LOW_DATE = dt.datetime(1899, 12, 31)
UNKNOWN_CARD_OPEN = dt.date(1900, 1, 1)

# Broadcast a dimension only below this many rows (checked with a count).
BROADCAST_MAX_ROWS = 2_000_000

# A larger table (cards, customers) is left to the planner only up to this many rows.
# The planner judges it by its compressed files and the columns asked for, and would
# send millions of narrow rows through the driver.
PLANNED_MAX_ROWS = 500_000


@dataclass(frozen=True)
class LoadContext:
    as_of: dt.datetime = dt.datetime(2002, 1, 1)
    extract_audit: int = 1
    dims_audit: int = 2
    fact_audit: int = 3
    calendar: tuple | None = None  # (start date, end date); default from the data
    broadcast_max_rows: int = BROADCAST_MAX_ROWS


DEFAULT_CTX = LoadContext()


def _ts(x: dt.datetime):
    return ntz(x)


# ----------------------------------------------------------------- staging ----
def stage(df: DataFrame, ctx: LoadContext) -> DataFrame:
    """Source columns plus load time and audit key."""
    return df.withColumns({"StgLoadDate": _ts(ctx.as_of),
                           "StgAuditKey": F.lit(ctx.extract_audit).cast("int")})


def staged(spark: SparkSession, sf_dir: str, ctx: LoadContext = DEFAULT_CTX) -> dict:
    s = Sources(spark, sf_dir)
    return {"users": stage(s.users(), ctx), "cards": stage(s.cards(), ctx),
            "transactions": stage(s.transactions(), ctx), "mcc_codes": stage(s.mcc_codes(), ctx)}


# -------------------------------------------------------------- dimensions ----
def _housekeeping(ctx: LoadContext) -> dict:
    return {"RowIsCurrent": F.lit("Y"), "RowStartDate": _ts(ctx.as_of),
            "RowEndDate": _ts(HIGH_DATE), "RowChangeReason": F.lit("New"),
            "InsertAuditKey": F.lit(ctx.dims_audit).cast("int"),
            "UpdateAuditKey": F.lit(ctx.dims_audit).cast("int")}


def _unknown_row(spark: SparkSession, like: DataFrame, values: dict) -> DataFrame:
    """The -1 member, with the reference's stated default values."""
    hk = {"RowIsCurrent": "Y", "RowStartDate": LOW_DATE, "RowEndDate": HIGH_DATE,
          "RowChangeReason": "N/A", "InsertAuditKey": -1, "UpdateAuditKey": -1}
    merged = {**{k: v for k, v in hk.items() if k in like.columns}, **values}
    def lit(v, t):
        return ntz(v) if isinstance(v, dt.datetime) else F.lit(v).cast(t)
    row = spark.range(1).select(*[lit(merged[f.name], f.dataType).alias(f.name)
                                  for f in like.schema.fields])
    return row


def _with_unknown(dim: DataFrame, values: dict) -> DataFrame:
    """The unknown row first, then the loaded members."""
    return _unknown_row(dim.sparkSession, dim, values).unionByName(dim)


def dim_date(stg_txn: DataFrame, ctx: LoadContext = DEFAULT_CTX) -> DataFrame:
    """Calendar from Jan 1 of the first to Dec 31 of the last year of data
    (or ``ctx.calendar``); one generated row per day."""
    spark = stg_txn.sparkSession
    if ctx.calendar:
        bounds = spark.range(1).select(F.lit(ctx.calendar[0]).cast("date").alias("s"),
                                       F.lit(ctx.calendar[1]).cast("date").alias("e"))
    else:
        bounds = stg_txn.agg(F.make_date(F.min(F.year("date")), F.lit(1), F.lit(1)).alias("s"),
                             F.make_date(F.max(F.year("date")), F.lit(12), F.lit(31)).alias("e"))
    d = bounds.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 DAY"))).alias("d"))
    dim = d.select(
        F.date_format("d", "yyyyMMdd").cast("int").alias("DateKey"),
        F.col("d").alias("FullDate"),
        F.year("d").cast("int").alias("Year"),
        F.quarter("d").cast("smallint").alias("Quarter"),
        F.concat(F.lit("Q"), F.quarter("d").cast("string")).alias("QuarterName"),
        F.month("d").cast("smallint").alias("MonthNumber"),
        F.date_format("d", "MMMM").alias("MonthName"),
        F.date_format("d", "yyyy-MM").alias("MonthYear"),
        F.dayofmonth("d").cast("smallint").alias("DayOfMonth"),
        F.date_format("d", "EEEE").alias("DayName"),
        F.dayofweek("d").isin(1, 7).alias("IsWeekend"),
    )
    unknown = {"DateKey": -1, "FullDate": LOW_DATE.date(), "Year": -1, "Quarter": -1,
               "QuarterName": "Unknown", "MonthNumber": -1, "MonthName": "Unknown",
               "MonthYear": "Unknown", "DayOfMonth": -1, "DayName": "Unknown",
               "IsWeekend": False}
    return _with_unknown(dim, unknown)


def dim_mcc(stg_mcc: DataFrame, ctx: LoadContext = DEFAULT_CTX) -> DataFrame:
    """D2 (type 1)."""
    base = stg_mcc.select(F.col("mcc_id").alias("BKMccID"),
                          F.col("description").alias("MccDescription")).withColumns(
        _housekeeping(ctx))
    dim = surrogate_keys(base, ["BKMccID"], "MccKey")
    return _with_unknown(dim, {"MccKey": -1, "BKMccID": -1, "MccDescription": "Unknown"})


def dim_geography(stg_txn: DataFrame, ctx: LoadContext = DEFAULT_CTX) -> DataFrame:
    """D3 (type 1): one row per composite key of city, state and zip. The key
    writes NULL as '', so '' and NULL share a row (which then holds '')."""
    base = stg_txn.groupBy(rules.geo_code().alias("BKGeoCode")).agg(
        F.min("merchant_city").alias("City"), F.min("merchant_state").alias("State"),
        F.min("zip").alias("Zip"),
        F.max(F.coalesce(F.col("merchant_city") == "ONLINE", F.lit(False))).alias("IsOnline"))
    dim = surrogate_keys(base.withColumns(_housekeeping(ctx)), ["BKGeoCode"], "GeographyKey")
    return _with_unknown(dim, {"GeographyKey": -1, "BKGeoCode": "Unknown", "City": "Unknown",
                               "State": "Unknown", "Zip": "Unknown", "IsOnline": False})


def dim_transaction_type(stg_txn: DataFrame, ctx: LoadContext = DEFAULT_CTX) -> DataFrame:
    """D4 (junk dimension): one row per key of entry mode, success flag and
    error text; several texts of use_chip share an entry mode."""
    base = stg_txn.groupBy(rules.trans_type_code().alias("BKTransTypeCode")).agg(
        F.min(rules.entry_mode()).alias("EntryMode"),
        F.min(F.col("errors").isNull()).alias("IsSuccess"),
        F.min(F.coalesce("errors", F.lit("None"))).alias("ErrorType"),
        F.min(rules.entry_mode() == "Online").alias("IsOnlineEntry"))
    dim = surrogate_keys(base.withColumns(_housekeeping(ctx)), ["BKTransTypeCode"],
                         "TransactionTypeKey")
    return _with_unknown(dim, {"TransactionTypeKey": -1, "BKTransTypeCode": "Unknown",
                               "EntryMode": "Unknown", "IsSuccess": False, "ErrorType": "None",
                               "IsOnlineEntry": False})


CUSTOMER_UNKNOWN = {"CustomerKey": -1, "BKCustomerID": -1, "Gender": "Unknown", "CurrentAge": -1,
                    "AgeGroup": "Unknown", "BirthYear": -1, "PerCapitaIncome": 0,
                    "YearlyIncome": 0, "IncomeBand": "Unknown", "TotalDebt": 0,
                    "DebtToIncome": 0, "CreditScore": -1, "CreditBand": "Unknown",
                    "NumCreditCards": -1}


def customer_attributes(users: DataFrame) -> DataFrame:
    """DimCustomer columns derived from a users snapshot (no keys, no housekeeping)."""
    return users.select(
        F.col("id").alias("BKCustomerID"), F.col("gender").alias("Gender"),
        F.col("current_age").alias("CurrentAge"), rules.age_group().alias("AgeGroup"),
        F.col("birth_year").alias("BirthYear"),
        F.col("per_capita_income").alias("PerCapitaIncome"),
        F.col("yearly_income").alias("YearlyIncome"), rules.income_band().alias("IncomeBand"),
        F.col("total_debt").alias("TotalDebt"), rules.debt_to_income().alias("DebtToIncome"),
        F.col("credit_score").alias("CreditScore"), rules.credit_band().alias("CreditBand"),
        F.col("num_credit_cards").alias("NumCreditCards"))


def dim_customer(stg_users: DataFrame, ctx: LoadContext = DEFAULT_CTX) -> DataFrame:
    """D5 (type 2, initial load)."""
    base = customer_attributes(stg_users).withColumns(_housekeeping(ctx))
    dim = surrogate_keys(base, ["BKCustomerID"], "CustomerKey")
    return _with_unknown(dim, CUSTOMER_UNKNOWN)


def card_attributes(cards: DataFrame) -> DataFrame:
    """DimCard columns derived from a cards snapshot (no keys, no housekeeping)."""
    return cards.select(
        F.col("id").alias("BKCardID"), F.col("card_brand").alias("CardBrand"),
        F.col("card_type").alias("CardType"), F.col("credit_limit").alias("CreditLimit"),
        rules.credit_limit_band().alias("CreditLimitBand"),
        F.coalesce(F.col("has_chip") == "YES", F.lit(False)).alias("HasChip"),
        F.col("num_cards_issued").alias("NumCardsIssued"),
        F.col("acct_open_date").alias("AcctOpenDate"))


def dim_card(stg_cards: DataFrame, ctx: LoadContext = DEFAULT_CTX) -> DataFrame:
    """D6 (type 2, initial load)."""
    base = card_attributes(stg_cards).withColumns(_housekeeping(ctx))
    dim = surrogate_keys(base, ["BKCardID"], "CardKey")
    return _with_unknown(dim, {"CardKey": -1, "BKCardID": -1, "CardBrand": "Unknown",
                               "CardType": "Unknown", "CreditLimit": 0,
                               "CreditLimitBand": "Unknown", "HasChip": False,
                               "NumCardsIssued": -1, "AcctOpenDate": UNKNOWN_CARD_OPEN})


# -------------------------------------------------------------------- fact ----
def sized_broadcast(dim: DataFrame, max_rows: int, rows: int | None = None) -> DataFrame:
    """Broadcast ``dim`` only if a count proves it small; otherwise ask for a
    shuffle join (AQE splits skewed keys).
    ``rows`` is a known upper bound on its rows (the row count of the written
    table it projects or filters); without it the frame is counted."""
    n = rows if rows is not None else dim.count()
    return F.broadcast(dim) if n <= max_rows else dim.hint("merge")


def sized_join(dim: DataFrame, rows: int | None = None) -> DataFrame:
    """``dim`` as a join's side that the planner may broadcast only if a count
    (``rows``, as in ``sized_broadcast``) proves it small."""
    n = rows if rows is not None else dim.count()
    return dim if n <= PLANNED_MAX_ROWS else dim.hint("merge")


def _current(dim: DataFrame, key: str) -> DataFrame:
    return dim.filter((F.col("RowIsCurrent") == "Y") & (F.col(key) > 0))


def card_lookup(stg_cards: DataFrame, d_card: DataFrame, d_customer: DataFrame,
                n_customers: int | None = None) -> DataFrame:
    """One row per card_id with its CardKey and, through the staged card's
    client, its CustomerKey. Both inputs are unique per card_id."""
    card_keys = _current(d_card, "CardKey").select(F.col("BKCardID").alias("card_id"), "CardKey")
    cust = _current(d_customer, "CustomerKey").select(
        F.col("BKCustomerID").alias("client_id"), "CustomerKey")
    via_client = (stg_cards.select(F.col("id").alias("card_id"), "client_id")
                  .join(sized_join(cust, n_customers), "client_id", "left")
                  .select("card_id", "CustomerKey"))
    return card_keys.join(via_client, "card_id", "full")


def fact_transaction(stg: dict, dims: dict, ctx: LoadContext = DEFAULT_CTX,
                     dim_rows: dict | None = None, parts: int | None = None) -> DataFrame:
    """One row per staged transaction, six key lookups, -1 on a miss.
    ``dim_rows`` holds known row counts of the dimensions (else each small
    lookup is counted before it is broadcast); ``parts``: shuffle partitions of
    the one large join, whose lines are hashed then, not sorted."""
    t = stg["transactions"]
    lim = ctx.broadcast_max_rows
    rows = dim_rows or {}
    dd = sized_broadcast(dims["date"].filter(F.col("DateKey") > 0).select("DateKey"), lim,
                         rows.get("date"))
    geo = sized_broadcast(_current(dims["geography"], "GeographyKey")
                          .select("BKGeoCode", "GeographyKey"), lim, rows.get("geography"))
    mcc = sized_broadcast(_current(dims["mcc"], "MccKey").select(
        F.col("BKMccID").alias("mcc"), "MccKey"), lim, rows.get("mcc"))
    tt = sized_broadcast(_current(dims["transaction_type"], "TransactionTypeKey")
                         .select("BKTransTypeCode", "TransactionTypeKey"), lim,
                         rows.get("transaction_type"))
    cards = card_lookup(stg["cards"], dims["card"], dims["customer"], rows.get("customer"))

    if parts:
        cards = cards.hint("shuffle_hash")
    f = (t.select("id", "merchant_id", "amount", "card_id", "mcc",
                  rules.date_key().alias("_dk"), rules.geo_code().alias("_geo"),
                  rules.trans_type_code().alias("_tt"))
          .join(dd, F.col("_dk") == dd.DateKey, "left")
          .join(geo, F.col("_geo") == geo.BKGeoCode, "left")
          .join(mcc, "mcc", "left")
          .join(tt, F.col("_tt") == tt.BKTransTypeCode, "left")
          .select("id", "merchant_id", "amount", "card_id", "DateKey", "GeographyKey", "MccKey",
                  "TransactionTypeKey"))
    f = (f.repartition(parts, "card_id") if parts else f).join(cards, "card_id", "left")
    neg = F.lit(-1)
    return f.select(
        F.coalesce("DateKey", neg).cast("int").alias("DateKey"),
        F.coalesce("CustomerKey", neg).cast("long").alias("CustomerKey"),
        F.coalesce("CardKey", neg).cast("long").alias("CardKey"),
        F.coalesce("GeographyKey", neg).cast("long").alias("GeographyKey"),
        F.coalesce("MccKey", neg).cast("long").alias("MccKey"),
        F.coalesce("TransactionTypeKey", neg).cast("long").alias("TransactionTypeKey"),
        F.lit(ctx.fact_audit).cast("int").alias("InsertAuditKey"),
        F.lit(ctx.fact_audit).cast("int").alias("UpdateAuditKey"),
        F.col("id").alias("BKTransactionID"),
        F.col("merchant_id").alias("BKMerchantID"),
        F.col("amount").cast("decimal(12,2)").alias("Amount"))


class Warehouse:
    """Handles on one warehouse load built from a scale-factor folder.

    With ``materialize`` the staging tables and the fact are written to the
    shared checkpoint folder on first use (the staging and fact writes of the
    load), so later readers scan them instead of recomputing the lineage;
    dimensions are always materialised by their key assignment.
    """

    _cache: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str, ctx: LoadContext = DEFAULT_CTX,
                 materialize: bool = False):
        self.spark, self.sf_dir, self.ctx, self.materialize = spark, sf_dir, ctx, materialize
        self.scope = f"wh_{uuid.uuid4().hex}"  # each load has tables of its own
        stg = staged(spark, sf_dir, ctx)
        if materialize:
            from cardspark.sources.store import write_table
            # the four staging writes are independent: submitted together
            stg = run_concurrently({k: (lambda k=k, v=v: write_table(v, f"{self.scope}/stg_{k}"))
                                    for k, v in stg.items()})
        self.stg = stg
        self._dims: dict = {}
        self._dim_rows: dict = {}
        self._fact = None
        self._fact_by_year = None

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, ctx: LoadContext, stg: dict,
                    dims: dict, fact: DataFrame) -> "Warehouse":
        """Handles on an already written load (staging, dimensions, fact)."""
        wh = cls.__new__(cls)
        wh.spark, wh.sf_dir, wh.ctx, wh.materialize = spark, sf_dir, ctx, False
        wh.scope = None
        wh.stg, wh._dims, wh._fact = stg, dict(dims), fact
        wh._dim_rows = {}
        wh._fact_by_year = None
        return wh

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str, ctx: LoadContext = DEFAULT_CTX):
        """One materialised load per (application, folder, context)."""
        key = (spark.sparkContext.applicationId, sf_dir, ctx)
        if key not in cls._cache:
            cls._cache[key] = cls(spark, sf_dir, ctx, materialize=True)
        return cls._cache[key]

    def dim(self, name: str) -> DataFrame:
        if name not in self._dims:
            build = {"date": lambda: dim_date(self.stg["transactions"], self.ctx),
                     "mcc": lambda: dim_mcc(self.stg["mcc_codes"], self.ctx),
                     "geography": lambda: dim_geography(self.stg["transactions"], self.ctx),
                     "transaction_type": lambda: dim_transaction_type(self.stg["transactions"],
                                                                      self.ctx),
                     "customer": lambda: dim_customer(self.stg["users"], self.ctx),
                     "card": lambda: dim_card(self.stg["cards"], self.ctx)}[name]
            dim = build()
            if self.materialize:
                from cardspark.sources.store import write_table
                dim = write_table(dim, f"{self.scope}/dim_{name}")
            self._dims[name] = dim
        return self._dims[name]

    def dim_rows(self, name: str) -> int:
        """Row count of a dimension of this load (written, so counted once):
        an upper bound on any projection or filter of it."""
        if name not in self._dim_rows:
            self._dim_rows[name] = self.dim(name).count()
        return self._dim_rows[name]

    def dims(self) -> dict:
        """All six dimensions; missing ones are built together (each depends
        only on staging)."""
        missing = [n for n in DIM_NAMES if n not in self._dims]
        run_concurrently({n: (lambda n=n: self.dim(n)) for n in missing})
        return {n: self.dim(n) for n in DIM_NAMES}

    def fact_by_year(self) -> DataFrame:
        """The fact with its partition column Year: a filter on it reads the
        folders of those years alone."""
        f = self.fact()
        return f.withColumn("Year", (F.col("DateKey") / 10000).cast("int")) \
            if self._fact_by_year is None else self._fact_by_year

    def fact(self, materialize: bool = False) -> DataFrame:
        if self._fact is None:
            dims = self.dims()
            looked_up = [n for n in DIM_NAMES if n != "card"]
            # the lookups' row counts, taken together (and kept for later queries)
            run_concurrently({n: (lambda n=n: self.dim_rows(n)) for n in looked_up})
            # written rows are counted from the files' footers
            parts = parts_of(self.spark, self.stg["transactions"].count()) \
                if self.materialize else None
            f = fact_transaction(self.stg, dims, self.ctx,
                                 {n: self.dim_rows(n) for n in looked_up}, parts)
            if self.materialize:
                from cardspark.sources.store import table_path
                path = table_path(self.spark, f"{self.scope}/fact_transaction")
                write_fact(f, path, self.ctx, parts)
                self._fact_by_year = self.spark.read.parquet(path)
                f = self._fact_by_year.drop("Year")
            elif materialize:
                f = f.checkpoint(eager=True)
            self._fact = f
        return self._fact


DIM_NAMES = ["date", "mcc", "geography", "transaction_type", "customer", "card"]
DIM_KEYS = {"date": "DateKey", "mcc": "MccKey", "geography": "GeographyKey",
            "transaction_type": "TransactionTypeKey", "customer": "CustomerKey",
            "card": "CardKey"}
DIM_BKS = {"mcc": "BKMccID", "geography": "BKGeoCode", "transaction_type": "BKTransTypeCode",
           "customer": "BKCustomerID", "card": "BKCardID"}
DIM_TABLES = {"date": "DimDate", "mcc": "DimMcc", "geography": "DimGeography",
              "transaction_type": "DimTransactionType", "customer": "DimCustomer",
              "card": "DimCard"}


def write_fact(fact: DataFrame, path: str, ctx: LoadContext = DEFAULT_CTX,
               parts: int | None = None) -> None:
    """The fact partitioned by year, range-ordered on DateKey inside,
    so date filters prune folders and row groups carry tight DateKey stats.
    The transaction id is the last range key: a busy day is split too. The year
    follows from the day, and the audit keys are those of ``ctx``: they are added
    behind the shuffle. ``parts``: its partitions, if not the session's."""
    by = ("DateKey", "BKTransactionID")
    audit = F.lit(ctx.fact_audit).cast("int")
    f = fact.drop("InsertAuditKey", "UpdateAuditKey")
    f = f.repartitionByRange(parts, *by) if parts else f.repartitionByRange(*by)
    (f.withColumns({"InsertAuditKey": audit, "UpdateAuditKey": audit,
                    "Year": (F.col("DateKey") / 10000).cast("int")})
      .select(*fact.columns, "Year").sortWithinPartitions("Year", *by)
      .write.mode("errorifexists").option("compression", CODEC).partitionBy("Year").parquet(path))
