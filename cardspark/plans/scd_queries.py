"""SCD-2 / SCD-1 on DimCustomer with the second users snapshot, and the
as-of (type-2) customer lookup of the fact (D12, D13, J13)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.operators.scd import asof_lookup, scd1_overwrite, scd2_feed, scd2_merge
from cardspark.plans.registry import register
from cardspark.plans.warehouse import (LoadContext, card_attributes, customer_attributes,
                                       dim_card, dim_customer, stage)
from cardspark.plans.warehouse_sql import warehouse_ctes
from cardspark.sources.tables import Sources

# The initial version is effective from the start of the history and the
# second snapshot from 1996-01-01, inside the test data's years, so the
# as-of lookup splits each changed customer's transactions between versions.
INITIAL_CTX = LoadContext(as_of=dt.datetime(1900, 1, 1))
SNAPSHOT_AS_OF = dt.datetime(1996, 1, 1)
SNAPSHOT_AUDIT = 4

# Per-column SCD types of DimCustomer.
CUSTOMER_TYPE1 = ["Gender", "CurrentAge", "AgeGroup", "BirthYear", "NumCreditCards"]
CUSTOMER_TYPE2 = ["PerCapitaIncome", "YearlyIncome", "IncomeBand", "TotalDebt", "DebtToIncome",
                  "CreditScore", "CreditBand"]


def _initial_dim(spark, sf_dir) -> DataFrame:
    users = stage(Sources(spark, sf_dir).users(), INITIAL_CTX)
    return dim_customer(users, INITIAL_CTX)


def customer_v2(spark, sf_dir) -> DataFrame:
    dim = _initial_dim(spark, sf_dir)
    inc = customer_attributes(Sources(spark, sf_dir).users_v2())
    return scd2_merge(dim, inc, "BKCustomerID", "CustomerKey", CUSTOMER_TYPE1, CUSTOMER_TYPE2,
                      SNAPSHOT_AS_OF, SNAPSHOT_AUDIT)


# ------------------------------------------------------------- SQL side ----
def _cust_v1_sql() -> str:
    ctes = dict(warehouse_ctes(INITIAL_CTX))
    return ctes["dim_customer"].replace("FROM stg_users", "FROM users")


def _attrs_sql(src: str) -> str:
    from cardspark.plans import warehouse_sql as w
    return (f"SELECT id AS BKCustomerID, gender AS Gender, current_age AS CurrentAge, "
            f"{w.AGE_GROUP} AS AgeGroup, birth_year AS BirthYear, "
            f"per_capita_income AS PerCapitaIncome, yearly_income AS YearlyIncome, "
            f"{w.INCOME_BAND} AS IncomeBand, total_debt AS TotalDebt, "
            f"{w.DEBT_TO_INCOME} AS DebtToIncome, credit_score AS CreditScore, "
            f"{w.CREDIT_BAND} AS CreditBand, num_credit_cards AS NumCreditCards FROM {src}")


_CUST_COLS = ["CustomerKey", "BKCustomerID", "Gender", "CurrentAge", "AgeGroup", "BirthYear",
              "PerCapitaIncome", "YearlyIncome", "IncomeBand", "TotalDebt", "DebtToIncome",
              "CreditScore", "CreditBand", "NumCreditCards", "RowIsCurrent", "RowStartDate",
              "RowEndDate", "RowChangeReason", "InsertAuditKey", "UpdateAuditKey"]


def _customer() -> "_Dim":
    return _Dim("BKCustomerID", "CustomerKey", CUSTOMER_TYPE1, _CUST_COLS, _cust_v1_sql(),
                _attrs_sql("users_v2"))


@dataclass(frozen=True)
class _Dim:
    """What the merge twin needs to know of a dimension."""
    bk: str
    key: str
    type1: list
    cols: list
    first: str  # SQL of the initial load
    snapshot: str  # SQL of the second snapshot's attributes


def _merge_sql(type2: list[str], dim: _Dim | None = None) -> list[tuple[str, str]]:
    dim = dim or _customer()
    bk, key = dim.bk, dim.key
    ts = f"TIMESTAMP '{SNAPSHOT_AS_OF:%Y-%m-%d %H:%M:%S}'"
    changed = (f"(n.{bk} IS NOT NULL AND e.RowIsCurrent = 'Y' AND ("
               + (" OR ".join(f"e.{c} IS DISTINCT FROM n.{c}" for c in type2) or "false") + "))")
    t1 = (f"(n.{bk} IS NOT NULL AND ("
          + " OR ".join(f"e.{c} IS DISTINCT FROM n.{c}" for c in dim.type1) + "))")
    sel = []
    for c in dim.cols:
        if c in dim.type1:
            sel.append(f"CASE WHEN n.{bk} IS NOT NULL THEN n.{c} ELSE e.{c} END AS {c}")
        elif c == "RowIsCurrent":
            sel.append(f"CASE WHEN {changed} THEN 'N' ELSE e.RowIsCurrent END AS RowIsCurrent")
        elif c == "RowEndDate":
            sel.append(f"CASE WHEN {changed} THEN {ts} ELSE e.RowEndDate END AS RowEndDate")
        elif c == "UpdateAuditKey":
            sel.append(f"CASE WHEN {changed} OR {t1} THEN CAST({SNAPSHOT_AUDIT} AS INT) "
                       f"ELSE e.UpdateAuditKey END AS UpdateAuditKey")
        else:
            sel.append(f"e.{c}")
    diff = " OR ".join(f"i.{c} IS DISTINCT FROM c.{c}" for c in type2) or "false"
    reasons = ", ".join(f"CASE WHEN i.{c} IS DISTINCT FROM c.{c} THEN '{c}' END" for c in type2)
    reason = (f"CASE WHEN c.{bk} IS NULL THEN 'New' ELSE "
              + (f"'Changed: ' || concat_ws(', ', {reasons})" if type2 else "'Changed: '")
              + " END")
    attrs = [c for c in dim.cols if c not in (key, "RowIsCurrent", "RowStartDate",
                                                 "RowEndDate", "RowChangeReason",
                                                 "InsertAuditKey", "UpdateAuditKey")]
    return [
        ("dim_v1", dim.first),
        ("inc", dim.snapshot),
        ("existing", f"SELECT * FROM dim_v1 WHERE {key} > 0"),
        ("updated", f"SELECT {', '.join(sel)} FROM existing e "
                    f"LEFT JOIN inc n ON n.{bk} = e.{bk}"),
        ("opened", f"SELECT i.*, {reason} AS RowChangeReason FROM inc i LEFT JOIN "
                   f"(SELECT * FROM existing WHERE RowIsCurrent = 'Y') c "
                   f"ON c.{bk} = i.{bk} WHERE c.{bk} IS NULL OR ({diff})"),
        ("fresh", f"SELECT (SELECT MAX({key}) FROM existing) + row_number() OVER "
                  f"(ORDER BY {bk}) AS {key}, {', '.join(attrs)}, "
                  f"'Y' AS RowIsCurrent, {ts} AS RowStartDate, "
                  f"TIMESTAMP '9999-12-31 00:00:00' AS RowEndDate, RowChangeReason, "
                  f"CAST({SNAPSHOT_AUDIT} AS INT) AS InsertAuditKey, "
                  f"CAST({SNAPSHOT_AUDIT} AS INT) AS UpdateAuditKey FROM opened"),
        ("merged", f"SELECT * FROM dim_v1 WHERE {key} = -1 UNION ALL "
                   f"SELECT {', '.join(dim.cols)} FROM updated UNION ALL "
                   f"SELECT {', '.join(dim.cols)} FROM fresh"),
    ]


@register("scd2_customer", "SELECT * FROM merged", _merge_sql(CUSTOMER_TYPE2))
def scd2_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DimCustomer after merging the second users snapshot."""
    return customer_v2(spark, sf_dir)


@register("scd1_customer", "SELECT * FROM dim_v1 WHERE CustomerKey = -1 UNION ALL "
                           f"SELECT {', '.join(_CUST_COLS)} FROM updated",
          _merge_sql([]))
def scd1_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-1 columns of the second snapshot overwritten in place."""
    dim = _initial_dim(spark, sf_dir)
    inc = customer_attributes(Sources(spark, sf_dir).users_v2())
    return scd1_overwrite(dim, inc, "BKCustomerID", "CustomerKey", CUSTOMER_TYPE1,
                          SNAPSHOT_AUDIT)


@register("fact_asof_scd2", """
SELECT t.id AS BKTransactionID, t.date AS txn_time, t.card_id,
       COALESCE(d.CustomerKey, -1) AS CustomerKey
FROM transactions t
LEFT JOIN cards sc ON sc.id = t.card_id
LEFT JOIN merged d ON d.BKCustomerID = sc.client_id AND d.CustomerKey > 0
     AND t.date >= d.RowStartDate AND t.date < d.RowEndDate""", _merge_sql(CUSTOMER_TYPE2))
def fact_asof_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each transaction's customer version as of the transaction time
    (business key through the card, then the validity range)."""
    s = Sources(spark, sf_dir)
    t = s.transactions().select(F.col("id").alias("BKTransactionID"),
                                F.col("date").alias("txn_time"), "card_id")
    cards = s.cards().select(F.col("id").alias("card_id"), "client_id")
    tc = t.join(cards, "card_id", "left")
    out = asof_lookup(tc, "client_id", "txn_time", customer_v2(spark, sf_dir), "BKCustomerID",
                      "CustomerKey")
    return out.select("BKTransactionID", "txn_time", "card_id", "CustomerKey")


# ------------------------------------------------------------ change feed ----
FEED_AUDIT = 5
# Per row of the feed: moment, sequence, which users, new id, score and income.
_FEED = [
    ("1997-03-01", 1, "id % 20 = 0", "id", "credit_score + 40", "yearly_income"),
    ("1998-06-01", 2, "id % 20 = 0", "id", "credit_score + 40", "yearly_income + 1000"),
    ("1994-05-01", 3, "id % 10 = 0", "id", "credit_score - 10", "yearly_income"),  # late
    ("1999-01-01", 4, "id % 15 = 0", "id", "credit_score - 5", "yearly_income"),
    ("1999-01-01", 5, "id % 30 = 0", "id", "credit_score + 5", "yearly_income"),  # the same moment
    ("1996-01-01", 6, "id % 40 = 0", "id", "credit_score + 7", "yearly_income"),  # a version's start
    ("1995-02-01", 7, "id % 21 = 0", "id", "credit_score", "yearly_income"),  # changes nothing
    ("1997-01-01", 8, "id % 50 = 0", "id + 100000000", "credit_score", "yearly_income"),  # new keys
]
_FEED_USERS = (
    "SELECT {id} AS id, current_age, retirement_age, birth_year, birth_month, gender, address, "
    "latitude, longitude, per_capita_income, CAST({income} AS DECIMAL(12,2)) AS yearly_income, "
    "total_debt, CAST({score} AS INT) AS credit_score, num_credit_cards, "
    "{at} AS EffectiveAt, {seq} AS Seq FROM {users} WHERE {where}")


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of customers at several moments, as one feed."""
    users = Sources(spark, sf_dir).users()
    parts = []
    for at, seq, where, id_, score, income in _FEED:
        u = users.filter(where).withColumns({
            "id": F.expr(id_), "credit_score": F.expr(f"CAST({score} AS INT)"),
            "yearly_income": F.expr(f"CAST({income} AS DECIMAL(12,2))")})
        parts.append(customer_attributes(u).withColumns({
            "EffectiveAt": F.lit(f"{at} 00:00:00").cast("timestamp_ntz"), "Seq": F.lit(seq)}))
    return reduce(DataFrame.unionByName, parts)


def _feed_sql() -> list[tuple[str, str]]:
    users = " UNION ALL ".join(
        _FEED_USERS.format(id=i, income=inc, score=sc, at=f"TIMESTAMP '{at} 00:00:00'", seq=seq,
                           users="users", where=where) for at, seq, where, i, sc, inc in _FEED)
    attrs = _attrs_sql("feed_users").replace(" FROM feed_users", ", EffectiveAt, Seq FROM feed_users")
    t2 = CUSTOMER_TYPE2
    same = " AND ".join(f"l.{c} IS NOT DISTINCT FROM l.b_{c}" for c in t2)
    diffs = ", ".join(f"CASE WHEN {c} IS DISTINCT FROM b_{c} THEN '{c}' END" for c in t2)
    fixed = "(CustomerKey IS NOT NULL AND said AND (" + " OR ".join(
        f"{c} IS DISTINCT FROM e_{c}" for c in t2) + "))"
    t1 = " OR ".join(f"n_{c} IS DISTINCT FROM e_{c}" for c in CUSTOMER_TYPE1)
    return [*_merge_sql(t2), ("feed_users", users), ("feed", attrs),
            ("said", "SELECT * FROM feed QUALIFY row_number() OVER "
                     "(PARTITION BY BKCustomerID, EffectiveAt ORDER BY Seq DESC) = 1"),
            ("latest", "SELECT * FROM said QUALIFY row_number() OVER "
                       "(PARTITION BY BKCustomerID ORDER BY EffectiveAt DESC) = 1"),
            ("old", "SELECT * FROM merged WHERE CustomerKey > 0 AND BKCustomerID IN "
                    "(SELECT BKCustomerID FROM said)"),
            ("listed", "SELECT COALESCE(f.BKCustomerID, e.BKCustomerID) AS BKCustomerID, "
                       "COALESCE(EffectiveAt, RowStartDate) AS RowStartDate, CustomerKey, RowEndDate, "
                       "RowChangeReason, InsertAuditKey, UpdateAuditKey, EffectiveAt IS NOT NULL AS said, "
                       + ", ".join(f"CASE WHEN EffectiveAt IS NOT NULL THEN f.{c} ELSE e.{c} END AS {c}, "
                                   f"e.{c} AS e_{c}" for c in t2) + ", "
                       + ", ".join(f"e.{c} AS e_{c}" for c in CUSTOMER_TYPE1)
                       + " FROM old e FULL JOIN said f ON f.BKCustomerID = e.BKCustomerID "
                         "AND f.EffectiveAt = e.RowStartDate"),
            ("lagged", "SELECT *, row_number() OVER w = 1 AS is_first, "
                       + ", ".join(f"lag({c}) OVER w AS b_{c}" for c in t2)
                       + " FROM listed WINDOW w AS (PARTITION BY BKCustomerID ORDER BY RowStartDate)"),
            ("kept", "SELECT l.* EXCLUDE (RowEndDate), RowEndDate AS e_end, "
                     "COALESCE(lead(RowStartDate) OVER (PARTITION BY l.BKCustomerID ORDER BY RowStartDate), "
                     "TIMESTAMP '9999-12-31 00:00:00') AS RowEndDate, "
                     + ", ".join(f"n.{c} AS n_{c}" for c in CUSTOMER_TYPE1)
                     + f" FROM lagged l JOIN latest n ON n.BKCustomerID = l.BKCustomerID "
                       f"WHERE CustomerKey IS NOT NULL OR is_first OR NOT ({same})"),
            ("fed", "SELECT COALESCE(CustomerKey, (SELECT MAX(CustomerKey) FROM merged) + row_number() OVER "
                    "(PARTITION BY CustomerKey IS NULL ORDER BY BKCustomerID, RowStartDate)) AS CustomerKey, "
                    "BKCustomerID, " + ", ".join(f"n_{c} AS {c}" for c in CUSTOMER_TYPE1) + ", "
                    + ", ".join(t2) + ", CASE WHEN RowEndDate = TIMESTAMP '9999-12-31 00:00:00' THEN 'Y' "
                    "ELSE 'N' END AS RowIsCurrent, RowStartDate, RowEndDate, "
                    f"CASE WHEN {fixed} THEN 'Corrected' WHEN CustomerKey IS NOT NULL THEN RowChangeReason "
                    f"WHEN is_first THEN 'New' ELSE 'Changed: ' || concat_ws(', ', {diffs}) END AS RowChangeReason, "
                    f"COALESCE(InsertAuditKey, CAST({FEED_AUDIT} AS INT)) AS InsertAuditKey, "
                    f"CASE WHEN CustomerKey IS NOT NULL AND NOT ({fixed} OR RowEndDate <> e_end OR {t1}) "
                    f"THEN UpdateAuditKey ELSE CAST({FEED_AUDIT} AS INT) END AS UpdateAuditKey FROM kept")]


@register("scd2_feed_customer", f"""
SELECT {', '.join(_CUST_COLS)} FROM merged
WHERE CustomerKey <= 0 OR BKCustomerID NOT IN (SELECT BKCustomerID FROM said)
UNION ALL SELECT {', '.join(_CUST_COLS)} FROM fed""", _feed_sql())
def scd2_feed_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DimCustomer after a feed of several changes a key, some of them late."""
    return scd2_feed(customer_v2(spark, sf_dir), customer_feed(spark, sf_dir), "BKCustomerID",
                     "CustomerKey", CUSTOMER_TYPE1, CUSTOMER_TYPE2, FEED_AUDIT)


# ----------------------------------------------------------------- DimCard ----
# Per-column SCD types of DimCard.
CARD_TYPE1 = ["CardBrand", "CardType", "HasChip", "NumCardsIssued", "AcctOpenDate"]
CARD_TYPE2 = ["CreditLimit", "CreditLimitBand"]
_CARD_COLS = ["CardKey", "BKCardID", "CardBrand", "CardType", "CreditLimit", "CreditLimitBand",
              "HasChip", "NumCardsIssued", "AcctOpenDate", "RowIsCurrent", "RowStartDate",
              "RowEndDate", "RowChangeReason", "InsertAuditKey", "UpdateAuditKey"]
CARDS_V2_SQL = """
SELECT id, client_id, card_brand, card_type,
       CASE WHEN id % 2 = 0 THEN CASE has_chip WHEN 'YES' THEN 'NO' ELSE 'YES' END ELSE has_chip END AS has_chip,
       num_cards_issued,
       CAST(CASE WHEN id % 9 = 0 THEN credit_limit + 5000 ELSE credit_limit END AS DECIMAL(12,2)) AS credit_limit,
       acct_open_date
FROM cards"""


def cards_v2(spark, sf_dir) -> DataFrame:
    """Second cards snapshot: every 9th card has a higher limit (type 2), every
    2nd one a new chip flag (type 1)."""
    c = Sources(spark, sf_dir).cards()
    return c.withColumns({
        "credit_limit": F.when(F.pmod("id", F.lit(9)) == 0, F.col("credit_limit") + 5000)
                         .otherwise(F.col("credit_limit")).cast("decimal(12,2)"),
        "has_chip": F.when(F.pmod("id", F.lit(2)) == 0, F.when(F.col("has_chip") == "YES", "NO")
                           .otherwise("YES")).otherwise(F.col("has_chip"))})


def _card() -> _Dim:
    from cardspark.plans import warehouse_sql as w
    first = dict(warehouse_ctes(INITIAL_CTX))["dim_card"].replace("FROM stg_cards", "FROM cards")
    snapshot = (f"SELECT id AS BKCardID, card_brand AS CardBrand, card_type AS CardType, "
                f"credit_limit AS CreditLimit, {w.LIMIT_BAND} AS CreditLimitBand, "
                f"COALESCE(has_chip = 'YES', false) AS HasChip, num_cards_issued AS "
                f"NumCardsIssued, acct_open_date AS AcctOpenDate FROM ({CARDS_V2_SQL})")
    return _Dim("BKCardID", "CardKey", CARD_TYPE1, _CARD_COLS, first, snapshot)


@register("scd2_card", "SELECT * FROM merged", _merge_sql(CARD_TYPE2, _card()))
def scd2_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D12 for DimCard: the second cards snapshot merged."""
    dim = dim_card(stage(Sources(spark, sf_dir).cards(), INITIAL_CTX), INITIAL_CTX)
    return scd2_merge(dim, card_attributes(cards_v2(spark, sf_dir)), "BKCardID", "CardKey",
                      CARD_TYPE1, CARD_TYPE2, SNAPSHOT_AS_OF, SNAPSHOT_AUDIT)


@register("scd1_card", "SELECT * FROM dim_v1 WHERE CardKey = -1 UNION ALL "
                       f"SELECT {', '.join(_CARD_COLS)} FROM updated", _merge_sql([], _card()))
def scd1_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D13 for DimCard: type-1 columns overwritten in place."""
    dim = dim_card(stage(Sources(spark, sf_dir).cards(), INITIAL_CTX), INITIAL_CTX)
    return scd1_overwrite(dim, card_attributes(cards_v2(spark, sf_dir)), "BKCardID", "CardKey",
                          CARD_TYPE1, SNAPSHOT_AUDIT)
