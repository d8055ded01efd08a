"""Registered warehouse queries: staging, dimensions, fact, views, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.plans import verify
from cardspark.plans.registry import register
from cardspark.plans.warehouse import DEFAULT_CTX, Warehouse
from cardspark.plans.warehouse_sql import warehouse_ctes

CTES = warehouse_ctes(DEFAULT_CTX)
_SRC_COLS = {
    "users": ["id", "current_age", "retirement_age", "birth_year", "birth_month", "gender",
              "address", "latitude", "longitude", "per_capita_income", "yearly_income", "total_debt", "credit_score",
              "num_credit_cards"],
    "cards": ["id", "client_id", "card_brand", "card_type", "card_number", "expires", "cvv",
              "has_chip", "num_cards_issued", "credit_limit", "acct_open_date",
              "year_pin_last_changed"],
    "transactions": ["id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id",
                     "merchant_city", "merchant_state", "zip", "mcc", "errors"],
    "mcc_codes": ["mcc_id", "description"],
}
_STG_SQL = {"users": "stg_users", "cards": "stg_cards", "transactions": "stg_transactions",
            "mcc_codes": "stg_mcc"}


def _wh(spark, sf_dir):
    return Warehouse.get(spark, sf_dir, DEFAULT_CTX)


# ------------------------------------------------------------------- S2 ----
def _stage_query(table: str):
    cols = _SRC_COLS[table] + ["StgLoadDate", "StgAuditKey"]

    @register(f"stage_{'mcc' if table == 'mcc_codes' else table}",
              f"SELECT {', '.join(cols)} FROM {_STG_SQL[table]}", CTES)
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _wh(spark, sf_dir).stg[table].select(*cols)
    return q


for _t in _SRC_COLS:
    _stage_query(_t)


# ------------------------------------------------------------ D1-D6, D7 ----
def _dim_query(name: str, sql_name: str):
    @register(sql_name, f"SELECT * FROM {sql_name}", CTES)
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _wh(spark, sf_dir).dim(name)
    return q


for _d in ["date", "mcc", "geography", "transaction_type", "customer", "card"]:
    _dim_query(_d, verify.SQL_DIM[_d])


@register("fact_transaction", "SELECT * FROM fact", CTES)
def fact_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wh(spark, sf_dir).fact()


# ------------------------------------------------------------------- S7 ----
# The user-facing column names of the reference's views.
DISPLAY_NAMES = {
    "date": {"DateKey": "Date Key", "FullDate": "Full Date", "Year": "Year",
             "Quarter": "Quarter", "QuarterName": "Quarter Name", "MonthNumber": "Month Number",
             "MonthName": "Month Name", "MonthYear": "Month Year", "DayOfMonth": "Day Of Month",
             "DayName": "Day Name", "IsWeekend": "Is Weekend"},
    "customer": {"CustomerKey": "Customer Key", "BKCustomerID": "Customer ID", "Gender": "Gender",
                 "CurrentAge": "Current Age", "AgeGroup": "Age Group", "BirthYear": "Birth Year",
                 "PerCapitaIncome": "Per Capita Income", "YearlyIncome": "Yearly Income",
                 "IncomeBand": "Income Band", "TotalDebt": "Total Debt",
                 "DebtToIncome": "Debt To Income", "CreditScore": "Credit Score",
                 "CreditBand": "Credit Band", "NumCreditCards": "Num Credit Cards",
                 "RowIsCurrent": "Row Is Current", "RowStartDate": "Row Start Date",
                 "RowEndDate": "Row End Date", "RowChangeReason": "Row Change Reason",
                 "InsertAuditKey": "InsertAuditKey", "UpdateAuditKey": "UpdateAuditKey"},
    "card": {"CardKey": "Card Key", "BKCardID": "Card ID", "CardBrand": "Card Brand",
             "CardType": "Card Type", "CreditLimit": "Credit Limit",
             "CreditLimitBand": "Credit Limit Band", "HasChip": "Has Chip",
             "NumCardsIssued": "Num Cards Issued", "AcctOpenDate": "Acct Open Date",
             "RowIsCurrent": "Row Is Current", "RowStartDate": "Row Start Date",
             "RowEndDate": "Row End Date", "RowChangeReason": "Row Change Reason",
             "InsertAuditKey": "InsertAuditKey", "UpdateAuditKey": "UpdateAuditKey"},
    "geography": {"GeographyKey": "Geography Key", "BKGeoCode": "Geo Code", "City": "City",
                  "State": "State", "Zip": "Zip", "IsOnline": "Is Online",
                  "RowIsCurrent": "Row Is Current", "RowStartDate": "Row Start Date",
                  "RowEndDate": "Row End Date", "RowChangeReason": "Row Change Reason",
                  "InsertAuditKey": "InsertAuditKey", "UpdateAuditKey": "UpdateAuditKey"},
    "mcc": {"MccKey": "MCC Key", "BKMccID": "MCC ID", "MccDescription": "MCC Description",
            "RowIsCurrent": "Row Is Current", "RowStartDate": "Row Start Date",
            "RowEndDate": "Row End Date", "RowChangeReason": "Row Change Reason",
            "InsertAuditKey": "InsertAuditKey", "UpdateAuditKey": "UpdateAuditKey"},
    "transaction_type": {"TransactionTypeKey": "Transaction Type Key",
                         "BKTransTypeCode": "Trans Type Code", "EntryMode": "Entry Mode",
                         "IsSuccess": "Is Success", "ErrorType": "Error Type",
                         "IsOnlineEntry": "Is Online Entry", "RowIsCurrent": "Row Is Current",
                         "RowStartDate": "Row Start Date", "RowEndDate": "Row End Date",
                         "RowChangeReason": "Row Change Reason",
                         "InsertAuditKey": "InsertAuditKey", "UpdateAuditKey": "UpdateAuditKey"},
    "audit": {"AuditKey": "AuditKey", "ParentAuditKey": "ParentAuditKey",
              "PackageName": "Package Name", "PackageVersion": "Package Version",
              "ExecutionStartTime": "Execution Start Time",
              "ExecutionEndTime": "Execution End Time", "ExecutionStatus": "Execution Status",
              "RowsInserted": "Rows Inserted", "RowsUpdated": "Rows Updated",
              "RowsDeleted": "Rows Deleted"},
    "fact": {"DateKey": "Date Key", "CustomerKey": "Customer Key", "CardKey": "Card Key",
             "GeographyKey": "Geography Key", "MccKey": "MCC Key",
             "TransactionTypeKey": "Transaction Type Key", "InsertAuditKey": "Insert Audit Key",
             "UpdateAuditKey": "Update Audit Key", "BKTransactionID": "Transaction ID",
             "BKMerchantID": "Merchant ID", "Amount": "Amount"},
}
_VIEW_SRC_SQL = {**verify.SQL_DIM, "audit": "audit_log", "fact": "fact"}
AUDIT_CTES = CTES + [("audit_log", verify.audit_log_sql(DEFAULT_CTX))]


def display_view(df: DataFrame, names: dict) -> DataFrame:
    """Rename to user-facing names (a projection, no data movement)."""
    return df.select(*[F.col(c).alias(n) for c, n in names.items()])


def _view_query(name: str):
    names = DISPLAY_NAMES[name]
    sql = "SELECT " + ", ".join(f'{c} AS "{n}"' for c, n in names.items()) + \
        f" FROM {_VIEW_SRC_SQL[name]}"

    @register(f"dw_view_{name}", sql, AUDIT_CTES)
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = _wh(spark, sf_dir)
        src = {"audit": lambda: verify.audit_log(wh), "fact": wh.fact}.get(
            name, lambda: wh.dim(name))()
        return display_view(src, names)
    return q


for _v in DISPLAY_NAMES:
    _view_query(_v)


def register_views(wh: Warehouse, prefix: str = "vw_") -> list[str]:
    """The eight display views of a load as temporary views, for SQL text."""
    out = []
    for name, names in DISPLAY_NAMES.items():
        src = verify.audit_log(wh) if name == "audit" else \
            wh.fact() if name == "fact" else wh.dim(name)
        display_view(src, names).createOrReplaceTempView(f"{prefix}{name}")
        out.append(f"{prefix}{name}")
    return out


@register("dw_views_sql", """
SELECT d.CardType AS card_type, COUNT(*) AS n, CAST(SUM(f.Amount) AS DECIMAL(38,2)) AS amount
FROM fact f JOIN dim_card d ON d.CardKey = f.CardKey GROUP BY 1""", AUDIT_CTES)
def dw_views_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question in SQL text over the display views."""
    register_views(_wh(spark, sf_dir))
    return spark.sql("""
        SELECT c.`Card Type` AS card_type, COUNT(*) AS n,
               CAST(SUM(f.`Amount`) AS DECIMAL(38,2)) AS amount
        FROM vw_fact f JOIN vw_card c ON c.`Card Key` = f.`Card Key` GROUP BY 1""")


# ---------------------------------------------------------- D8, V1-V43 ----
@register("audit_log", "SELECT * FROM audit_log", AUDIT_CTES)
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.audit_log(_wh(spark, sf_dir))


VERIFY_CTES = AUDIT_CTES + [("m", verify.metrics_sql()), ("report", verify.report_sql())]


@register("verify_report", "SELECT * FROM report", VERIFY_CTES)
def verify_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


def _report(spark, sf_dir) -> DataFrame:
    """The check report of this load, computed once (42 rows, checkpointed)."""
    wh = _wh(spark, sf_dir)
    if getattr(wh, "_report", None) is None:
        wh._report = verify.verify_report(wh).checkpoint(eager=True)
    return wh._report


@register("verify_summary", verify.summary_sql(), VERIFY_CTES)
def verify_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.verify_summary(_report(spark, sf_dir))


@register("contract_nulls", verify.contract_nulls_sql(), CTES)
def contract_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.contract_nulls(_wh(spark, sf_dir))


@register("contract_widths", verify.contract_widths_sql(), CTES)
def contract_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.contract_widths(_wh(spark, sf_dir))
