"""Source tables: the four bank tables, plus the second users snapshot and the
deterministic score table, derived from the driver's parquet tables.

Every reader returns a lazy DataFrame over a parquet scan, so Catalyst prunes
columns and pushes filters into the scan; nothing is materialised here. The
mapping rules are the ones in FIXTURES.md (section B) and must stay exactly as
written there, since the DuckDB oracle runs the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# S3: staged source schemas. Keys are long: order keys pass 2 ** 31 below a
# terabyte of source data.
USERS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("current_age", T.IntegerType()),
    T.StructField("retirement_age", T.IntegerType()),
    T.StructField("birth_year", T.IntegerType()),
    T.StructField("birth_month", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("latitude", T.StringType()),
    T.StructField("longitude", T.StringType()),
    T.StructField("per_capita_income", T.DecimalType(12, 2)),
    T.StructField("yearly_income", T.DecimalType(12, 2)),
    T.StructField("total_debt", T.DecimalType(12, 2)),
    T.StructField("credit_score", T.IntegerType()),
    T.StructField("num_credit_cards", T.IntegerType()),
])

CARDS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("client_id", T.LongType(), False),
    T.StructField("card_brand", T.StringType()),
    T.StructField("card_type", T.StringType()),
    T.StructField("card_number", T.StringType()),
    T.StructField("expires", T.DateType()),
    T.StructField("cvv", T.StringType()),
    T.StructField("has_chip", T.StringType()),
    T.StructField("num_cards_issued", T.IntegerType()),
    T.StructField("credit_limit", T.DecimalType(12, 2)),
    T.StructField("acct_open_date", T.DateType()),
    T.StructField("year_pin_last_changed", T.IntegerType()),
])

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("client_id", T.LongType()),
    T.StructField("card_id", T.LongType(), False),
    T.StructField("amount", T.DecimalType(10, 2)),
    T.StructField("use_chip", T.StringType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("merchant_city", T.StringType()),
    T.StructField("merchant_state", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("mcc", T.LongType(), False),
    T.StructField("errors", T.StringType()),
])

MCC_SCHEMA = T.StructType([
    T.StructField("mcc_id", T.LongType(), False),
    T.StructField("description", T.StringType()),
])

SOURCE_SCHEMAS = {
    "users": USERS_SCHEMA,
    "cards": CARDS_SCHEMA,
    "transactions": TRANSACTIONS_SCHEMA,
    "mcc_codes": MCC_SCHEMA,
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Shuffle partitions for each partition that a scan is read in (128 MB of Parquet
# at most): a task then sorts some 16 MB of it, whatever the table's size.
SPREAD = 8


def spread_parts(scan: DataFrame) -> int:
    """Shuffle partitions for the rows of ``scan`` (a scan with narrow steps):
    they grow in number with its size, and are never fewer than the session's."""
    least = int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, SPREAD * scan.rdd.getNumPartitions())


# Rows of a partition that is sorted or hashed (some 50 MB of a fact's rows).
PART_ROWS = 500_000


def parts_of(spark: SparkSession, rows: int) -> int | None:
    """Shuffle partitions for so many rows; None if the session's are enough."""
    n = -(-rows // PART_ROWS)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """``scan`` shuffled by ``keys``, so that the sorts after it stay in memory."""
    return scan.repartition(spread_parts(scan), *keys)


def _mod(col, m):
    return F.pmod(col, F.lit(m))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("long")
    age = 18 + _mod(k * 31, 70)
    return raw(spark, sf_dir, "customer").select(
        k.alias("id"),
        age.cast("int").alias("current_age"),
        (60 + _mod(k, 11)).cast("int").alias("retirement_age"),
        (2024 - age).cast("int").alias("birth_year"),
        (1 + _mod(k, 12)).cast("int").alias("birth_month"),
        F.when(_mod(k, 2) == 0, "Female").otherwise("Male").alias("gender"),
        F.concat(_mod(k * 13, 9999).cast("string"), F.lit(" "), F.col("c_mktsegment"),
                 F.lit(" Street")).alias("address"),
        F.concat((25 + _mod(k, 25)).cast("string"), F.lit("."),
                 (10 + _mod(k * 3, 90)).cast("string")).alias("latitude"),
        F.concat(F.lit("-"), (70 + _mod(k, 50)).cast("string"), F.lit("."),
                 (10 + _mod(k * 7, 90)).cast("string")).alias("longitude"),
        (20000 + _mod(k * 97, 30000)).cast("decimal(12,2)").alias("per_capita_income"),
        F.when(_mod(k, 101) == 0, F.lit(0)).otherwise(12000 + _mod(k * 7919, 140001))
         .cast("decimal(12,2)").alias("yearly_income"),
        _mod(k * 104729, 200000).cast("decimal(12,2)").alias("total_debt"),
        (480 + _mod(k * 37, 371)).cast("int").alias("credit_score"),
        (1 + _mod(k, 9)).cast("int").alias("num_credit_cards"),
    )


def users_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second users snapshot for SCD tests: every 10th user changes a type-2
    column (credit_score + 25), every 7th a type-1 column (num_credit_cards + 1)."""
    u = users(spark, sf_dir)
    return u.withColumns({
        "credit_score": F.when(_mod(F.col("id"), 10) == 0, F.col("credit_score") + 25)
                         .otherwise(F.col("credit_score")).cast("int"),
        "num_credit_cards": F.when(_mod(F.col("id"), 7) == 0, F.col("num_credit_cards") + 1)
                             .otherwise(F.col("num_credit_cards")).cast("int"),
    })


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey").cast("long")
    prio = F.substring("o_orderpriority", 1, 1)
    return raw(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.col("o_custkey").cast("long").alias("client_id"),
        F.when(prio == "1", "Amex").when(prio == "2", "Discover")
         .when(prio == "3", "Mastercard").otherwise("Visa").alias("card_brand"),
        F.when(F.col("o_orderstatus") == "O", "Credit")
         .when(F.col("o_orderstatus") == "F", "Debit")
         .otherwise("Debit (Prepaid)").alias("card_type"),
        (F.lit(4_000_000_000_000_000) + k * 7919).cast("string").alias("card_number"),
        F.make_date((2000 + _mod(k, 10)).cast("int"), (1 + _mod(k, 12)).cast("int"), F.lit(1))
         .alias("expires"),
        (100 + _mod(k, 900)).cast("string").alias("cvv"),
        F.when(_mod(k, 5) == 0, "NO").otherwise("YES").alias("has_chip"),
        (1 + _mod(k, 3)).cast("int").alias("num_cards_issued"),
        F.when(_mod(k, 250) == 0, F.lit(0)).otherwise(_mod(k * 613, 40001))
         .cast("decimal(12,2)").alias("credit_limit"),
        F.to_date("o_orderdate").alias("acct_open_date"),
        (1990 + _mod(k, 9)).cast("int").alias("year_pin_last_changed"),
    )


def mcc_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (raw(spark, sf_dir, "part")
            .select((5000 + F.col("p_partkey").cast("long")).alias("mcc_id"),
                    F.concat(F.col("p_type"), F.lit("/"), F.col("p_name")).alias("description")))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions from lineitem joined to its order.

    ``(l_orderkey, l_linenumber)`` is not unique in the test data, so a
    row_number within that pair makes the id unique. The join is on
    l_orderkey and the window is partitioned by (l_orderkey, l_linenumber):
    hash partitioning on l_orderkey satisfies both, so the window reuses the
    join's shuffle. The orders (two columns, a part of the lines) are the hashed
    side: the lines are not sorted for the join, only for the window. When ``id``
    is not selected, Catalyst prunes the window.
    """
    li = raw(spark, sf_dir, "lineitem")
    od = raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("shuffle_hash")
    base = spread(li, "l_orderkey").join(od, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    base = base.withColumn("rn", F.row_number().over(w))

    ok = F.col("l_orderkey").cast("long")
    ln = F.col("l_linenumber").cast("long")
    pk = F.col("l_partkey").cast("long")
    sk = F.col("l_suppkey").cast("long")
    online = _mod(ln, 3) == 2
    err_sel = _mod(ok * 7 + ln * 13 + pk, 59)
    return base.select(
        (ok * 1000 + ln * 100 + F.col("rn")).cast("long").alias("id"),
        (F.col("l_shipdate").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _mod(pk * 7919, 86400).cast("int")))
        .alias("date"),
        F.col("o_custkey").cast("long").alias("client_id"),
        F.when(_mod(pk, 199) == 0, -1 - ok).otherwise(ok).alias("card_id"),
        F.when((F.col("l_returnflag") == "R") & (ln == 1), -F.col("l_extendedprice"))
         .when((F.col("l_quantity") == 50) & (ln == 2), F.lit(0.0))
         .otherwise(F.col("l_extendedprice")).cast("decimal(10,2)").alias("amount"),
        F.when(_mod(ok * 3 + ln, 97) == 0, F.lit(None).cast("string"))
         .when(_mod(ln, 3) == 0, "Chip Transaction").when(_mod(ln, 3) == 1, "Swipe Transaction")
         .when(_mod(ok, 11) == 0, "Online Order").otherwise("Online Transaction")
         .alias("use_chip"),
        F.when(_mod(ok + pk, 83) != 0, sk).alias("merchant_id"),
        F.when(online, "ONLINE").otherwise(F.concat(F.lit("City"), _mod(sk, 40).cast("string")))
         .alias("merchant_city"),
        F.when(online, F.when(_mod(ok, 7) == 0, ""))
         .otherwise(F.concat(F.lit("S"), _mod(sk, 25).cast("string"))).alias("merchant_state"),
        F.when(online, F.when(_mod(ok, 5) == 0, "")).otherwise((10000 + sk).cast("string"))
         .alias("zip"),
        # every 110th part is billed under a code that no part has
        F.when(_mod(pk, 110) == 109, 1000 + _mod(pk, 10)).otherwise(5000 + pk)
         .alias("mcc"),
        F.when(err_sel == 0, "Insufficient Balance")
         .when(err_sel == 1,
               F.when(_mod(pk, 3) == 0, "Bad PIN,Insufficient Balance")
                .when(_mod(pk, 3) == 1, "Bad PIN").otherwise("Technical Glitch"))
         .alias("errors"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic stand-in for model output, with ties, so the metric
    operators have an exact oracle."""
    t = Sources(spark, sf_dir).transactions().filter(F.col("amount") > 0)
    base = F.pmod(F.col("id") * 37 + F.floor("amount").cast("int"), F.lit(101)).cast("double") / 200
    bump = F.when(F.col("errors").isNotNull() & (F.pmod(F.col("id"), F.lit(3)) == 0), 0.25) \
        .otherwise(0.0)
    return t.select("id", F.when(F.col("errors").isNull(), 0).otherwise(1).alias("label"),
                    (base + bump).alias("score"))


class Sources:
    """Lazy handles on the source tables of one scale-factor folder: always
    the source itself, so that a check of the source never sees a copy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _read(self, name: str, derive) -> DataFrame:
        return derive(self.spark, self.sf_dir)

    def users(self) -> DataFrame:
        return self._read("users", users)

    def users_v2(self) -> DataFrame:
        return users_v2(self.spark, self.sf_dir)

    def cards(self) -> DataFrame:
        return self._read("cards", cards)

    def mcc_codes(self) -> DataFrame:
        return self._read("mcc_codes", mcc_codes)

    def transactions(self) -> DataFrame:
        return self._read("transactions", transactions)

    def scored(self) -> DataFrame:
        return scored(self.spark, self.sf_dir)
