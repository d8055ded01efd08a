"""Dimensions that are large in rows but small in files are not sent through the
driver, and the rows are those of the plain joins."""

import re

import pytest
from pyspark.sql import functions as F

from cardspark.plans import warehouse as W
from cardspark.plans.star import FACT_PART, FLAT_PARTS, flat_frame
from cardspark.plans.verify import ORDER

ROWS = {"card": 600_000, "customer": 600_000, "mcc": W.BROADCAST_MAX_ROWS + 1}


@pytest.fixture(scope="module")
def dims(spark, tmp_path_factory):
    """Every dimension with one text for each column; keys from 1."""
    top, made = tmp_path_factory.mktemp("dims"), {}
    for name in ORDER:
        cols = {*FLAT_PARTS[name].values(), "RowIsCurrent"} - {"IsSuccess"}
        rows = spark.range(1, ROWS.get(name, 4) + 1).select(
            F.col("id").alias(W.DIM_KEYS[name]), F.col("id").alias(W.DIM_BKS.get(name, "BK")),
            *[F.lit("Y").alias(c) for c in sorted(cols)], (F.col("id") % 2 == 0).alias("IsSuccess"))
        rows.write.parquet(f"{top}/{name}")
        made[name] = spark.read.parquet(f"{top}/{name}")
    return made


def _broadcast_keys(df) -> set:
    """Keys of the joins by one key (a small fact may meet its pairs of keys by a broadcast)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"BroadcastHashJoin \[(\w+)#\d+L?\]", plan))


def test_the_flat_frame_broadcasts_no_large_dimension(spark, dims, tmp_path):
    n = 1000
    keys = [(1 + F.col("id") % ROWS.get(d, 4)).alias(W.DIM_KEYS[d]) for d in ORDER]
    rest = set(FACT_PART.values()) - set(W.DIM_KEYS.values())
    spark.range(n).select(*keys, *[F.col("id").alias(c) for c in sorted(rest)]).write.parquet(f"{tmp_path}/fact")
    wh = W.Warehouse.from_tables(spark, "", W.DEFAULT_CTX, {}, dims, spark.read.parquet(f"{tmp_path}/fact"))
    # asked for these alone, the large dimensions are read by their keys
    flat = flat_frame(wh).agg(F.count(F.lit(1)).alias("n"), F.sum("is_error").alias("e"))
    assert not _broadcast_keys(flat) & {"CardKey", "CustomerKey", "MccKey"}
    assert {"DateKey", "GeographyKey", "TransactionTypeKey"} <= _broadcast_keys(flat)
    assert tuple(flat.first()) == (n, n // 2)


def test_the_card_lookup_broadcasts_no_large_dimension(spark, dims, tmp_path):
    spark.range(3).select(F.col("id"), (F.col("id") + 1).alias("client_id")).write.parquet(f"{tmp_path}/cards")
    found = W.card_lookup(spark.read.parquet(f"{tmp_path}/cards"), dims["card"].filter("BKCardID <= 2"),
                         dims["customer"])
    assert not _broadcast_keys(found)
    assert sorted(tuple(r) for r in found.select("card_id", "CardKey", "CustomerKey").collect()
                  if r["card_id"] is not None) == [(0, None, 1), (1, 1, 2), (2, 2, 3)]
