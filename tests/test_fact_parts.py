"""The fact load's large join and range sort take parts that grow with the staged
rows, and give the rows and files' order that few parts give."""

import glob

from cardspark.plans import warehouse as W
from cardspark.plans.star import time_features
from cardspark.sources import tables

SF = "/root/testdata/sf0.001"


def test_parts_grow_with_the_rows(spark):
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tables.parts_of(spark, few * tables.PART_ROWS) is None
    assert tables.parts_of(spark, few * tables.PART_ROWS + 1) == few + 1


def test_the_fact_is_the_same_in_many_parts(spark, monkeypatch):
    want = W.Warehouse(spark, SF, materialize=True).fact_by_year()
    monkeypatch.setattr(tables, "PART_ROWS", 300)
    wh = W.Warehouse(spark, SF, materialize=True)
    got = wh.fact_by_year()
    assert got.schema == want.schema and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    parts = -(-want.count() // 300)
    folder = got.inputFiles()[0].rsplit("/", 2)[0].removeprefix("file://")
    tasks = {f.rsplit("part-", 1)[1][:5] for f in glob.glob(f"{folder}/Year=*/*.parquet")}
    assert len(tasks) > parts // 2
    # the files are compressed as asked for, and each holds a range of days
    assert all(".zstd." in f for f in got.inputFiles())
    lines = W.fact_transaction(wh.stg, wh.dims(), parts=parts)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert f"RepartitionByExpression [card_id" in plan and f", {parts}" in plan


def test_velocity_of_missing_cards_and_days(spark):
    rows = spark.sql("""
        SELECT * FROM VALUES (1L, 7L, timestamp_ntz'2000-01-01 03:00:00'), (2L, 7L, timestamp_ntz'2000-01-01 09:00:00'),
          (3L, 7L, NULL), (4L, 7L, NULL), (5L, NULL, NULL), (6L, NULL, timestamp_ntz'2000-01-01 00:00:00'),
          (7L, NULL, timestamp_ntz'2000-01-01 23:00:00'), (8L, 9L, timestamp_ntz'2000-01-01 23:00:00')
        AS t(id, card_id, date)""")
    got = {r["transaction_id"]: (r["txn_per_card_day"], r["is_night"]) for r in time_features(rows).collect()}
    assert got == {1: (2, 1), 2: (2, 0), 3: (2, 0), 4: (2, 0), 5: (1, 0), 6: (2, 1), 7: (2, 0), 8: (1, 0)}
