"""The streaming velocity job equals the batch aggregation and drops rows
that arrive after the watermark has passed their windows."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from cardspark.sources.tables import TRANSACTIONS_SCHEMA
from cardspark.streaming.velocity import start_velocity_stream, velocity_windows


def _rows(spark, items):
    base = dict(client_id=1, amount=None, use_chip="Chip Transaction", merchant_id=1,
                merchant_city="C", merchant_state="S", zip="1", mcc=5001, errors=None)
    rows = [dict(base, id=i, date=ts, card_id=c) for i, (ts, c) in enumerate(items)]
    return spark.createDataFrame(rows, TRANSACTIONS_SCHEMA)


def test_stream_matches_batch_and_drops_late_rows(spark):
    src = tempfile.mkdtemp(prefix="velocity-src-", dir="/tmp")
    t0 = dt.datetime(2020, 1, 1, 10, 0)
    first = [(t0 + dt.timedelta(minutes=m), c) for m in (0, 7, 30, 50) for c in (1, 2)]
    _rows(spark, first).write.mode("append").parquet(src)
    out = []

    def sink(df, _):
        out.extend(df.collect())

    q = start_velocity_stream(spark, src, sink, name=f"t{id(out)}")
    q.processAllAvailable()
    # advance the watermark well past the first hour, then send a late row
    _rows(spark, [(t0 + dt.timedelta(hours=5), 1)]).write.mode("append").parquet(src)
    q.processAllAvailable()
    _rows(spark, [(t0 + dt.timedelta(minutes=1), 1)]).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    batch = velocity_windows(_rows(spark, first)).filter(
        F.col("window_end") <= F.lit(t0 + dt.timedelta(hours=3)))
    want = sorted(tuple(r) for r in batch.collect())
    got = sorted(tuple(r) for r in out if r["window_end"] <= t0 + dt.timedelta(hours=3))
    assert got == want  # the late row at 10:01 changed nothing


def test_windows_of_panes_equal_windows_of_rows(spark):
    import random
    rng = random.Random(3)
    t0 = dt.datetime(1969, 12, 31, 21, 0)  # before and after the epoch
    items = [(t0 + dt.timedelta(seconds=rng.randrange(6 * 3600)), rng.choice([1, 2, 2, None]))
             for _ in range(400)] + [(None, 1)]
    rows = spark.createDataFrame([(ts, c) for ts, c in items], "date timestamp_ntz, card_id long")
    want = {}
    for ts, c in items:
        if ts is None:
            continue
        pane = dt.datetime(1960, 1, 1) + (ts - dt.datetime(1960, 1, 1)) // dt.timedelta(minutes=5) * dt.timedelta(minutes=5)
        for i in range(12):
            k = (pane - i * dt.timedelta(minutes=5), c)
            want[k] = want.get(k, 0) + 1
    out = velocity_windows(rows)
    got = {(r["window_start"], r["card_id"]): r["n_txn"] for r in out.collect()}
    assert got == want
    assert all(r["window_end"] - r["window_start"] == dt.timedelta(hours=1) for r in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan  # no row is copied into its windows


def test_parts_of_the_batch_windows(spark):
    """Panes and hours fall into the parts that are asked for, with the same
    windows; the query asks for more than the session's."""
    from cardspark.sources.tables import raw, spread_parts, transactions
    t = transactions(spark, "/root/testdata/sf0.001").select("card_id", "date")
    spread, plain = velocity_windows(t, parts=13), velocity_windows(t)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "13), REPARTITION_BY_NUM" in plan
    assert spread.exceptAll(plain).count() == 0 and spread.count() == plain.count() > 0
    assert spread_parts(raw(spark, "/root/testdata/sf0.001", "lineitem")) > 4
