"""Plan discipline: no cartesian product in any registered query, scans
pruned to the columns a query needs, filters pushed into the scan."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_no_cartesian_product(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan


def test_scan_is_pruned(spark):
    from cardspark.sources.tables import transactions
    df = transactions(spark, SF).groupBy("mcc").count()
    # mcc needs l_partkey, the join needs l_orderkey: nothing else is read
    schemas = re.findall(r"struct<([^>]*)>", _plan(df))
    lineitem = [s for s in schemas if "l_" in s]
    assert lineitem and all(len(s.split(",")) <= 2 for s in lineitem), lineitem


def test_filter_pushed_to_scan(spark):
    from cardspark.sources.tables import raw
    df = raw(spark, SF, "lineitem").filter("l_quantity > 40").select("l_orderkey")
    assert "GreaterThan(l_quantity,40" in _plan(df)


def test_state_ranking_is_a_bounded_top_n(spark):
    # the top states come from a distributed top-k, not a window that pulls
    # every distinct state into one task
    plan = _plan(entry.queries()["state_top_n"](spark, SF))
    assert "TakeOrderedAndProject" in plan
    assert "Window" not in plan


def test_orphan_checks_count_per_key_before_the_anti_join(spark):
    from cardspark.plans.verify import verify_metrics
    from cardspark.plans.warehouse import DEFAULT_CTX, Warehouse
    plan = _plan(verify_metrics(Warehouse.get(spark, SF, DEFAULT_CTX)))
    # all six key columns in one pass: (dimension, key) counts, one anti-join
    anti = [line for line in plan.splitlines() if "LeftAnti" in line]
    assert len(anti) == 1
    assert "partial_count" in plan


def test_dates_prune(spark):
    plan = _plan(entry.queries()["txn_one_year"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in plan or "year(" not in plan
    for name in ("kpi_utilization", "fact_by_year"):
        plan = _plan(entry.queries()[name](spark, SF))
        filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
        assert any("Year" in f for f in filters), name


def test_cluster_sessions_keep_their_partitions():
    from cardspark import session
    assert "spark.sql.shuffle.partitions" not in session.BASE_CONF


def test_a_span_of_days_prunes_year_folders_at_run_time(spark):
    q = entry.queries()["kpi_spend_of_span"](spark, SF)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    scan = next(x for x in plan.split("\n") if "PartitionFilters" in x and "Year" in x)
    assert "dynamicpruning" in scan.lower()


def test_sketches_of_days_make_any_period(spark):
    from pyspark.sql import functions as F

    from cardspark.plans.star import SKETCH_ERROR, _wh, active_sketches
    wh = _wh(spark, SF)
    total = entry.queries()["kpi_active_customers"](spark, SF).first()["active_customers"]
    got = active_sketches(wh).agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("n")).first()["n"]
    assert abs(got - total) <= 4 * SKETCH_ERROR * total + 1
    plan = active_sketches(wh)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan  # read, not computed


def _lines(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_texts_join_after_the_shuffles(spark):
    """The flat frame is shuffled by id and card before a dimension's text is on
    its rows, and its rows are those of the frame joined the plain way."""
    from pyspark.sql import functions as F

    from cardspark.plans.star import _wh, flat_frame, flat_with_time, time_features
    wh = _wh(spark, SF)
    frame = flat_with_time(wh)
    depth = {}
    for line in _lines(frame):
        for key in ("BKTransactionID", "MccKey"):
            if " Join " in f" {line}" and f"({key}#" in line and "RowIsCurrent" not in line:
                depth.setdefault(key, line.index("Join"))
    assert depth["BKTransactionID"] > depth["MccKey"]
    plain = flat_frame(wh).join(time_features(wh.stg["transactions"]), "transaction_id", "left")
    assert plain.filter("txn_hour IS NULL").count() == 0
    cols = frame.columns
    as_long = [F.col(c).cast("double").alias(c) if c in ("txn_hour", "txn_weekday")
               else F.col(c).cast("long").alias(c) if c == "txn_per_card_day" else F.col(c)
               for c in cols]
    assert frame.exceptAll(plain.select(*as_long)).count() == 0
    assert frame.count() == plain.count()


def test_lines_are_not_sorted_for_their_orders(spark):
    from cardspark.sources.tables import transactions
    plan = transactions(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_curve_reads_the_scores_once(spark, tmp_path):
    """Nothing built on a score curve makes the scored rows again."""
    from cardspark.plans.metrics import score_curve
    path = f"{tmp_path}/scored"
    spark.createDataFrame([(1, 0, 0.5), (2, 1, 0.5), (3, 1, 0.9)],
                          "id long, label int, score double").write.parquet(path)
    curve = score_curve(spark.read.parquet(path))
    assert not any(path in f for f in curve.inputFiles())
    assert sorted(tuple(r) for r in curve.select("score", "pos", "neg", "tp", "fp", "P", "N")
                  .collect()) == [(0.5, 1, 1, 2, 1, 2, 1), (0.9, 1, 0, 1, 0, 2, 1)]


def test_tree_partitions():
    """As before up to the cores' share, then no more tasks a level than cores
    until partitions would be too large."""
    from cardspark.plans.models import tree_partitions
    assert [tree_partitions(n, 8) for n in (0, 5_000, 60_000, 160_000)] == [1, 1, 3, 8]
    assert tree_partitions(3_000_000, 12) == 12  # 150 at 20,000 rows each
    assert tree_partitions(180_000_000, 12) == 360
