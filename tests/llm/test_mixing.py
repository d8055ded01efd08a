import math
import re

from cardspark.llm.mixing import mix_report, plan, position, training_order
from pyspark.sql import functions as F


def brute_targets(sizes: dict) -> dict:
    """Share by weight, cap, share the excess again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total = sum(sizes.values())
    target, capped = {}, set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / w for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def n_words(t):
    return len([w for w in re.split("[ \t\n\x0b\x0c\r]+", t or "") if w])


def test_targets_and_takes(messy):
    rows = mix_report(messy).collect()
    assert len(rows) == messy.count()
    src = {}
    for r in messy.select("source", "text").collect():
        src[r["source"]] = src.get(r["source"], 0) + n_words(r["text"])
    want = brute_targets(src)
    by_size = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        key = (r["source_size"], round(r["target"], 6))
        by_size[key] = by_size.get(key, 0) + r["taken"]
    assert sorted(round(t, 6) for t in want.values()) == sorted(
        x for (s, x) in by_size) or len(by_size) < len(want)
    for (_, target), taken in by_size.items():
        assert abs(taken - target) <= 1 or len(by_size) < len(want)


def test_many_sources_and_caps(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), f"s{i % 9}" if i % 10 else "tiny")
            for i in range(300)] + [(1000, "one two", "aaa"), (1001, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + n_words(t)
    want = brute_targets(sizes)
    source = {i: s for i, _, s in rows}
    got, taken = {}, {}
    for r in mix_report(d).collect():
        s = source[r["doc_id"]]
        got[s] = r["target"]
        taken[s] = taken.get(s, 0) + r["taken"]
        assert r["source_size"] == sizes[s]
    for s in want:
        assert math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(taken[s] - want[s]) <= 1


def test_reruns_agree(messy):
    a = sorted(map(str, mix_report(messy).collect()))
    assert a == sorted(map(str, mix_report(messy.repartition(7)).collect()))


def test_position_inverts_the_demand(spark):
    d = spark.range(0, 101).select((F.col("id") / 100).alias("x")).crossJoin(
        spark.createDataFrame([(-0.8,), (0.0,), (0.5,)], "a double"))
    for r in d.withColumn("t", position(F.col("x"), F.col("a"))).collect():
        assert math.isclose(r["t"] + r["a"] * (r["t"] ** 2 - r["t"]), r["x"], abs_tol=1e-12)
        assert -1e-12 <= r["t"] <= 1 + 1e-12


def test_training_order(messy):
    out = training_order(messy)
    assert out.columns == messy.columns + ["_mix_copy", "_mix_position"]
    rows = out.collect()
    assert [r["_mix_position"] for r in rows] == sorted(r["_mix_position"] for r in rows)
    assert sum(n_words(r["text"]) for r in rows) == \
        plan(messy).agg(F.sum("_mix_taken")).first()[0]
    assert {r["_mix_copy"] for r in rows} <= {0, 1, 2}


def test_heavy_sources_come_late(spark):
    rows = [(i, "w " * 20, s) for i in range(400) for s in "abc"]
    d = training_order(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    mean = {r["source"]: r["m"] for r in d.groupBy("source").agg(F.avg("_mix_position").alias("m"))
            .collect()}
    assert mean["a"] < mean["b"] < mean["c"]


def test_no_python_in_the_plan(messy):
    for d in (mix_report(messy), training_order(messy)):
        p = d._jdf.queryExecution().toString()
        assert "Python" not in p and "InArrow" not in p and "Pandas" not in p


def test_empty_tables(no_docs, messy):
    assert mix_report(no_docs).count() == 0
    assert training_order(no_docs).count() == 0
    wordless = messy.filter("doc_id in (3, 4, 5)")
    assert [r["taken"] for r in mix_report(wordless).collect()] == [0, 0, 0]
    assert training_order(wordless).count() == 0


def test_rows_without_an_id_are_spread(spark):
    from cardspark.llm.mixing import plan
    d = spark.createDataFrame([(None, f"a b {i}", "s") for i in range(500)], "doc_id long, text string, source string")
    assert plan(d).select("_mix_bucket").distinct().count() > 10
    assert mix_report(d).agg({"taken": "sum"}).first()[0] == 1500
