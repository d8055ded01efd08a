import re
from collections import Counter

from pyspark.sql import functions as F

from cardspark.llm.quality_rules import (
    base_failed, cascade, judge, order_rules, text_measures, verdict,
)

SPACE = "[ \t\n\x0b\x0c\r]+"


def brute(text):
    t = text or ""
    words = [w for w in re.split(SPACE, t) if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {p for i, w in enumerate(windows) if often[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search("[^ \t\n\x0b\x0c\r]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(inside))


TEXTS = [
    None, "", "   \t", "one", "a b c a b c", "a b c d a b c d a b c", "x x x x x x",
    "l1 w\nl1 w\n\n \nl1 w", "# * $ % & | < >", "é ß y  z", "a\x0bb\x0cc\rd",
    " ".join(f"w{i}" for i in range(60)), " ".join(["spam"] * 80), "p q r " * 40 + "end",
    " ".join(f"w{i % 7}" for i in range(100)), "WORD!! " * 60,
]


def test_measures_match_brute_force(spark):
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                         r["n_repeat_words"]) for r in text_measures(d).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_verdict_and_base(spark):
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in judge(d).collect():
        n, *_, repeats = brute(TEXTS[r["doc_id"]])
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (r["kept"] and r["base_failed"])
        assert r["kept"] == (r["rejected_by"] is None)
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    assert judge(spark.createDataFrame([(1, clean)], "doc_id long, text string")).first()["kept"]


def test_order_does_not_change_the_verdict(spark):
    m = text_measures(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))
    rules = cascade()
    ways = [list(rules), list(rules)[::-1]]
    a, b = ({r["doc_id"]: r["v"] for r in m.select("doc_id", verdict(rules, w).isNull().alias("v"))
             .collect()} for w in ways)
    assert a == b
    assert m.filter(base_failed() & verdict(rules, ways[0]).isNull()).count() == 0


def test_rules_are_ordered_by_rejections_a_second(spark):
    d = spark.createDataFrame(list(enumerate(TEXTS * 5)), "doc_id long, text string")
    found = order_rules(d, cascade())
    gain = [r["rejects"] / r["seconds_a_row"] for r in found]
    assert gain == sorted(gain, reverse=True)
    assert {r["rule"] for r in found} == set(cascade())


def test_no_python_in_the_plan(spark):
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    plan = judge(d)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_messy_and_empty(messy, no_docs):
    assert judge(messy).count() == messy.count()
    assert judge(no_docs).count() == 0
    empty = judge(messy.filter("doc_id in (3, 4, 5)")).agg(F.sum("n_words"), F.max("kept")).first()
    assert tuple(empty) == (0, False)


def test_messy_rows_match_brute_force(messy):
    """Nulls, repeated rows, a very long text and clashing column names."""
    key = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted(map(repr, (tuple(r) for r in judge(messy).select(*key).collect())))
    want = [(r["doc_id"], *brute(r["text"])) for r in messy.select("doc_id", "text").collect()]
    assert got == sorted(map(repr, want))
    assert judge(messy).columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines",
                                    "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"]


def test_costs_are_those_of_the_texts(spark):
    """Counting repeated windows costs more than counting words, of which it is
    one part."""
    text = " ".join(f"w{i % 900}" for i in range(4000))
    d = spark.createDataFrame([(i, text) for i in range(300)], "doc_id long, text string")
    cost = {r["rule"]: r["seconds_a_row"] for r in order_rules(d, cascade())}
    assert cost["repeat_words"] > 2 * cost["min_words"]
