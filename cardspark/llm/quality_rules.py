"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

``text_measures`` computes per text the word, symbol, duplicate-line and
repeated-window counts. ``CASCADE`` are the rules that reject; a text is
rejected if any of them fires, so their order changes the work and not the
verdict. ``order_rules`` runs each rule on the texts of a sample, with the
measures that it needs and no others, takes its seconds a row and the share it
rejects, and puts the rules with the most rejections a second
first; ``verdict`` is one CASE over the rules in that order, which stops at the
first that fires.

Defined results: null or empty text, or one of white space alone: no words,
all counts 0, rejected by ``min_words``. Repeated rows are judged one by one.
Only the id and text columns are read; further columns, whatever their names,
are left out of the result. An empty table gives an empty result and keeps the
rules in their listed order.

3-word windows are compared by a 64-bit hash of their words inside one text;
two different windows of a text of n words are taken as equal with a chance of
about n * n / 2 ** 65.
"""

from __future__ import annotations

import string
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.llm.common import words, written

SPACES = " \t\n\x0b\x0c\r"
DIGITS = string.digits
MARKS = string.punctuation
CAPITALS = string.ascii_uppercase
# Rows of the sample that orders the rules (their costs and shares; the
# verdict does not depend on it).
SAMPLE_ROWS = 2000


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(hashes: Column) -> Column:
    """Words that lie in 3-word windows found twice or more, given the hashes
    of all windows of the text in order."""
    tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        def same(x: Column, at: Column) -> Column:
            return F.coalesce(x["h"] == F.get(s, at)["h"], F.lit(False))
        return F.sort_array(F.transform(
            F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        # each window covers up to the start of the next, three words at most
        return F.aggregate(F.transform(p, lambda x, k: F.least(
            F.lit(3), F.coalesce(F.get(p, k + 1), x + 3) - x)), F.lit(0), lambda a, x: a + x)

    return _let(tagged, lambda s: _let(twice(s), covered))


def text_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``text``, n_words, word_chars,
    n_symbols, n_lines (lines with a word), n_dup_lines and n_repeat_words."""
    d = docs.select(F.col(id_col).alias("doc_id"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumns({
        "_words": words(F.col("text")),
        "_lines": F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACES, "") != ""),
    })
    d = d.withColumn("_windows", F.expr(
        "transform(slice(_words, 1, greatest(size(_words) - 2, 0)),"
        " (w, i) -> xxhash64(w, get(_words, i + 1), get(_words, i + 2)))"))
    return d.select(
        "doc_id", "text",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", "")))
        .cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), F.lit(0))
        .otherwise(_repeat_words(F.col("_windows"))).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def cascade() -> dict[str, Column]:
    """The rejecting rules over ``text_measures`` columns."""
    text, n = F.col("text"), F.col("n_words")
    # letters: all but ASCII digits, marks and spaces
    letters = F.length(F.translate(text, DIGITS + MARKS + SPACES, ""))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    digits = F.length(text) - F.length(F.translate(text, DIGITS, ""))
    shouts = F.size(F.split(text, "!!")) - 1
    return {
        "min_words": n < 50,
        "repeat_words": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "duplicate_lines": 10 * F.col("n_dup_lines") > 4 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        "few_letters": 2 * letters < F.col("word_chars"),
        "capitals": 2 * capitals > letters,
        "digits": 5 * digits > F.col("word_chars"),
        "exclamations": 5 * shouts > n,
    }


def order_rules(docs: DataFrame, rules: dict[str, Column], id_col: str = "doc_id",
                text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
                seed: int = 7) -> list[dict]:
    """The rules by rejections a second, most first: name, seconds a row and
    share rejected, measured on a random sample of about ``sample_rows``."""
    # the ids alone are counted: the scan reads no text for it
    total = docs.select(id_col).count()
    # texts, not measures: a rule costs what it takes to get at its measures too
    part = docs.select(id_col, text_col)
    if total > sample_rows:
        part = part.sample(fraction=sample_rows / total, seed=seed)
    part = written(part, "rule_sample")
    rows = part.count()
    if not rows:
        return [{"rule": r, "seconds_a_row": 0.0, "rejects": 0.0} for r in rules]

    measured = text_measures(part, id_col, text_col)

    def run(rule: Column) -> tuple[float, int]:
        began = time.perf_counter()
        n = measured.agg(F.sum(F.when(rule, 1).otherwise(0)).alias("n")).first()["n"]
        return time.perf_counter() - began, n

    run(F.lit(False))  # compiles and opens what all rules share
    idle, _ = run(F.lit(False))
    found = []
    for name, rule in rules.items():
        took, n = run(rule)
        found.append({"rule": name, "seconds_a_row": max(took - idle, 1e-4) / rows,
                      "rejects": n / rows})
    return sorted(found, key=lambda r: (-r["rejects"] / r["seconds_a_row"], r["rule"]))


def verdict(rules: dict[str, Column], order: list[str]) -> Column:
    """The first rule of ``order`` that fires, else null."""
    out = None
    for name in order:
        hit = F.when(rules[name], F.lit(name)) if out is None else out.when(rules[name], F.lit(name))
        out = hit
    return out.otherwise(F.lit(None).cast("string"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, base_failed,
    rejected_by (the first rule of the cascade that fired; which one depends
    on the measured order) and kept (no rule fired)."""
    measures = text_measures(docs, id_col, text_col)
    rules = cascade()
    order = [r["rule"] for r in order_rules(docs, rules, id_col, text_col, sample_rows)]
    return (measures.withColumn("rejected_by", verdict(rules, order))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                    "n_repeat_words", base_failed().alias("base_failed"), "rejected_by",
                    F.col("rejected_by").isNull().alias("kept")))
