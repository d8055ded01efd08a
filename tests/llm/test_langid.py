import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from cardspark.llm.common import text_slices
from cardspark.llm.langid import (
    OUTSIDE, UND, _mixed, fitted, identify, label_rows, language_report, train, viterbi,
)

SYLLABLES = {"xx": "ba ke lo mi", "yy": "schu tzer ung ich", "ru": "да не по ста"}


def text(rng, lang, n):
    s = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, 30), lang) for i, lang in
            enumerate(["xx", "yy", "ru"] * 60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(docs):
    return fitted(docs)


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(4)
    for _ in range(40):
        s = rng.normal(size=(6, 3)) * 3

        def value(path):
            return sum(s[t, j] for t, j in enumerate(path)) - 2.5 * sum(
                a != b for a, b in zip(path, path[1:]))
        best = max(itertools.product(range(3), repeat=6), key=value)
        assert abs(value(viterbi(s, 2.5)) - value(best)) < 1e-9


def test_rows_that_skip_viterbi_keep_its_result():
    rng = np.random.default_rng(5)
    for scale in (0.5, 2.0, 6.0):
        n = rng.integers(1, 30, 50)
        first = np.append(0, np.cumsum(n))
        s = rng.normal(size=(first[-1], 3)) * scale
        s[:, 0] += scale / 2
        single = np.array([s[a:b].sum(axis=0).argmax() for a, b in zip(first, first[1:])])
        mixed = _mixed(s, first, single, 8.0)
        for r in range(50):
            labels = viterbi(s[first[r]:first[r + 1]], 8.0)
            if not mixed[r]:
                assert (labels == single[r]).all()


def test_held_out_accuracy(docs):
    got = {r["doc_id"]: r for r in language_report(docs).collect()}
    out = [(got[r["doc_id"]]["lang_pred"], r["lang"]) for r in docs.collect()
           if got[r["doc_id"]]["held_out"]]
    assert len(out) > 20 and all(a == b for a, b in out)


def test_real_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_report(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_mixed_text_is_cut_into_spans(spark, model):
    rng = random.Random(2)
    mixed = " ".join([text(rng, "xx", 25), text(rng, "yy", 15), text(rng, "ru", 40)])
    d = spark.createDataFrame([(1, mixed)], "doc_id long, text string")
    r = identify(d, model).first()
    assert [(s["lang"], s["start"], s["end"]) for s in r["_lang_spans"]] == \
        [("xx", 0, 25), ("yy", 25, 40), ("ru", 40, 80)]
    assert r["_lang_pred"] == "ru" and abs(r["_lang_score"] - 0.5) < 1e-9


def test_script_narrows(model):
    data = "да".encode()
    (_, raw, off), = text_slices(pa.array([data.decode()]))
    scores, has = model.word_scores(raw, np.array([0]), np.array([len(raw)]))
    assert has.all() and model.names[scores[0].argmax()] == "ru"
    assert scores[0, model.names.index("xx")] <= scores[0].max() - OUTSIDE
    pick, share, _, _ = label_rows(model, raw, off)
    assert model.names[pick[0]] == "ru" and share[0] == 1.0


def test_und_and_messy(spark, model, messy, no_docs):
    rows = [(1, None), (2, ""), (3, "123 !! 4"), (4, "×÷ ²"), (5, "x"), (6, " \n "), (7, "ª")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["_lang_pred"], r["_lang_score"]) for r in identify(d, model).collect()}
    assert {i for i, (p, _) in got.items() if p == UND} == {1, 2, 3, 4, 6}
    assert all(s == 0 for p, s in got.values() if p == UND)
    report = language_report(messy)
    assert report.count() == messy.count()
    out = identify(messy, fitted(messy))
    assert out.columns[:len(messy.columns)] == messy.columns
    assert language_report(no_docs).count() == 0
    # nothing to learn from
    unlabelled = d.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r["lang_pred"] for r in language_report(unlabelled).collect()} == {UND}


def test_training_sample_is_bounded(docs):
    small = train(docs, train_rows=60)
    assert small.names == ["ru", "xx", "yy"]


def test_rare_language_is_learned_at_any_size(spark):
    """The bound holds for each language: 3 texts among 3,000 stay, and so do
    rows that all have the same hash."""
    rng = random.Random(7)
    rows = [(i, text(rng, "xx", 5), "xx") for i in range(3000)]
    rows += [(5000 + i, text(rng, "yy", 30), "yy") for i in range(3)]
    rows += [(6000, text(rng, "ru", 30), "ru")] * 2
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    small = train(d, train_rows=3)
    assert small.names == ["ru", "xx", "yy"]
    new = spark.createDataFrame([(1, text(rng, "yy", 20))], "doc_id long, text string")
    assert identify(new, small).first()["_lang_pred"] == "yy"
