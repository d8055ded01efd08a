import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardspark.llm import runs
from cardspark.llm.runs import digests, find_runs, with_planted_runs, word_runs


def brute(w, least=6, repeats=4):
    """Every period's maximal stretches; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, repeats * q):
                found.setdefault((s, i + q - s), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


pieces = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=4),
                            st.integers(1, 25)), max_size=6)


@given(st.lists(pieces, max_size=4), st.sampled_from([(6, 4), (2, 2), (7, 3), (1, 2)]))
@settings(max_examples=400, deadline=None)
def test_equal_to_brute_force(texts, bounds):
    texts = [[w.encode() for unit, n in parts for w in (unit * n)[:n]] for parts in texts]
    ids, ends = runs._numbered(texts)
    at, want = 0, []
    for t in texts:
        want += [(s + at, n, q) for s, n, q in brute(t, *bounds)]
        at += len(t)
    assert find_runs(ids, ends, *bounds) == want


@pytest.mark.parametrize("unit", [["a"], ["a", "b", "c"], ["a", "a", "b"], [str(i) for i in range(997)]])
def test_long_periodic_texts(unit):
    n = 20_000
    t = [w.encode() for w in (unit * n)[:n]]
    ids, ends = runs._numbered([t])
    assert (0, n, len(unit)) in find_runs(ids, ends)


def test_levels_sort_the_suffixes():
    rng = random.Random(1)
    ids = np.array([rng.randrange(3) for _ in range(300)])
    last = runs._levels(ids, np.full(300, 300))[-1][:300]
    assert sorted(range(300), key=lambda i: last[i]) == sorted(range(300), key=lambda i: ids[i:].tolist())


def test_two_periods_are_needed():
    with pytest.raises(ValueError):
        find_runs(np.array([0]), np.array([1]), 6, 1)


def expected(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    found = brute(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3),
            1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def report(docs):
    return sorted(map(repr, map(tuple, word_runs(with_planted_runs(docs), ["doc_id"])
                                .select("doc_id", *digests()).collect())))


def check(docs):
    want = [expected(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert report(docs) == sorted(map(repr, want))
    return want


def test_messy(messy, monkeypatch):
    monkeypatch.setattr(runs, "SLICE_WORDS", 100)
    # the long text has 30,000 different-looking words: brute force only up to 3,000
    assert check(messy.filter("length(text) < 20000 OR text IS NULL"))


def test_long_text(spark, messy):
    docs = messy.filter("doc_id = 6")
    row = word_runs(docs, ["doc_id"]).collect()[0]
    assert row["n_words"] == 30_000 and row["collapsed"] == docs.collect()[0]["text"]


def test_planted_runs(spark):
    rng = random.Random(9)
    docs = spark.createDataFrame(
        [(i, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 60))))
         for i in range(400)], "doc_id long, text string")
    want = check(docs)
    assert sum(r[1] for r in want) > 5


def test_general_columns(spark):
    d = spark.createDataFrame([(1, "x y z z z z z z", "k")], "doc_id long, body string, source string")
    row = word_runs(d, ["source", "doc_id"], column="body").collect()[0]
    assert row["source"] == "k" and row["collapsed"] == "x y z" and row["n_words"] == 8
    assert [tuple(r) for r in row["runs"]] == [(2, 6, 1)]
    with pytest.raises(ValueError, match="runs"):
        word_runs(d.withColumnRenamed("body", "runs"), ["runs"], column="runs")


def test_empty_table(no_docs):
    assert report(no_docs) == []
