import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardspark.llm import pii
from cardspark.llm.pii import base_spans, disclosures, detect, pii_report, redact
from cardspark.llm.common import written

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(out)]


TEXTS = [
    "", "a@b.c", "a@b.c@d.e f@g", "x.34@mail7.example.com la", "@@a@b.c.d@e", "1.2.3.4.5.6.7.8",
    "0255.1.1.1 256.1.1.1 999.1.1.1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 2",
    "4111  1111", "+1 (555) 555-0100 and +49.30.123456", "+1", "+12", "++1 2345678901",
    "tel+1(2)3-4.5 6789012345678901", "a@b", "a.@b.c", "é@b.c é1.2.3.4é", "1" * 50,
    "5500005555555559x", "79927398713 79927398713 0", "a@b.c-d.e-", "+1 234 567 8901 @ 1.1.1.1",
]


def test_base_spans_match_the_patterns():
    for t in TEXTS:
        assert base_spans(t) == brute(t), t


@given(st.text(alphabet="a.@-1 25+()é", max_size=40))
@settings(max_examples=1500, deadline=None)
def test_base_spans_on_random_text(t):
    assert base_spans(t) == brute(t)


@given(st.text(alphabet="0123456789 -", min_size=14, max_size=30))
@settings(max_examples=500, deadline=None)
def test_cards_on_random_digits(t):
    assert base_spans(t) == brute(t)


def test_long_runs_are_linear():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "+1" + " " * 300_000, "1." * 150_000):
        base_spans(t)


def test_report(messy, no_docs, spark):
    rows = pii_report(messy).collect()
    assert len(rows) == messy.count()
    assert {r["base_sha256"] for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert pii_report(no_docs).count() == 0
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in pii_report(d).collect():
        want = brute(TEXTS[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"] == joined
        for k in PATTERNS:
            assert r[f"n_{k}"] == sum(x[2] == k for x in want)


def corpus(n=400):
    """Texts in which "zorblatt" stands by one address and nowhere else, and
    "common" everywhere."""
    rng = random.Random(5)

    def words(k):
        return " ".join("w" + str(rng.randrange(4000)) for _ in range(k))
    rows = [(i, f"{words(40)} common {words(40)}") for i in range(n)]
    for i in range(8):
        rows.append((1000 + i, f"{words(20)} common zorblatt wrote from jo@corp.example {words(20)}"))
    rows += [(2000 + i, rows[-1][1]) for i in range(50)]  # copies say nothing new
    rows.append((3000, f"{words(5)} lonely@corp.example {words(5)}"))
    return rows


def test_disclosing_terms(spark):
    rows = corpus()
    d = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    got = {r["doc_id"]: r["spans"] for r in pii_report(d).collect()}
    for i in range(8):
        t = text[1000 + i]
        named = {t[int(a):int(b)] for k, a, b in (s.split(":") for s in got[1000 + i].split(","))
                 if k in ("term", "removed")}
        assert "zorblatt" in named and "common" not in named
        assert "email" in got[1000 + i]
    assert all(got[i] == "" for i in range(400))  # clean texts stay as they are
    assert got[3000].count(":") == 2  # one context is no evidence
    found = written(detect(d), "found")
    share = {r["term"]: r["disclosure"] for r in disclosures(found, d, most=0.0, generalise=-9.0).collect()}
    assert max(share.values()) <= 1.0 and min(share.values()) < 0.7


def test_redact(spark):
    rows = corpus() + [(4000, None), (4001, ""), (4002, "mail a@b.c or 1.2.3.4, +1 (555) 555-0100")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "'k' AS kind", "text", "5 AS start")
    out = redact(d)
    assert out.columns == d.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[4000] is None and got[4001] == ""
    assert got[4002] == "mail [EMAIL] or [IP], [PHONE]"
    assert "zorblatt" not in got[1000] and "[EMAIL]" in got[1000] and "common" in got[1000]
    assert got[5] == dict(rows)[5]
    assert redact(d.limit(0)).count() == 0


def test_redact_messy(messy):
    assert sorted(map(str, redact(messy).collect())) == sorted(map(str, messy.collect()))


def test_disclosing_terms_anywhere_in_the_document(spark):
    """The name stands in the title and the footer, far from the address."""
    rng = random.Random(9)

    def words(k):
        return " ".join("w" + str(rng.randrange(400)) for _ in range(k))
    rows = [(i, f"{words(40)} common {words(40)}") for i in range(200)]
    rows += [(1000 + i, f"Zorblatt common {words(60)} jo@corp.example {words(60)} zorblatt") for i in range(6)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii_report(d).collect()}
    for i, t in rows[200:]:
        named = [t[int(a):int(b)] for k, a, b in (s.split(":") for s in got[i].split(",")) if k != "email"]
        assert [x for x in named if x.lower() == "zorblatt"] == ["Zorblatt", "zorblatt"]
        assert "common" not in named
    assert all(got[i] == "" for i in range(200))


def disclosed(rows, sure, most, generalise, remove):
    """Brute force: every entity against every term of its documents."""
    import math
    docs = []
    for _, text in rows:
        spans = brute(text)
        inside = lambda m: any(a < m.end() and m.start() < b for a, b, _ in spans)
        terms = [m[0].lower() for m in re.finditer("[0-9A-Za-z]+", text) if not inside(m)]
        every = {m[0].lower() for m in re.finditer("[0-9A-Za-z]+", text)}
        docs.append(({(k, text[a:b].lower()) for a, b, k in spans}, terms, every))
    total = len(docs)
    out = {}
    for e in {e for es, _, _ in docs for e in es}:
        mine = [(terms, frozenset(es)) for es, terms, _ in docs if e in es]
        ic = -math.log2(len(mine) / total)
        different = {(tuple(terms), es) for terms, es in mine}
        for t in {t for terms, _ in mine for t in terms}:
            p = min(1, sum(t in terms for terms, _ in mine) / sum(t in every for _, _, every in docs))
            hits = sum(terms.count(t) for terms, _ in different)
            n = hits / p
            low = (p + sure ** 2 / (2 * n) - sure * math.sqrt(p * (1 - p) / n + sure ** 2 / (4 * n * n))) \
                / (1 + sure ** 2 / n)
            d = 1 + math.log2(p) / ic
            if low > most and d >= generalise:
                out[e, t] = round(d, 9), "removed" if d >= remove else "term"
    return out


@pytest.mark.parametrize("limits", [(1.645, 0.5, 0.85, 0.95), (1.0, 0.3, 0.2, 0.6)])
def test_disclosure_equals_brute_force(spark, limits):
    rng = random.Random(14)
    names = [f"p{i}@corp.example" for i in range(6)] + ["10.1.2.3", "+1 (555) 555-0100"]
    rows = []
    for i in range(150):
        words = [f"w{rng.randrange(25)}" for _ in range(12)]
        for name in rng.sample(names, rng.choice([0, 0, 0, 1, 1, 2])):
            near = f"x{names.index(name)}"
            words += [name] + [near] * rng.randint(0, 3) + [f"y{rng.randrange(9)}"] * rng.randint(0, 2)
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    rows += [(200 + i, f"one only{i} only{i} only{i} rare{i} a{i}@b.example w1") for i in range(3)]
    rows += [(300 + i, r[1]) for i, r in enumerate(rows[:30])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    found = written(detect(d), "found")
    got = {(r["entity"], r["term"]): (round(r["disclosure"], 9), r["action"])
           for r in disclosures(found, d, "text", *limits).collect()}
    want = {}
    for (kind_value, t), v in disclosed(rows, *limits).items():
        want[pii._hash64(pii._entity(*kind_value)), int(pii.term_hashes([t])[0])] = v
    assert got == want and want
    assert any(t.startswith("only") for _, t in disclosed(rows, *limits))  # of a single document
