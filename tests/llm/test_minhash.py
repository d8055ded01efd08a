import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cardspark.llm import minhash
from cardspark.llm.common import text_slices
from cardspark.llm.components import components
from cardspark.llm.minhash import HASHES, near_duplicates, shingle_sets, signatures

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(t):
    w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", (t or "").translate(LOW)) if x]
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """{doc_id: (n_shingles, component)} over rows with unique ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def run(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_duplicates(d).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


def edited(rng, words, k):
    out = list(words)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10 ** 9)}"
    return " ".join(out)


def groups(seed):
    rng = random.Random(seed)

    def fresh(n):
        return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    rows, passage = [], fresh(60)
    for _ in range(12):  # near copies, from sure to borderline
        base = fresh(rng.randint(30, 200))
        for k in range(rng.randint(2, 6)):
            rows.append(edited(rng, base, k))
        rows.append(" ".join(base).upper())
    for _ in range(25):  # a passage that many share
        rows.append(" ".join(fresh(60) + passage + fresh(40)))
    hub = fresh(160)  # linked to all its copies, which are not linked among themselves
    rows += [edited(rng, hub, 4) for _ in range(30)] + [" ".join(hub)]
    rows += ["a b c", "A b  c", "a b c d", "x", "x\n", "", " ", None]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    rows = groups(seed)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("levels", [0, 2])
def test_large_buckets_by_every_path(spark, monkeypatch, levels):
    """With tiny blocks, buckets are split by signature, by block, and by pairs of blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 2000)
    monkeypatch.setattr(minhash, "LEVELS", levels)
    rows = groups(3)
    assert run(spark, rows) == brute(rows)


def rest_of_planted(spark, n_pairs, keys):
    """(pairs, links of _rest) for borderline pairs of texts; ``keys``: what pair
    i has in its bands, by band. All other bands are shared with nobody."""
    rng = random.Random(11)
    texts = []
    for _ in range(n_pairs):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(124)]
        pair = list(base)
        for at in (20, 60, 100):  # 15 of 120 shingles: similarity 105 / 135 = 0.78
            pair[at] = f"new{rng.randrange(10 ** 9)}"
        texts += [" ".join(base), " ".join(pair)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    facts, members = [], []
    for r in minhash.signed(docs).collect():
        pair = r["doc_id"] // 2
        bands = [10 ** 9 + r["doc_id"] * 100 + b for b in range(minhash.BANDS)]
        for b, key in keys(pair).items():
            bands[b] = key
            members.append((r["doc_id"], r["n_shingles"], b, key, 2))
        facts.append((r["doc_id"], r["n_shingles"], bytes(r["sig"]), np.array(bands, np.int64).tobytes()))
    got = minhash._rest(
        docs, spark.createDataFrame(members, "node long, n long, band int, bucket long, n_in_bucket long"),
        spark.createDataFrame([], "node long, component long"),
        spark.createDataFrame(facts, "node long, n long, sig binary, bands binary")).collect()
    return {(2 * i, 2 * i + 1) for i in range(n_pairs)}, {(min(r), max(r)) for r in got}


@pytest.mark.parametrize("exact", [64, 1])
def test_large_bucket_loses_no_pair(spark, monkeypatch, exact):
    """All in one large bucket: searched by pairs of blocks, or by sub-buckets."""
    monkeypatch.setattr(minhash, "BLOCK", 20_000)
    monkeypatch.setattr(minhash, "EXACT", exact, raising=False)
    pairs, got = rest_of_planted(spark, 150, lambda i: {0: 7})
    assert got == pairs


def test_small_bucket_rescues_what_a_split_one_missed(spark, monkeypatch):
    """With one sub-bucket a level a split misses many; each pair's own bucket does not."""
    monkeypatch.setattr(minhash, "BLOCK", 20_000)
    monkeypatch.setattr(minhash, "EXACT", 1, raising=False)
    monkeypatch.setattr(minhash, "SPLITS", 1)
    pairs, got = rest_of_planted(spark, 60, lambda i: {0: 7, 5: 100 + i})
    assert got == pairs


def test_signature_estimates_similarity():
    rng = random.Random(4)
    errors, errors_in = [], 0
    for _ in range(150):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
        pair = [" ".join(base), edited(rng, base, rng.randint(0, 8))]
        (_, data, off), = text_slices(pa.array(pair))
        sig = signatures(*shingle_sets(data, off))
        a, b = map(shingles, pair)
        true = len(a & b) / len(a | b)
        errors.append((sig[0] == sig[1]).mean() - true)
        errors_in += true * (1 - true) / HASHES
    assert abs(np.mean(errors)) < 0.01
    # no wider than independent hashes would be
    assert np.var(errors) < 1.3 * errors_in / len(errors)


def test_signature_of_a_set_fills_every_place_once_a_round():
    (_, data, off), = text_slices(pa.array(["one", "", "a b c d e f g"]))
    sig = signatures(*shingle_sets(data, off))
    assert sorted((sig[0] >> 24).tolist()) == list(range(HASHES))  # one shingle: a permutation
    assert (sig[1] == 0xFFFFFFFF).all()
    rounds = np.sort(sig[2] >> 24)
    assert np.bincount(rounds)[0] >= 1 and rounds[-1] < HASHES


def test_shingles_across_slices():
    texts = ["A b c d e f", None, "", "x y", "a B c d e f"]
    whole = list(text_slices(pa.array(texts)))
    single = list(text_slices(pa.array(texts), slice_bytes=1))
    assert len(whole) == 1 and len(single) > 1
    h, first = shingle_sets(whole[0][1], whole[0][2])
    got = [h[a:b].tolist() for a, b in zip(first, first[1:])]
    one = []
    for _, data, off in single:
        x, f = shingle_sets(data, off)
        one += [x[a:b].tolist() for a, b in zip(f, f[1:])]
    assert got == one and got[0] == got[4] and got[1] == got[2] == []
    assert [len(g) for g in got] == [len(shingles(t)) for t in texts]


def test_messy(spark, messy, no_docs):
    got = near_duplicates(messy).collect()
    assert len(got) == messy.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append((r["component_id"], r["kept"]))
    assert by_id[1] == [(1, True), (1, True)] and by_id[2] == [(1, False)]
    assert by_id[7] == [(1, False)] and by_id[3] == [(3, True)]
    assert by_id[None] == [(None, True)] * 2
    assert near_duplicates(no_docs).count() == 0


def test_components_of_links(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(0, 300)]  # a long chain
    links += [(1000, 1000 + i) for i in range(1, 200)]  # a star
    links += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    links += [(5, 5), (1, 0)]
    rng.shuffle(links)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    d = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r["node"]: r["component"] for r in components(d).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
    assert components(d.limit(0)).count() == 0
