import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cardspark.llm import bpe
from cardspark.llm.bpe import Vocabulary, decode, digests, encode, encoder

PATH = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
MULTI = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def library(path):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module", params=[PATH, MULTI])
def pair(request):
    return encoder(request.param, public_tokenizers.PATTERN), library(request.param)


def ids(e, texts):
    return [np.frombuffer(x, np.int32).tolist() for x in e.encode(texts)]


def matched(vocabulary, matches):
    return [np.frombuffer(x, np.int32).tolist() for x in vocabulary.encode_matches(matches)]


def merged(vocabulary, data):
    """Brute force: join the lowest-ranked neighbours until none join."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, i = min((vocabulary.rank.get(a + b, 1 << 30), i)
                      for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best == 1 << 30:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [vocabulary.rank[p] for p in parts]


@given(st.lists(st.text(alphabet="abthe \n'\t1é日-՘\x1c\x85\U0001f600", max_size=40), max_size=5))
@settings(max_examples=150, deadline=None)
def test_ids_equal_the_library(pair, texts):
    e, lib = pair
    assert ids(e, texts) == [lib.encode_ordinary(t) for t in texts]


@given(st.lists(st.text(max_size=30), max_size=4))
@settings(max_examples=100, deadline=None)
def test_any_characters(pair, texts):
    e, lib = pair
    assert ids(e, texts) == [lib.encode_ordinary(t) for t in texts]


def test_characters_of_other_classes(pair):
    e, lib = pair
    odd = sorted(bpe._other_classes())[::97]
    texts = [f"ab{c}cd {c} 1{c}2{c}{c} x" for c in odd]
    assert ids(e, texts) == [lib.encode_ordinary(t) for t in texts]


@given(st.lists(st.integers(0, 255), min_size=1, max_size=30), st.sampled_from(["ab", "the ing", None]))
@settings(max_examples=150, deadline=None)
def test_any_bytes_equal_merging(values, alphabet):
    v = encoder(PATH, public_tokenizers.PATTERN).vocabulary
    data = bytes(values) if alphabet is None else \
        bytes(ord(alphabet[x % len(alphabet)]) for x in values)
    assert matched(v, [data]) == [merged(v, data)]


def test_long_matches(pair):
    e, lib = pair
    rng = random.Random(5)
    texts = ["a" * 5000, "ab" * 3000, "-" * 4000, " " * 4000, "the" * 2000, "\n" * 999, "日本" * 700,
             "".join(rng.choice("ab") for _ in range(20000)),
             "".join(rng.choice("etaoinshrdlu") for _ in range(20000))]
    assert ids(e, texts) == [lib.encode_ordinary(t) for t in texts]


def rank_file(tmp_path, tokens):
    every = [bytes([b]) for b in range(256)] + tokens
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(every)))
    return str(path)


@given(st.text(alphabet="abc", min_size=1, max_size=25))
@settings(max_examples=300, deadline=None)
def test_dead_ends_and_equal_ranks(tmp_path_factory, text):
    tokens = [b"aa", b"ab", b"bc", b"aaa", b"abc", b"bca", b"aaaa", b"abab", b"cc", b"bcabc"]
    if not hasattr(test_dead_ends_and_equal_ranks, "v"):
        test_dead_ends_and_equal_ranks.v = Vocabulary(rank_file(tmp_path_factory.mktemp("v"), tokens))
    v = test_dead_ends_and_equal_ranks.v
    want = merged(v, text.encode())
    whole = v.rank.get(text.encode())
    want = [[whole] if whole is not None else want]
    assert matched(v, [text.encode()]) == want
    assert matched(v, [text.encode(), b"x" * 100, text.encode() * 40])[0] == want[0]
    long = text.encode() * 40  # beyond the matches that are walked together
    assert matched(v, [long]) == [merged(v, long)]


def test_tokens_that_merging_does_not_make(tmp_path):
    # "abc" is there, but neither "ab" nor "bc"
    v = Vocabulary(rank_file(tmp_path, [b"abc", b"cd"]))
    assert matched(v, [b"abc", b"abcd", b"xabc"]) == [
        [256], [97, 98, 257], [120, 97, 98, 99]]


def test_a_token_made_of_a_later_one_is_an_error(tmp_path):
    with pytest.raises(ValueError, match="later token"):
        Vocabulary(rank_file(tmp_path, [b"abc", b"ab"]))


def test_the_memory_is_bounded(monkeypatch):
    e = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    e.memo.bound = 20
    lib = library(PATH)
    for k in range(6):
        texts = [f"alpha{k} beta{i} gamma " + "x" * 60 for i in range(15)]
        assert ids(e, texts) == [lib.encode_ordinary(t) for t in texts]
        assert len(e.memo.young) + len(e.memo.old) < 120
        assert not any(len(m) > bpe.MEMO_CHARS for m in e.memo.young)


def report(docs):
    both = decode(encode(docs, keep=["doc_id"]), keep=["doc_id", "ids"])
    return both.select("doc_id", *digests("ids", "decoded")).collect()


def want(docs):
    lib = library(PATH)
    out = []
    for r in docs.select("doc_id", "text").collect():
        x = lib.encode_ordinary(r["text"] or "")
        out.append((r["doc_id"], len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(),
                    hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    return out


def test_messy(messy, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", 500)
    key = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert key(report(messy)) == key(want(messy))


def test_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert sorted(map(tuple, report(docs))) == sorted(want(docs))


def test_empty_table_and_null_ids(spark, no_docs):
    assert report(no_docs) == []
    d = spark.createDataFrame([(1, None), (2, []), (3, [64, 65])], "doc_id long, ids array<int>")
    assert [bytes(r["b"]) for r in decode(d, ["doc_id"], into="b").orderBy("doc_id").collect()] == [
        b"", b"", b"".join(Vocabulary(PATH).token[i] for i in (64, 65))]


def test_a_clashing_name_is_an_error(no_docs):
    with pytest.raises(ValueError, match="ids"):
        encode(no_docs.withColumnRenamed("lang", "ids"), keep=["ids"])
