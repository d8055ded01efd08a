import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardspark.llm import packing
from cardspark.llm.packing import END_ID, WINDOW, _ids, fill, pack, pack_lengths

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = ["", " ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "don't we'll 's", "x y z w",
       "<|endoftext|>", "a <|endoftext|> b", "1 23 456,7", "é ü ß 日本 語", "tab\tx y\x0bz",
       "word " * 50 + "end", "aé'll! (b) ...", "\x85 q​ r", "aa bb cc " * 3 + "x" * 90]


@given(st.lists(st.text(alphabet="ab '\n\t1é! 日<|>", max_size=25), max_size=6))
@settings(max_examples=60, deadline=None)
def test_ids_equal_the_tokenizers(texts):
    t = Tokenizer.from_file(PATH) if not hasattr(test_ids_equal_the_tokenizers, "t") else \
        test_ids_equal_the_tokenizers.t
    test_ids_equal_the_tokenizers.t = t
    got = _ids(None).encode(texts)
    for text, raw in zip(texts, got):
        ids = t.encode(text, add_special_tokens=False).ids
        assert raw == struct.pack(f"<{len(ids)}I", *ids)


def test_odd_texts(tokenizer):
    for text, raw in zip(ODD, _ids(PATH).encode(ODD)):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert raw == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_the_cache_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 5)
    ids = packing._Ids(PATH)
    for k in range(4):
        texts = [f"alpha{k} beta{i} gamma " + "x" * 60 for i in range(10)]
        for text, raw in zip(texts, ids.encode(texts)):
            x = tokenizer.encode(text, add_special_tokens=False).ids
            assert raw == struct.pack(f"<{len(x)}I", *x)
        assert len(ids.memo.young) + len(ids.memo.old) < 40
    # what was wanted last stays, however often the generations change
    for k in range(9):
        ids.encode([f"a often{k} b{k} c{k} d{k} e{k} f{k} gamma"])
        assert "gamma" in ids.memo.young


def test_many_chunks_as_one_text(tokenizer):
    rng = __import__("random").Random(6)
    text = " ".join("".join(rng.choice("abét1,.<'") for _ in range(rng.randint(1, 9)))
                    + ("\nx" if i % 9 == 0 else "") for i in range(7000))
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    assert packing._Ids(PATH).encode([text])[0] == struct.pack(f"<{len(ids)}I", *ids)


@given(st.lists(st.integers(1, 30), max_size=12), st.integers(1, 60))
@settings(max_examples=200, deadline=None)
def test_fill_is_the_closest_sum(lengths, room):
    counts = Counter(lengths)
    best, taken = fill(sorted(counts, reverse=True), counts, room)
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums}
    assert best == max(s for s in sums if s <= room)
    assert sum(x * k for x, k in taken.items()) == best
    assert all(k <= counts[x] for x, k in taken.items())


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=100, deadline=None)
def test_windows_hold_every_piece_once(lengths):
    bins = pack_lengths(lengths, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 50 for b in bins)


def check(spark, docs, tokenizer):
    rows = pack(docs).collect()
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    pieces, places = Counter(), {}
    for r in rows:
        pieces[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = Counter()
    for doc, all_ in texts.items():
        for text in all_:
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID]
            for s in range(0, len(ids), WINDOW):
                part = ids[s:s + WINDOW]
                want[doc, s, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids)] += 1
    assert pieces == want
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= WINDOW
    return places


def test_messy(spark, messy, tokenizer):
    check(spark, messy, tokenizer)


def test_little_padding(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    places = check(spark, docs, tokenizer)
    full = [sum(n for _, n in p) for p in places.values()]
    assert sum(WINDOW - n for n in full) < WINDOW * 2


def test_with_ids(messy):
    for r in pack(messy.filter("doc_id = 9"), with_ids=True).collect():
        assert len(r["ids"]) == 4 * r["length"]
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]


def test_empty_table(no_docs):
    assert pack(no_docs).count() == 0


def test_a_chunk_is_looked_up_once_a_slice(tokenizer, monkeypatch):
    ids = packing._Ids(PATH)
    asked = []
    monkeypatch.setattr(ids.memo, "of", lambda wanted, make, of=ids.memo.of:
                        asked.append(len(wanted)) or of(wanted, make))
    texts = ["one two\nthree two one", "two two", "one", "three\ntwo"]
    for size in (packing.SLICE_CHARS, 5):
        monkeypatch.setattr(packing, "SLICE_CHARS", size)
        for text, raw in zip(texts, ids.encode(texts)):
            x = tokenizer.encode(text, add_special_tokens=False).ids
            assert raw == struct.pack(f"<{len(x)}I", *x)
    # three heads, " two", " one", "\nthree", "\ntwo" at once; then text by text
    assert asked[0] == 7 and len(asked) == 5


def test_batches_are_gathered(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(packing, "SLICE_CHARS", 4)
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": [t]})
               for i, t in enumerate(["ab", None, "cde", "", "f"])]
    got = [(d, t) for d, t, _ in packing._gathered(iter(batches))]
    assert got == [([0, 1, 2], ["ab", "", "cde"]), ([3, 4], ["", "f"])]
