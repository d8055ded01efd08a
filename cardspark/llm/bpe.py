"""Byte-level BPE encoding by longest matches with backtracking, and decoding.

A vocabulary gives each token its bytes and its rank; merging joins, again and
again, the neighbouring pair whose joined bytes have the lowest rank (the
leftmost of equals). The encoder reaches the same tokens without merging:

- Every match of the split pattern is written with one Latin-1 character a byte,
  and an Aho-Corasick automaton over the tokens gives the longest token that
  starts at each place.
- Two tokens may stand side by side if merging their bytes together leaves them
  so. Their histories are undone latest merge first; the pair at the seam must
  at no time have a join that ranks before the merge that ended it. Answers are
  memoised (``PAIRS``).
- A walk takes the longest token at its place that may follow the last one, else
  the next shorter prefix of it that is a token. If none is left, the place is
  dead: the last token is taken back and shortened. The tokens that merging
  gives to a prefix are unique, so a dead place stays dead, each place dies once
  at most, and the walk is linear in the length of the match.

A match that is a token as a whole is that token, as in the reference library.
Ids of matches up to ``MEMO_CHARS`` characters are remembered, twice
``MEMO_MATCHES`` of them at most in a worker.

Character classes follow the library that is matched: letters, numbers and
white space are those of its regular expressions, which may know another
version of Unicode than ours. Characters whose class differs are replaced by a
stand-in of the right class before a text is split, and only then.

A task holds one Arrow batch of texts and works on ``SLICE_CHARS`` characters at
a time (a longer single text alone). Encoding is row by row: there is no
shuffle, and hot sources or repeated texts cost what other rows do.

Defined results: a null or empty text has no ids (an empty list) and decodes to
empty bytes; null ids decode to empty bytes; repeated rows are encoded each; an
empty table gives an empty one. Of other columns only those in ``keep`` are
carried; one of them named like the result is an error.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from cardspark.llm.common import small_batches, tidied
from cardspark.llm.memo import Memo

PAIRS = 1 << 18
MEMO_MATCHES = 300_000
MEMO_CHARS = 40
SLICE_CHARS = 1_000_000
# Matches up to this size are walked together.
GREEDY_BYTES = 64
# stands between matches given to the automaton: beyond every byte
_GAP = "\u0100"
# a character that is neither letter, number nor white space in any version
_STAND_IN = "\ue000"


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Vocabulary:
    """Tokens of a rank file and the tables of the encoder."""

    def __init__(self, path: str):
        self.rank = _ranks(path)
        top = max(self.rank.values()) + 1
        self.token: list[bytes] = [b""] * top
        for token, rank in self.rank.items():
            self.token[rank] = token
        if any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError(f"{path}: not every byte is a token")
        self.size = [len(t) for t in self.token]
        self.sizes = np.array(self.size, np.int32)
        # when a token is made (single bytes are there from the start) and of what
        self.made = [-1] * top
        self.left, self.right = [-1] * top, [-1] * top
        self.shorter = [-1] * top
        # tokens that merging never makes: whole matches alone
        self.unmade: set[bytes] = set()
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            if len(token) > 1:
                parts = self._parts(token, rank)
                if parts is None:
                    self.unmade.add(token)
                    continue
                self.left[rank], self.right[rank] = parts
                self.made[rank] = rank
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.automaton.make_automaton()
        for token, rank in self.rank.items():
            for n in range(len(token) - 1, 0, -1):
                r = self.rank.get(token[:n])
                if r is not None and (n == 1 or self.made[r] >= 0):
                    self.shorter[rank] = r
                    break
        self.may_meet = lru_cache(PAIRS)(self._may_meet)

    def _parts(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None if merging its bytes
        stops at more than two."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((self.rank.get(a + b, len(self.token)), i)
                           for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == len(self.token):
                return None
            if best >= rank:
                raise ValueError(f"token {rank} is made of later token {best}")
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return self.rank[parts[0]], self.rank[parts[1]]

    def _may_meet(self, a: int, b: int) -> bool:
        """Whether merging the bytes of tokens ``a`` and ``b`` in one go leaves
        them as they are."""
        rank, token, made = self.rank.get, self.token, self.made
        # the pair at the seam stood until a merge of this rank, itself to the
        # left of the seam (it goes first among equals) or to the right
        until, from_left = len(token), False
        while True:
            join = rank(token[a] + token[b])
            if join is not None and (join < until or join == until and not from_left):
                return False
            if made[a] < 0 and made[b] < 0:
                return True
            if made[a] > made[b]:
                until, from_left, a = made[a], True, self.right[a]
            else:
                until, from_left, b = made[b], False, self.left[b]

    def _walk(self, longest: list[int], start: int, end: int) -> list[int]:
        ids: list[int] = []
        dead: set[int] = set()
        size, shorter, may_meet = self.size, self.shorter, self.may_meet
        at, t = start, longest[start]
        while True:
            stop = at + size[t]
            if stop not in dead and (not ids or may_meet(ids[-1], t)):
                ids.append(t)
                if stop == end:
                    return ids
                at, t = stop, longest[stop]
            elif shorter[t] >= 0:
                t = shorter[t]
            else:
                dead.add(at)
                t = ids.pop()
                at -= size[t]

    def _greedy(self, longest: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """The longest token at each place, from the start to the end of each
        match: (ids, first of each match), and whether all neighbours may meet."""
        at = starts.copy()
        going = np.arange(len(starts))
        who, ids = [], []
        while len(going):
            t = longest[at[going]]
            who.append(going)
            ids.append(t)
            at[going] += self.sizes[t]
            going = going[at[going] < ends[going]]
        who, ids = np.concatenate(who), np.concatenate(ids)
        order = np.argsort(who, kind="stable")
        who, ids = who[order], ids[order]
        inside = np.flatnonzero(who[1:] == who[:-1])
        pairs = ids[inside].astype(np.int64) << 32 | ids[inside + 1]
        pairs, which = np.unique(pairs, return_inverse=True)
        meet = np.array([self.may_meet(p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()], bool)
        good = np.ones(len(starts), bool)
        good[who[inside[~meet[which]]]] = False
        return ids, np.searchsorted(who, np.arange(len(starts) + 1)), good

    def encode_matches(self, matches: list[bytes]) -> list[bytes]:
        """Ids of byte strings, none of them empty, as native 32-bit integers.
        Short ones take the first steps of their walks together; where the
        longest tokens may all meet, that is the whole walk."""
        if not matches:
            return []
        text = _GAP.join([m.decode("latin-1") for m in matches])
        # single bytes first; in the automaton's order ends rise, so that the
        # longest token of a place is the last one put there
        longest = self.byte[np.frombuffer(b"\0".join(matches), np.uint8)]
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int32).reshape(-1, 2)
        longest[found[:, 0] + 1 - self.sizes[found[:, 1]]] = found[:, 1]
        lengths = np.array([len(m) for m in matches])
        starts = np.cumsum(lengths + 1) - lengths - 1
        out: list = [None] * len(matches)
        short = np.flatnonzero(lengths <= GREEDY_BYTES)
        left = np.flatnonzero(lengths > GREEDY_BYTES).tolist()
        if len(short):
            ids, first, good = self._greedy(longest, starts[short], (starts + lengths)[short])
            raw = ids.tobytes()
            cuts = (4 * first).tolist()
            for k, (i, fine) in enumerate(zip(short.tolist(), good.tolist())):
                if fine:
                    out[i] = raw[cuts[k]:cuts[k + 1]]
                else:
                    left.append(i)
        at_places = longest.tolist() if left else []
        for i in left:
            out[i] = array("i", self._walk(at_places, int(starts[i]), int(starts[i] + lengths[i]))).tobytes()
        if self.unmade:
            for i, m in enumerate(matches):
                if m in self.unmade:
                    out[i] = array("i", [self.rank[m]]).tobytes()
        return out


class Splitter:
    """Matches of a split pattern, with the character classes of the library."""

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        odd = _other_classes()
        ranges = []
        for c in sorted(map(ord, odd)):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
        self.least_odd = min(odd, default=chr(0x10FFFF))
        self.odd = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) + "]"
                              if odd else "(?!)")
        self.stand_ins = {ord(c): to for c, to in odd.items()}

    def matches(self, text: str) -> list[str]:
        if text.isascii() or max(text) < self.least_odd or not self.odd.search(text):
            return self.pattern.findall(text)
        return [text[m.start():m.end()]
                for m in self.pattern.finditer(text.translate(self.stand_ins))]


@lru_cache(1)
def _other_classes() -> dict[str, str]:
    """Characters that the library's regular expressions put into another class
    than ours: character to a stand-in of the library's class."""
    import tiktoken
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    out = {}
    kinds = [(r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", " "),
             (r"[^\s\p{L}\p{N}]", _STAND_IN)]
    for kind, stand_in in kinds:
        theirs = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={})
        found = set(bytes(theirs.encode_ordinary(every)).decode())
        for c in found.difference(regex.findall(kind, every)):
            out[c] = stand_in
    return out


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.splitter = Splitter(pattern)
        self.memo = Memo(MEMO_MATCHES, MEMO_CHARS)

    def _make(self, matches: list[str]) -> list[bytes]:
        return self.vocabulary.encode_matches([m.encode() for m in matches])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as native 32-bit integers."""
        split = [self.splitter.matches(t) for t in texts]
        known = self.memo.of(set().union(*split), self._make)
        return [b"".join(map(known.__getitem__, ms)) for ms in split]


@lru_cache(4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(4)
def _token_bytes(path: str) -> pa.Array:
    rank = _ranks(path)
    tokens = [b""] * (max(rank.values()) + 1)
    for token, r in rank.items():
        tokens[r] = token
    return pa.array(tokens, pa.large_binary())


def _defaults(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers
    return (path or str(public_tokenizers.path("byte_bpe_50k.tiktoken")),
            pattern or public_tokenizers.PATTERN)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    i = held = 0
    for j, t in enumerate(texts):
        if held and held + len(t) > SLICE_CHARS:
            yield i, j
            i, held = j, 0
        held += len(t)
    if i < len(texts):
        yield i, len(texts)


def _with_result(df: DataFrame, keep: list[str], into: str, kind) -> StructType:
    if into in keep:
        raise ValueError(f"column {into} is both kept and made")
    return StructType([df.schema[c] for c in keep] + [StructField(into, kind)])


def encode(docs: DataFrame, keep: list[str], column: str = "text", into: str = "ids",
           path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the token ids of ``column`` as an array
    of int. ``path``: a file of ranks, one base64 token and its rank a line, that
    every worker can read; ``pattern``: what splits a text before the merges."""
    schema = _with_result(docs, keep, into, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(*_defaults(path, pattern))
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            for i, j in _slices(texts):
                raw = e.encode(texts[i:j])
                ends = np.cumsum([0] + [len(r) // 4 for r in raw]).astype(np.int32)
                ids = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.frombuffer(b"".join(raw), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(i, j - i) for k in range(len(keep))] + [ids],
                    keep + [into])

    small_batches(docs.sparkSession)
    return docs.select(*keep, F.col(column).alias("_bpe_text")).mapInArrow(tidied(run), schema)


def decode(encoded: DataFrame, keep: list[str], column: str = "ids", into: str = "decoded",
           path: str | None = None) -> DataFrame:
    """Columns ``keep`` and the bytes (binary) that the ids in ``column`` stand
    for."""
    schema = _with_result(encoded, keep, into, BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _token_bytes(_defaults(path, None)[0])
        for batch in batches:
            ids = batch.column(len(keep))
            sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
            ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
            # the tokens taken in order: their data is the decoded texts end to end
            taken = tokens.take(ids.flatten())
            where = np.frombuffer(taken.buffers()[1], np.int64)[:len(taken) + 1] \
                if len(taken) else np.zeros(1, np.int64)
            data = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
            texts = pa.Array.from_buffers(
                pa.large_binary(), len(batch),
                [None, pa.py_buffer(where[ends].tobytes()), data])
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(keep))] + [texts.cast(pa.binary())],
                keep + [into])

    small_batches(encoded.sparkSession)
    return encoded.select(*keep, F.col(column).alias("_bpe_ids")).mapInArrow(tidied(run), schema)


def digests(ids: str, decoded: str) -> list:
    """n_tokens, ids_sha256 and decoded_sha256 of columns of ids and bytes."""
    return [F.size(ids).cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256)
            .alias("ids_sha256"),
            F.sha2(F.col(decoded), 256).alias("decoded_sha256")]
