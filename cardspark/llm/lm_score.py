"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Counting. Tasks count the unigrams and bigrams of the training texts (words
with A-Z lower-cased, and an end token that also stands before the first word),
unite equal ones as they go, and pass on sorted runs of (64-bit hash, count),
cut into slices by the hash's leading bits. One task a slice adds the runs up.

Filter. Counts are quantised on a scale of thresholds that grow by ``STEP``
(small counts are exact). An n-gram of level q is put in its slice's Bloom
filter once for each level 1..q; asking for levels 1, 2, ... until one is
missing gives q back, and false positives only ever add to it. Every bigram is
stored, those met once included (``BIGRAM_FLOOR``). The slices' filters, together
at most ``FILTER_MB``, are broadcast: ``BITS`` bits an item, fewer if that would
not fit. Then false positives rise (the number of probes follows the bits, no
level beyond the highest stored is asked for, and no n-gram is left out);
``FILTER_MB`` should grow with the memory of the workers.

Model. P(w | v) = a * c(vw) / c(v) + (1 - a) * P(w), where P(w) is
(1 - u) * c(w) / sum(c) for words in the filter and u for any other, u the
Good-Turing mass of words met once. The weight a depends on c(v)'s level and is
the best of a grid on all training texts, each scored without its own counts.
The score is the sum of log10 P over the tokens. The filter is asked once per
text: what it says goes along as two bytes a token, and a task's gains by weight
as one row, so the weights are known before the scores are made of the bytes. What
it says of the top words (see Base) is looked up once for all texts.

Base. The exact add-one unigram score needs exact counts. The ``TOP_WORDS``
most frequent words (fixed number) are broadcast with theirs; the others go, as
runs per slice, to the slice's counts, and their sums come back per text.

Defined results: null or empty text is the end token alone; a null doc_id
counts as training; repeated rows count and are scored each; an empty table
gives an empty result; without training texts all counts are 0. Extra columns
are not read. Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm.common import (
    LOWER, bucket_of, golden, mix64, poly_of, small_batches, text_slices, tidied, word_bounds,
    word_hashes, written,
)

STEP = 1.2
BIGRAM_FLOOR = 1
BITS = 10
PROBES = 6
FILTER_MB = 160
TOP_WORDS = 1 << 18
GRID = (0.0, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
RUN_ITEMS = 1_500_000  # n-grams a task holds before it passes them on
END = mix64(np.array([0xE4D], np.uint64))[0]


# ------------------------------------------------------------- quantisation

def thresholds(floor: int, most: int = 1 << 62) -> np.ndarray:
    """The least count of level 1, 2, ...: from ``floor``, growing by STEP."""
    out = [floor]
    while out[-1] < most:
        out.append(max(out[-1] + 1, int(out[-1] * STEP + 0.999)))
    return np.array(out, np.float64)


_LEVELS = {1: thresholds(1), BIGRAM_FLOOR: thresholds(BIGRAM_FLOOR)}


def levels(counts: np.ndarray, floor: int) -> np.ndarray:
    return np.searchsorted(_LEVELS[floor], counts, "right")


def level_counts(level: np.ndarray, floor: int) -> np.ndarray:
    """The count a level stands for: the middle of its range; 0 for level 0."""
    t = _LEVELS[floor]
    mid = np.append(0.0, (t[:-1] + t[1:] - 1) / 2)
    return mid[level]


# -------------------------------------------------------------------- grams

def tokens(data: np.ndarray, off: np.ndarray):
    """(hashes, first): the token hashes of the rows, each row's words and
    then the end token, and where each row's begin."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, off)
    h = word_hashes(data, starts, ends)
    n = np.diff(first)
    place = np.arange(len(h)) + np.repeat(np.arange(len(n)), n)
    out = np.full(len(h) + len(n), END, np.uint64)
    out[place] = h
    return out, first + np.arange(len(first))


def before(h: np.ndarray) -> np.ndarray:
    """The token before each: the end token opens every row."""
    return np.append(END, h[:-1])


def _bigrams(h: np.ndarray) -> np.ndarray:
    return poly_of([before(h), h])


def _united(hashes: list[np.ndarray], counts: list[np.ndarray]):
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    if not len(h):
        return h, c
    at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    return h[at], np.add.reduceat(c, at)


def _slice_bits(n_slices: int) -> int:
    return n_slices.bit_length() - 1


def _cut(h: np.ndarray, n_slices: int) -> np.ndarray:
    """Where each slice begins in sorted hashes (one more entry)."""
    edge = np.arange(1, n_slices, dtype=np.uint64) << np.uint64(64 - _slice_bits(n_slices))
    return np.concatenate([[0], np.searchsorted(h, edge), [len(h)]])


def count_runs(train: DataFrame, n_slices: int) -> DataFrame:
    """(slice, n, hashes, counts): sorted runs of n-gram counts, n the order."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {1: ([], []), 2: ([], [])}
        size = 0

        def flush():
            for order, (hs, cs) in held.items():
                if hs:
                    h, c = _united(hs, cs)
                    at = _cut(h, n_slices)
                    s = np.flatnonzero(np.diff(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s, pa.int32()), pa.array(np.full(len(s), order), pa.int32()),
                         pa.array([h[at[i]:at[i + 1]].tobytes() for i in s], pa.binary()),
                         pa.array([c[at[i]:at[i + 1]].astype(np.uint32).tobytes() for i in s],
                                  pa.binary())], ["slice", "n", "hashes", "counts"])
                hs.clear()
                cs.clear()

        for batch in batches:
            for _, data, off in text_slices(batch.column(0)):
                h, _ = tokens(data, off)
                for order, x in ((1, h), (2, _bigrams(h))):
                    u, c = np.unique(x, return_counts=True)
                    held[order][0].append(u)
                    held[order][1].append(c)
                    size += len(u)
                if size > RUN_ITEMS:
                    for hs, cs in held.values():
                        u, c = _united(hs, cs)
                        hs[:], cs[:] = [u], [c]
                    size = sum(len(hs[0]) for hs, _ in held.values())
                    if size > RUN_ITEMS // 2:  # uniting no longer shrinks them
                        yield from flush()
                        size = 0
        yield from flush()

    small_batches(train.sparkSession)
    return train.select("text").mapInArrow(
        tidied(count), "slice int, n int, hashes binary, counts binary")


# ------------------------------------------------------------------- filter

def probes_for(bits: float) -> int:
    """Probes that make false positives fewest at so many bits an item."""
    return min(PROBES, max(1, round(bits * math.log(2))))


_LOW = np.uint64(0xFFFFFFFF)


def _seeds(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix64(keys + golden(level))
    return x & _LOW, (x >> np.uint64(32)) | np.uint64(1)


def _position(a: np.ndarray, b: np.ndarray, i: int, n_bits) -> np.ndarray:
    """Probe ``i``: 32 hash bits scaled to the size (below 2 ** 32)."""
    return (((a + np.uint64(i) * b) & _LOW) * n_bits >> np.uint64(32)).astype(np.int64)


def put(keys: np.ndarray, level: np.ndarray, n_bits: int, probes: int = PROBES) -> np.ndarray:
    """The bytes of a filter of ``n_bits`` bits that holds each key once for
    every level up to its own."""
    flags = np.zeros(n_bits, bool)
    size = np.uint64(n_bits)
    q = 1
    while len(keys):
        a, b = _seeds(keys, q)
        for i in range(probes):
            flags[_position(a, b, i, size)] = True
        stay = level > q
        keys, level = keys[stay], level[stay]
        q += 1
    return np.packbits(flags, bitorder="little")


class Filter:
    """The slices' filters in one array; ``level(keys)`` probes them, up to
    ``top``, the highest level that was put in."""

    def __init__(self, data: np.ndarray, start: np.ndarray, n_bits: np.ndarray, top: int,
                 probes: int = PROBES):
        self.data, self.start, self.n_bits = data, start, n_bits
        self.top, self.probes = top, probes

    def level(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        s = (keys >> np.uint64(64 - _slice_bits(len(self.start)))).astype(np.int64) \
            if len(self.start) > 1 else np.zeros(len(keys), np.int64)
        start, n_bits = self.start[s], self.n_bits[s]
        alive, q = np.arange(len(keys)), 1
        while len(alive) and q <= self.top:
            a, b = _seeds(keys[alive], q)
            at, size = start[alive], n_bits[alive]
            for i in range(self.probes):
                p = _position(a, b, i, size)
                held = (self.data[at + (p >> 3)] >> (p & 7).astype(np.uint8)) & 1 == 1
                # what one probe misses is not asked again
                alive, a, b, at, size = alive[held], a[held], b[held], at[held], size[held]
            out[alive] = q
            q += 1
        return out


def add_up(runs: DataFrame) -> DataFrame:
    """Per slice: words and word_counts (exact, sorted), items, the stored
    n-grams as keys and levels, and totals."""

    def add(group: pa.Table) -> pa.Table:
        order = group.column("n").to_numpy()
        raw_h, raw_c = group.column("hashes").to_pylist(), group.column("counts").to_pylist()
        found = {}
        for n in (1, 2):
            pick = np.flatnonzero(order == n)
            found[n] = _united(
                [np.frombuffer(raw_h[i], np.uint64) for i in pick] or [np.zeros(0, np.uint64)],
                [np.frombuffer(raw_c[i], np.uint32).astype(np.int64) for i in pick]
                or [np.zeros(0, np.int64)])
        (w, wc), (b, bc) = found[1], found[2]
        often = bc >= BIGRAM_FLOOR
        keys = np.concatenate([w, b[often]])
        level = np.concatenate([levels(wc, 1), levels(bc[often], BIGRAM_FLOOR)])
        counts, of_count = np.unique(wc, return_counts=True)
        return pa.table({
            "slice": group.column("slice").slice(0, 1).cast(pa.int32()),
            "words": pa.array([w.tobytes()], pa.binary()),
            "word_counts": pa.array([wc.tobytes()], pa.binary()),
            "keys": pa.array([keys.tobytes()], pa.binary()),
            "levels": pa.array([level.astype(np.uint16).tobytes()], pa.binary()),
            "items": pa.array([int(level.sum())], pa.int64()),
            "top": pa.array([int(level.max(initial=0))], pa.int32()),
            "n_words": pa.array([len(w)], pa.int64()),
            "n_tokens": pa.array([int(wc.sum())], pa.int64()),
            "n_once": pa.array([int((wc == 1).sum())], pa.int64()),
            "quantised": pa.array([float(level_counts(levels(wc, 1), 1).sum())], pa.float64()),
            "counts": pa.array([[{"c": int(c), "n": int(k)} for c, k in zip(counts, of_count)]],
                               pa.list_(pa.struct([("c", pa.int64()), ("n", pa.int64())]))),
        })

    return runs.groupBy("slice").applyInArrow(
        add, "slice int, words binary, word_counts binary, keys binary, levels binary, items long, top int,"
             " n_words long, n_tokens long, n_once long, quantised double,"
             " counts array<struct<c:long,n:long>>")


def make_filter(added: DataFrame, n_slices: int, filter_mb: int = FILTER_MB) -> Filter:
    """Bits are set in one task a slice; FILTER_MB at most come here."""
    t = added.agg(F.sum("items").alias("n"), F.max("top").alias("top")).first()
    bits = min(float(BITS), filter_mb * 8e6 / max(t["n"] or 0, 1))
    probes = probes_for(bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, k, q, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                n_bits = max(64, int(n * bits))
                data = put(np.frombuffer(k, np.uint64),
                           np.frombuffer(q, np.uint16).astype(np.int64), n_bits, probes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([n_bits], pa.int64()),
                     pa.array([data.tobytes()], pa.binary())], ["slice", "n_bits", "data"])

    small_batches(added.sparkSession, 8)
    parts = added.select("slice", "keys", "levels", "items").mapInArrow(
        fill, "slice int, n_bits long, data binary")
    start = np.zeros(n_slices, np.int64)
    n_bits = np.full(n_slices, 64, np.uint64)
    blank = bytes(8)
    data, at = [blank], 8  # slices that no n-gram fell into share 64 clear bits
    for row in parts.toLocalIterator(prefetchPartitions=True):
        start[row["slice"]], n_bits[row["slice"]] = at, row["n_bits"]
        data.append(bytes(row["data"]))
        at += len(row["data"])
    return Filter(np.frombuffer(b"".join(data), np.uint8), start, n_bits, t["top"] or 0, probes)


# ------------------------------------------------------------------ scoring

class Model:
    """What a worker needs to score: the filter, totals and weights."""

    def __init__(self, filter_: Filter, quantised: float, unseen: float, weights: np.ndarray):
        self.filter, self.quantised, self.unseen, self.weights = \
            filter_, quantised, unseen, weights
        # of the end token, which stands before every row
        self.end_level = filter_.level(np.array([END]))[0]

    def asked(self, h: np.ndarray) -> np.ndarray:
        """The filter's levels of every token and of the bigram that ends there."""
        words, at = np.unique(h, return_inverse=True)
        return np.stack([self.filter.level(words)[at], self.pairs(h)], axis=1)

    def pairs(self, h: np.ndarray) -> np.ndarray:
        """The filter's levels of the bigrams that end at every token."""
        pairs, at = np.unique(_bigrams(h), return_inverse=True)
        return self.filter.level(pairs)[at]

    def cases(self, asked: np.ndarray):
        """The levels of the token before, of the token and of their bigram, for
        every token of whole rows."""
        w = asked[:, 0].astype(np.int64)
        return np.append(self.end_level, w)[:len(w)], w, asked[:, 1].astype(np.int64)

    def parts(self, v: np.ndarray, w: np.ndarray, vw: np.ndarray, own: bool = False):
        """(level of c(v), c(vw) / c(v), P(w)) of every case; ``own``: with the
        token's own occurrence taken out of all counts."""
        cv, cw, cvw = level_counts(v, 1), level_counts(w, 1), level_counts(vw, BIGRAM_FLOOR)
        v_level = levels(cv, 1)
        n = self.quantised
        if own:
            cw, cv, n = np.maximum(cw - 1, 0), np.maximum(cv - 1, 0), n - 1
            cvw = np.where(cvw - 1 >= BIGRAM_FLOOR, cvw - 1, 0)
        # false levels may add a word's count up beyond all
        p = np.where(cw > 0, (1 - self.unseen) * np.minimum(cw / max(n, 1.0), 1.0), self.unseen)
        ratio = np.minimum(cvw / np.maximum(cv, 1.0), 1.0)
        return np.minimum(v_level, len(self.weights) - 1), ratio, p

    def logs(self, asked: np.ndarray) -> np.ndarray:
        v, ratio, p = self.parts(*self.cases(asked))
        a = self.weights[v]
        return np.log10(a * ratio + (1 - a) * p)

    def gains(self, asked: np.ndarray) -> np.ndarray:
        """What each weight of GRID gives to training texts scored without their
        own counts, per level of c(v). Tokens of the same levels gain alike, so
        each case is worked out once and counts as often as it occurs."""
        v, w, vw = self.cases(asked)
        size = 1 + max(x.max(initial=0) for x in (v, w, vw))
        case, n = np.unique((v * size + w) * size + vw, return_counts=True)
        v, ratio, p = self.parts(case // size ** 2, case // size % size, case % size, own=True)
        return np.stack([np.bincount(v, n * np.log10(a * ratio + (1 - a) * p), _V_LEVELS)
                         for a in GRID], axis=1)


_V_LEVELS = 128


def best_weights(gains: DataFrame) -> np.ndarray:
    """The weight for each level of c(v): the best of GRID by the sum of
    ``gains`` (gains: binary, one row a task or batch)."""

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_V_LEVELS * len(GRID))
        for batch in batches:
            for g in batch.column(0).to_pylist():
                total += np.frombuffer(g, np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size), pa.int32()), pa.array(total)], ["i", "x"])

    found = gains.mapInArrow(apart, "i int, x double").groupBy("i").agg(F.sum("x").alias("x"))
    total = np.zeros(_V_LEVELS * len(GRID))
    for r in found.collect():  # levels x grid rows
        total[r["i"]] = r["x"]
    return np.array(GRID)[total.reshape(_V_LEVELS, -1).argmax(axis=1)]


def tune(train: DataFrame, model: Model) -> np.ndarray:
    """The best weights on all training texts."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def gain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((_V_LEVELS, len(GRID)))
        for batch in batches:
            for _, data, off in text_slices(batch.column(0)):
                total += shared.value.gains(shared.value.asked(tokens(data, off)[0]))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["gains"])

    small_batches(train.sparkSession)
    return best_weights(train.select("text").mapInArrow(tidied(gain), "gains binary"))


def _top(added: DataFrame, top_words: int):
    """The most frequent words and their counts, sorted by hash: at most
    ``top_words``, all over one count."""
    by_count = (added.select(F.explode("counts").alias("x")).groupBy("x.c")
                .agg(F.sum("x.n").alias("n")).orderBy(F.col("c").desc()).limit(top_words).collect())
    least, words = None, 0
    for r in by_count:
        words += r["n"]
        if words > top_words:
            break
        least = r["c"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w, c = np.frombuffer(w, np.uint64), np.frombuffer(c, np.int64)
                keep = c >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[keep].view(np.int64)), pa.array(c[keep])], ["h", "c"])

    got = added.select("words", "word_counts").mapInArrow(pick, "h long, c long").toArrow()
    h = got.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], got.column("c").to_numpy()[order], least


def ask_texts(docs: DataFrame, model: Model, top: tuple, n_slices: int) -> DataFrame:
    """Per row of (doc_id, held_out, text): n_tokens, asked (the filter's levels,
    two bytes a token), what the top words give to the base score (base_top) and
    to n_known (known_top), batch and no (its place), and rest: the other words
    of the batch as runs per slice, on the batch's first row. A last row of each
    task, without a place, holds the gains of its training texts."""
    # most tokens are top words: the filter is asked for those here, once
    shared = docs.sparkSession.sparkContext.broadcast((model, top, model.filter.level(top[0])))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rest_type = pa.list_(pa.struct([("slice", pa.int32()), ("no", pa.binary()),
                                    ("h", pa.binary())]))
    names = ["doc_id", "held_out", "n_tokens", "asked", "base_top", "known_top", "batch", "no",
             "rest", "gains"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (top_h, top_c, _), top_level = shared.value
        top_log = np.log10(top_c + 1.0)
        number = TaskContext.get().partitionId() << 33
        gains, types = np.zeros((_V_LEVELS, len(GRID))), None
        for batch in batches:
            for at, data, off in text_slices(batch.column(2)):
                h, first = tokens(data, off)
                n = np.diff(first)
                row = np.repeat(np.arange(len(n)), n)
                words, word_at = np.unique(h, return_inverse=True)
                i = np.searchsorted(top_h, words)
                i[i == len(top_h)] = 0
                hit = top_h[i] == words if len(top_h) else np.zeros(len(words), bool)
                level, log = np.zeros(len(words), np.int64), np.zeros(len(words))
                level[hit], log[hit] = top_level[i[hit]], top_log[i[hit]]
                level[~hit] = model.filter.level(words[~hit])
                asked = np.stack([level[word_at], model.pairs(h)], axis=1)
                held = batch.column(1).slice(at, len(n))
                learnt = ~held.to_numpy(zero_copy_only=False).astype(bool)
                gains += model.gains(asked[learnt[row]])
                hit = hit[word_at]
                base = np.bincount(row, log[word_at], len(n))
                known = np.bincount(row[hit], minlength=len(n))
                rest_h, rest_row = h[~hit], row[~hit].astype(np.int32)
                order = np.argsort(rest_h, kind="stable")
                rest_h, rest_row = rest_h[order], rest_row[order]
                cut = _cut(rest_h, n_slices)
                rest = [{"slice": int(s), "no": rest_row[cut[s]:cut[s + 1]].tobytes(),
                         "h": rest_h[cut[s]:cut[s + 1]].tobytes()}
                        for s in np.flatnonzero(np.diff(cut))]
                said = memoryview(asked.astype(np.uint8)).cast("B")
                columns = [
                    batch.column(0).slice(at, len(n)), held, pa.array(n, pa.int64()),
                    pa.array([bytes(said[2 * x:2 * y]) for x, y in zip(first[:-1], first[1:])],
                             pa.binary()),
                    pa.array(base, pa.float64()), pa.array(known, pa.int64()),
                    pa.array(np.full(len(n), number), pa.int64()),
                    pa.array(np.arange(len(n)), pa.int32()),
                    pa.array([rest] + [None] * (len(n) - 1), rest_type),
                    pa.nulls(len(n), pa.binary())]
                types = [c.type for c in columns]
                yield pa.RecordBatch.from_arrays(columns, names)
                number += 1
        if types:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, t) for t in types[:-1]] + [pa.array([gains.tobytes()], pa.binary())],
                names)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        tidied(ask), f"doc_id {kind}, held_out boolean, n_tokens long, asked binary, base_top double,"
               " known_top long, batch long, no int,"
               " rest array<struct<slice:int,no:binary,h:binary>>, gains binary")


def scores_of(asked: DataFrame, model: Model) -> DataFrame:
    """``asked`` (rows with a place) with the score in place of the levels."""
    numbers = (model.quantised, model.unseen, model.weights, model.end_level)
    kept = [c for c in asked.columns if c != "asked"]
    types = ", ".join(f"{c} {asked.schema[c].dataType.simpleString()}" for c in kept)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Model.__new__(Model)
        part.quantised, part.unseen, part.weights, part.end_level = numbers
        for batch in batches:
            n = batch.column(batch.schema.get_field_index("n_tokens")).to_numpy()
            x = batch.column(batch.schema.get_field_index("asked")).to_pylist()
            logs = part.logs(np.frombuffer(b"".join(x), np.uint8).reshape(-1, 2))
            out = np.add.reduceat(logs, np.cumsum(n) - n) if len(n) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in kept]
                + [pa.array(out, pa.float64())], kept + ["score"])

    small_batches(asked.sparkSession)
    return asked.mapInArrow(tidied(score), f"{types}, score double")


def _rest_sums(scored: DataFrame, added: DataFrame) -> DataFrame:
    """(batch, no, base_rest, known_rest) from the exact counts of the slices."""
    rest = scored.filter("rest IS NOT NULL").select("batch", F.explode("rest").alias("r")) \
        .select("batch", "r.slice", "r.no", "r.h")

    def look_up(runs: pa.Table, counts: pa.Table) -> pa.Table:
        if counts.num_rows:
            w = np.frombuffer(counts.column("words")[0].as_py(), np.uint64)
            c = np.frombuffer(counts.column("word_counts")[0].as_py(), np.int64)
        else:
            w, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = [[], [], [], []]
        for batch, no, h in zip(*(runs.column(k).to_pylist() for k in ("batch", "no", "h"))):
            no, h = np.frombuffer(no, np.int32), np.frombuffer(h, np.uint64)
            i = np.searchsorted(w, h)
            i[i == len(w)] = 0
            found = c[i] * (w[i] == h) if len(w) else np.zeros(len(h), np.int64)
            rows = np.unique(no)
            at = np.searchsorted(rows, no)
            out[0].append(np.full(len(rows), batch, np.int64))
            out[1].append(rows)
            out[2].append(np.bincount(at, np.log10(found + 1.0), len(rows)))
            out[3].append(np.bincount(at, found > 0, len(rows)).astype(np.int64))
        cols = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table({"batch": pa.array(cols[0], pa.int64()), "no": pa.array(cols[1], pa.int32()),
                         "base_rest": pa.array(cols[2], pa.float64()),
                         "known_rest": pa.array(cols[3], pa.int64())})

    sums = rest.groupBy("slice").cogroup(
        added.select("slice", "words", "word_counts").groupBy("slice")).applyInArrow(
        look_up, "batch long, no int, base_rest double, known_rest long")
    return sums.groupBy("batch", "no").agg(F.sum("base_rest").alias("base_rest"),
                                           F.sum("known_rest").alias("known_rest"))


def slices_for(rows: int) -> int:
    """A power of two: about 2,000 texts a slice, 64 to 65,536 slices."""
    return 1 << min(16, max(6, (rows // 2000).bit_length()))


def counted(train: DataFrame, filter_mb: int = FILTER_MB):
    """(model without weights, exact counts by slice, tokens, different words) of
    the training texts."""
    n_slices = slices_for(train.count())
    added = written(add_up(count_runs(train, n_slices)), "ngrams")
    t = added.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                    for c in ("n_words", "n_tokens", "n_once", "quantised")]).first()
    unseen = min(0.5, (t["n_once"] + 1) / (t["n_tokens"] + 2))
    model = Model(make_filter(added, n_slices, filter_mb), float(t["quantised"]), unseen,
                  np.zeros(_V_LEVELS))
    return model, added, t["n_tokens"], t["n_words"]


def fitted(train: DataFrame, filter_mb: int = FILTER_MB):
    """``counted`` with the weights, all training texts read once more."""
    model, added, n, v = counted(train, filter_mb)
    model.weights = tune(train, model)
    return model, added, n, v


def lm_scores(docs: DataFrame, held_of: int = 7, held: int = 2, top_words: int = TOP_WORDS,
              filter_mb: int = FILTER_MB) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score. Texts whose crc32(doc_id) leaves
    ``held`` modulo ``held_of`` are held out of training."""
    docs = docs.select("doc_id", bucket_of(held, held_of, F.col("doc_id")).alias("held_out"), "text")
    train = docs.filter(~F.col("held_out")).select("text")
    model, added, n, v = counted(train, filter_mb)
    n_slices = len(model.filter.start)
    asked = written(ask_texts(docs, model, _top(added, top_words), n_slices), "asked")
    model.weights = best_weights(asked.filter("gains IS NOT NULL").select("gains"))
    rows = asked.filter("gains IS NULL")
    rest = _rest_sums(rows, added)
    d = scores_of(rows.drop("rest", "gains"), model).join(rest, ["batch", "no"], "left")
    return d.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known_top") + F.coalesce("known_rest", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_top") + F.coalesce("base_rest", F.lit(0.0))
         - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        "score")
