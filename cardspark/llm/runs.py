"""Periodic runs of words: suffix classes united by descending LCP.

A run is a stretch of words with smallest period q (words q apart are equal) and
length at least max(``least``, ``repeats`` * q) that no neighbouring word extends
with that period.

The words of a text are numbered, and prefix doubling sorts its suffixes: class
numbers of the first 1, 2, 4, ... words at every place, refined until all
suffixes differ. The longest common prefix (LCP) of suffixes that are next to
each other in that order is read off the levels. Kruskal's walk then takes these
neighbours by falling LCP and unites their classes in a union-find whose classes
hold their positions in order. Wherever uniting makes positions i < j neighbours
in a class, d = j - i is a period of the stretch from i of length LCP + d. If
that is long enough and the word before i differs from the one before j, it is
a run, and every run is met so exactly once: were there a smaller period q, the
position i + q would have a longer common prefix with i and would stand between
the two already. The walk ends at the least LCP that a run can have.

Whole texts are worked on, ``SLICE_WORDS`` words of several texts at a time (a
longer text alone): word numbers of different texts differ, so no class spans
two. A long text takes some 30 bytes a word, and 4 more for each doubling of
its longest repeated stretch. Rows are independent; nothing is shuffled.

Defined results: null or empty text, or one of white space, has no words, no
runs (an empty list) and an empty collapsed text; repeated rows are handled
each; an empty table gives an empty one; of other columns only those in ``keep``
are carried, and a clash with a result's name is an error.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cardspark.llm.common import small_batches, tidied, words

LEAST = 6
REPEATS = 4
SLICE_WORDS = 200_000
# classes that get fewer new positions take them one by one
FEW = 16

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _levels(ids: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Level k: the class of the first 2 ** k words at each place, as the number
    of places of smaller classes; one entry more than places. Classes of the
    last level are single. ``stop``: the end of the text that a place is in."""
    n = len(ids)
    count = np.bincount(ids)
    cls = (np.cumsum(count) - count)[ids].astype(np.int32)
    levels = [np.append(cls, np.int32(-1))]
    shared = np.flatnonzero(count[ids] > 1)
    width = 1
    while len(shared):
        then = shared + width
        # a text that ends before is smaller than one that goes on
        second = np.where(then < stop[shared], levels[-1][np.minimum(then, n)], -1)
        key = cls[shared].astype(np.int64) * (n + 1) + second + 1
        order = np.argsort(key)
        key, at = key[order], shared[order]
        old = cls[at]
        new_class = np.append(True, old[1:] != old[:-1])
        new_part = np.append(True, key[1:] != key[:-1])
        place = np.arange(len(at), dtype=np.int32)
        begins = np.flatnonzero(new_part)
        sizes = np.diff(np.append(begins, len(at)))
        part_at = np.repeat(place[begins], sizes)
        class_at = np.maximum.accumulate(np.where(new_class, place, 0))
        cls = cls.copy()
        cls[at] = old + (part_at - class_at)
        levels.append(np.append(cls, np.int32(-1)))
        shared = at[np.repeat(sizes > 1, sizes)]
        width *= 2
    return levels


def _neighbours(levels: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places next to each other in suffix order whose LCP is ``least`` or more,
    and the LCP."""
    n = len(levels[0]) - 1
    at = np.empty(n, np.int64)
    at[levels[-1][:n]] = np.arange(n)
    a, b = at[:-1], at[1:]
    k = least.bit_length() - 1
    if k >= len(levels):
        return a[:0], b[:0], a[:0]
    close = levels[k][a] == levels[k][b]
    a, b = a[close], b[close]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        lcp += (levels[k][a + lcp] == levels[k][b + lcp]).astype(np.int64) << k
    long = lcp >= least
    return a[long], b[long], lcp[long]


def _least_lcp(least: int, repeats: int) -> int:
    """The least LCP of the first two periods' places of a run."""
    return min(max(least - d, (repeats - 1) * d) for d in range(1, max(least, 1) + 1))


def find_runs(ids: np.ndarray, ends: np.ndarray, least: int = LEAST,
              repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in several texts laid end to end, by
    start and period. ``ids``: word numbers from 0, different in different texts;
    ``ends``: where each text ends."""
    if repeats < 2 or least < 1:
        raise ValueError("a run has two periods at least")
    if not len(ids):
        return []
    stop = np.repeat(ends, np.diff(np.append(0, ends)))
    a, b, lcp = _neighbours(_levels(ids, stop), _least_lcp(least, repeats))
    order = np.argsort(-lcp, kind="stable")
    parent: dict[int, int] = {}
    ordered: dict[int, list[int]] = {}
    found = []

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    def seed(i: int, j: int, common: int) -> None:
        d = j - i
        if common + d >= max(least, repeats * d) and (i == 0 or ids[i - 1] != ids[j - 1]):
            found.append((i, common + d, d))

    for x, y, common in zip(a[order].tolist(), b[order].tolist(), lcp[order].tolist()):
        x, y = root(x), root(y)
        big, small = ordered.pop(x, [x]), ordered.pop(y, [y])
        if len(big) < len(small):
            x, y, big, small = y, x, small, big
        parent[y] = x
        ordered[x] = big
        if len(small) < FEW:
            for p in small:
                insort(big, p)
        else:
            big += small
            big.sort()
        new = set(small)
        for p in small:
            k = bisect_left(big, p)
            if k and big[k - 1] not in new:
                seed(big[k - 1], p, common)
            if k + 1 < len(big) and big[k + 1] not in new:
                seed(p, big[k + 1], common)
    return sorted(found, key=lambda r: (r[0], r[2]))


def _slices(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    i = held = 0
    for j, t in enumerate(texts):
        if held and held + len(t) > SLICE_WORDS:
            yield i, j
            i, held = j, 0
        held += len(t)
    if i < len(texts):
        yield i, len(texts)


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    parts, used = [], 0
    for t in texts:
        number = {w: k for k, w in enumerate(dict.fromkeys(t), used)}
        used += len(number)
        parts.append(np.fromiter(map(number.__getitem__, t), np.int64, len(t)))
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64),
            np.cumsum([len(t) for t in texts], dtype=np.int64))


def word_runs(docs: DataFrame, keep: list[str], column: str = "text", least: int = LEAST,
              repeats: int = REPEATS) -> DataFrame:
    """Columns ``keep``; ``n_words``; ``runs``, an array of (start, length, period)
    by start and period; and ``collapsed``: the words joined by one space,
    without those that a run contains after its first period."""
    made = StructType.fromDDL("n_words long, runs array<struct<start: long, length: long, "
                              "period: long>>, collapsed string")
    if clash := set(keep) & set(made.names):
        raise ValueError(f"columns {sorted(clash)} are both kept and made")
    schema = StructType([StructField(f.name, f.dataType) for f in (docs.schema[c] for c in keep)]
                        + made.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.split parts at the space and \x09-\x0D alone
            texts = [(t or "").encode().split() for t in batch.column(len(keep)).to_pylist()]
            for i, j in _slices(texts):
                part = texts[i:j]
                ids, ends = _numbered(part)
                found = np.array(find_runs(ids, ends, least, repeats), np.int64).reshape(-1, 3)
                begins = np.append(0, ends[:-1])
                text = np.searchsorted(ends, found[:, 0], "right")
                gone = np.zeros(len(ids) + 1, np.int64)
                np.add.at(gone, found[:, 0] + found[:, 2], 1)
                np.add.at(gone, found[:, 0] + found[:, 1], -1)
                gone = np.cumsum(gone) > 0
                touched = set(text.tolist())
                collapsed = [
                    b" ".join([w for w, g in zip(t, gone[begins[k]:ends[k]].tolist()) if not g]
                              if k in touched else t).decode()
                    for k, t in enumerate(part)]
                runs = pa.StructArray.from_arrays(
                    [pa.array(found[:, 0] - begins[text]), pa.array(found[:, 1]),
                     pa.array(found[:, 2])], fields=list(_RUNS.value_type))
                first = np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                    + [pa.array([len(t) for t in part], pa.int64()),
                       pa.ListArray.from_arrays(pa.array(first), runs, type=_RUNS),
                       pa.array(collapsed, pa.string())],
                    keep + made.names)

    small_batches(docs.sparkSession)
    return docs.select(*keep, F.col(column).alias("_runs_text")).mapInArrow(tidied(run), schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; where h = crc32 of the id as text is divisible by 10 and
    the text has n > 0 words, its words from a = g % n on repeat the p words that
    stand there (g = h div 10, p = 1 + (n - a) div (3 + g % 8)). A null id plants
    nothing."""
    h = F.crc32(F.col("doc_id").cast("string"))
    picked = F.coalesce(h % 10 == 0, F.lit(False))
    d = docs.select("doc_id", "text", F.when(picked, words(F.col("text"))).alias("w"),
                    F.expr("crc32(CAST(doc_id AS STRING)) div 10").alias("g"))
    d = d.withColumn("n", F.size("w"))
    d = d.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    d = d.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    planted = F.expr("array_join(concat(slice(w, 1, a), slice(flatten(array_repeat("
                     "slice(w, a + 1, p), CAST((n - a) div p + 1 AS INT))), 1, n - a)), ' ')")
    return d.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def digests() -> list[Column]:
    """n_runs; start, length, period and exponent_milli of the longest run (ties:
    smallest start, then period); runs_sha256 and collapsed_sha256."""
    best = ("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, "
            "-r.period AS period)))")
    lines = ("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), "
             "'')")
    return [F.size("runs").cast("long").alias("n_runs"),
            F.expr(f"-({best}).start").alias("start"),
            F.expr(f"({best}).length").alias("length"),
            F.expr(f"-({best}).period").alias("period"),
            F.expr(f"1000 * ({best}).length div -({best}).period").alias("exponent_milli"),
            F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")]
