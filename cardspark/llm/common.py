"""Helpers that several operators share: the word rule, in SQL and over bytes;
written intermediate tables; documented batch sizes.

A word is a run of characters other than space and \\x09-\\x0D. Lower-casing
touches A-Z alone. Both rules look at ASCII bytes only, so they hold on the
UTF-8 bytes of a text as they do on its code points.
"""

from __future__ import annotations

import ctypes
import gc
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.session import ensure_checkpoint_dir

# Rows that go to a Python worker at once. Texts have no length limit, so the
# row count is what keeps a batch small.
BATCH_ROWS = 1000
# Bytes of text that the byte-wise numpy code works on at once (a longer
# single text is worked on alone).
SLICE_BYTES = 2_000_000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches of the Python tasks that follow."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def tidied(task):
    """``task`` (batches to batches), handing freed memory back to the system at
    its end: Python workers are kept for later stages, and idle ones would
    otherwise hold what their largest batch took."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
                trim(0)
    return run


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/llm/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later
    passes neither repeat its work nor depend on an executor that held it.
    ``codec``: the compression, else the session's."""
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- in SQL

def words(text: Column) -> Column:
    """array<string> of a text's words; null text: no words."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaced, " "), "")


def bucket_of(remainder: int, of: int, key: Column) -> Column:
    """True where crc32 of the key as text leaves ``remainder`` modulo ``of``
    (null key: false)."""
    return F.coalesce(F.crc32(key.cast("string")) % F.lit(of) == F.lit(remainder), F.lit(False))


def partitions_for(rows: int, rows_each: int, least: int = 1) -> int:
    return max(least, -(-rows // rows_each))


# ---------------------------------------------------------------- over bytes

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def golden(k: int) -> np.uint64:
    """``k * GOLDEN`` modulo 2 ** 64."""
    return np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


with np.errstate(over="ignore"):
    # a random 64-bit value for each byte
    _BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_BASE = np.uint64(0x5851F42D4C957F2D)
_POWERS = np.cumprod(np.full(256, _BASE, np.uint64))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        p = np.cumprod(np.full(n, _BASE, np.uint64))
        if n > 1_000_000:  # one very long word: not kept
            return p
        _POWERS = p
    return _POWERS


def text_slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES):
    """Split a string array (null: empty) into (first row, uint8 bytes, byte
    offsets of the rows) of about ``slice_bytes`` each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(off, off[i] + slice_bytes, "right")) - 1
        j = min(max(j, i + 1), len(texts))
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_bounds(data: np.ndarray, off: np.ndarray, gap: np.ndarray = _SPACE):
    """(starts, ends, first) of the words of the rows: byte positions, and for
    each row the index of its first word (one more entry than rows). ``gap``:
    for each byte value, whether it parts words."""
    n = len(data)
    solid = ~gap[data]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    at = off[:-1][off[:-1] < n]
    opens[at] |= solid[at]
    at = off[1:][off[1:] > 0] - 1
    closes[at] |= solid[at]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                gap: np.ndarray = _SPACE) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over random byte
    values, with the length mixed in. Two of n words collide with a chance of
    about n * n / 2 ** 65."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    gaps = np.diff(np.append(starts, len(data)))
    rel = np.arange(starts[0], len(data)) - np.repeat(starts, gaps)
    longest = int((ends - starts).max())
    # what follows a word up to the next one counts nothing
    values = np.where(gap, np.uint64(0), _BYTE)[data[starts[0]:]]
    values *= _powers(longest)[np.minimum(rel, longest - 1)]
    sums = np.add.reduceat(values, starts - starts[0])
    return mix64(sums + (ends - starts).astype(np.uint64) * GOLDEN)


def poly_of(hashes: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash of several aligned hash arrays, in their order."""
    total = np.zeros(len(hashes[0]), np.uint64)
    for i, h in enumerate(hashes):
        total += h * _powers(len(hashes) + 1)[i]
    return mix64(total + golden(len(hashes)))


# ------------------------------------------------------------ hash bitmaps

BITMAP_BITS = 23


def hash_bitmap(df: DataFrame, col: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """2 ** bits flags packed in bytes: which leading bits the (long) hashes
    in ``col`` have. What comes to the driver is 2 ** (bits - 6) words at most,
    whatever the rows. As a filter it lets through all of them and few others;
    more rows make it less sharp and never wrong."""
    lead = F.shiftrightunsigned(F.col(col), 64 - bits)
    words_ = (df.select(lead.alias("lead"))
              .groupBy(F.shiftright("lead", 6).alias("at"))
              .agg(F.bit_or(F.expr("shiftleft(1L, CAST(lead & 63 AS INT))")).alias("bits"))
              .toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words_.column("at").to_numpy()] = words_.column("bits").to_numpy().view(np.uint64)
    return out.view(np.uint8)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray, bits: int = BITMAP_BITS) -> np.ndarray:
    """Flags for uint64 hashes: whether their leading bits are in the bitmap."""
    lead = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[lead >> 3] >> (lead & 7).astype(np.uint8)) & 1 == 1
