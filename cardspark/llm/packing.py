"""Packing token sequences by minimum bin slack.

Documents are tokenised, ended with an end id and cut at multiples of the
window: the whole windows are sequences of their own, the remainders (shorter
than a window) are packed. Pieces fall into shards by a hash, a few thousand
each, and every shard packs its remainders alone: the longest remaining piece
opens a window, and a subset-sum over the multiset of the remaining lengths
(a Python integer as bitset, whose bit s says that some choice adds up to s)
finds the choice that fills the rest of the window most closely; walking the
steps backwards gives how many pieces of each length it took. What stays open
is the last windows of each shard.

A task holds some ``SLICE_CHARS`` of texts and their tokens, or one shard of piece rows
(``SHARD_PIECES``), never all of them. Pieces are written before they are
shuffled, so a lost executor does not tokenise again.

Defined results: null or empty text is one piece of the end id alone; repeated
rows are packed one by one; an empty table gives no pieces; extra columns are
not read.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from operator import neg

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm.common import partitions_for, small_batches, tidied, written
from cardspark.llm.memo import Memo

WINDOW = 2048
END_ID = 1
SHARD_PIECES = 8192
# Chunks of text whose ids a worker remembers (about 200 bytes each): this many
# young ones and as many old ones.
CACHE_CHUNKS = 400_000
# Longer chunks are not remembered.
CACHE_CHARS = 40
# Chunks that are encoded as one text.
TOGETHER = 20_000
# Characters that are cut into chunks at a time (a longer single text alone): the
# more, the fewer chunks are looked up again.
SLICE_CHARS = 10_000_000


# White space other than the space and the line end.
_RARE_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B)))
_LINE = "\x00"  # marks a chunk that a line end leads
_FIRST = "\x00\x00"  # marks a chunk that nothing leads
_LEADS = "\u0120\u010a"  # what byte-level vocabularies write for a space and a line end


class _Ids:
    """Token ids of texts, as little-endian uint32 bytes.

    The byte-level pre-tokeniser cuts before a space or a line end that stands
    alone between two other characters, and pieces are merged on their own. So
    a text in which all white space stands alone so is the concatenation of
    its chunks, each led by its space or line end, and the ids of a chunk are
    looked up: Arrow cuts a slice of texts and finds its different chunks, these
    are looked up once, and numpy lays their ids end to end. Any other text goes
    to the tokenizer as it is."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = Memo(CACHE_CHUNKS, CACHE_CHARS)
        vocabulary = self.tokenizer.get_vocab()
        # ids whose first byte is a space or a line end
        self.leads = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.leads[[i for token, i in vocabulary.items() if token[0] in _LEADS]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of marked chunks; those that begin a text are encoded alone."""
        heads = iter(self._encode([c[2:] for c in chunks if c[:2] == _FIRST]))
        rest = iter(self._led(["\n" + c[1:] if c[0] == _LINE else " " + c
                               for c in chunks if c[:2] != _FIRST]))
        return [next(heads if c[:2] == _FIRST else rest) for c in chunks]

    def _led(self, led: list[str]) -> list[bytes]:
        """Ids of chunks with their space or line end, many at a time as one
        text: a chunk begins where a token begins with a space or a line end."""
        parts = [led[i:i + TOGETHER] for i in range(0, len(led), TOGETHER)]
        out: list[bytes] = []
        for part, e in zip(parts, self.tokenizer.encode_batch_fast(
                ["".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            at = (4 * np.append(np.flatnonzero(self.leads[ids]), len(ids))).tolist()
            if len(at) == len(part) + 1 and at[0] == 0:
                raw = ids.astype("<u4").tobytes()
                out += [raw[x:y] for x, y in zip(at, at[1:])]
            else:  # a tokenizer whose tokens do not show where chunks begin
                out += self._encode(part)
        return out

    def _joined(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are not odd."""
        cut = pc.split_pattern(pa.array(
            [_FIRST + t.replace("\n", " " + _LINE) for t in texts], pa.large_string()), " ")
        chunks = cut.values.dictionary_encode()
        different = chunks.dictionary.to_pylist()
        known = self.memo.of(set(different), self._chunks)
        raws = list(map(known.__getitem__, different))
        sizes = np.fromiter(map(len, raws), np.int64, len(raws)) // 4
        firsts = np.cumsum(sizes) - sizes
        which = chunks.indices.to_numpy()
        n = sizes[which]
        ends = np.append(0, np.cumsum(n))
        # every id's place among those of the different chunks
        at = np.repeat(firsts[which] - ends[:-1], n) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(raws), "<u4")[at].tobytes()
        cuts = (4 * ends[cut.offsets.to_numpy()]).tolist()
        return [ids[x:y] for x, y in zip(cuts, cuts[1:])]

    def _is_odd(self, t: str) -> bool:
        return (t[:1] in " \n" or t[-1] in " \n" or "  " in t or "\n " in t or " \n" in t
                or "\n\n" in t or _LINE in t or any(c in t for c in _RARE_SPACE)
                or any(s in t for s in self.special))

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        rest: list[int] = []
        cut: list[int] = []
        held = 0

        def join() -> None:
            for i, x in zip(cut, self._joined([texts[i] for i in cut])):
                out[i] = x
            cut.clear()
        for i, t in enumerate(texts):
            if not t:
                out[i] = b""
            elif self._is_odd(t):
                rest.append(i)
            else:
                if cut and held + len(t) > SLICE_CHARS:
                    join()
                    held = 0
                cut.append(i)
                held += len(t)
        if cut:
            join()
        if rest:
            for i, x in zip(rest, self._encode([texts[i] for i in rest])):
                out[i] = x
        return out


_LOADED: dict[str, _Ids] = {}


def _ids(path: str | None) -> _Ids:
    if path is None:
        import public_tokenizers
        path = str(public_tokenizers.path("byte_bpe_50k.json"))
    if path not in _LOADED:
        _LOADED[path] = _Ids(path)
    return _LOADED[path]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], pa.DataType]]:
    """Ids and texts of several batches, up to ``SLICE_CHARS`` and one batch."""
    docs: list = []
    texts: list[str] = []
    held, kind = 0, None
    for batch in batches:
        new = [t or "" for t in batch.column(1).to_pylist()]
        docs += batch.column(0).to_pylist()
        texts += new
        held, kind = held + sum(map(len, new)), batch.schema.field(0).type
        if held >= SLICE_CHARS:
            yield docs, texts, kind
            docs, texts, held = [], [], 0
    if docs:
        yield docs, texts, kind


def pieces(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32,
    doc_tokens, salt (a running number of the task) and, if asked for, ids
    (little-endian uint32 bytes)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, salt long"
              + (", ids binary" if with_ids else ""))
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(tokenizer_path)
        salt = 0
        for docs_, texts, doc_type in _gathered(batches):
            rows = [[] for _ in range(7)]
            for doc, raw in zip(docs_, ids.encode(texts)):
                raw += end
                n = len(raw) // 4
                for start in range(0, n, window):
                    part = raw[4 * start:4 * (start + window)]
                    for col, x in zip(rows, (doc, start, len(part) // 4, zlib.crc32(part), n,
                                             salt, part)):
                        col.append(x)
                    salt += 1
            types = [doc_type] + [pa.int64()] * 5 + [pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt", "ids"]
            k = 7 if with_ids else 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows[:k], types)], names[:k])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        tidied(cut), schema)


def fill(order: list[int], counts: dict[int, int], room: int) -> tuple[int, dict[int, int]]:
    """The choice from a multiset of lengths (``order``: the lengths, falling;
    ``counts``: how many are left of each) whose sum comes closest to ``room``
    from below: (sum, length to how many taken)."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in order[bisect_left(order, -room, key=neg):]:
        left, k = min(counts[length], room // length), 1
        while left:
            k = min(k, left)
            more = (reach | reach << k * length) & mask
            if more != reach:
                steps.append((length, k, reach))
                reach = more
            left -= k
            k *= 2
        if reach >> room & 1:
            break
    at = best = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + k
            at -= k * length
    return best, taken


def pack_lengths(lengths: list[int], window: int = WINDOW) -> list[list[int]]:
    """Windows as lists of positions in ``lengths``."""
    rows: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        rows.setdefault(lengths[i], []).append(i)
    counts = {x: len(r) for x, r in rows.items()}
    order = sorted(counts, reverse=True)
    out = []
    while order:
        seed = order[0]
        counts[seed] -= 1
        bin_ = [rows[seed].pop()]
        used = {seed}
        if seed < window:
            for length, k in fill(order, counts, window - seed)[1].items():
                counts[length] -= k
                used.add(length)
                bin_ += [rows[length].pop() for _ in range(k)]
        for length in used:
            if not counts[length]:
                del order[bisect_left(order, -length, key=neg)]
        out.append(bin_)
    return out


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and its offset there; columns of
    ``pieces`` without salt."""
    cut = written(pieces(docs, tokenizer_path, window, end_id, with_ids), "pieces")
    shards = partitions_for(cut.count(), SHARD_PIECES)
    names = [c for c in cut.columns if c != "salt"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields
                       if f.name != "salt") + ", sequence_id long, offset long"

    def assign(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
             ("salt", "ascending")])
        shard = group.column("shard")[0].as_py()
        lengths = group.column("length").to_pylist()
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for k, bin_ in enumerate(pack_lengths(lengths, window)):
            at = 0
            for i in bin_:
                sequence[i], offset[i] = (shard << 32) + k, at
                at += lengths[i]
        return group.select(names).append_column("sequence_id", pa.array(sequence, pa.int64())) \
            .append_column("offset", pa.array(offset, pa.int64()))

    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "salt"), F.lit(shards)).cast("long")
    return cut.withColumn("shard", shard).groupBy("shard").applyInArrow(assign, schema)
