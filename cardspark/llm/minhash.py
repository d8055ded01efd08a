"""Near-duplicate groups by SuperMinHash, banding, verification on full
shingle sets and union-find.

1. Signatures. Every distinct 5-word shingle runs through its own random
   permutation of the ``HASHES`` places, one place a round: in round j its
   value there is j plus a random fraction, and each place keeps its least
   value. All shingles of a text go through round j together; once every
   place is filled no later round can lower one, and the text stops (long
   texts after a few rounds). Places are filled without repeats, which is what
   makes the estimate's variance lower than that of independent hashes.
2. Copies. Texts with the same shingle set (two 64-bit sums) form a class and
   go on as one.
3. Banding: ``BANDS`` bands of ``ROWS`` places; equal bands are a bucket.
4. Stars. Each member of a bucket is compared with the bucket's most popular
   member (the one whose bands are shared by most others: in a group of edited
   copies, the text they were made from) and with its smallest. Pairs pass a
   bound on sizes (exact) and on the signatures' agreement (``LEAST_MATCHES``),
   then are confirmed on the full sets. Confirmed links give components.
5. Rest. A bucket whose members are now one component needs nothing more. The
   members of the others meet in tasks with their signatures and full sets,
   block by block: pairs of different components that agree are confirmed there,
   the most alike first, and only links that unite two components are emitted.
   A pair that shares several buckets is looked at in the first of them that is
   searched whole. A bucket over ``BLOCK`` is cut into blocks: if what lies
   outside its largest component is small, that goes with every block of the
   largest; else there is a group for each pair of blocks. Only where that takes
   over ``EXACT`` copies of each member do members go to sub-buckets by further
   places of their signatures first (``SPLITS`` of them, no fewer copies), at most
   ``LEVELS`` times; what is left then goes to pairs of blocks at any size.
6. The components of all links.

What can be missed: a pair at 0.75 shares no band with a chance of 5e-6, falls
below ``LEAST_MATCHES`` with one of 2e-7, and if all buckets that it shares are
over ``EXACT`` blocks, meets in no sub-bucket with one of 1e-6 a level. 64-bit hashes stand for words and
shingles.

Defined results: null or empty text, or white space alone: n_shingles 0,
linked with nothing. Rows without a doc_id are linked with nothing either:
component_id null, kept. Repeated rows are equal texts and share a component;
as both carry its smallest id, both are marked kept. An empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm.common import (
    GOLDEN, LOWER, golden, hash_bitmap, in_bitmap, mix64, poly_of, small_batches, text_slices,
    tidied, word_bounds, word_hashes, written,
)
from cardspark.llm.components import components

SHINGLE = 5
HASHES = 128
BANDS = 32
ROWS = 4
PER_100 = 75  # similarity in hundredths
LEAST_MATCHES = 70
# The weight of what a task compares at once; a member weighs its shingles and
# ROW_WEIGHT, so a block has about 1,000 average texts and 2,000 at most.
BLOCK = 800_000
ROW_WEIGHT = 400
EXACT = 64
SPLITS = 64
LEVELS = 3

_EMPTY = np.uint32(0xFFFFFFFF)


# --------------------------------------------------------------- signatures

def shingle_sets(data: np.ndarray, off: np.ndarray, size: int = SHINGLE):
    """(hashes, first): the distinct shingle hashes of the rows, sorted within
    each row, and where each row's begin (one more entry than rows)."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, off)
    h = word_hashes(data, starts, ends)
    n_words = np.diff(first)
    row_of = np.repeat(np.arange(len(n_words)), n_words)
    at = np.arange(len(h)) - first[:-1][row_of]
    whole = at + size <= n_words[row_of]
    i = np.flatnonzero(whole)
    parts, rows = [poly_of([h[i + k] for k in range(size)])] if len(i) else [], [row_of[i]]
    for few in range(1, size):  # shorter texts: the whole sequence
        short = np.flatnonzero(n_words == few)
        if len(short):
            parts.append(poly_of([h[first[short] + k] for k in range(few)]))
            rows.append(short)
    all_h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    all_r = np.concatenate(rows)
    order = np.lexsort((all_h, all_r))
    all_h, all_r = all_h[order], all_r[order]
    new = np.ones(len(all_h), bool)
    new[1:] = (all_h[1:] != all_h[:-1]) | (all_r[1:] != all_r[:-1])
    all_h, all_r = all_h[new], all_r[new]
    return all_h, np.searchsorted(all_r, np.arange(len(n_words) + 1))


def signatures(hashes: np.ndarray, first: np.ndarray, m: int = HASHES) -> np.ndarray:
    """uint32 [rows, m]: round in the upper byte, fraction in the lower 24
    bits; rows without shingles keep the empty mark."""
    n = len(first) - 1
    sig = np.full((n, m), _EMPTY, np.uint32)
    flat = sig.reshape(-1)
    row = np.repeat(np.arange(n), np.diff(first))
    x = hashes
    places = None
    for j in range(m):
        if not len(x):
            break
        draw = mix64(x + golden(j + 1))
        k = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        if places is None:
            place = k
        else:
            line = np.arange(len(x))
            place = places[line, k].astype(np.int64)
        value = (draw >> np.uint64(40)).astype(np.uint32) | np.uint32(j << 24)
        np.minimum.at(flat, row * m + place, value)
        open_row = (sig == _EMPTY).any(axis=1)
        stay = open_row[row]
        if places is None:
            x, row, k = x[stay], row[stay], k[stay]
            places = np.tile(np.arange(m, dtype=np.uint8), (len(x), 1))
            places[np.arange(len(x)), k] = j  # place j moves to where k was
        else:
            places[line, k] = places[:, j]
            if not stay.all():
                x, row, places = x[stay], row[stay], places[stay]
    return sig


def _bands(sig: np.ndarray) -> np.ndarray:
    """int64 [rows, BANDS] bucket keys."""
    s = sig.astype(np.uint64).reshape(len(sig), BANDS, ROWS)
    key = poly_of([np.ascontiguousarray(s[:, :, r]).reshape(-1) for r in range(ROWS)])
    band = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), len(sig))
    return mix64(key + band * GOLDEN).view(np.int64).reshape(len(sig), BANDS)


def _short(sig: np.ndarray) -> np.ndarray:
    """uint8 [rows, HASHES]: eight mixed bits of each place."""
    return (mix64(sig.astype(np.uint64)) & np.uint64(0xFF)).astype(np.uint8)


def _binary(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix)
    width = matrix.shape[1] * matrix.itemsize
    off = np.arange(len(matrix) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(matrix),
                                 [None, pa.py_buffer(off), pa.py_buffer(matrix)])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), HASHES)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (sums that name the shingle set), sig
    (one byte a place) and bands (BANDS int64 keys) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, off in text_slices(batch.column(1)):
                hashes, first = shingle_sets(data, off)
                n = np.diff(first)
                full = n > 0
                set_a, set_b = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if full.any():
                    set_a[full] = np.add.reduceat(hashes, first[:-1][full])
                    set_b[full] = np.add.reduceat(mix64(hashes ^ GOLDEN), first[:-1][full])
                sig = signatures(hashes, first)
                bands = _bands(sig)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(n)), pa.array(n, pa.int64()),
                     pa.array(set_a.view(np.int64)), pa.array(set_b.view(np.int64)),
                     _binary(_short(sig)), _binary(bands)],
                    ["doc_id", "n_shingles", "set_a", "set_b", "sig", "bands"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        tidied(sign), f"doc_id {kind}, n_shingles long, set_a long, set_b long, sig binary, bands binary")


# ------------------------------------------------------------- verification

def _size_ok(a: str, b: str):
    return (F.lit(100) * F.least(a, b)) >= (F.lit(PER_100) * F.greatest(a, b))


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, sig_a, sig_b) whose signatures agree often enough."""
    for batch in batches:
        if batch.num_rows:
            same = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1)
            yield batch.select([0, 1]).filter(pa.array(same >= LEAST_MATCHES))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, shingles_a, shingles_b) that are linked."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            x = np.frombuffer(x.as_buffer(), np.uint64)
            y = np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * both >= PER_100 * (len(x) + len(y) - both)
        yield batch.select([0, 1]).filter(pa.array(keep))


def _id_hash(col: str):
    return F.xxhash64(F.col(col))


def _full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the named documents: texts are read again, and a
    bitmap of the wanted ids keeps the others out before the join."""
    bitmap = docs.sparkSession.sparkContext.broadcast(
        hash_bitmap(nodes.select(_id_hash("node").alias("h")), "h"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = in_bitmap(bitmap.value, batch.column(2).to_numpy().view(np.uint64))
            if not wanted.any():
                continue
            batch = batch.filter(pa.array(wanted))
            for at, data, off in text_slices(batch.column(1)):
                hashes, first = shingle_sets(data, off)
                raw = pa.Array.from_buffers(
                    pa.large_binary(), len(off) - 1,
                    [None, pa.py_buffer((first * 8).astype(np.int64)), pa.py_buffer(hashes)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(off) - 1), raw.cast(pa.binary())],
                    ["node", "shingles"])

    small_batches(docs.sparkSession)
    found = (docs.filter("doc_id IS NOT NULL")
             .select(F.col("doc_id").cast("long").alias("node"), "text", _id_hash("doc_id").alias("h"))
             .mapInArrow(
        tidied(sets), "node long, shingles binary"))
    return found.join(nodes, "node", "left_semi")


def _confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, by their full shingle sets."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # rows of one id twice: equal ids, any of their sets
    sets = written(_full_sets(docs, nodes).dropDuplicates(["node"]), "shingle_sets")
    small_batches(docs.sparkSession, 500)
    return (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(_similar, "a long, b long"))


# ------------------------------------------------------------------ buckets

def _in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each band of (node, n, bands)."""
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
        node, n = (np.repeat(batch.column(i).to_numpy(), BANDS) for i in (0, 1))
        band = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node, n, band, keys)],
                                         ["node", "n", "band", "bucket"])


def _stars(members: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs of each bucket's members with its most popular and its smallest
    member whose sizes and signatures allow a link."""
    popular = members.groupBy("node").agg(F.sum("n_in_bucket").alias("popularity"))
    ranked = members.join(popular, "node")
    hubs = ranked.groupBy("bucket").agg(
        F.max(F.struct("popularity", (-F.col("node")).alias("neg"), "n")).alias("hub"),
        F.min(F.struct("node", "n")).alias("least"))
    pairs = members.join(hubs, "bucket").select(
        "node", "n", F.explode(F.array(
            F.struct((-F.col("hub.neg")).alias("p"), F.col("hub.n").alias("pn")),
            F.struct(F.col("least.node").alias("p"), F.col("least.n").alias("pn")))).alias("q"))
    pairs = (pairs.filter((F.col("node") != F.col("q.p")) & _size_ok("n", "q.pn"))
             .select(F.least("node", "q.p").alias("a"), F.greatest("node", "q.p").alias("b"))
             .distinct())
    return (pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(_agree, "a long, b long"))


def _links_within(group: pa.Table) -> pa.Table:
    """Links between the components of one block. Rows: bucket, node, n,
    component, band, sig, bands, loose, shingles, block, part. If some rows have part
    1, only pairs with at least one of those are wanted, and pairs of two such
    rows in block 0 alone. A band below 0: pairs may be looked at anywhere.
    Bits of loose: bands whose bucket was not searched whole."""
    group = group.combine_chunks()
    order = np.argsort(group.column("n").to_numpy(), kind="stable")
    group = group.take(pa.array(order)).combine_chunks()
    node, n = group.column("node").to_numpy(), group.column("n").to_numpy()
    part = group.column("part").to_numpy()
    band, block = group.column("band")[0].as_py(), group.column("block")[0].as_py()
    sig = _matrix(group.column("sig"))
    bands = np.frombuffer(b"".join(group.column("bands").to_pylist()), np.int64).reshape(-1, BANDS)
    whole = (group.column("loose").to_numpy()[:, None] >> np.arange(max(band, 0))) & 1 == 0
    raw = group.column("shingles").to_pylist()
    root = {c: c for c in group.column("component").to_pylist()}
    comp = group.column("component").to_pylist()

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    some = part.any()
    # with sizes sorted, a row's partners reach from it to the last that is not too large
    reach = np.searchsorted(n, n * 100 // PER_100, "right")
    left, right = [], []
    now = np.array(comp)
    for i in range(len(node)):
        k = np.arange(i + 1, reach[i])
        if some:
            k = k[(part[k] == 1) | (part[i] == 1)]
            if block:
                k = k[(part[k] == 0) | (part[i] == 0)]
        own = find(comp[i])
        k = k[now[k] != own]
        if not len(k):
            continue
        same = (sig[k] == sig[i]).sum(axis=1)
        near = same >= LEAST_MATCHES
        k, same = k[near], same[near]
        if band > 0 and len(k):
            first = ~((bands[k, :band] == bands[i, :band]) & whole[i]).any(axis=1)
            k, same = k[first], same[first]
        k = k[np.argsort(-same, kind="stable")]
        mine = np.frombuffer(raw[i], np.uint64)
        while len(k):
            some_k, k = k[:16], k[16:]
            others = np.concatenate([np.frombuffer(raw[x], np.uint64) for x in some_k])
            at = np.searchsorted(mine, others)
            at[at == len(mine)] = 0
            both = np.add.reduceat((mine[at] == others).astype(np.int64),
                                   np.append(0, np.cumsum(n[some_k])[:-1]))
            linked = some_k[100 * both >= PER_100 * (n[i] + n[some_k] - both)]
            for x in linked.tolist():
                a, b = find(comp[i]), find(comp[x])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    now[(now == a) | (now == b)] = min(a, b)
                    left.append(node[i])
                    right.append(node[x])
            if len(linked):
                k = k[now[k] != find(comp[i])]
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def _unsettled(rows: DataFrame) -> DataFrame:
    """Rows of the buckets that still hold more than one component, with the
    bucket's weight, its largest component and the weight outside that."""
    by_comp = rows.groupBy("bucket", "component").agg(
        F.sum(F.col("n") + ROW_WEIGHT).alias("c"))
    of_bucket = by_comp.groupBy("bucket").agg(
        F.sum("c").alias("size"), F.count(F.lit(1)).alias("comps"),
        F.max(F.struct("c", "component")).alias("top"))
    wanted = of_bucket.filter("comps > 1").select(
        "bucket", "size", F.col("top.component").alias("major"),
        (F.col("size") - F.col("top.c")).alias("outside"))
    return rows.join(wanted, "bucket")


def _subkeys(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """Each row once for each of SPLITS sub-buckets, by places of its signature;
    sub-buckets share none until all places are used."""
    rng = np.random.default_rng(level)
    rounds = -(-SPLITS * ROWS // HASHES)
    places = np.concatenate([rng.permutation(HASHES) for _ in range(rounds)]).reshape(-1, ROWS)[:SPLITS]
    for batch in batches:
        sig = _matrix(batch.column("sig")).astype(np.uint64)
        old = batch.column("bucket").to_numpy().view(np.uint64)
        for s, at in enumerate(places):
            key = poly_of([old, *(sig[:, p] for p in at), np.full(len(old), s, np.uint64)])
            yield batch.set_column(0, "bucket", pa.array(key.view(np.int64)))


_PLACE = ["bucket", "node", "n", "component", "band"]


def _rest(docs: DataFrame, members: DataFrame, comps: DataFrame, sigs: DataFrame) -> DataFrame:
    """Links (a, b) between components whose members share a bucket."""
    rows = members.join(comps, "node", "left").select(
        "bucket", "node", "n", F.coalesce("component", "node").alias("component"), "band")
    rows = written(_unsettled(rows), "unsettled")
    nodes = written(rows.select("node").distinct(), "unsettled_nodes")
    sets = _full_sets(docs, nodes).dropDuplicates(["node"])
    facts = written(sigs.select("node", "sig", "bands").join(sets, "node"), "facts")
    blocks, loose = [], None
    for level in range(LEVELS + 1):
        size, outside = F.col("size"), F.col("outside")
        small = rows.filter(size <= BLOCK).withColumns({"block": F.lit(0), "part": F.lit(0)})
        n_blocks = F.ceil(size / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("node"), n_blocks).cast("int")
        # little outside the largest component: it goes with each of its blocks
        few = rows.filter((size > BLOCK) & (outside <= BLOCK))
        few = few.withColumn("part", (F.col("component") != F.col("major")).cast("int")) \
            .withColumn("block", F.explode(F.when(F.col("part") == 1, F.sequence(
                F.lit(0), n_blocks - 1)).otherwise(F.array(own))))
        blocks += [x.select(*_PLACE, "block", "part") for x in (small, few)]
        large = rows.filter((size > BLOCK) & (outside > BLOCK)).withColumns(
            {"own": own.cast("long"), "blocks": n_blocks.cast("long")})
        # a group for each pair of blocks; across two blocks, only pairs across
        paired = (large if level == LEVELS else large.filter(F.col("blocks") <= EXACT)) \
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        blocks.append(paired.withColumns({
            "block": F.least("own", "other") * F.col("blocks") + F.greatest("own", "other"),
            "part": (F.col("own") < F.col("other")).cast("int")}).select(*_PLACE, "block", "part"))
        if level == LEVELS:
            break
        large = large.filter(F.col("blocks") > EXACT)
        if large.isEmpty():
            break
        if not level:
            loose = large.groupBy("node").agg(F.expr("bit_or(shiftleft(1L, band))").alias("loose"))
        split = large.select(*_PLACE).join(facts.select("node", "sig"), "node") \
            .select("bucket", "node", "n", "component", F.lit(-1).alias("band"), "sig").mapInArrow(
            lambda it, k=level: _subkeys(it, k),
            "bucket long, node long, n long, component long, band int, sig binary")
        rows = written(_unsettled(split.drop("sig")), "split")
    todo = blocks[0]
    for b in blocks[1:]:
        todo = todo.unionByName(b)
    facts = facts.withColumn("loose", F.lit(0).cast("long")) if loose is None else \
        facts.join(loose, "node", "left").na.fill(0, ["loose"])
    return todo.join(facts, "node").groupBy("bucket", "block").applyInArrow(
        _links_within, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id, kept."""
    marked = written(signed(docs), "signed")
    kind = marked.schema["doc_id"].dataType
    some = marked.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = written(some.groupBy("set_a", "set_b", F.col("n_shingles").alias("n")).agg(
        F.min(F.struct(F.col("doc_id").cast("long").alias("node"), "sig", "bands")).alias("r"))
        .select("set_a", "set_b", "n", "r.*"), "classes")
    members = classes.select("node", "n", "bands").mapInArrow(
        _in_buckets, "node long, n long, band int, bucket long")
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_in_bucket")) \
        .filter("n_in_bucket > 1")
    members = written(members.join(crowded, "bucket"), "members")
    links = written(_confirmed(docs, written(_stars(members, classes), "stars")), "links_by_star")
    comps = written(components(links), "star_components")
    more = written(_rest(docs, members, comps, classes), "links_of_rest")
    # the first components stand for their links
    final = components(comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
                       .unionByName(more))
    of_class = classes.select("set_a", "set_b", "node").join(
        final, "node", "left").select(
        "set_a", "set_b", F.coalesce("component", "node").cast(kind).alias("component_id"))
    linked = some.select("doc_id", "n_shingles", "set_a", "set_b").join(
        of_class, ["set_a", "set_b"]).select("doc_id", "n_shingles", "component_id")
    alone = marked.filter("doc_id IS NULL OR n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
