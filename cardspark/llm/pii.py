"""Personal data: base patterns, and information-theoretic sanitisation of the
terms that reveal what the patterns found.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers.
Each value found is a protected entity. Terms (runs of letters and digits,
A-Z lower-cased) that touch no span co-occur with every entity of their
document, wherever they stand. With n(e) documents that mention entity e,
n(e,t) of them holding term t, f(t) documents holding t of the corpus of M,

    IC(e) = -log2(n(e) / M)        PMI(e;t) = IC(e) + log2(n(e,t) / f(t))

and PMI / IC is the share of the entity's information that the term discloses:
1 for a term met nowhere else, far lower for common ones. Terms that disclose
``REMOVE`` or more are removed, from ``GENERALISE`` on they are replaced by a
general label, at every place of the documents that mention the entity.

Evidence. A word met once, beside an address, is found nowhere else either, and
says nothing. So a pair must also be sure: the lower end of a Wilson interval
(``SURE`` standard errors) of the share of the term's occurrences that lie in
documents of the entity must be above ``MOST``. Occurrences inside one document
count, so an entity of a single document can have terms; copies of a document
are no further evidence, and count alike in n(e), n(e,t) and f(t).

Scale. Equal documents go on as one. Pairs that no f(t) could make sure are left
out before they are shuffled, exactly those of too few occurrences. Counting
f(t) reads all texts again, but passes on only terms whose hash hits a bitmap of
the candidate terms (2 ** ``BITMAP_BITS`` bits whatever the corpus; a fuller
bitmap lets more terms through and changes no count). Pairs and counts meet in
plain joins on pre-aggregated rows. Text goes through a shuffle only for
documents with a mention, and only when redacted texts are asked for.

Defined results: null or empty text has no spans (the base_sha256 is that of
the empty string); repeated rows each get their result; an empty table gives an
empty result. Columns that this module adds start with ``_pii_``; all others
are carried or left out as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.llm.common import (
    LOWER, small_batches, text_slices, tidied, word_bounds, word_hashes, written,
)

SURE = 1.645  # standard errors: 95 % on one side
MOST = 0.5
GENERALISE = 0.85
REMOVE = 0.95
BITMAP_BITS = 20
RUN_TERMS = 1_000_000  # counts a task holds before it passes them on

KINDS = ("email", "ip", "card", "phone")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]",
          "term": "[TERM]", "removed": ""}

# A run of digits is only ever entered at its start; the possessive forms
# match what the plain ones do and never retry.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# bytes that part terms: all of ASCII but letters and digits
TERM_GAP = np.zeros(256, bool)
TERM_GAP[:128] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    TERM_GAP[_a:_b] = False
_TERM = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        elif start < at:
            free = start  # nothing before this sign can match a later one
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as listed."""
    found = [(a, 0, b, "email") for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40 and 14 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and _luhn(d):
            found.append((m.start(), 2, m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return [(a, b, k) for a, _, b, k in sorted(found)]


def _entity(kind: str, value: str) -> str:
    return kind + ":" + (value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value))


def _around(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The terms of the text that touch no span."""
    covered = np.zeros(len(text) + 1, np.int64)
    for a, b, _ in spans:
        covered[a + 1:b + 1] = 1
    covered = np.cumsum(covered)
    return [(m.start(), m.end()) for m in _TERM.finditer(text) if covered[m.start()] == covered[m.end()]]


def term_hashes(terms: list[str]) -> np.ndarray:
    """int64 hashes of terms, as the corpus count makes them from bytes."""
    data = np.frombuffer(" ".join(terms).encode(), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]), TERM_GAP)
    return word_hashes(LOWER[data], starts, ends, TERM_GAP).view(np.int64)


_SPAN = "array<struct<start:int,end:int,kind:string>>"
_AROUND = "array<struct<term:long,start:int,end:int>>"
_COUNTS = "array<struct<term:long,n:int>>"


def _hash64(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little", signed=True)


def detect(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if None) of every row with _pii_row (an id),
    _pii_spans (base spans) and, if there are any, _pii_entities (different
    ones), _pii_around (all terms that touch no span), _pii_counts (how often each
    of them occurs) and _pii_context (a hash of entities and terms). Must be written before it is read twice: the ids are
    those of the tasks."""
    keep = docs.columns if keep is None else keep
    docs = docs.select(*keep, F.col(text_col).alias("_pii_text"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + \
        f", _pii_row long, _pii_spans {_SPAN}, _pii_entities array<long>," \
        f" _pii_around {_AROUND}, _pii_counts {_COUNTS}, _pii_context long"
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                    ("kind", pa.string())]))

    def mentions(text: str, spans) -> tuple[list[int], np.ndarray, np.ndarray, int]:
        around = np.array(_around(text, spans), np.int32).reshape(-1, 2)
        hashes = term_hashes([text[x:y] for x, y in around]) if len(around) else np.zeros(0, np.int64)
        entities = sorted({_hash64(_entity(kind, text[a:b])) for a, b, kind in spans})
        return entities, around, hashes, _hash64(repr((entities, hashes.tolist())))

    def structs(sizes: list[int], **columns: np.ndarray) -> pa.Array:
        """One list of structs a row, from the columns of all rows."""
        return pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(c) for c in columns.values()], list(columns)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            n = batch.num_rows
            texts = batch.column(len(keep))
            spans, entities, context = [[]] * n, [[]] * n, [None] * n
            # terms by row: places and hashes, and how often each hash occurs
            n_around, n_counts = [0] * n, [0] * n
            places, hashes = [np.zeros((0, 2), np.int32)], [np.zeros(0, np.int64)]
            terms, often = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            hits = pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False)
            for i in np.flatnonzero(hits.to_numpy(zero_copy_only=False)):
                text = texts[int(i)].as_py()
                if found := base_spans(text):
                    spans[i] = [{"start": a, "end": b, "kind": k} for a, b, k in found]
                    entities[i], around, h, context[i] = mentions(text, found)
                    t, c = np.unique(h, return_counts=True)
                    n_around[i], n_counts[i] = len(h), len(t)
                    places.append(around)
                    hashes.append(h)
                    terms.append(t)
                    often.append(c.astype(np.int32))
            at = np.concatenate(places)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))]
                + [pa.array(range(row, row + n), pa.int64()), pa.array(spans, span_type),
                   pa.array(entities, pa.list_(pa.int64())),
                   structs(n_around, term=np.concatenate(hashes), start=at[:, 0].copy(),
                           end=at[:, 1].copy()),
                   structs(n_counts, term=np.concatenate(terms), n=np.concatenate(often)),
                   pa.array(context, pa.int64())],
                keep + ["_pii_row", "_pii_spans", "_pii_entities", "_pii_around", "_pii_counts",
                        "_pii_context"])
            row += n

    small_batches(docs.sparkSession)
    return docs.mapInArrow(
        tidied(find), schema)


def _bitmap(candidates: DataFrame) -> np.ndarray:
    """2 ** BITMAP_BITS flags: the leading bits of the candidates' hashes.
    At most that many small integers come to the driver."""
    lead = F.shiftrightunsigned("term", 64 - BITMAP_BITS).cast("int").alias("lead")
    flags = np.zeros(1 << BITMAP_BITS, bool)
    flags[[r["lead"] for r in candidates.select(lead).distinct().collect()]] = True
    return flags


def term_counts(docs: DataFrame, candidates: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n): texts that hold each of the candidate terms (and of others
    that share their leading bits); the null term has those with any term."""
    flags = docs.sparkSession.sparkContext.broadcast(np.packbits(_bitmap(candidates)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(flags.value).astype(bool)
        total, size, held = 0, 0, []

        def united():
            terms, at = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
            return terms, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        def rows(terms, n):
            return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n, pa.int64())], ["term", "n"])

        for batch in batches:
            for _, data, off in text_slices(batch.column(0)):
                starts, ends, first = word_bounds(data, off, TERM_GAP)
                total += int((np.diff(first) > 0).sum())
                if not wanted.any():
                    continue
                h = word_hashes(LOWER[data], starts, ends, TERM_GAP)
                hit = wanted[(h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)]
                h, row = h[hit], np.repeat(np.arange(len(off) - 1), np.diff(first))[hit]
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)  # one for each text
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                terms, n = np.unique(h[new].view(np.int64), return_counts=True)
                if len(terms):
                    held.append((terms, n))
                    size += len(terms)
                if size > RUN_TERMS:
                    held[:] = [united()]
                    size = len(held[0][0])
                    if size > RUN_TERMS // 2:  # uniting no longer shrinks them
                        yield rows(*held.pop())
                        size = 0
        if held:
            yield rows(*united())
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["term", "n"])

    small_batches(docs.sparkSession)
    return (docs.select(text_col).mapInArrow(
        tidied(count), "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


def sure_share(hits: Column, share: Column, sure: float = SURE) -> Column:
    """The lower end of the Wilson interval of ``share``, of which ``hits`` were
    seen (so hits / share trials)."""
    n, z2 = hits / share, sure * sure
    return ((share + z2 / (2 * n) - sure * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n)))
            / (1 + z2 / n))


def disclosures(found: DataFrame, docs: DataFrame, text_col: str = "text", sure: float = SURE,
                most: float = MOST, generalise: float = GENERALISE,
                remove: float = REMOVE) -> DataFrame:
    """(entity, term, disclosure, action): the pairs that are sure and over the
    threshold."""
    contexts = (found.filter(F.size("_pii_entities") > 0).groupBy("_pii_context").agg(
        F.first("_pii_entities").alias("entities"), F.first("_pii_counts").alias("terms"),
        F.count(F.lit(1)).alias("copies")))
    contexts = written(contexts, "pii_contexts")
    of_entity = (contexts.select(F.explode("entities").alias("entity"), "copies").groupBy("entity")
                 .agg(F.sum("copies").alias("n_e"), F.count(F.lit(1)).alias("contexts")))
    # a share of 1 is the surest that some hits can make
    could = sure_share(F.col("hits").cast("double"), F.lit(1.0), sure) > most
    pairs = (contexts.select(F.explode("entities").alias("entity"), "copies", "terms")
             .join(of_entity, "entity")
             .select("entity", "copies", "contexts", F.explode("terms").alias("t"))
             .select("entity", "copies", "contexts", "t.term", F.col("t.n").alias("hits"))
             .filter((F.col("contexts") > 1) | could)
             .groupBy("entity", "term")
             .agg(F.sum("copies").alias("n_et"), F.sum("hits").alias("hits")).filter(could))
    pairs = written(pairs, "pii_pairs")
    counts = written(term_counts(docs, pairs, text_col), "pii_terms")
    total = counts.filter("term IS NULL").agg(F.sum("n").alias("m")).first()["m"] or 1
    d = pairs.join(counts, "term").join(of_entity, "entity")
    ic = -F.log2(F.col("n_e") / F.lit(float(max(total, 2))))
    share = F.least(F.lit(1.0), F.col("n_et") / F.col("n"))
    return (d.filter(sure_share(F.col("hits").cast("double"), share, sure) > most)
            .select("entity", "term", F.when(ic > 0, 1 + F.log2(share) / ic).alias("disclosure"))
            .filter(F.col("disclosure") >= generalise)
            .withColumn("action", F.when(F.col("disclosure") >= remove, "removed")
                        .otherwise("term")))


def term_spans(found: DataFrame, disclosing: DataFrame) -> DataFrame:
    """(_pii_row, _pii_terms): the spans of disclosing terms of each row."""
    some = found.filter(F.size("_pii_entities") > 0)
    wanted = (some.select("_pii_row", F.explode("_pii_entities").alias("entity"))
              .join(disclosing.select("entity", "term", "action"), "entity")
              .groupBy("_pii_row", "term").agg(F.min("action").alias("action")))
    places = (some.join(wanted.select("_pii_row"), "_pii_row", "left_semi")
              .select("_pii_row", F.explode("_pii_around").alias("t"))
              .select("_pii_row", "t.term", "t.start", "t.end"))
    return (places.join(wanted, ["_pii_row", "term"])
            # one span for each place; removal wins
            .groupBy("_pii_row", "start", "end").agg(F.min("action").alias("kind"))
            .groupBy("_pii_row").agg(F.sort_array(F.collect_list(
                F.struct("start", "end", "kind"))).alias("_pii_terms")))


def sanitise(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
             **limits) -> DataFrame:
    """Columns ``keep`` of every row with _pii_spans (base) and _pii_terms
    (spans of disclosing terms; kind ``term`` or ``removed``)."""
    # it may hold all texts once more
    found = written(detect(docs, text_col, keep), "pii_found", "zstd")
    spans = term_spans(found, written(disclosures(found, docs, text_col, **limits), "pii_disclosing"))
    none = F.expr(f"CAST(array() AS {_SPAN})")
    # a row without a mention has no term spans and needs no join
    plain = found.filter(F.size("_pii_entities") == 0).withColumn("_pii_terms", none)
    rest = found.filter(F.size("_pii_entities") > 0).join(spans, "_pii_row", "left") \
        .withColumn("_pii_terms", F.coalesce("_pii_terms", none))
    out = [c for c in plain.columns if c not in ("_pii_row", "_pii_entities", "_pii_around",
                                                   "_pii_counts", "_pii_context")]
    return plain.select(*out).unionByName(rest.select(*out))


def redact(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with personal data replaced by labels, disclosing terms by a
    general label or nothing."""
    marked = sanitise(docs, text_col, None, **limits)
    names, place = docs.columns, docs.columns.index(text_col)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            base, terms = batch.column(len(names)), batch.column(len(names) + 1)
            size = pc.add(pc.list_value_length(base), pc.list_value_length(terms))
            hit = np.flatnonzero(size.to_numpy(zero_copy_only=False))
            if len(hit):
                new = texts.to_pylist()
                for i in hit:
                    new[i] = _replaced(new[i], base[int(i)].as_py() + terms[int(i)].as_py())
                texts = pa.array(new, texts.type)
            cols = [batch.column(i) for i in range(len(names))]
            cols[place] = texts
            yield pa.RecordBatch.from_arrays(cols, names)

    small_batches(docs.sparkSession)
    return marked.select(*names, "_pii_spans", "_pii_terms") \
        .mapInArrow(
        tidied(replace), docs.schema)


def _replaced(text: str, spans: list[dict]) -> str:
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["end"] <= at:
            continue
        out += [text[at:max(at, s["start"])], LABELS[s["kind"]] if s["start"] >= at else ""]
        at = s["end"]
    return "".join(out) + text[at:]


def _count_of(kind: str) -> Column:
    return F.size(F.filter("_pii_spans", lambda s: s["kind"] == kind)).cast("long")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans (base
    and term spans by start, base ones first at the same start)."""
    d = sanitise(docs.select("doc_id", "text"), "text", ["doc_id"], **limits)
    # base kinds come in their listed order; "z" puts term spans after them
    ranked = F.sort_array(F.concat(
        F.transform("_pii_spans", lambda s, i: F.struct(
            s["start"].alias("start"), F.lit(0).alias("late"), i.alias("i"), s["end"].alias("end"),
            s["kind"].alias("kind"))),
        F.transform("_pii_terms", lambda s, i: F.struct(
            s["start"].alias("start"), F.lit(1).alias("late"), i.alias("i"), s["end"].alias("end"),
            s["kind"].alias("kind")))))
    return d.select(
        "doc_id",
        *[_count_of(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.col("_pii_spans")).cast("binary"), 256).alias("base_sha256"),
        _joined(ranked).alias("spans"))
