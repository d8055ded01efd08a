"""Language identification of spans: script ranges, per-word scores, Viterbi.

Training, on about ``TRAIN_ROWS`` labelled texts of each language (a documented
bound; all texts of a language with fewer; the draw is by a hash of the id, and
a language that occurs has one row at least): for each language, counts of the byte trigrams inside
words, word edges included, hashed to ``BUCKETS`` places; and the share of its
letters in each script.

Scoring. A word's score for a language is the sum of its trigrams' log
probabilities less their mean over the languages. The script of its characters
narrows the candidates to the languages written in that script; others lose
``OUTSIDE``. Over the words of a text, Viterbi labels every word so that the
sum of scores less ``SWITCH`` for each change of language is largest. Texts
where no run of words gains more than half a penalty from any other language
keep their best single language without it, which is provably the same result.

Result. The language of a text is the one that labels most of its words with
letters (ties: the first by code point), its score the share of those words,
the spans are the runs of equal labels.

Defined results: null text or text without a letter: ``und``, score 0, no
spans; so is every text if no labelled text was given. Repeated rows are
labelled each; rows without a label or text teach nothing; an empty table gives
an empty result. Columns that this module adds start with ``_lang_``; others
are carried as asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm.common import (
    LOWER, bucket_of, small_batches, text_slices, tidied, word_bounds,
)

TRAIN_ROWS = 20_000
BUCKETS = 1 << 16
SMOOTH = 0.5
SWITCH = 20.0
OUTSIDE = 25.0
SCRIPT_SHARE = 0.02  # of a language's letters, to count as written in a script
UND = "und"

# The script that a UTF-8 lead byte stands for.
_SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9)],
    "greek": [(0xCD, 0xCF)],
    "cyrillic": [(0xD0, 0xD4)],
    "hebrew": [(0xD6, 0xD7)],
    "arabic": [(0xD8, 0xDB)],
    "indic": [(0xE0, 0xE0)],
    "other": [(0xE1, 0xE1)],
    "kana": [(0xE3, 0xE3)],
    "han": [(0xE4, 0xE9)],
    "hangul": [(0xEA, 0xED)],
}
SCRIPT_BIT = np.zeros(256, np.uint16)
for _i, _ranges in enumerate(_SCRIPTS.values()):
    for _a, _b in _ranges:
        SCRIPT_BIT[_a:_b + 1] = 1 << _i
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True
_FEATURE = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
# bytes that part words here: spaces, digits and the ASCII marks
GAP = np.zeros(256, bool)
GAP[:128] = ~_ASCII_LETTER[:128]


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(features, first): the hashed trigrams around every byte of the words,
    and where each word's begin (one more entry than words)."""
    sizes = ends - starts
    first = np.append(0, np.cumsum(sizes))
    at = np.arange(first[-1]) + np.repeat(starts - first[:-1], sizes)
    b = data[at].astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
    prev, next_ = np.append(np.uint32(0), b[:-1]), np.append(b[1:], np.uint32(0))
    if len(starts):
        prev[first[:-1]] = 0
        next_[first[1:] - 1] = 0
    x = prev * _FEATURE[0] ^ b * _FEATURE[1] ^ next_ * _FEATURE[2]
    return (x ^ (x >> np.uint32(15))) & np.uint32(BUCKETS - 1), first


class LanguageModel:
    """Names, trigram log probabilities [bucket, language] and script masks."""

    def __init__(self, names: list[str], logs: np.ndarray, masks: np.ndarray):
        self.names, self.logs, self.masks = names, logs, masks

    def word_scores(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(scores [word, language], whether the word has a script)."""
        f, first = features(LOWER[data], starts, ends)
        n = len(starts)
        scores = np.empty((n, len(self.names)))
        for i in range(len(self.names)):
            total = np.append(0.0, np.cumsum(self.logs[f, i], dtype=np.float64))
            scores[:, i] = total[first[1:]] - total[first[:-1]]
        if not n:
            return scores, np.zeros(0, bool)
        sizes = ends - starts
        at = np.arange(first[-1]) + np.repeat(starts - first[:-1], sizes)
        script = np.bitwise_or.reduceat(SCRIPT_BIT[data[at]], first[:-1])
        can = (script[:, None] & self.masks[None, :]) != 0
        # a script that no language is known to use tells nothing
        can |= ~can.any(axis=1, keepdims=True)
        scores[~can] -= OUTSIDE
        return scores, script > 0


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of every word."""
    n, k = scores.shape
    stay = np.ones((n, k), bool)
    hub = np.zeros(n, np.int64)
    rows = scores.tolist()
    best = rows[0]
    for t in range(1, n):
        top = max(best)
        i = best.index(top)
        hub[t] = i
        top -= switch
        row, new = rows[t], [0.0] * k
        for j in range(k):
            if best[j] >= top:
                new[j] = best[j] + row[j]
            else:
                new[j] = top + row[j]
                stay[t, j] = False
        best = new
    labels = np.empty(n, np.int64)
    j = best.index(max(best))
    for t in range(n - 1, -1, -1):
        labels[t] = j
        if not stay[t, j]:
            j = hub[t]
    return labels


def _mixed(scores: np.ndarray, first: np.ndarray, single: np.ndarray, switch: float) -> np.ndarray:
    """For each row: whether some run of words gains more than half a penalty
    from a language other than the row's best single one."""
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    gain = scores - scores[np.arange(len(scores)), single[row]][:, None]
    out = np.zeros(len(n), bool)
    # running sums with a 0 before each row; rows stand so far apart that a
    # running minimum never reaches back into the row before
    place = np.arange(len(scores)) + row + 1
    for i in range(scores.shape[1]):
        c = np.zeros(len(scores) + len(n))
        total = np.append(0.0, np.cumsum(gain[:, i]))
        c[place] = total[1:] - total[first[:-1]][row]
        row0 = np.repeat(np.arange(len(n)), n + 1)
        far = 4 * (np.abs(c).max() + 1)
        c -= row0 * far
        best = c - np.minimum.accumulate(c)
        out |= np.maximum.reduceat(best, first[:-1] + np.arange(len(n))) > switch / 2
    return out


def label_rows(model: LanguageModel, data: np.ndarray, off: np.ndarray, switch: float = SWITCH):
    """Per row: language index (-1: und), score, and runs [(label, words)]."""
    starts, ends, first = word_bounds(data, off, GAP)
    scores, lettered = model.word_scores(data, starts, ends)
    n_rows, k = len(off) - 1, len(model.names)
    n = np.diff(first)
    row = np.repeat(np.arange(n_rows), n)
    totals = np.stack([np.bincount(row, scores[:, i], n_rows) for i in range(k)], axis=1)
    single = totals.argmax(axis=1)
    labels = single[row]
    some = n > 0
    if k > 1 and some.any():
        full = np.flatnonzero(some)
        keep = np.append(first[full], first[-1])
        mixed = _mixed(scores, keep, single[full], switch)
        for r in full[mixed]:
            labels[first[r]:first[r + 1]] = viterbi(scores[first[r]:first[r + 1]], switch)
    weight = lettered.astype(np.float64)
    votes = np.stack([np.bincount(row, weight * (labels == i), n_rows) for i in range(k)], axis=1)
    pick = votes.argmax(axis=1)
    all_ = votes.sum(axis=1)
    share = votes[np.arange(n_rows), pick] / np.maximum(all_, 1.0)
    # words by their scripts' bytes; marks beyond ASCII may look like letters
    ascii_letters = np.zeros(n_rows, bool)
    is_letter = np.append(0, np.cumsum(_ASCII_LETTER[data]))
    ascii_letters = is_letter[off[1:]] > is_letter[off[:-1]]
    for r in np.flatnonzero(~ascii_letters):
        text = data[off[r]:off[r + 1]].tobytes().decode()
        if not any(map(str.isalpha, text)):
            pick[r], share[r] = -1, 0.0
        elif not all_[r]:
            pick[r], share[r] = single[r], 1.0
    return pick, share, labels, first


# ----------------------------------------------------------------- training

def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Fit on about ``train_rows`` of each language's rows (doc_id, text, lang)."""
    labelled = labelled.filter("lang IS NOT NULL AND text IS NOT NULL") \
        .select("doc_id", "lang", "text")
    u = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30))
    # one row a language; the least hash stays, so that no label is lost
    drawn = labelled.groupBy("lang").agg(F.greatest(
        F.lit(float(train_rows)) / F.count(F.lit(1)) * F.lit(1 << 30), F.min(u)).alias("most"))
    labelled = labelled.join(F.broadcast(drawn), "lang").filter(u <= F.col("most"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for at, data, off in text_slices(batch.column(1)):
                starts, ends, first = word_bounds(data, off, GAP)
                f, begin = features(LOWER[data], starts, ends)
                edge = begin[first]  # features of the rows
                for r in range(len(off) - 1):
                    lang = langs[at + r]
                    if lang not in grams:
                        grams[lang] = np.zeros(BUCKETS, np.int64)
                        scripts[lang] = np.zeros(16, np.int64)
                    # np.unique keeps short texts cheap
                    x, c = np.unique(f[edge[r]:edge[r + 1]], return_counts=True)
                    grams[lang][x] += c
                    bits, c = np.unique(SCRIPT_BIT[data[off[r]:off[r + 1]]], return_counts=True)
                    for b, k in zip(bits, c):
                        if b:
                            scripts[lang][int(b).bit_length() - 1] += k
        for lang, g in grams.items():
            i = np.flatnonzero(g)
            j = np.flatnonzero(scripts[lang])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(i) + len(j)), pa.string()),
                 pa.array(np.append(i, BUCKETS + j), pa.int32()),
                 pa.array(np.append(g[i], scripts[lang][j]), pa.int64())], ["lang", "at", "n"])

    small_batches(labelled.sparkSession)
    # BUCKETS rows a language at most come to the driver
    got = (labelled.select("lang", "text").mapInArrow(
        tidied(count), "lang string, at int, n long")
           .groupBy("lang", "at").agg(F.sum("n").alias("n")).toArrow())
    langs = np.array(got.column("lang").to_pylist(), object)
    at, n = got.column("at").to_numpy(), got.column("n").to_numpy()
    names = sorted(set(langs))
    table = np.zeros((len(names), BUCKETS + 16))
    for i, name in enumerate(names):
        table[i, at[langs == name]] = n[langs == name]
    grams, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
    logs = np.log(grams + SMOOTH) - np.log(grams.sum(axis=1, keepdims=True) + SMOOTH * BUCKETS)
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    masks = ((share >= SCRIPT_SHARE) * (1 << np.arange(16))).sum(axis=1).astype(np.uint16)
    centred = logs - logs.mean(axis=0) if names else logs
    return LanguageModel(names, centred.T.astype(np.float32).copy(), masks)


# --------------------------------------------------------------- prediction

def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             keep: list[str] | None = None, switch: float = SWITCH) -> DataFrame:
    """Columns ``keep`` (all, if None) of every row with _lang_pred,
    _lang_score and _lang_spans (label, first word, word after the last)."""
    keep = docs.columns if keep is None else keep
    docs = docs.select(*keep, F.col(text_col).alias("_lang_text"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + \
        ", _lang_pred string, _lang_score double," \
        " _lang_spans array<struct<lang:string,start:int,end:int>>"
    span = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows_of(data, off):
        model = shared.value
        n = len(off) - 1
        if not model.names:
            return [UND] * n, [0.0] * n, [[]] * n
        pick, share, labels, first = label_rows(model, data, off, switch)
        spans = []
        for r in range(n):
            a, b = first[r], first[r + 1]
            if pick[r] < 0 or a == b:
                spans.append([])
                continue
            turn = np.flatnonzero(np.diff(labels[a:b])) + 1
            edge = [0, *turn.tolist(), int(b - a)]
            spans.append([{"lang": model.names[labels[a + x]], "start": x, "end": y}
                          for x, y in zip(edge, edge[1:])])
        return [model.names[i] if i >= 0 else UND for i in pick], share.tolist(), spans

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, off in text_slices(batch.column(len(keep))):
                pred, score, spans = rows_of(data, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(at, len(pred)) for i in range(len(keep))]
                    + [pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                       pa.array(spans, span)],
                    keep + ["_lang_pred", "_lang_score", "_lang_spans"])

    small_batches(docs.sparkSession)
    return docs.mapInArrow(
        tidied(label), schema)


def fitted(docs: DataFrame, held_of: int = 4, held: int = 2) -> LanguageModel:
    """The model learned from the rows whose crc32(doc_id) does not leave
    ``held`` modulo ``held_of``."""
    return train(docs.filter(~bucket_of(held, held_of, F.col("doc_id"))))


def language_report(docs: DataFrame, held_of: int = 4, held: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, spans."""
    model = fitted(docs, held_of, held)
    d = docs.select("doc_id", bucket_of(held, held_of, F.col("doc_id")).alias("held_out"), "text")
    return identify(d, model, "text", ["doc_id", "held_out"]).select(
        "doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"),
        F.col("_lang_score").alias("score"), F.col("_lang_spans").alias("spans"))
