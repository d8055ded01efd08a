"""Main text of HTML pages by a linear-chain conditional random field over the
DOM's leaf blocks.

A page becomes a sequence of leaf blocks. Each block has binary features of its
ancestors (tags, and what their class, id and role name) and of its text
(length, links, punctuation, place in the page). The model scores the two
labels of every block by its features and each pair of neighbouring labels; it
is trained by the gradient of the log-likelihood (forward-backward) on labelled
pages, and pages are decoded by Viterbi.

Labelled pages: ``labelled_pages`` lays out ``TRAIN_PAGES`` pages of invented
words in many layouts, with and without telling tags and names, and knows the
label of each block. No feature looks at a particular word, so what the words
are does not matter. ``train`` takes any labelled pages.

Training is a bounded computation of the driver; pages are decoded in tasks,
one at a time, and the model (a few hundred numbers) is broadcast.

Defined results: null or empty html, or a page without a main block: empty
text. Repeated rows are extracted each. An empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.llm.common import small_batches, tidied
from cardspark.llm.html_blocks import ANCESTORS, KEYS, Block, parse

TRAIN_PAGES = 800
EPOCHS = 250
RATE = 0.1
DECAY = 3e-4  # L2 on the weights

# Elements that name the part of a page.
PARTS = ("article", "main", "nav", "header", "footer", "aside", "form", "figure", "dialog")

_LENGTHS = (20, 50, 100, 200, 400, 1000)


def _features() -> dict[str, int]:
    names = ["bias"] + [f"in:{t}" for t in sorted(ANCESTORS)]
    names += [f"of:{t}" for t in sorted(ANCESTORS)] + ["of:none"]
    names += [f"key:{k}" for k in (*KEYS, "hidden")]
    # the innermost part and the innermost named group, which may lie in others
    names += [f"part:{t}" for t in (*PARTS, "none")] + [f"near:{k}" for k in (*KEYS, "none")]
    names += [f"chars:{i}" for i in range(len(_LENGTHS) + 1)]
    names += ["links:none", "links:some", "links:most", "links:all", "ends", "comma", "sentences",
              "sign", "digits", "title", "first", "last", "early", "late", "after_heading"]
    return {n: i for i, n in enumerate(names)}


FEATURES = _features()
_PATHS: dict[tuple, list[int]] = {}


def _of_path(path: tuple) -> list[int]:
    found = _PATHS.get(path)
    if found is None:
        names = {f"in:{t}" for t, _ in path if t in ANCESTORS}
        names |= {f"key:{k}" for _, keys in path for k in keys}
        near = [t for t, _ in path if t in ANCESTORS]
        names.add(f"of:{near[-1]}" if near else "of:none")
        parts = [t for t, _ in path if t in PARTS]
        names.add(f"part:{parts[-1]}" if parts else "part:none")
        groups = [[k for k in keys if k in KEYS] for _, keys in path]
        groups = [g for g in groups if g]
        names |= {f"near:{k}" for k in groups[-1]} if groups else {"near:none"}
        if len(_PATHS) > 50_000:
            _PATHS.clear()
        found = _PATHS[path] = [FEATURES[n] for n in names]
    return found


def block_features(title: str, blocks: list[Block]) -> list[list[int]]:
    """Indices of the active features of every block."""
    out = []
    n = len(blocks)
    heading = False
    f = FEATURES
    for i, b in enumerate(blocks):
        x = [0, *_of_path(b.path)]
        text = b.text
        size = len(text)
        x.append(f["chars:0"] + sum(size >= k for k in _LENGTHS))
        if not b.link_chars:
            x.append(f["links:none"])
        elif b.link_chars >= 0.95 * size:
            x.append(f["links:all"])
        else:
            x.append(f["links:most"] if 2 * b.link_chars >= size else f["links:some"])
        if text[-1] in ".!?…。！？":
            x.append(f["ends"])
        if "," in text:
            x.append(f["comma"])
        if text.count(". ") >= 2:
            x.append(f["sentences"])
        if any(c in text for c in "©®™|»"):
            x.append(f["sign"])
        if 3 * sum(map(text.count, "0123456789")) > size:
            x.append(f["digits"])
        if title and (text == title or (size > 10 and title.startswith(text))):
            x.append(f["title"])
        if i == 0:
            x.append(f["first"])
        if i == n - 1:
            x.append(f["last"])
        x.append(f["early"] if 2 * i < n else f["late"])
        if heading:
            x.append(f["after_heading"])
        heading = bool(b.path) and b.path[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6")
        out.append(x)
    return out


class Crf:
    """weights [feature] (of label 1 against 0), moves [from, to], starts [2]."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, starts: np.ndarray):
        self.weights, self.moves, self.starts = weights, moves, starts

    def decode(self, active: list[list[int]]) -> list[int]:
        """The most likely labels, by Viterbi."""
        if not active:
            return []
        w = self.weights.tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = self.starts.tolist()
        b += sum([w[i] for i in active[0]])
        back = []
        for x in active[1:]:
            score = sum([w[i] for i in x])
            from0, from1 = b + m10 > a + m00, b + m11 >= a + m01
            back.append((from0, from1))
            a, b = (b + m10 if from0 else a + m00), (b + m11 if from1 else a + m01) + score
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[str, list[Block], list[int]]], epochs: int = EPOCHS,
          rate: float = RATE, decay: float = DECAY) -> Crf:
    """Maximum likelihood by Adam over all pages at once, padded to the
    longest. ``pages``: (title, blocks, labels)."""
    pages = [p for p in pages if p[1]]
    n, longest, k = len(pages), max(len(p[1]) for p in pages), len(FEATURES)
    x = np.zeros((n, longest, k), np.float32)
    y = np.zeros((n, longest), np.int64)
    mask = np.zeros((n, longest))
    for i, (title, blocks, labels) in enumerate(pages):
        for t, active in enumerate(block_features(title, blocks)):
            x[i, t, active] = 1
        y[i, :len(labels)], mask[i, :len(labels)] = labels, 1
    flat = x.reshape(-1, k)
    pairs = mask[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][pairs > 0], y[:, 1:][pairs > 0]), 1)
    begun = np.bincount(y[:, 0], minlength=2)
    theta = np.zeros(k + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def lse(a, axis):
        top = a.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, epochs + 1):
        w, moves, starts = theta[:k], theta[k:k + 4].reshape(2, 2), theta[k + 4:]
        e = np.zeros((n, longest, 2))
        e[:, :, 1] = (flat @ w.astype(np.float32)).reshape(n, longest)
        alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        alpha[:, 0] = starts + e[:, 0]
        for t in range(1, longest):
            go = lse(alpha[:, t - 1, :, None] + moves, 1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None] > 0, go, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            go = lse(moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None] > 0, go, 0.0)
        z = lse(alpha[:, -1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * mask[:, :, None]
        joint = np.exp(alpha[:, :-1, :, None] + moves + (e[:, 1:] + beta[:, 1:])[:, :, None, :]
                       - z[:, None, None, None]) * pairs[:, :, None, None]
        grad = np.concatenate([
            flat.T @ ((y * mask) - p[:, :, 1]).reshape(-1).astype(np.float32),
            (seen - joint.sum(axis=(0, 1))).reshape(-1), begun - p[:, 0].sum(axis=0)]) / n
        grad -= decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Crf(theta[:k], theta[k:k + 4].reshape(2, 2), theta[k + 4:])


# ---------------------------------------------------------- labelled pages

class _Page:
    """Lays out one page; the label of each block is kept by its text, which
    carries a number of its own."""

    def __init__(self, rng: random.Random):
        self.rng, self.labels, self.count = rng, {}, 0

    def words(self, low: int, high: int) -> str:
        r = self.rng
        return " ".join("".join(r.choice("abdefghilmnoprstuvz") for _ in range(r.randint(2, 9)))
                        for _ in range(r.randint(low, high)))

    def prose(self, low: int = 1, high: int = 6) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            s = self.words(2, 18)
            if self.rng.random() < 0.4:
                s = s.replace(" ", ", ", 1)
            out.append(s.capitalize() + self.rng.choice("...!?"))
        return " ".join(out)

    def say(self, text: str, main: bool) -> str:
        self.count += 1
        text = f"q{self.count}q {text}"
        self.labels[self.count] = int(main)
        return text

    def name(self, group: str) -> str:
        r = self.rng
        word = r.choice(KEYS[group].split())
        style = r.random()
        if style < 0.15:
            return f' id="{word}"'
        if style < 0.3:
            return f' class="{word}-{r.choice(["box", "wrap", "inner", "area"])}"'
        return f' class="{word}"' if style < 0.85 else f' class="x{r.randint(1, 99)} {word}"'

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="#">{self.say(self.words(1, 3), False)}</a></li>'
                       for _ in range(n))

    def aside_of(self, kind: str, inside: bool = False) -> str:
        """A part that is not main text; inside the main part it has a telling
        name or tag."""
        r, no = self.rng, False
        bare = not inside and r.random() < 0.1

        def box(group: str, body: str, tag: str = "div") -> str:
            plain = bare or (tag == "aside" and r.random() < 0.6)  # the tag tells enough
            return f"<{tag}{'' if plain else self.name(group)}>{body}</{tag}>"

        def line() -> str:
            return r.choice([self.say(self.words(2, 8), no), self.say(self.prose(1, 3), no)])
        if kind == "menu":
            body = f"<ul>{self.links(r.randint(2, 8))}</ul>"
            return f"<nav>{body}</nav>" if r.random() < 0.6 else box("menu", body)
        if kind == "header":
            body = line() if r.random() < 0.7 else f"<h1>{self.say(self.words(1, 4), no)}</h1>"
            return f"<header>{body}</header>" if r.random() < 0.6 else box("header", body)
        if kind == "footer":
            body = r.choice(["", "&copy; "]) + line()
            if r.random() < 0.3:
                body = f"<p>{body}</p><ul>{self.links(r.randint(1, 4))}</ul>"
            return f"<footer>{body}</footer>" if r.random() < 0.7 else box("footer", body)
        if kind == "side":
            body = f"<h3>{self.say(self.words(1, 3), no)}</h3>" + r.choice([
                f"<p>{line()}</p>", f"<ul>{self.links(r.randint(2, 5))}</ul>"])
            return f"<aside>{body}</aside>" if r.random() < 0.6 else box("side", body)
        if kind == "comment":
            body = "".join(f"<{t}>{line()}</{t}>" for t in
                           r.choices(["p", "div", "li"], k=r.randint(1, 5)))
            if r.random() < 0.5:
                body = f"<h3>{self.say(self.words(1, 2), no)}</h3>" + body
            return box("comment", body, r.choice(["div", "section", "ul", "div"]))
        if kind == "form":
            return f"<form>{r.choice(['<label>', '<p>', ''])}{line()}<input name=a></form>" \
                if r.random() < 0.6 else box("form", f"<p>{line()}</p>")
        body = r.choice([line(), f"<p>{line()}</p>"])
        return box(kind, body, r.choice(["div", "div", "div", "section", "aside"]))

    def main(self) -> str:
        r = self.rng
        out = []
        if r.random() < 0.8:
            out.append(f"<h1>{self.say(self.words(2, 10), True)}</h1>")
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.72:
                opening = r.choice(["<p>", "<p>", "<p>", "<p><b>", "<div>", "<p><em>", ""])
                closing = "</div>" if opening == "<div>" else "<br><br>" if not opening else \
                    r.choice(["</p>", "</p>", "", "<br>"])
                short = self.words(1, 5).capitalize() + r.choice([".", ""])
                out.append(opening + self.say(self.prose() if r.random() < 0.8 else short, True)
                           + closing)
            elif kind < 0.8:
                out.append(f"<h2>{self.say(self.words(1, 6), True)}</h2>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{self.say(self.prose(1, 2), True)}</li>"
                                            for _ in range(r.randint(1, 4))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{self.say(self.prose(), True)}</blockquote>")
            elif kind < 0.96:
                out.append(f"<pre>{self.say(self.words(3, 20), True)}</pre>")
            else:
                out.append("<table><tr>" + "".join(f"<td>{self.say(self.words(1, 4), True)}</td>"
                                                   for _ in range(r.randint(1, 3))) + "</tr></table>")
        if r.random() < 0.2:
            cut = r.randint(0, len(out))
            out[cut:] = ["<section>" + "".join(out[cut:]) + "</section>"]
        for kind in ("ad", "related", "share", "comment", "side", "form", "notice", "meta"):
            if r.random() < 0.15:
                out.insert(r.randint(0, len(out)), self.aside_of(kind, inside=True))
        body = "".join(out)
        wrap = r.random()
        if wrap < 0.5:
            return f"<article>{body}</article>"
        if wrap < 0.65:
            return f"<main>{body}</main>"
        if wrap < 0.85:
            return f"<div{self.name('content')}>{body}</div>"
        return f"<div>{body}</div>" if wrap < 0.91 else body

    def lay_out(self) -> tuple[str, list[Block], list[int]]:
        r = self.rng
        before = [self.aside_of(k) for k in ("header", "menu", "notice", "ad", "form")
                  if r.random() < 0.45]
        main = self.main()
        after = [self.aside_of(k) for k in ("comment", "related", "side", "share", "form", "ad",
                                            "menu", "footer", "footer") if r.random() < 0.35]
        title, blocks = parse("<html><body>" + "".join(before) + main + "".join(after))
        labels = []
        for b in blocks:
            number, _, text = b.text.partition("q ")
            at = number.rfind("q") + 1
            labels.append(self.labels[int(number[at:])])
            b.text = text or "x"
        return title, blocks, labels


def labelled_pages(n: int = TRAIN_PAGES, seed: int = 1) -> list[tuple[str, list[Block], list[int]]]:
    """``n`` pages as (title, blocks, labels), the same for equal arguments."""
    rng = random.Random(seed)
    return [_Page(rng).lay_out() for _ in range(n)]


_TRAINED: dict[tuple, Crf] = {}


def trained(n: int = TRAIN_PAGES, seed: int = 1) -> Crf:
    if (n, seed) not in _TRAINED:
        _TRAINED[n, seed] = train(labelled_pages(n, seed))
    return _TRAINED[n, seed]


# --------------------------------------------------------------- extraction

def main_text(html: str, model: Crf) -> tuple[str, int, int]:
    """(text, blocks kept, blocks) of a page."""
    title, blocks = parse(html)
    labels = model.decode(block_features(title, blocks))
    kept = [b.text for b, label in zip(blocks, labels) if label]
    return "\n".join(kept), len(kept), len(blocks)


def extract(pages: DataFrame, model: Crf | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text,
    n_chars, n_blocks, n_main_blocks."""
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [main_text(h or "", model) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([len(f[0]) for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.int32()),
                 pa.array([f[1] for f in found], pa.int32())],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_main_blocks"])

    small_batches(pages.sparkSession, 500)
    return pages.select("page_id", F.col("url").cast("string"), "html").mapInArrow(
        tidied(run), f"page_id {kind}, url string, text string, n_chars long, n_blocks int,"
             " n_main_blocks int")
