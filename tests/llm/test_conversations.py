import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardspark.llm import conversations as C
from cardspark.llm.conversations import LETTERS, Repair, damaged, repair_report, walk

COLS = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def every_repair(letters):
    """Cheapest edits by enumeration: all choices for rows, up to two inserts a gap."""
    gaps = ["", "u", "a", "ua", "au"]
    best = None
    for put in product(gaps, repeat=len(letters) + 1):
        for edits in product("DKRr", repeat=len(letters)):
            roles, audit, cost = put[0], "I" * len(put[0]), 2 * len(put[0])
            for letter, edit, more in zip(letters, edits, put[1:]):
                role, state = divmod(LETTERS.index(letter), 4)
                if edit == "D":
                    cost += 3
                elif state >= C.TWICE or edit == "K" and role == 3:
                    break
                else:
                    cost += (edit != "K") * 2 + (state == C.CUT)
                    roles += {"K": "suax"[role], "R": "u", "r": "a"}[edit]
                audit += edit.upper() + "I" * len(more)
                roles += more
                cost += 2 * len(more)
            else:
                if LEGAL.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def by_recursion(letters):
    """The same by plain recursion over (rows left, what may follow)."""
    @lru_cache(None)
    def least(i, s, inserted):
        found = [(0, "")] if i == len(letters) and s in (0, 3) else []
        due = 3 if s == 2 else 2
        if inserted < 2:
            c, a = least(i, due, inserted + 1)
            found.append((c + 2, "I" + a))
        if i < len(letters):
            role, state = divmod(LETTERS.index(letters[i]), 4)
            c, a = least(i + 1, s, 0)
            found.append((c + 3, "D" + a))
            if state < C.TWICE:
                c, a = least(i + 1, due, 0)
                found.append((c + 2 + (state == C.CUT), "R" + a))
                to = {0: {0: 1, 1: 2}, 1: {1: 2}, 2: {2: 3}, 3: {1: 2}}[s].get(role)
                if to is not None:
                    c, a = least(i + 1, to, 0)
                    found.append((c + (state == C.CUT), "K" + a))
        return min(found, default=(1 << 40, ""))
    return least(0, 0, 0)


def whole(letters):
    audit, state = walk(letters, C.END, [C.START], True)[C.START]
    costs = C.END
    for x in reversed(letters):
        costs = C.before(x, costs)
    return costs[C.START], audit


@pytest.mark.parametrize("n", [0, 1, 2])
def test_equal_to_all_edits(n):
    for letters in product(LETTERS, repeat=n):
        assert whole("".join(letters)) == every_repair(letters)


def test_equal_to_all_edits_of_three_rows():
    rng = random.Random(4)
    for _ in range(12):
        letters = [rng.choice(LETTERS) for _ in range(3)]
        assert whole("".join(letters)) == every_repair(letters)


@given(st.text(alphabet=LETTERS, max_size=40))
@settings(max_examples=300, deadline=None)
def test_equal_to_recursion(letters):
    assert whole(letters) == by_recursion(letters)


@given(st.text(alphabet=LETTERS, min_size=1, max_size=40), st.integers(1, 7))
@settings(max_examples=200, deadline=None)
def test_pieces_are_the_whole(letters, size):
    parts = [letters[i:i + size] for i in range(0, len(letters), size)]
    behind, costs = [], C.END
    for p in reversed(parts):
        behind.append(costs)
        costs = C.through(C.matrix(p), costs)
    state, audit = C.START, ""
    for k, (p, after) in enumerate(zip(parts, reversed(behind))):
        out, state = walk(p, after, [0, 1, 2, 3], k == len(parts) - 1)[state]
        audit += out
    assert (costs[C.START], audit) == whole(letters)


@given(st.text(alphabet=LETTERS, min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_lines_are_legal(letters):
    audit = whole(letters)[1]
    initials = ""
    for i, _, role in C.lines(letters, audit, C.START):
        initials += role.lstrip("I")[0] if role else "suax"[LETTERS.index(letters[i]) // 4]
    assert LEGAL.fullmatch(initials)


def expected(rows):
    """The contract row by row."""
    convs = {}
    for conv, turn, role, text in rows:
        got = convs.setdefault(conv, [])
        name = lambda x: " " if x is None else str(x)
        k = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        got += [(turn, role, text)] * {0: 0, 3: 2}.get(k, 1)
    out = []
    for conv, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, letters, counts = set(), "", [0, 0, 0, 0]
        for turn, role, text in got:
            t = text.strip(C.SPACE)
            state = C.BLANK if not t else C.TWICE if (role, text) in seen else \
                C.CUT if t[-1] not in ".!?" else C.SOUND
            seen.add((role, text))
            counts[state] += 1
            letters += LETTERS[4 * max("suax".find(role[:1] or "x"), 3 * (role[:1] not in tuple("sua"))) + state]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(got, got[1:])]
        turns = [t for t, _, _ in got if t is not None]
        cost, audit = by_recursion(letters)
        repaired, state = [], 0
        i = 0
        for e in audit:
            due = "assistant" if state == 2 else "user"
            if e == "I":
                repaired.append(due + ":")
            elif e != "D":
                repaired.append((due if e == "R" else got[i][1]) + ":" + got[i][2])
            if e == "K" and got[i][1][0] == "s":
                state = 1
            elif e != "D":
                state = 3 if state == 2 else 2
            i += e != "I"
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    counts[C.BLANK], counts[C.TWICE], counts[C.CUT],
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return out


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
         "repaired_sha256"]


def check(docs):
    rows = [tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in repair_report(docs).select(*NAMES).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(rows)))
    return got


@pytest.fixture(scope="module")
def messy_rows(spark):
    rng = random.Random(11)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "s", "ab"]
    texts = ["a b.", "c?", "d", " \t\n\x0b\x0c\r", "", None, "é ß!", "long " * 5000 + "x. ", "e.\n", "f .", "g"]
    rows = [(rng.choice([1, 2, 3, None, *range(10, 40)]), rng.choice([None, *range(9)]),
             rng.choice(roles), rng.choice(texts)) for _ in range(500)]
    rows += rows[:20]
    # a conversation of one row that the damage drops
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "x.")]
    return rows


@pytest.mark.parametrize("piece", [4096, 3])
def test_messy(spark, messy_rows, piece, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(C, "PIECE", piece)
    docs = spark.createDataFrame(messy_rows, COLS)
    for c in ["pos", "piece", "letters", "kind", "line", "audit", "no", "digest", "owner"]:
        docs = docs.withColumn(c, F.lit("x"))
    got = check(docs)
    assert any(r[2:] == (0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for r in got)


def test_hot_conversation(spark, monkeypatch):
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)  # of the plain recursion
    monkeypatch.setattr(C, "PIECE", 64)
    rng = random.Random(12)
    rows = [(7, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice("abcdefgh") * rng.randint(1, 9) + rng.choice(".!x"))
            for t in range(700)] + [(8, None, "user", "same.")] * 300
    try:
        check(spark.createDataFrame(rows, COLS))
    finally:
        sys.setrecursionlimit(limit)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "hi."), (1, 1, "user", "again"), (1, 2, "assistant", "yes."), (1, 3, "assistant", "yes.")]
    r = Repair(spark.createDataFrame(rows, COLS))
    got = [tuple(x) for x in r.repaired().orderBy("conv_id", "pos", "line").select("role", "text").collect()]
    assert got == [("user", "hi."), ("assistant", "yes.")]
    assert r.report().collect()[0]["audit"] == "KDKD"
    assert sorted(map(tuple, r.repaired(together=True).select("role", "text").collect())) == sorted(got)


def test_damage(spark):
    rows = [(i, 0, "assistant", "a. b!") for i in range(200)]
    got = {}
    for r in damaged(spark.createDataFrame(rows, COLS)).collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for i in range(200):
        k = zlib.crc32(f"{i}:0".encode()) % 20
        want = {0: [], 1: [("assistant", "")], 2: [("assistant", "a b")], 3: [("assistant", "a. b!")] * 2,
                4: [("user", "a. b!")]}.get(k, [("assistant", "a. b!")])
        assert got.get(i, []) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], COLS)
    assert check(docs) == []
    assert Repair(docs).repaired().count() == 0
