"""Repair of conversation structure at least cost.

The rows of a conversation stand in the order of their turns (nulls first; ties
by role, then by the SHA-256 of the text, which
also stands for the text wherever texts are compared). A row's first fault counts: blank (no
character but white space), duplicate (role and text seen earlier), truncated
(the last character but white space is none of ``.!?``). Edits: Keep 0; Rerole
to user or assistant 2; Delete 3, a must for blank and duplicate rows; Insert an
empty user or assistant row anywhere 2; a truncated row that stays adds 1. The
roles' initials of the repaired conversation match ``(s?(ua)+)?``, so four
states tell what may follow: nothing yet, after s, after u, after a. Of the
cheapest edits those whose initials (D, I, K, R) are ASCII-least are taken.

Square-root checkpointed dynamic programming, in two layers.

- A global sort gives every row a position; a piece is what a conversation has
  of one stretch of ``PIECE`` positions, one letter a row. So a conversation of
  any length falls into pieces of bounded size, dealt out over the cluster.
- A piece's effect on the four costs to go is a 4 x 4 matrix (smallest sums).
  A pass over the matrices of a conversation, last piece first, leaves the
  vector of costs behind every piece: the outer checkpoints.
- Each piece stores its own backward vectors at every square root of its rows,
  recomputes a block at a time while it walks forward, and emits the least
  letter of the tight edits (those whose cost plus cost to go is the cost here).
  It does so for every state that it can be entered in; a pass over the pieces,
  first one first, picks the walk that the one before it leads to.

Passes over pieces hold one row at a time, sorted inside their partition; a
conversation has one row in them for ``PIECE`` of its own. Duplicates are found
by a grouped minimum of positions, not by a window over equal rows. Texts leave
the scan twice, as a fixed-size row of features and, once, to their place in the
result.

Defined results: a null role or text is one space (so such a row has no legal
initial, and a null text is blank); roles go by their first character, an empty
role has none that is legal; a null conv_id is a conversation of its own; rows
repeated in full are duplicates; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardspark.llm.common import small_batches, written
from cardspark.operators.keys import global_position

PIECE = 4096
SPACE = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
BATCH_PIECES = 500

# A row's letter: its role (s, u, a, another) and, within that, its state.
ROLES = "sua"
SOUND, CUT, TWICE, BLANK = range(4)
LETTERS = "ABCDEFGHIJKLMNOP"
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # after the user or assistant row due
_DUE = ("user", "user", "assistant", "user")
_BEYOND = 1 << 60

Costs = tuple[int, int, int, int]


def _with_inserts(b: list[int]) -> Costs:
    """Costs to go once rows may be inserted first. More than two in a row
    lead back to a state."""
    u = min(b[AFTER_U], INSERT + b[AFTER_A])
    a = min(b[AFTER_A], INSERT + b[AFTER_U])
    return min(b[START], INSERT + u), min(b[AFTER_S], INSERT + u), u, a


# A conversation may end before it has begun or after an assistant's row.
END = _with_inserts([0, _BEYOND, _BEYOND, 0])


def _edits(letter: str) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a row: initial, state after, cost."""
    role, state = divmod(LETTERS.index(letter), 4)
    out = []
    for s in range(4):
        edits = [("D", s, DELETE)]
        if state in (SOUND, CUT):
            more = TRUNCATED if state == CUT else 0
            if role == 0 and s == START:
                edits.append(("K", AFTER_S, more))
            elif role < 3 and role and _DUE[s][0] == ROLES[role]:
                edits.append(("K", _NEXT[s], more))
            edits.append(("R", _NEXT[s], REROLE + more))
        out.append(edits)
    return out


EDITS = {letter: _edits(letter) for letter in LETTERS}


def before(letter: str, after: Costs) -> Costs:
    """Costs to go before a row, from those after it."""
    return _with_inserts([min([cost + after[to] for _, to, cost in edits])
                          for edits in EDITS[letter]])


def matrix(letters: str) -> list[int]:
    """Row by row: the least cost from a state before the rows to one after."""
    columns = []
    for to in range(4):
        costs = tuple(0 if s == to else _BEYOND for s in range(4))
        for letter in reversed(letters):
            costs = before(letter, costs)
        columns.append(costs)
    return [min(columns[to][s], _BEYOND) for s in range(4) for to in range(4)]


def through(m: list[int], after: Costs) -> Costs:
    """Costs to go before a piece of matrix ``m``."""
    return tuple(min(m[4 * s + to] + after[to] for to in range(4)) for s in range(4))


def walk(letters: str, after: Costs, states: list[int], last: bool) -> dict[int, tuple[str, int]]:
    """For each entering state the initials of the ASCII-least tight edits and
    the state left in. ``last``: the conversation ends here, so rows that its
    end lacks are inserted."""
    n = len(letters)
    step = max(1, isqrt(n))
    marks, costs = {n: after}, after
    for i in range(n - 1, -1, -1):
        costs = before(letters[i], costs)
        if i % step == 0:
            marks[i] = costs
    now = {s: s for s in states}
    audit: dict[int, list[str]] = {s: [] for s in states}
    for start in range(0, n, step):
        stop = min(start + step, n)
        block = [marks[stop]]
        for i in range(stop - 1, start - 1, -1):
            block.append(before(letters[i], block[-1]))
        block.reverse()
        for entered, out in audit.items():
            s = now[entered]
            for i in range(start, stop):
                here, there = block[i - start], block[i - start + 1]
                edits = EDITS[letters[i]]
                while True:
                    initial, to, cost = edits[s][0]
                    if here[s] != cost + there[to]:
                        if here[s] == INSERT + here[_NEXT[s]]:
                            out.append("I")
                            s = _NEXT[s]
                            continue
                        initial, to, cost = next(e for e in edits[s][1:]
                                                 if here[s] == e[2] + there[e[1]])
                    out.append(initial)
                    s = to
                    break
            now[entered] = s
    for entered, out in audit.items():
        while last and END[now[entered]]:
            out.append("I")
            now[entered] = _NEXT[now[entered]]
    return {s: ("".join(out), now[s]) for s, out in audit.items()}


def lines(letters: str, audit: str, state: int) -> Iterator[tuple[int, int, str | None]]:
    """The rows of the repaired piece: place of the row that the line comes from
    or stands before (inserted ones at the end: the last row), a running number,
    and its role (None: the row's own), with 'I' in front if inserted."""
    i = 0
    for k, initial in enumerate(audit):
        if initial == "I":
            yield min(i, len(letters) - 1), k, "I" + _DUE[state]
            state = _NEXT[state]
            continue
        if initial == "R":
            yield i, k, _DUE[state]
            state = _NEXT[state]
        elif initial == "K":
            yield i, k, None
            state = AFTER_S if LETTERS.index(letters[i]) < 4 else _NEXT[state]
        i += 1


def illegal_pairs(letters: str, earlier: str) -> int:
    """Neighbours other than su, ua, au; ``earlier``: the letter before, or none."""
    roles = [LETTERS.index(x) // 4 for x in earlier + letters]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(roles, roles[1:]))


# ----------------------------------------------------------------- on Spark

def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH_PIECES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _map_rows(df: DataFrame, task, schema: str) -> DataFrame:
    """Rows to rows, a partition at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(lambda batches: _batched(task(_rows(batches)), arrow), schema)


def _backward(rows: Iterator[dict]) -> Iterator[dict]:
    """Pieces of conversations, last ones first: the costs behind each."""
    held = None
    costs = END
    for row in rows:
        if held is not None:
            yield held | {"first": held["conv_id"] != row["conv_id"]}
        last = held is None or held["conv_id"] != row["conv_id"]
        after = END if last else costs
        costs = through(row.pop("matrix"), after)
        held = row | {"after": list(after), "last": last, "cost": costs[START]}
    if held is not None:
        yield held | {"first": True}


def _walks(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        found = walk(row["letters"], tuple(row.pop("after")),
                     [START] if row["first"] else [START, AFTER_S, AFTER_U, AFTER_A], row.pop("last"))
        yield row | {"audits": [found.get(s, (None, None))[0] for s in range(4)],
                     "exits": [found.get(s, (None, None))[1] for s in range(4)]}


def _forward(rows: Iterator[dict]) -> Iterator[dict]:
    """Pieces of conversations, first ones first: the walk taken."""
    state, earlier = START, ""
    for row in rows:
        if row["first"]:
            state, earlier = START, ""
        yield {"conv_id": row["conv_id"], "piece": row["piece"], "place": row["place"],
               "letters": row["letters"], "state": state, "audit": row["audits"][state],
               "illegal": illegal_pairs(row["letters"], earlier),
               "cost": row["cost"] if row["first"] else None}
        state, earlier = row["exits"][state], row["letters"][-1]


def _all_lines(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        for i, k, role in lines(row["letters"], row["audit"], row["state"]):
            inserted = role is not None and role[0] == "I"
            yield {"conv_id": row["conv_id"], "pos": row["place"] + i,
                   "line": (row["piece"] << 32) + k, "inserted": inserted,
                   "new_role": role[1:] if inserted else role}


def _text_features(rows: DataFrame) -> DataFrame:
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))
    trimmed = F.rtrim("text", F.lit(SPACE))
    return rows.select("*", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                       (trimmed == "").alias("blank"),
                       (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"))


class Repair:
    """The repair of ``rows`` (conv_id, turn, role, text): ``report()``, one row
    a conversation, and ``repaired()``, the rows that it leaves."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        small_batches(spark, BATCH_PIECES)
        self.kind = rows.schema["conv_id"].dataType.simpleString()
        self.rows = _text_features(rows)
        order = ["conv_id", "turn", "role", "digest"]
        # rows alike in all of these are parted by a running number, so that
        # they need not meet in one task
        placed = global_position(self.rows.drop("text").withColumn("no", F.monotonically_increasing_id()),
                                 [*order, "no"], "pos", start=0)
        self.places = written(placed.drop("no"), "conversation_rows")
        self.pieces = written(self._repaired_pieces(), "conversation_pieces")

    def _repaired_pieces(self) -> DataFrame:
        first = self.places.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")) \
            .select("pos", F.lit(True).alias("seen_first"))
        p = self.places.join(first, "pos", "left")
        state = F.when(F.col("blank"), BLANK).when(F.col("seen_first").isNull(), TWICE) \
            .when(F.col("cut"), CUT).otherwise(SOUND)
        initial = F.left("role", F.lit(1))
        role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        p = p.select("conv_id", "pos", state.alias("state"),
                     F.substring(F.lit(LETTERS), 4 * role + state + 1, F.lit(1)).alias("letter"),
                     F.expr(f"pos div {PIECE}").alias("piece"))
        pieces = p.groupBy("conv_id", "piece").agg(
            F.min("pos").alias("place"),
            F.expr("array_join(transform(array_sort(collect_list(struct(pos, letter))), "
                   "x -> x.letter), '')").alias("letters"))
        key = f"conv_id {self.kind}, piece long, place long, letters string"
        with_matrix = _map_rows(
            pieces, lambda rows: (r | {"matrix": matrix(r["letters"])} for r in rows),
            f"{key}, matrix array<long>")
        behind = _map_rows(
            with_matrix.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece")),
            _backward, f"{key}, after array<long>, last boolean, cost long, first boolean")
        walked = _map_rows(
            behind.repartition("conv_id", "piece"), _walks,
            f"{key}, cost long, first boolean, audits array<string>, exits array<int>")
        return _map_rows(
            walked.repartition("conv_id").sortWithinPartitions("conv_id", "piece"), _forward,
            f"{key}, state int, audit string, illegal long, cost long")

    def report(self) -> DataFrame:
        """Per conversation: gaps (turns missing between the least and the
        greatest), blank, duplicate and truncated rows, illegal neighbours, cost
        and audit (the edits' initials)."""
        def letters_of(state: int) -> Column:
            return F.sum(F.length("letters") - F.length(F.translate(
                "letters", LETTERS[state::4], ""))).alias(f"n{state}")
        found = self.pieces.groupBy("conv_id").agg(
            *map(letters_of, (BLANK, TWICE, CUT)), F.sum("illegal").alias("illegal"),
            F.sum("cost").alias("cost"),
            F.expr("array_join(transform(array_sort(collect_list(struct(piece, audit))), "
                   "x -> x.audit), '')").alias("audit"))
        turns = self.places.filter("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")) \
            .groupBy("conv_id").agg((F.max("turn").cast("decimal(20,0)") - F.min("turn") + 1
                                     - F.count("one")).cast("long").alias("gaps"))
        # one more grouping in place of joins: every part has its own columns
        parts = found.unionByName(turns, allowMissingColumns=True)
        counts = {"gaps": "gaps", "blank": f"n{BLANK}", "duplicate": f"n{TWICE}",
                  "truncated": f"n{CUT}", "illegal": "illegal", "cost": "cost"}
        return parts.groupBy("conv_id").agg(
            *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(name) for name, c in counts.items()],
            F.coalesce(F.max("audit"), F.lit("")).alias("audit"))

    def repaired(self, together: bool = False) -> DataFrame:
        """The rows left, in the order of (pos, line) within conv_id: conv_id,
        pos, line, role, text. ``together``: all rows of a conversation in one
        partition, in that order."""
        made = _map_rows(self.pieces, _all_lines, f"conv_id {self.kind}, pos long, line long, "
                                                  "inserted boolean, new_role string")
        kept = made.filter("NOT inserted").join(self.places.select("pos", "role", "digest"), "pos") \
            .select("conv_id", "role", "digest", F.lit(0).alias("kind"), "pos", "line",
                    F.coalesce("new_role", "role").alias("now"), F.lit(None).cast("string").alias("text"))
        new = made.filter("inserted").select(
            "conv_id", "new_role", F.lit(None).cast("binary"), F.lit(2), "pos", "line", "new_role",
            F.lit(""))
        nothing = F.lit(None)
        texts = self.rows.filter("NOT blank").select(
            "conv_id", "role", "digest", F.lit(1), nothing.cast("long"), nothing.cast("long"),
            nothing.cast("string"), "text")
        # of rows alike only the first is kept, so a kept row's text is that of
        # any row alike: the one that the sort puts behind it
        alike = Window.partitionBy("conv_id", "role", "digest").orderBy("kind")
        all_ = kept.union(new).union(texts)
        if together:
            all_ = all_.repartition("conv_id")
        out = all_.withColumn("owner", F.lag(F.struct("kind", "pos", "line", "now")).over(alike)) \
            .filter("kind = 2 OR kind = 1 AND owner.kind = 0")
        taken = [F.when(F.col("kind") == 2, F.col(c)).otherwise(F.col("owner")[c]).alias(n)
                 for c, n in (("pos", "pos"), ("line", "line"), ("now", "role"))]
        out = out.select("conv_id", *taken, "text")
        return out.sortWithinPartitions("conv_id", "pos", "line") if together else out


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, with faults by crc32 of ``conv_id:turn``
    (nulls: one space) modulo 20: 0 drops a row, 1 empties its text, 2 takes the
    marks ``.!?`` out of it, 3 repeats it, 4 makes it the user's."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    role = F.when(k == 4, "user").otherwise(shown("role"))
    text = F.when(k == 1, "").when(k == 2, F.translate(shown("text"), ".!?", "")) \
        .otherwise(shown("text"))
    return rows.filter(k != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                      F.explode(F.expr(f"sequence(1, {_copies()})")).alias("no")).drop("no")


def _copies() -> str:
    key = "concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' '))"
    return f"CASE WHEN crc32({key}) % 20 = 3 THEN 2 ELSE 1 END"


def _digest(rows: Iterator[dict]) -> Iterator[dict]:
    now, sha = None, None
    for row in rows:
        if sha is None or row["conv_id"] != now:
            if sha is not None:
                yield {"conv_id": now, "repaired_sha256": sha.hexdigest()}
            now, sha = row["conv_id"], hashlib.sha256()
        else:
            sha.update(b"\n")
        sha.update(f"{row['role']}:{row['text']}".encode())
    if sha is not None:
        yield {"conv_id": now, "repaired_sha256": sha.hexdigest()}


def repair_report(rows: DataFrame) -> DataFrame:
    """What ``Repair`` finds and does in the damaged rows of every conversation
    of ``rows``, and the digest of its repaired ``role:text`` lines. A digest
    reads a conversation in its order, so its lines pass one task, in batches."""
    repair = Repair(damaged(rows))
    digest = _map_rows(repair.repaired(together=True), _digest,
                       f"conv_id {repair.kind}, repaired_sha256 string")
    every = rows.select("conv_id")
    parts = repair.report().unionByName(digest, allowMissingColumns=True) \
        .unionByName(every, allowMissingColumns=True)
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in longs],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest()))
        .alias("repaired_sha256"))
