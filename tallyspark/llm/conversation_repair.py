"""Repair of the turn structure of conversations at least cost, by depth-first branch and bound.

A conversation should read: at most one system turn, then user and assistant in turn,
ending with the assistant (or nothing at all).  Every turn is kept (free), given the other
role (3) or deleted (4, a must for blank and repeated turns); turns without text may be
put in (3); a turn that breaks off costs 3 unless it is deleted.  Of all cheapest repairs
the one whose edit initials (K, R, D, I in order) come first in ASCII is taken.

1. Equal rows of a conversation become one row with their number, so a row repeated
   without end is one row; the first of equal messages is found by an aggregate.
2. Rows are dealt by ranges of (conversation, turn, role, text), so that a conversation with
   a third of all rows is spread over many tasks, and each task cuts what it reads into
   blocks of ``BLOCK`` turns that may stay.  A search per block (``search``) finds the cheapest
   edits between each two states of the pattern that may matter there: those of a
   block which is a whole conversation from the start to the end alone.
3. Blocks are joined in order: the cheapest way to each state, with where it came from.
4. The chosen edits go back to the blocks, become lines there, get their texts by a join
   and are hashed in order; that holds one batch of lines at a time.

No forced deletion enters a search: it changes no state, and as ``D`` comes before ``I`` it
stands before the insertions at its place.

Defined cases: nulls count as one space (a null id names a conversation of its own); rows of one turn come by role, the
first 64 characters of their text and its MD5; roles are told by their first character, and one that is none of
``s``, ``u``, ``a`` (an empty one too) can't be kept; a conversation without rows left after the damage, or with
all rows deleted, has an empty repaired form; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, written

RESET, DELETE, INSERT, BROKEN_OFF = 3, 4, 3, 3
#: Turns that may stay, in one search.
BLOCK = 16
#: Patterns of turns whose edits a worker remembers.
REMEMBERED = 20_000

# States of the pattern: nothing yet, after the system turn, after a user turn, after an assistant turn; and the end.
START, SYSTEM, USER, ASSISTANT, END = range(5)
_ASKS = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # what an insertion or a new role gives
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_LEGAL = {"su", "ua", "au"}
_NAMES = {"u": "user", "a": "assistant"}


def _bounds(turns: str, goal: int) -> list[dict[int, int]]:
    """For each place and state the least that the edits of the rest can cost.

    Each row pays its own least price.  User and assistant turns must also be equal in
    number: a new role changes their difference by two, an insertion or deletion by one,
    while rows that pay anyway (other roles, broken off) may be worth one each.
    """
    out = []
    own = systems = free = surplus = 0
    for place in range(len(turns), -1, -1):
        if place < len(turns):
            kind = turns[place]
            low, cut = kind.lower(), kind.isupper()
            if low in "ua":
                own += BROKEN_OFF if cut else 0
                free += cut
                surplus += 1 if low == "u" else -1
            else:
                own += min(RESET + BROKEN_OFF * cut, DELETE)
                free += 1
                systems += low == "s"
        at = {}
        for state in range(4):
            wanted = (goal == USER) - (state == USER)
            apart = max(0, abs(surplus - wanted) - free)
            spared = RESET if state == START and systems else 0
            at[state] = max(0, own - spared) + RESET * -(-apart // 2)
        out.append(at)
    return out[::-1]


def search(turns: str, entry: int, goal: int) -> tuple[int, str] | None:
    """Cheapest edits of ``turns`` from state ``entry`` to ``goal``, and their cost; None if there are none.

    ``turns`` has one letter a row: its role's (``x`` for others), a capital one if it
    breaks off.  Depth first with a stack of its own; a branch ends where its cost and the
    rest's bound exceed the incumbent's, or meet it with later letters, and where its
    place and state were reached before at no higher cost by no later letters.
    """
    bound = _bounds(turns, goal)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        place, state, cost, edits = stack.pop()
        if best is not None:
            least = cost + bound[place][state]
            if least > best[0] or (least == best[0] and edits > best[1][:len(edits)]):
                continue
        seen = reached.get((place, state))
        if seen is not None and seen <= (cost, edits):
            continue
        reached[place, state] = cost, edits
        if place == len(turns):
            if goal == END:
                done = cost + INSERT * len(_CLOSING[state]), edits + _CLOSING[state]
            elif state == goal:
                done = cost, edits
            else:
                continue
            if best is None or done < best:
                best = done
            continue
        kind = turns[place]
        low, extra = kind.lower(), BROKEN_OFF if kind.isupper() else 0
        asks, after = _ASKS[state], _NEXT[state]
        ways = [(place + 1, state, cost + DELETE, edits + "D"), (place, after, cost + INSERT, edits + "I")]
        if low == asks:
            ways.append((place + 1, after, cost + extra, edits + "K"))
        else:
            ways.append((place + 1, after, cost + RESET + extra, edits + "R"))
            if low == "s" and state == START:
                ways.append((place + 1, SYSTEM, cost + extra, edits + "K"))
        ways.sort(key=lambda w: (w[2] + bound[w[0]][w[1]], w[3]), reverse=True)
        stack += ways
    return best


_remembered = lru_cache(REMEMBERED)(search)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """The rows after the damage, with ``copies`` 2 where a row is repeated (it is not written out twice)."""
    space = F.lit(" ")
    name, at = rows[conv].cast("string"), rows[turn].cast("long")
    fault = F.crc32(F.concat(F.coalesce(name, space), F.lit(":"), F.coalesce(at.cast("string"), space))
                    .cast("binary")) % 20
    said = F.coalesce(rows[text].cast("string"), space)
    return rows.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("conv"), at.isNotNull().alias("dated"),
        F.coalesce(at, F.lit(0)).alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(F.coalesce(rows[role].cast("string"), space)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        fault.alias("fault")).where("fault <> 0").withColumn(
        "copies", F.when(F.col("fault") == 3, 2).otherwise(1).cast("long")).drop("fault")


def _digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def turn_rows(after: DataFrame) -> DataFrame:
    """Distinct rows without their texts: what is wrong with each, how often it comes, and if it is the first of its kind."""
    end = F.rtrim("text", F.lit(WHITE))
    rows = (after.select("conv", "dated", "turn", "role", F.substring("text", 1, 64).alias("head"),
                         _digest(F.col("text")).alias("digest"), (end == "").alias("blank"),
                         (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"), "copies")
            .groupBy("conv", "dated", "turn", "role", "head", "digest", "blank", "cut")
            .agg(F.sum("copies").alias("n")))
    rows = written(rows, "turns")
    first = (rows.groupBy("conv", "role", "digest").agg(F.min(F.struct("dated", "turn")).alias("t"))
             .select("conv", "role", "digest", F.col("t.dated").alias("dated"), F.col("t.turn").alias("turn"),
                     F.lit(True).alias("first")))
    return rows.join(first, ["conv", "role", "digest", "dated", "turn"], "left").withColumn(
        "first", F.coalesce("first", F.lit(False)))


_BLOCKS = """conv string, part int, seq long, live string, before array<long>, tail long, blank long, duplicate long,
truncated long, illegal long, opens string, closes string, low long, high long, turns long, first_turn long,
last_turn long, at_turn array<long>, at_dated array<boolean>, at_role array<string>, at_digest array<string>,
ways array<struct<entry:int,goal:int,cost:long,edits:string>>"""


class _Block:
    def __init__(self, conv, seq, first):
        self.conv, self.seq, self.first = conv, seq, first
        self.live, self.before, self.tail = [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.opens = self.closes = self.first_turn = self.last_turn = self.low = self.high = None
        self.keys = []

    def add(self, dated, turn, role, digest, blank, cut, n, first):
        initial = role[:1]
        if self.opens is None:
            self.opens = initial
        else:
            self.illegal += self.closes + initial not in _LEGAL
        self.illegal += n - 1
        self.closes = initial
        if dated:
            if self.low is None:
                self.low = self.first_turn = turn
            self.turns += turn != self.last_turn
            self.high = self.last_turn = turn
        if blank:
            self.blank += n
            self.tail += n
            return
        stays = 1 if first else 0
        if stays:
            self.truncated += cut
            kind = initial if initial and initial in "sua" else "x"
            self.live.append(kind.upper() if cut else kind)
            self.before.append(self.tail)
            self.tail = 0
            self.keys.append((turn, dated, role, digest))
        self.duplicate += n - stays
        self.tail += n - stays

    def row(self, part, last):
        live = "".join(self.live)
        ways = []
        for entry in (START,) if self.first else range(4):
            for goal in (END,) if last else range(4):
                way = _remembered(live, entry, goal)
                if way is not None:
                    ways.append({"entry": entry, "goal": goal, "cost": way[0], "edits": way[1]})
        at = [list(c) for c in zip(*self.keys)] if self.keys else [[], [], [], []]
        return (self.conv, part, self.seq, live, self.before, self.tail, self.blank, self.duplicate, self.truncated,
                self.illegal, self.opens, self.closes, self.low, self.high, self.turns, self.first_turn,
                self.last_turn, *at, ways)


def _frame(rows: list, schema: str) -> pd.DataFrame:
    """Rows with whole numbers that may be missing."""
    names = [c.split()[0] for c in schema.replace("\n", " ").split(", ")]
    made = pd.DataFrame(rows, columns=names, dtype="object")
    return made


def _blocks(frames):
    part = TaskContext.get().partitionId()
    block, out = None, []
    for frame in frames:
        for conv, dated, turn, role, digest, blank, cut, n, first in zip(*(frame[c].tolist() for c in (
                "conv", "dated", "turn", "role", "digest", "blank", "cut", "n", "first"))):
            if block is not None and conv != block.conv:
                out.append(block.row(part, True))
                block = _Block(conv, 0, True)
            elif block is None:
                block = _Block(conv, 0, False)  # an earlier task may hold rows of it
            elif len(block.live) == BLOCK:
                out.append(block.row(part, False))
                block = _Block(conv, block.seq + 1, False)
            block.add(dated, turn, role, digest, blank, cut, n, first)
        if len(out) >= 1000:
            yield _frame(out, _BLOCKS)
            out = []
    if block is not None:
        out.append(block.row(part, False))  # a later task may hold rows of it
    yield _frame(out, _BLOCKS)


_CHOSEN = """conv string, part int, seq long, entry int, edits string, gaps long, blank long, duplicate long,
truncated long, illegal long, cost long, audit string"""


def _woven(edits: str, before, tail: int) -> str:
    """The edits with the forced deletions: those before a turn come before the insertions there."""
    out, at = [], 0
    for n in before:
        end = at
        while edits[end] == "I":
            end += 1
        out += "D" * int(n), edits[at:end + 1]
        at = end + 1
    return "".join(out) + "D" * int(tail) + edits[at:]


class _Joined:
    """The blocks of one conversation in order: cheapest ways to each state, and where they came from."""

    def __init__(self, conv):
        self.conv = conv
        self.states = {START: (0, 0)}  # cost, place among the edits so far (no two of them are equal)
        self.blocks = []
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.closes = self.last_turn = self.low = self.high = None
        self.ended = False

    def add(self, row: dict):
        for name in self.sums:
            self.sums[name] += int(row[name])
        if self.closes is not None:
            self.sums["illegal"] += self.closes + row["opens"] not in _LEGAL
        self.closes = row["closes"]
        if not pd.isna(row["low"]):
            self.sums["turns"] -= self.last_turn is not None and row["first_turn"] == self.last_turn
            self.low = row["low"] if self.low is None else self.low
            self.high = self.last_turn = row["high"]
        best = {}
        for way in row["ways"]:
            if way["entry"] in self.states:
                cost, rank = self.states[way["entry"]]
                found = cost + way["cost"], rank, way["edits"], way["entry"]
                if way["goal"] not in best or found < best[way["goal"]]:
                    best[way["goal"]] = found
        ranks = {k: r for r, k in enumerate(sorted(best, key=lambda g: best[g][1:3]))}
        self.states = {g: (best[g][0], ranks[g]) for g in best}
        self.blocks.append((row["part"], row["seq"], row["before"], row["tail"],
                            {g: (b[3], b[2]) for g, b in best.items()}))
        self.ended = END in best

    def rows(self):
        if not self.ended:
            end = {g: (c + INSERT * len(_CLOSING[g]), r) for g, (c, r) in self.states.items()}
            goal = min(end, key=end.get)
            cost, closing = end[goal][0], _CLOSING[goal]
        else:
            goal, cost, closing = END, self.states[END][0], ""
        out, audit = [], [closing]
        for part, seq, before, tail, came in reversed(self.blocks):
            goal, edits = came[goal]
            audit.append(_woven(edits, before, tail))
            out.append((self.conv, part, seq, goal, edits + closing) + (None,) * 7)
            closing = ""
        s = self.sums
        gaps = 0 if self.low is None else self.high - self.low + 1 - s["turns"]
        forced = DELETE * (s["blank"] + s["duplicate"])
        out.append((self.conv, None, None, None, None, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"],
                    cost + forced, "".join(reversed(audit))))
        return out


def _join_blocks(frames):
    current, out = None, []
    for frame in frames:
        names = list(frame.columns)
        for values in zip(*(frame[c].tolist() for c in names)):
            row = dict(zip(names, values))
            if current is None or current.conv != row["conv"]:
                if current is not None:
                    out += current.rows()
                current = _Joined(row["conv"])
            current.add(row)
        if len(out) >= 1000:
            yield _frame(out, _CHOSEN)
            out = []
    if current is not None:
        out += current.rows()
    yield _frame(out, _CHOSEN)


_LINES = "conv string, part int, seq long, idx int, dated boolean, turn long, role string, digest string, said string"


def _lines(frames):
    for frame in frames:
        out = []
        for row in frame.to_dict("records"):
            state, at, keys = row["entry"], 0, list(zip(row["at_dated"], row["at_turn"], row["at_role"],
                                                        row["at_digest"]))
            for idx, edit in enumerate(row["edits"]):
                place = row["conv"], row["part"], row["seq"], idx
                if edit == "I":
                    out.append((*place, None, None, None, None, _NAMES[_ASKS[state]]))
                    state = _NEXT[state]
                    continue
                dated, turn, role, digest = keys[at]
                at += 1
                if edit == "D":
                    continue
                kept = edit == "K"
                out.append((*place, dated, turn, role, digest, role if kept else _NAMES[_ASKS[state]]))
                state = SYSTEM if kept and state == START and role[:1] == "s" else _NEXT[state]
        yield _frame(out, _LINES)


_HASHES = "conv string, repaired_sha256 string"


def _hashed(frames):
    conv, own, out = None, None, []
    for frame in frames:
        for name, said, text in zip(frame["conv"], frame["said"], frame["text"]):
            line = f"{said}:{text}".encode("utf-8", "replace")
            if name == conv:
                own.update(b"\n" + line)
                continue
            if own is not None:
                out.append((conv, own.hexdigest()))
            conv, own = name, hashlib.sha256(line)
        if len(out) >= 1000:
            yield _frame(out, _HASHES)
            out = []
    if own is not None:
        out.append((conv, own.hexdigest()))
    yield _frame(out, _HASHES)


_KEY = ["conv", "dated", "turn", "role", "digest"]


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """What was found and done in each conversation, and the repaired messages.

    The first has ``conv`` and the counts, cost and audit; the second one row per message that is left or put in:
    ``conv, part, seq, idx`` (its order), ``said`` (the role) and ``text``.
    """
    after = damaged(rows, conv, turn, role, text)
    order = ["conv", "dated", "turn", "role", "head", "digest"]
    blocks = written(turn_rows(after).repartitionByRange(*order).sortWithinPartitions(*order)
                     .mapInPandas(_blocks, _BLOCKS), "blocks")
    narrow = blocks.drop("live", "at_turn", "at_dated", "at_role", "at_digest")
    chosen = written(narrow.repartition("conv").sortWithinPartitions("conv", "part", "seq")
                     .mapInPandas(_join_blocks, _CHOSEN), "chosen")
    found = chosen.where("seq is null").drop("part", "seq", "entry", "edits")
    steps = chosen.where("seq is not null").select("conv", "part", "seq", "entry", "edits")
    held = blocks.select("conv", "part", "seq", "at_turn", "at_dated", "at_role", "at_digest")
    lines = held.join(steps, ["conv", "part", "seq"]).mapInPandas(_lines, _LINES)
    texts = (after.select("conv", "dated", "turn", "role", _digest(F.col("text")).alias("digest"), "text")
             .groupBy(*_KEY).agg(F.first("text").alias("text")))
    messages = lines.join(texts, _KEY, "left").select(
        "conv", "part", "seq", "idx", "said", F.coalesce("text", F.lit("")).alias("text"))
    return found, messages


def repair_report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """One row for every conversation of ``rows``: the faults, the repair's cost, audit and hash."""
    found, messages = repair(rows, conv, turn, role, text)
    hashes = (messages.repartition("conv").sortWithinPartitions("conv", "part", "seq", "idx")
              .select("conv", "said", "text").mapInPandas(_hashed, _HASHES))
    every = rows.select(rows[conv].alias("conv_id")).distinct().withColumn(
        "conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    out = every.join(found, "conv", "left").join(hashes, "conv", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
