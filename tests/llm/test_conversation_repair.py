"""The repair of conversations against a plain dynamic programme, row by row."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from tallyspark.llm import conversation_repair as repair
from tallyspark.llm import queries
from tallyspark.llm.common import ship

SCHEMA = "conv_id long, turn long, role string, text string, conv string, seq int, digest string"
EDGES = {"": {"u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}  # last initial -> role wanted -> new last
ASKS = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def cheapest(rows):
    """Least (cost, audit, lines) over all edits; ``rows`` are (role, text, forced, cut)."""
    states = {"": (0, "", ())}

    def put(to, key, value):
        if key not in to or value[:2] < to[key][:2]:
            to[key] = value

    def insertions(states):
        for _ in range(3):
            for last, (cost, audit, lines) in list(states.items()):
                put(states, ASKS[last][0], (cost + 3, audit + "I", lines + (ASKS[last] + ":",)))
        return states

    for role, text, forced, cut in rows:
        after = {}
        for last, (cost, audit, lines) in insertions(dict(states)).items():
            put(after, last, (cost + 4, audit + "D", lines))
            if forced:
                continue
            if role[:1] == ASKS[last][0] or (last == "" and role[:1] == "s"):
                put(after, role[:1], (cost + 3 * cut, audit + "K", lines + (f"{role}:{text}",)))
            put(after, ASKS[last][0], (cost + 3 + 3 * cut, audit + "R", lines + (f"{ASKS[last]}:{text}",)))
        states = after
    return min(v for last, v in insertions(states).items() if last in ("", "a"))


def brute(rows):
    """{conv_id: report} of ``(conv_id, turn, role, text)`` rows."""
    by = {}
    for conv, turn, role, text in rows:
        held = by.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        held += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, held in by.items():
        held.sort(key=lambda h: (h[0] is not None, h[0] or 0, h[1], h[2][:64], hashlib.md5(h[2].encode()).hexdigest()))
        seen, plain, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in held:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not ink else "duplicate" if (role, text) in seen
                     else "truncated" if ink[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            plain.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in held if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(held)]
        cost, audit, lines = cheapest(plain)
        out[conv] = counts | {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
    return out


def made(seed, conversations, most):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "s", "ua"]
    texts = ["Yes.", "No", "Why?", "", " \t\n", "same text, twice.", None, "ends.  \n", "é漢!", "x" * 70 + "a", "x" * 70 + "b."]
    rows = []
    for c in range(conversations):
        for t in range(r.randint(1, most)):
            row = (c if c else None, r.choice([t, t, t, r.randint(-3, 3), None]), r.choice(roles), r.choice(texts))
            rows += [row] * r.choice([1, 1, 1, 1, 2, 5])
    return rows


def frame(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*row, "clash", 5, "x") for row in rows], SCHEMA)


def compare(spark, rows):
    want = brute(rows)
    got = repair.repair_report(frame(spark, rows)).collect()
    assert len(got) == len(want)
    for row in got:
        own = row.asDict()
        assert {k: own[k] for k in want[row["conv_id"]]} == want[row["conv_id"]], row["conv_id"]


def test_matches_brute_force(spark):
    compare(spark, made(7, 120, 12))


def test_long_conversations_cross_blocks_and_tasks(spark):
    """A conversation of hundreds of turns lies in many blocks and ranges; one row comes three thousand times."""
    r = random.Random(3)
    long = [(5, t, r.choice(["user", "assistant"]), r.choice([f"turn {t}.", f"cut {t}", "again."])) for t in range(700)]
    one = [(6, 2, "assistant", "the same.")] * 3000
    compare(spark, long + one + made(8, 12, 6))


def test_search_equals_all_edits(spark):
    r = random.Random(2)
    for _ in range(300):
        kinds = "".join(r.choice("suaxSUAX") for _ in range(r.randint(0, 9)))
        rows = [({"s": "s", "u": "u", "a": "a", "x": "x"}[k.lower()], "", False, k.isupper()) for k in kinds]
        assert repair.search(kinds, repair.START, repair.END) == cheapest(rows)[:2], kinds


def test_empty_table_and_lost_conversations(spark):
    assert repair.repair_report(frame(spark, [])).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repair_report(frame(spark, [(gone, 0, "user", "Hello.")])).first()
    assert (row["cost"], row["audit"], row["repaired_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest())


def test_sql_of_the_query(spark, tmp_path):
    """The registered SQL agrees with brute force on the odd rows too."""
    rows = made(11, 60, 9)
    frame(spark, rows).select("conv_id", "turn", "role", "text").coalesce(1).write.parquet(str(tmp_path / "c"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    want = brute(rows)
    cur = db.execute(queries.oracle_sql()["op13_conversation_repair"])
    names = [d[0] for d in cur.description]
    for values in cur.fetchall():
        own = dict(zip(names, values))
        assert {k: own[k] for k in want[own["conv_id"]]} == want[own["conv_id"]]
